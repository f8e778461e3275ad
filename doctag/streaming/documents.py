"""Streams of documents. Cleaning, tokenizing, rule tagging and prediction keep
no state, so the batch functions apply to a stream unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from doctag.operators.rules import RuleBook, tag_documents
from doctag.schema import RAW_DOCUMENT


def read_document_stream(
    spark: SparkSession, path: str, schema: StructType = RAW_DOCUMENT, form: str = "json"
) -> DataFrame:
    """New files of a folder as a stream of documents."""
    return spark.readStream.schema(schema).format(form).load(path)


def tag_stream(stream: DataFrame, book: RuleBook, path: str, checkpoint: str) -> StreamingQuery:
    """Tag everything that has arrived and append it to a snapshot."""
    return (
        tag_documents(stream, book)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

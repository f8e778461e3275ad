"""Document sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from doctag.schema import RAW_DOCUMENT, document_set_schema
from doctag.sources.json_lists import read_list_items


REQUIRED = tuple(RAW_DOCUMENT.fieldNames())


def _record(value: Column, schema: StructType, required: Sequence[str]) -> Column:
    """A JSON object as a struct; a malformed one, or one without a required key, is an
    error. A key that is there may be null."""
    keys = F.json_object_keys(value)
    missing = F.array_except(F.array(*[F.lit(n) for n in required]).cast("array<string>"), keys)
    text = F.concat(F.lit("document without "), F.array_join(missing, ", "), F.lit(": "), F.left(value, F.lit(80)))
    checked = F.when(F.size(missing) > 0, F.raise_error(text).cast("string")).otherwise(value)
    return F.from_json(checked, schema, {"mode": "FAILFAST"})


def read_json_lines(
    spark: SparkSession, path: str, schema: StructType = RAW_DOCUMENT, required: Sequence[str] = REQUIRED
) -> DataFrame:
    """Documents, one JSON object per line; empty lines are skipped."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(_record(F.col("value"), schema, required).alias("_r")).select("_r.*")


def read_json_array(
    spark: SparkSession, path: str, schema: StructType = RAW_DOCUMENT, required: Sequence[str] = REQUIRED
) -> DataFrame:
    """Documents in files that are one JSON list each. A large file is read by several
    tasks, see :mod:`doctag.sources.json_lists`; one that is no list is an error at once."""
    items = read_list_items(spark, path)
    return items.select(_record(F.col("value"), schema, required).alias("_r")).select("_r.*")


def documents(
    spark: SparkSession,
    rows: DataFrame | Sequence[dict] | None = None,
    add_column: str | list[str] | None = None,
) -> DataFrame:
    """A document set from a DataFrame, from rows in memory, or a blank one with
    the declared columns."""
    if isinstance(rows, DataFrame):
        return rows
    if rows is None:
        return spark.createDataFrame([], document_set_schema(add_column))
    if isinstance(rows, (list, tuple)) and all(isinstance(r, dict) for r in rows):
        names = RAW_DOCUMENT.fieldNames()
        return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], RAW_DOCUMENT)
    raise TypeError("documents are a DataFrame, a list of dicts, or None")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_snapshot(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def write_json_records(df: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON record per line in UTF-8, nulls included."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_report(report: DataFrame, path: str, mode: str = "error") -> None:
    """A report with one folder per outcome."""
    report.write.mode(mode).partitionBy("outcome").json(path)

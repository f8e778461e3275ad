"""Schemas of the documents, vocabularies and rule books."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

RAW_DOCUMENT = StructType([StructField(c, StringType()) for c in ("title", "desc", "tag")])

DOCUMENT_SET = StructType(
    [StructField(c, StringType()) for c in ("job_id", "title", "desc", "tag", "title_seg", "desc_seg")]
    + [StructField("sampled", BooleanType())]
)

VOCABULARY = StructType(
    [
        StructField("token", StringType()),
        StructField("frequency", LongType()),
        StructField("rank", LongType()),
    ]
)

RULE_FIELDS = ("title_inc", "title_exc", "desc_inc", "desc_exc")

RULE_BOOK = StructType(
    [StructField(c, StringType()) for c in RULE_FIELDS]
    + [
        StructField("level", IntegerType()),
        StructField("tag", StringType()),
        StructField("suppress", BooleanType()),
    ]
)


def document_set_schema(add_column: str | list[str] | None = None) -> StructType:
    """The document set schema with the caller's extra columns, all strings."""
    if add_column is None:
        names = []
    elif isinstance(add_column, str):
        names = [add_column]
    elif isinstance(add_column, list):
        names = add_column
    else:
        raise TypeError("add_column must be a str or a list of str")
    return StructType(DOCUMENT_SET.fields + [StructField(n, StringType()) for n in names])

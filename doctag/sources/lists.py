"""Word lists, charsets and rule books: small settings read on the driver."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doctag.operators.rules import RuleBook, check_patterns, rule_book
from doctag.schema import RULE_BOOK, RULE_FIELDS

def _lines(spark: SparkSession, path: str) -> set[str]:
    """The distinct lines of a file, or of all files of a folder."""
    text = spark.read.text(path, wholetext=True)
    return {r.line for r in text.select(F.explode(F.split("value", "\n")).alias("line")).distinct().collect()}


def read_word_list(spark: SparkSession, path: str) -> frozenset[str]:
    """The words of a file or a folder of files, one per line. A trailing newline adds
    the empty word."""
    return frozenset(_lines(spark, path))


def read_word_table(spark: SparkSession, path: str) -> DataFrame:
    """The distinct words as a table ``token``, for lists too long for the driver."""
    return spark.read.text(path).select(F.col("value").alias("token")).distinct()


def read_charset(spark: SparkSession, path: str) -> frozenset[str]:
    """Legal characters, one per line: the character itself or four hex digits."""
    lines = _lines(spark, path)
    codes = {int(line, 16) for line in lines if len(line) == 4}
    return frozenset(line for line in lines if len(line) == 1) | {chr(c) for c in codes}


def _rules(spark: SparkSession, path: str) -> list[dict]:
    """The rules of the JSON lists in ``path``, in the order of the file names. A file
    that is no such list, or a rule without one of its fields, is an error."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    rules, files = [], text.orderBy("file").collect()
    if not files:
        raise ValueError(f"{path} holds no rules")
    for row in files:
        listed = json.loads(row.value)
        if not isinstance(listed, list):
            raise ValueError(f"{row.file} is no JSON list of rules")
        rules += [{name: rule[name] for name in RULE_BOOK.fieldNames()} for rule in listed]
    if any(r["level"] is None for r in rules):
        raise ValueError("a rule without a level")
    return rules


def read_rule_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rules of a JSON list with their position in it, levels as texts."""
    rows = [(n, *[r[f] for f in RULE_FIELDS], str(r["level"]), r["tag"], r["suppress"]) for n, r in enumerate(_rules(spark, path))]
    fields = ", ".join(f"{f} string" for f in RULE_FIELDS)
    return spark.createDataFrame(rows, f"position int, {fields}, level string, tag string, suppress boolean")


def read_rule_book(spark: SparkSession, path: str) -> RuleBook:
    """The active rules of a JSON list; invalid patterns are reported. Levels are
    numbers when all of them are, else texts in their own order."""
    rules = _rules(spark, path)
    if not all(isinstance(r["level"], int) for r in rules):
        rules = [{**r, "level": str(r["level"])} for r in rules]
    book = rule_book(rules)
    check_patterns(spark, book)
    return book

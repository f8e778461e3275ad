"""TF-IDF in long form: ``key, field, term, weight``.

The fitted table works for a vocabulary of any length; the vector form for Spark
ML is in :mod:`doctag.plans.training`.

Most n-grams are rare, and a fit with a lower limit drops them. They are not shuffled to
find that out: all terms are first counted in a fixed number of hashed buckets. A bucket
holds at least as many occurrences as any of its terms has documents, so the terms of
buckets below the limit are rare, and only the others are counted one by one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doctag.functions.tokens import as_terms, distinct_terms, term_counts
from doctag.operators.lemmas import fits_broadcast, join_small_or_salted
from doctag.session import durable


@dataclass(frozen=True)
class FittedTfidf:
    """``terms``: ``field, term, df, idf``; one block of rows per field. ``limits`` are
    the largest and smallest document frequency that each field was fitted with."""

    terms: DataFrame
    n_docs: int
    fields: tuple[str, ...]
    limits: Mapping[str, tuple[float | int, float | int]]


def term_list(df: DataFrame, col: str) -> Column:
    """A token column as an array; token texts are lower-cased and split."""
    if dict(df.dtypes)[col] == "string":
        return F.split(F.lower(col), r"\|")
    return F.col(col)


def term_frequency(df: DataFrame, key: str, fields: Mapping[str, str]) -> DataFrame:
    """``key, field, term, tf``, counted inside each row."""

    def of_field(name, col):
        return F.transform(
            term_counts(term_list(df, col)),
            lambda t: F.struct(
                F.lit(name).alias("field"), t["term"].alias("term"), t["tf"].alias("tf")
            ),
        )

    per_field = [of_field(name, col) for name, col in fields.items()]
    return df.select(key, F.inline(F.concat(*per_field)))


def field_document_frequency(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """``field, term, df`` of all fields from one scan."""

    def of_field(name, col):
        return F.transform(
            distinct_terms(term_list(df, col)),
            lambda t: F.struct(F.lit(name).alias("field"), t.alias("term")),
        )

    per_field = [of_field(name, col) for name, col in fields.items()]
    return (
        df.select(F.inline(F.concat(*per_field)))
        .groupBy("field", "term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


# Buckets of a field for the first count, buckets of a shuffled row, and the lower limit, as
# a share of the documents, under which there is no first count: it would drop too little.
BUCKETS, BLOCK, MIN_SHARE = 1 << 20, 1 << 12, 0.002


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def full_buckets(df: DataFrame, fields: Mapping[str, str], low: Mapping[str, float]) -> DataFrame:
    """``_field, _bucket``: the buckets whose terms, repeats included, occur as often as the
    lower limit ``low`` of their field asks for. At most one row per bucket and field. A
    task keeps one array of counts per field, and only those arrays are shuffled."""
    least = [float(low[name]) for name in fields]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(least), BUCKETS), "int64")
        for batch in batches:
            for i, column in enumerate(batch.columns):
                counts[i] += np.bincount(column.flatten().to_numpy(zero_copy_only=False), minlength=BUCKETS)
        for i, j in zip(*np.nonzero(counts.reshape(len(least), -1, BLOCK).any(2))):
            part = counts[i, j * BLOCK : (j + 1) * BLOCK]
            part = part.astype(np.min_scalar_type(part.max())).tobytes()
            yield pa.RecordBatch.from_pydict({"_field": pa.array([i], pa.int32()), "_block": pa.array([j], pa.int32()), "counts": [part]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for i, j, part in zip(*(c.to_pylist() for c in batch.columns)):
                sums[i, j] = sums.get((i, j), 0) + np.frombuffer(part, f"u{len(part) // BLOCK}").astype("int64")
        for (i, j), total in sums.items():
            full = np.flatnonzero(total >= least[i])
            yield pa.RecordBatch.from_pydict(
                {"_field": pa.array(np.full(len(full), i), pa.int32()), "_bucket": pa.array(full + j * BLOCK, pa.int32())}
            )

    buckets = [F.transform(as_terms(term_list(df, col)), _bucket).alias(f"_{i}") for i, col in enumerate(fields.values())]
    parts = df.select(*buckets).mapInArrow(count, "_field int, _block int, counts binary")
    return parts.repartition("_field", "_block").mapInArrow(add, "_field int, _bucket int")


def frequent_document_frequency(
    df: DataFrame, fields: Mapping[str, str], low: Mapping[str, float], n_docs: int
) -> DataFrame:
    """:func:`field_document_frequency` of the terms that may have ``low`` documents, and
    of some that have fewer; reads ``df`` twice."""
    if min(low.values()) < max(MIN_SHARE * n_docs, 2):
        return field_document_frequency(df, fields)
    names = F.array(*[F.lit(name) for name in fields])
    each = F.array(
        *[
            F.struct(F.lit(i).alias("_field"), distinct_terms(term_list(df, col)).alias("terms"))
            for i, col in enumerate(fields.values())
        ]
    )
    terms = df.select(F.inline(each)).select("_field", F.explode("terms").alias("term"))
    full = durable(full_buckets(df, fields, low))
    return (
        terms.withColumn("_bucket", _bucket(F.col("term")))
        .join(F.broadcast(full), ["_field", "_bucket"], "left_semi")
        .groupBy(F.get(names, "_field").alias("field"), "term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def _limit(n_docs: int, df: float | int) -> float | int:
    return df * n_docs if isinstance(df, float) else df


def _between(n_docs: int, max_df: float | int, min_df: float | int) -> Column:
    low, high = _limit(n_docs, min_df), _limit(n_docs, max_df)
    if high < low:
        raise ValueError("max_df corresponds to fewer documents than min_df")
    return (F.col("df") >= low) & (F.col("df") <= high)


def prune(
    counts: DataFrame, n_docs: int, max_df: float | int = 1.0, min_df: float | int = 1
) -> DataFrame:
    """Terms with ``min_df <= df <= max_df``; a float is a share of the documents,
    an int a number of them."""
    return counts.filter(_between(n_docs, max_df, min_df))


def smooth_idf(n_docs: int) -> Column:
    return F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0


def fit_tfidf(
    df: DataFrame,
    fields: Mapping[str, str] | str,
    max_df: float | int | Mapping[str, float | int] = 1.0,
    min_df: float | int | Mapping[str, float | int] = 1,
) -> FittedTfidf:
    """Vocabulary and idf of each field; ``fields`` maps a name to a token column, and
    the limits are for all fields or by field. The fitted table is made durable, as
    every transform reads it."""
    if isinstance(fields, str):
        fields = {fields: fields}
    limits = {
        name: tuple(m[name] if isinstance(m, Mapping) else m for m in (max_df, min_df)) for name in fields
    }
    n_docs = df.count()
    kept = F.lit(False)
    for name, (high, low) in limits.items():
        kept = kept | ((F.col("field") == name) & _between(n_docs, high, low))
    low = {name: _limit(n_docs, least) for name, (_, least) in limits.items()}
    counts = frequent_document_frequency(df, fields, low, n_docs).filter(kept)
    terms = durable(counts.withColumn("idf", smooth_idf(n_docs)))
    return FittedTfidf(terms, n_docs, tuple(fields), limits)


def save_tfidf(fitted: FittedTfidf, path: str) -> None:
    """The table of terms, and what it was fitted with."""
    about = json.dumps({"n_docs": fitted.n_docs, "fields": fitted.fields, "limits": fitted.limits})
    spark = fitted.terms.sparkSession
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/about")
    fitted.terms.write.parquet(f"{path}/terms")


def load_tfidf(spark: SparkSession, path: str) -> FittedTfidf:
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    limits = {name: tuple(pair) for name, pair in about["limits"].items()}
    terms = spark.read.parquet(f"{path}/terms")
    return FittedTfidf(terms, about["n_docs"], tuple(about["fields"]), limits)


def _known_counts(df: DataFrame, vocabulary: DataFrame, key: str, fields: Mapping[str, str]) -> DataFrame:
    """``key, field, term, idf, tf`` of the known terms of each row of ``df``, which are the few that
    are counted; a grouping that begins with the key."""
    names = F.array(*[F.lit(name) for name in fields])
    # As in term_frequency, a row without one of its texts has no terms. A filter would make
    # the n-grams once more, before the rows are hashed.
    whole = reduce(and_, [F.col(col).isNotNull() for col in fields.values()])
    each = F.array(
        *[
            F.struct(F.lit(i).alias("_field"), F.when(whole, as_terms(term_list(df, col))).alias("terms"))
            for i, col in enumerate(fields.values())
        ]
    )
    rows = df.select(key, F.monotonically_increasing_id().alias("_row"), F.inline(each))
    rows = rows.select(key, "_row", F.get(names, "_field").alias("field"), F.explode("terms").alias("term"))
    return (
        rows.join(F.broadcast(vocabulary), ["field", "term"])
        .groupBy(key, "_row", "field", "term", "idf")
        .agg(F.count(F.lit(1)).alias("tf"))
        .drop("_row")
    )


def transform_tfidf(
    df: DataFrame, fitted: FittedTfidf, key: str, fields: Mapping[str, str] | str, keyed: bool = False
) -> DataFrame:
    """``key, field, term, weight`` with unit length per document and field.
    Terms outside the vocabulary are dropped before anything is shuffled. ``keyed`` says that
    ``df`` is hashed by its key; then nothing is, unless the vocabulary is too long to be sent along."""
    if isinstance(fields, str):
        fields = {fields: fields}
    vocabulary = fitted.terms.select("field", "term", "idf")
    if keyed and fits_broadcast(vocabulary):
        known = _known_counts(df, vocabulary, key, fields)
    else:
        known = join_small_or_salted(
            term_frequency(df, key, fields), vocabulary, ["field", "term"], "inner", key
        )
    known = known.withColumn("weight", F.col("tf") * F.col("idf"))
    # One window per document serves all fields, so the rows stay partitioned by
    # the key for whatever joins or groups them next.
    square = F.col("weight") * F.col("weight")
    norms = [
        F.when(
            F.col("field") == name,
            F.sqrt(F.sum(F.when(F.col("field") == name, square)).over(W.partitionBy(key))),
        )
        for name in fields
    ]
    weight = F.col("weight") / F.coalesce(*norms)
    return known.select(key, "field", "term", weight.alias("weight"))


def terms_by_idf(fitted: FittedTfidf, field: str, k: int | None = None) -> DataFrame:
    out = (
        fitted.terms.filter(F.col("field") == field)
        .select("term", "idf")
        .orderBy(F.desc("idf"), "term")
    )
    return out if k is None else out.limit(k)

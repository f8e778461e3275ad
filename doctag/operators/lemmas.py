"""Lemmas and stop words from tables of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doctag.functions.tokens import lemma_candidate

# What may be sent along with every task: both bounds are checked first.
BROADCAST_ROWS = 1_000_000
BROADCAST_CHARS = 100_000_000
SALTS = 16


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the rows and their characters stay below the bounds."""
    chars = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in df.columns]))
    rows, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(chars), F.lit(0))).first()
    return rows <= BROADCAST_ROWS and total <= BROADCAST_CHARS


def join_small_or_salted(left: DataFrame, right: DataFrame, on: list[str], how: str, spread_by: str):
    """Join where a few values of ``on`` may hold much of the left side. The right
    side, one row per key, is sent along when it is short enough; otherwise it is
    repeated once per salt, so a frequent key is shared by several tasks."""
    if fits_broadcast(right):
        return left.join(F.broadcast(right), on, how)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
    return salted.join(right.select("*", salts), [*on, "_salt"], how).drop("_salt")


def _each(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """``key, _pos, token``. For the plain form Spark first tests whether there are tokens, and
    would make them once more to do so."""
    return df.select(key, F.posexplode_outer(tokens).alias("_pos", "token")).filter("_pos IS NOT NULL")


def lemmatize_by_join(
    df: DataFrame, key: str, tokens: str, lemmas: DataFrame, keywords=(), skip_z: bool = True
) -> DataFrame:
    """Replace tokens by the ``lemma`` of the ``token, lemma`` table."""
    each = _each(df, key, tokens)
    each = join_small_or_salted(each, lemmas.select("token", "lemma"), ["token"], "left", "_pos")
    wanted = lemma_candidate(F.col("token"), keywords, skip_z) & F.col("lemma").isNotNull()
    each = each.withColumn("token", F.when(wanted, F.col("lemma")).otherwise(F.col("token")))
    return _regroup(df, each, key, tokens)


def drop_words_by_join(df: DataFrame, key: str, tokens: str, stops: DataFrame) -> DataFrame:
    """Drop the tokens listed in the one-column table ``token``."""
    each = _each(df, key, tokens)
    listed = stops.select("token").distinct()
    return _regroup(df, join_small_or_salted(each, listed, ["token"], "left_anti", "_pos"), key, tokens)


def _regroup(df: DataFrame, each: DataFrame, key: str, tokens: str) -> DataFrame:
    """Tokens back into one array per document, in their order. A group is the
    tokens of one document, which were one row before."""
    rows = each.groupBy(key).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_pos", "token"))), lambda x: x["token"]
        ).alias("_tokens")
    )
    empty = F.array().cast("array<string>")
    return (
        df.join(rows, key, "left")
        .withColumn(tokens, F.coalesce("_tokens", empty))
        .drop("_tokens")
    )

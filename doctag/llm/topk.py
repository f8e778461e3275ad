"""Exact top-k by inner product: exhaustive term-at-a-time accumulation.

A vector component is a term; a block of candidates is an inverted index of
postings (candidate, weight) per term. Every term of a block of query rows
scatters its postings, times the query's weight, into a dense array of scores;
the k best of each block are selected by partition and merged per query.

The query set meets all candidates in blocks: a task holds one block of either
kind. Both block sizes are fixed, so memory does not depend on the tables.

Defined cases: vectors that are null or hold a null or non-finite component, and
rows with a null id, take no part; an empty vector scores 0 with everything, and a
missing component counts as 0; ties go to the smaller id; a repeated row is a
candidate as often as it occurs; a query id that occurs on several rows is asked
once, with its smallest vector, and leaves out all rows of its own; empty tables give an empty result.
Scores are exact; beyond the range of a long they are cut to it before they are
compared.
Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doctag.llm.registry import durable, query, ship, table

SCALE = 64
CANDIDATES = 1 << 14
QUERIES_PER_BLOCK = 1 << 11
# Queries whose dense score arrays are held at a time.
SCORES = 64


def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, as double."""

    def whole(x: Column) -> Column:
        y = x.cast("double") * F.lit(float(scale))
        # Doubles from 2^52 on are whole numbers, some too large for a long.
        return F.when(F.abs(y) < F.lit(float(1 << 52)), F.floor(y).cast("double")).otherwise(y)

    return F.transform(vector, whole)


class Postings:
    """Inverted index of a block: for each term the candidates that have it, and
    their weights."""

    def __init__(self, vectors: list[np.ndarray]):
        width = max(map(len, vectors), default=0)
        dense = np.zeros((len(vectors), width))
        for row, vector in zip(dense, vectors):
            row[: len(vector)] = vector
        top = np.abs(dense).max(initial=0.0)
        self.largest = float(top)
        self.dense, self.lists = dense, []

    def prepare(self, kind: np.dtype | type) -> None:
        self.lists = []
        for term in self.dense.T:
            at = np.flatnonzero(term)
            weights = [int(x) for x in term[at]] if kind is object else term[at]
            # A term that all have needs no list of places.
            place = slice(None) if len(at) == len(term) else at
            self.lists.append((place, np.array(weights, kind)))


def accumulate(postings: Postings, queries: list[np.ndarray]) -> np.ndarray:
    """Scores of the queries (rows) against the block's candidates."""
    largest = max((float(np.abs(q).max(initial=0.0)) for q in queries), default=0.0)
    bound = largest * postings.largest * max(1, postings.dense.shape[1])
    kind = np.int32 if bound < 2**31 else np.int64 if bound < 2**62 else object
    if not postings.lists or postings.lists[0][1].dtype != kind:
        postings.prepare(kind)
    scores = np.zeros((len(queries), len(postings.dense)), kind)
    for row, vector in zip(scores, queries):
        for term in np.flatnonzero(vector[: len(postings.lists)]).tolist():
            place, weights = postings.lists[term]
            row[place] += weights * (int(vector[term]) if kind is object else kind(vector[term]))
    if kind is object:
        return np.clip(scores, -(2**63), 2**63 - 1).astype(np.int64)
    return scores


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best candidates; ``ids`` are in rising order."""
    at = np.flatnonzero(ids != own)
    score = scores[at]
    if len(at) > k:
        cut = np.partition(score, len(at) - k)[len(at) - k]
        above = np.flatnonzero(score > cut)
        pick = np.r_[above, np.flatnonzero(score == cut)[: k - len(above)]]
        at, score = at[pick], score[pick]
    return ids[at], score


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score`` of ``vectors(vec_id, vector)``, where
    ``vector`` is an array of whole doubles."""
    ship(vectors.sparkSession)
    rows = durable(vectors.withColumn("_query", F.coalesce(is_query, F.lit(False))))
    asked = durable(rows.filter("_query").groupBy("vec_id").agg(F.min("vector").alias("vector")))
    n, n_queries = rows.count(), asked.count()
    blocks, query_blocks = -(-n // CANDIDATES), -(-n_queries // QUERIES_PER_BLOCK)
    if not n_queries:
        return rows.select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")
        ).limit(0)

    def dealt(some: DataFrame, own: int, other: int, names: tuple[str, str]) -> DataFrame:
        """Puts each row into a block, by its place in the stored table, and sends
        it to the blocks of the other kind."""
        place = F.monotonically_increasing_id()
        block = F.pmod(F.xxhash64(place), F.lit(own)).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        return some.select("vec_id", "vector", block.alias(names[0])).withColumn(names[1], others)

    candidates = dealt(rows, blocks, query_blocks, ("_c", "_q"))
    queries = dealt(asked, query_blocks, blocks, ("_q", "_c"))

    def meet(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("vec_id", kind="stable")
        ids, index = block["vec_id"].to_numpy(np.int64), Postings(list(block["vector"]))
        out = []
        for at in range(0, len(asked) if len(block) else 0, SCORES):
            part = asked.iloc[at : at + SCORES]
            scores = accumulate(index, list(part["vector"]))
            for own, row in zip(part["vec_id"], scores):
                found, score = best(row, ids, own, k)
                out.append(pd.DataFrame({"query_id": own, "vec_id": found, "score": score.astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, np.int64)

    found = (
        queries.groupBy("_c", "_q")
        .cogroup(candidates.groupBy("_c", "_q"))
        .applyInPandas(meet, "query_id long, vec_id long, score long")
    )
    # At most k rows of each block and query.
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.e, c.e), lambda z: coalesce(z[1] * z[2], 0)))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 20
"""


@query("op4_topk", SQL)
def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best partners of every 20th vector."""
    rows = table(spark, sf_dir, "embeddings").filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    vectors = rows.select("vec_id", quantized(F.col("embedding")).alias("vector"))
    return top_k(vectors, F.col("vec_id") % 20 == 0)

"""Near-duplicate embeddings by an inverted multi-index.

Vectors are split into halves; each half has its own codebook, and the pairs of
codes form a grid of cells. Every vector lies in one cell and visits the cells
nearest to it, by the sum of the distances of its halves, in the order of a
multi-sequence traversal. How many cells it visits follows from a target recall:
for sampled vectors, partners at exactly the wanted cosine are drawn, and the
rank of the partner's cell that covers the target is taken. All vectors are indexed
and all probe; pairs that meet in a cell are verified in double precision.

Equal vectors of a label are one node until the end, so copies cost nothing. Cells
with many rows are dealt to tasks in blocks. A task hands on only what grows with its
rows: link counts per vector, and a star of links per connected group.

Defined cases: rows with a null label or id, and vectors that are null, empty, zero
or hold null or non-finite components, link with nothing; vectors of different
length link with nothing of another length; repeated rows are vectors linked with
each other; an empty table gives an empty result. Other columns are not read. An id
is expected to stand for one vector of one label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doctag.llm.components import components, roots
from doctag.llm.registry import durable, query, ship, table
from doctag.llm.topk import usable

COSINE = 0.93
TARGET_RECALL = 0.995
#: The codebooks and the number of visits are fitted on at most this many vectors.
SAMPLE = 8192
# Vectors that a cell holds on average, and codes of a half.
PER_CELL, MIN_CODES, MAX_CODES = 256, 8, 128
ROUNDS = 8
BLOCK = 2048
# Vectors that are placed at a time.
ROWS = 512
SEED = 29


@dataclass
class MultiIndex:
    """Codebooks of the two halves, and how many cells a vector visits."""

    width: int
    books: list[np.ndarray]
    visits: int = 1

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        cut = (self.width + 1) // 2
        halves = (x[:, :cut], x[:, cut:])
        return [((h * h).sum(1)[:, None] + (c * c).sum(1) - 2 * h @ c.T) for h, c in zip(halves, self.books)]

    def cell(self, x: np.ndarray) -> np.ndarray:
        first, second = self.distances(x)
        return first.argmin(1) * len(self.books[1]) + second.argmin(1)

    def traversal(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The nearest cells of each vector, nearest first. Only the product of the
        nearest codes of either half can hold them: cell (i, j) of the sorted halves
        is preceded by at least (i + 1)(j + 1) - 1 others."""
        n = len(self.books[1])
        i, j = np.divmod(np.arange(len(self.books[0]) * n), n)
        i, j = (k[(i + 1) * (j + 1) <= self.visits] for k in (i, j))
        first, second = self.distances(x)
        a, b = np.argsort(first, 1, kind="stable"), np.argsort(second, 1, kind="stable")
        total = np.take_along_axis(first, a, 1)[:, i] + np.take_along_axis(second, b, 1)[:, j]
        order = np.argsort(total, 1, kind="stable")[:, : self.visits]
        return np.take_along_axis(a[:, i] * n + b[:, j], order, 1)


def codebook(x: np.ndarray, codes: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's rounds from drawn rows."""
    centers = x[rng.permutation(len(x))[:codes]].copy()
    for _ in range(ROUNDS):
        near = ((centers * centers).sum(1) - 2 * x @ centers.T).argmin(1)
        for c in range(len(centers)):
            if (near == c).any():
                centers[c] = x[near == c].mean(0)
    return centers


def fit_index(sample: np.ndarray, n_rows: int, cosine: float, recall: float) -> MultiIndex:
    rng = np.random.default_rng(SEED)
    width = sample.shape[1]
    codes = int(np.clip(np.sqrt(n_rows / PER_CELL), MIN_CODES, MAX_CODES))
    cut = (width + 1) // 2
    index = MultiIndex(width, [codebook(h, codes, rng) for h in (sample[:, :cut], sample[:, cut:])])
    noise = rng.normal(size=sample.shape)
    noise -= (noise * sample).sum(1, keepdims=True) * sample
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
    partner = index.cell(cosine * sample + np.sqrt(1 - cosine**2) * noise)
    index.visits = len(index.books[0]) * len(index.books[1])
    rank = (index.traversal(sample) == partner[:, None]).argmax(1)
    index.visits = int(np.quantile(rank, recall, method="higher")) + 1
    return index


def unit(vectors: pd.Series, width: int) -> np.ndarray:
    """The vectors, padded to ``width``, at length 1 in double precision."""
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors):
        row[: len(vector)] = vector
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


ENTRY = "label int, dim int, node long, copies long, cell int, home int, vector binary, visits binary"


def _entries(nodes: DataFrame, index: MultiIndex) -> DataFrame:
    """Every vector once per visited cell, its own included."""
    names = [c.split()[0] for c in ENTRY.split(", ")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = unit(part.column(4).to_numpy(zero_copy_only=False), index.width)
                visits = index.traversal(x).astype(np.int32)
                each = pa.array(np.repeat(np.arange(len(x)), visits.shape[1]))
                # The nearest cell is the vector's own.
                columns = [
                    *(part.column(i).take(each) for i in range(4)),
                    pa.array(visits.ravel()),
                    pa.array(visits[:, 0].copy()).take(each),
                    pa.array([row.tobytes() for row in x], pa.binary()).take(each),
                    pa.array([row.tobytes() for row in visits], pa.binary()).take(each),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return nodes.select("label", "dim", "node", "copies", "vector").mapInArrow(place, ENTRY)


def _rows(column: pd.Series, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


FOUND = "node long, root long, links long"


def _meet(cosine: float):
    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Probes against the members of one cell. A pair that meets in both its
        cells counts where the smaller node is the probe."""
        if not len(left) or not len(right):
            return pd.DataFrame({"node": [], "root": [], "links": []}, dtype=np.int64)
        x, y = _rows(left["vector"], np.float64), _rows(right["vector"], np.float64)
        probe, member = left["node"].to_numpy(), right["node"].to_numpy()
        seen, home = _rows(right["visits"], np.int32), left["home"].to_numpy()
        p, m = np.nonzero(x @ y.T >= cosine)
        again = (seen[m] == home[p][:, None]).any(1)
        use = (probe[p] < member[m]) | ((probe[p] > member[m]) & ~again)
        p, m = p[use], m[use]
        nodes, at = np.unique(np.r_[probe, member], return_inverse=True)
        a, b = at[: len(probe)][p], at[len(probe) :][m]
        links = np.bincount(a, right["copies"].to_numpy()[m], len(nodes))
        links += np.bincount(b, left["copies"].to_numpy()[p], len(nodes))
        out = pd.DataFrame({"node": nodes, "root": nodes[roots(len(nodes), a, b)], "links": links.astype(np.int64)})
        return out[links > 0]

    return meet


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, recall: float = TARGET_RECALL
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of ``vectors(vec_id, label, vector)``."""
    ship(vectors.sparkSession)
    rows = vectors.select("vec_id", F.col("label").cast("int"), F.col("vector").cast("array<double>"))
    fit = usable(F.col("vector")) & F.exists("vector", lambda x: x != 0) & F.col("vec_id").isNotNull()
    rows = durable(rows.withColumn("_fit", F.coalesce(fit & F.col("label").isNotNull(), F.lit(False))))
    some = rows.filter("_fit")
    nodes = durable(
        some.groupBy("label", "vector").agg(
            F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")
        ).withColumn("dim", F.size("vector"))
    )
    n, width = nodes.agg(F.count(F.lit(1)), F.max("dim")).first()
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if n:
        drawn = nodes.orderBy(F.xxhash64("node", "label")).limit(SAMPLE).select("vector").toPandas()
        index = fit_index(unit(drawn["vector"], width), n, cosine, recall)
        found = durable(_links(_entries(nodes, index), cosine))
        links = found.groupBy("node").agg(F.sum("links").alias("_links"))
        linked = components(found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
        # Only linked and copied nodes need a join; they come back to the rows by content.
        known = (
            nodes.join(links, "node", "left")
            .join(linked.withColumnRenamed("component", "_component"), "node", "left")
            .filter("_links IS NOT NULL OR copies > 1")
            .select(
                F.col("label").alias("_label"),
                F.col("vector").alias("_vector"),
                (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_n"),
                F.coalesce("_component", "node").alias("_component"),
            )
        )
        same = F.col("_fit") & (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector"))
        alone = rows.join(known, same, "left").select(
            "vec_id",
            F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("_component", "vec_id").alias("component_id"),
        )
    return alone.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _links(entries: DataFrame, cosine: float) -> DataFrame:
    """Meets probes and members cell by cell. A crowded cell is dealt to tasks in
    blocks of rows, so that a task holds two blocks whatever the cell's size."""
    entries = durable(entries)
    cell = ["label", "dim", "cell"]
    crowded = durable(
        entries.groupBy(*cell)
        .agg(
            F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_ps"),
            F.ceil(F.sum((F.col("home") == F.col("cell")).cast("int")) / BLOCK).cast("int").alias("_ms"),
        )
        .filter("_ps > 1 OR _ms > 1")
    )
    dealt = entries.join(crowded, cell, "left")

    def blocks(n: str) -> tuple:
        count = F.coalesce(F.col(n), F.lit(1))
        own = F.pmod(F.xxhash64("node"), count).cast("int")
        return own, F.explode(F.sequence(F.lit(0), count - 1))

    own_p, all_p = blocks("_ps")
    own_m, all_m = blocks("_ms")
    probes = dealt.withColumn("_p", own_p).withColumn("_m", all_m).drop("_ps", "_ms", "visits")
    members = dealt.filter("home = cell").withColumn("_m", own_m).withColumn("_p", all_p).drop("_ps", "_ms")
    # Both sides come from one table: the members' columns get an identity of their own.
    members = members.select(*[F.col(c).alias(c) for c in members.columns])
    keys = [*cell, "_p", "_m"]
    return probes.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInPandas(_meet(cosine), FOUND)


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, len(embedding) AS dim, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.dim = b.dim AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.93),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least_of AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(m.b, e.vec_id)) AS component_id,
       coalesce(e.vec_id = least(e.vec_id, coalesce(m.b, e.vec_id)), false) AS kept
FROM embeddings e LEFT JOIN counts c ON e.vec_id = c.a LEFT JOIN least_of m ON e.vec_id = m.a
"""


@query("op7_embeddings", SQL)
def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links and its component."""
    return near_duplicates(table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector"))

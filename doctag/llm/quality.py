"""Quality classifier: random-indexing word vectors pooled per document, then a
two-layer network with temperature-calibrated probabilities.

Every token (a run of letters, digits or other marks) has a row of a fixed-size
hashed table and a sparse random ternary index vector. A row's context vector is
the sum of the index vectors of its tokens and of their neighbours in all
documents; these sums are integers, so that the order of addition does not
matter. A document is the mean and the spread of its tokens' unit vectors, with the
mean likeness of neighbouring ones. The
network learns from a bounded, hash-drawn sample of the labelled rows, of which a
fifth only sets the temperature.

Defined cases: null and empty texts have zero features and get a score like any
other; labels without a document or with a null id or quality are not used; a
document labelled more than once takes its smallest label; repeated rows are
scored alike; without any usable label every score is 0.5; an empty table has no
scores. Labels with other columns, or documents with more or clashing ones, are
fine: only ``doc_id, text`` and ``doc_id, quality`` are read, and ``score`` writes
its own columns over those of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doctag.llm import bytetext
from doctag.llm.registry import query, ship, table

ROWS = 1 << 15
DIMENSIONS = 64
NONZERO = 3
WINDOW = 2
BLOCK_ROWS = 1 << 10
HIDDEN = 32
EPOCHS = 60
BATCH = 256
SEED = 17
#: The network sees at most this many labelled rows, whatever the corpus size.
SAMPLE = 20_000
THRESHOLD = 0.3
# Tokens whose vectors are gathered at a time.
GATHER = 1 << 14


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of every row's index vector."""
    rng = np.random.default_rng(SEED)
    return (
        rng.integers(0, DIMENSIONS, (NONZERO, ROWS), dtype=np.int64),
        rng.choice(np.array([-1, 1], np.int64), (NONZERO, ROWS)),
    )


def add_contexts(sums: np.ndarray, rows: np.ndarray, piece: np.ndarray) -> None:
    """Adds the index vectors of each token and its neighbours to its row."""
    places, signs = index_vectors_of_process()
    flat = rows * DIMENSIONS
    for step in range(WINDOW + 1):
        same = piece[step:] == piece[: len(piece) - step]
        left, right = flat[: len(flat) - step][same], flat[step:][same]
        pairs = [(left, right)] if step == 0 else [(left, right), (right, left)]
        for to, of in pairs:
            of = of // DIMENSIONS
            for j in range(NONZERO):
                np.add.at(sums, to + places[j][of], signs[j][of])


_index: list[tuple[np.ndarray, np.ndarray]] = []


def index_vectors_of_process() -> tuple[np.ndarray, np.ndarray]:
    if not _index:
        _index.append(index_vectors())
    return _index[0]


def _token_rows(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, piece = bytetext.tokens(data, starts)
    return (hashes & np.uint64(ROWS - 1)).astype(np.int64), piece


def word_table(docs: DataFrame) -> np.ndarray:
    """Unit word vectors, ``ROWS x DIMENSIONS``. A task sums its documents up in a
    table of that size and hands it on in blocks; blocks are added as a stream, scaled
    where they were added, and the driver gets the vectors alone, half as long."""
    ship(docs.sparkSession)
    schema = "block int, sums binary"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(ROWS * DIMENSIONS, np.int64)
        for batch in batches:
            for data, starts, _ in bytetext.slices(batch.column(0)):
                add_contexts(sums, *_token_rows(data, starts))
        if sums.any():
            yield from _blocks(dict(enumerate(np.split(sums, ROWS // BLOCK_ROWS))))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(part.as_buffer(), np.int64)
                sums[block] = sums[block] + part if block in sums else part
        yield from _blocks({block: unit_vectors(part) for block, part in sums.items()})

    parts = docs.select("text").mapInArrow(partial, schema)
    blocks = parts.repartition(ROWS // BLOCK_ROWS, "block").mapInArrow(total, schema)
    out = np.zeros((ROWS, DIMENSIONS), np.float32)
    for row in blocks.collect():
        at = row.block * BLOCK_ROWS
        out[at : at + BLOCK_ROWS] = np.frombuffer(row.sums, np.float32).reshape(BLOCK_ROWS, DIMENSIONS)
    return out


def unit_vectors(sums: np.ndarray) -> np.ndarray:
    out = sums.reshape(-1, DIMENSIONS).astype(float)
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return np.divide(out, norm, out=np.zeros_like(out), where=norm > 0).astype(np.float32)


def _blocks(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for block, part in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "sums"]
        )


def features(texts: pa.Array, words: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of the token vectors, how alike neighbours are
    (mean cosine, share of equal ones), and the log of the number of tokens, for
    every text."""
    n = len(texts)
    alike = np.zeros((n, 2))
    count, total, square = np.zeros(n), np.zeros((n, DIMENSIONS)), np.zeros((n, DIMENSIONS))
    for data, starts, rows in bytetext.slices(texts):
        token, piece = _token_rows(data, starts)
        owner = rows[piece]
        inside = owner[1:] == owner[:-1]
        pair, of = (token[:-1][inside], token[1:][inside]), owner[1:][inside]
        alike[:, 1] += np.bincount(of, pair[0] == pair[1], n)
        for at in range(0, len(of), GATHER):
            part = slice(at, at + GATHER)
            cosine = np.einsum("ij,ij->i", words[pair[0][part]], words[pair[1][part]])
            alike[:, 0] += np.bincount(of[part], cosine, n)
        for at in range(0, len(token), GATHER):
            vectors, of = words[token[at : at + GATHER]], owner[at : at + GATHER]
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            total[of[first]] += np.add.reduceat(vectors, first)
            square[of[first]] += np.add.reduceat(vectors * vectors, first)
            count[of[first]] += np.diff(np.append(first, len(of)))
    some = np.maximum(count, 1)[:, None]
    mean = total / some
    spread = np.sqrt(np.maximum(square / some - mean * mean, 0))
    return np.hstack([mean, spread, alike / some, np.log1p(count)[:, None]])


@dataclass
class Network:
    """A hidden layer of tanh units and a logistic output, divided by a temperature."""

    center: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float = 1.0

    def _layers(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w1, b1, w2, b2 = self.weights
        hidden = np.tanh(x @ w1 + b1)
        return hidden, hidden @ w2 + b2

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self._layers((x - self.center) / self.scale)[1]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def fit_network(x: np.ndarray, y: np.ndarray, calibration: np.ndarray) -> Network:
    """Adam on the cross entropy of the rows outside ``calibration``; the rows in it
    choose the temperature."""
    rng = np.random.default_rng(SEED)
    learn = ~calibration if (~calibration).any() else np.ones(len(x), bool)
    z, t = x[learn], y[learn].astype(float)
    center, scale = z.mean(0), z.std(0) + 1e-6
    z -= center
    z /= scale
    w = [
        rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, HIDDEN),
        np.zeros(1),
    ]
    net = Network(center, scale, w)
    m, v, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(z))
        for at in range(0, len(z), BATCH):
            rows = order[at : at + BATCH]
            a, b = z[rows], t[rows]
            hidden, out = net._layers(a)
            d = (1 / (1 + np.exp(-np.clip(out, -500, 500))) - b) / len(rows)
            dh = np.outer(d, w[2]) * (1 - hidden * hidden)
            grads = [a.T @ dh + 1e-4 * w[0], dh.sum(0), hidden.T @ d + 1e-4 * w[2], d.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                rate = 3e-3 * (1 - epoch / EPOCHS)
                w[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    if calibration.any():
        net.temperature = temperature(net.logits(x[calibration]), y[calibration])
    return net


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the smallest cross entropy, from a fine grid."""
    sign = np.where(y > 0, 1.0, -1.0)
    grid = np.geomspace(0.25, 8, 101)
    return float(grid[np.argmin([np.logaddexp(0, -sign * logits / t).mean() for t in grid])])


@dataclass
class QualityModel:
    words: np.ndarray
    network: Network | None

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), 0.5)
        return self.network.probability(features(texts, self.words))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Word vectors of all ``docs(doc_id, text)``; a network fitted on ``labels(doc_id,
    quality)`` outside the held-out fold."""
    words = word_table(docs)
    draw = F.xxhash64(F.lit("quality"), F.col("_id"))
    drawn = (
        labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y"))
        .filter(F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.min("_y").alias("_y"))
        .orderBy(draw, "_id")
        .limit(sample)
    )
    # At most ``sample`` ids are sent to every task.
    chosen = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("_id"))
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(2), shared.value).astype(np.float32)
            flat = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), flat], ["_id", "_y", "x"])

    # A copied document id can bring more rows than ids: the bound holds for them too.
    rows = (
        chosen.select("_id", "_y", "text")
        .mapInArrow(pool, "_id long, _y int, x binary")
        .orderBy(draw, "_id", "x")
        .limit(sample)
        .collect()
    )
    if not rows:
        return QualityModel(words, None)
    shared.destroy()
    y = np.array([r._y > 0 for r in rows], int)
    x = np.empty((len(rows), len(rows[0].x) // 4))
    # Each row is let go once it is copied.
    while rows:
        row = rows.pop()
        x[len(rows)] = np.frombuffer(row.x, np.float32)
    return QualityModel(words, fit_network(x, y, np.arange(len(x)) % 5 == 4))


def score(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` added. The model, whose size is fixed
    by its parameters, is broadcast; documents are neither shuffled nor stored."""
    ship(docs.sparkSession)
    keep = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    schema = T.StructType(
        [*keep, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    names = schema.names
    at = [f.name for f in keep].index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = shared.value.score(batch.column(at))
            columns = [*batch.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(*[f"`{f.name}`" for f in keep]).mapInArrow(judge, schema)


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score; rows of the held-out fold are never learnt from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )

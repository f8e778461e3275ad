"""Language identification with a string kernel.

The kernel of two texts is the number of character n-grams of 1 to ``LONGEST`` letters
that occur in both (a blended spectrum of presences), divided by the root of the product
of their own numbers. Letters are lowered, marks belong to letters, and every run of
anything else is one space. The spectrum is that of the landmarks: a bounded number of
training texts of each language, of whose n-grams the ``GRAMS`` most common count.

Nystroem features, the kernel with the landmarks times the inverse root of the kernel
among them, go into a ridge regression of +1 and -1 for each language against the rest,
fitted on a bounded sample of each language. A score is linear in the presences of a text:
so the presences of a batch of texts, a matrix, are multiplied with the product of all that
does not depend on the text. The scores become probabilities by a softmax whose sharpness
is chosen on a fifth of the sample.

Documents are neither shuffled nor stored. A text is read whole, in slices, whatever its
length; a batch is as wide as the spectrum and ``BATCH`` texts high.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a text without
any known n-gram gets the most frequent language; ties go to the more frequent language,
then to the smaller name; without anything to learn from, all are ``und`` with score 0;
documents with a null id are not learnt from and not held out; repeated rows are judged
alike; of more than ``MAX_LANGUAGES`` languages the most frequent are learnt; an empty table
has no predictions. ``identify`` writes its columns over those of the same name; others pass
through.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doctag.llm.registry import durable, query, ship, table

LONGEST = 4
GRAMS = 1 << 16
#: Bounds of what is learnt from: texts that are landmarks, of a language and in all, texts
#: of the sample, of a language and in all, and languages.
LANDMARKS, ALL_LANDMARKS = 32, 512
SAMPLE, ALL_SAMPLES = 512, 20_000
MAX_LANGUAGES = 1000
RIDGE = 1e-3
# Texts scored at a time, and code points handled at a time.
BATCH, SLICE = 64, 1 << 18
# Slots of a lookup table, as a power of two.
TABLE = 20
UNKNOWN = "und"
SPACE = 0x20

_FACTOR, _SPREAD = 0x9E3779B97F4A7C15, (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD)
_characters: list[np.ndarray] = []


def characters() -> tuple[np.ndarray, np.ndarray]:
    """What every code point counts as (a space for all but letters and marks), and which
    are letters."""
    if not _characters:
        counts, letters = np.full(0x110000, SPACE, np.uint32), np.zeros(0x110000, bool)
        for c in range(0x110000):
            kind = unicodedata.category(chr(c))[0]
            if kind in "LM":
                low = chr(c).lower()
                counts[c], letters[c] = ord(low) if len(low) == 1 else c, kind == "L"
        _characters[:] = [counts, letters]
    return _characters[0], _characters[1]


def normal(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``codes, rows, letter`` of slices of about ``SLICE`` code points: normal characters,
    the text that each belongs to, and whether it is a letter. A long text comes in
    several, each of which repeats the end of the one before."""
    group: list[int] = []
    room = SLICE
    for row, text in enumerate(texts):
        if len(text or "") >= SLICE:
            yield from _long(text, row)
            continue
        group.append(row)
        room -= len(text or "")
        if room < 0:
            yield _slice([f" {texts[r] or ''} " for r in group], group)
            group, room = [], SLICE
    if group:
        yield _slice([f" {texts[r] or ''} " for r in group], group)


def _slice(parts: list[str], of: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    counts, letters = characters()
    raw = np.frombuffer("".join(parts).encode("utf-32-le", "replace"), np.uint32)
    rows = np.repeat(np.array(of), np.array([len(p) for p in parts]))
    codes = counts[raw]
    space = codes == SPACE
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(space[1:] & space[:-1] & (rows[1:] == rows[:-1]))
    return codes[keep], rows[keep], letters[raw[keep]]


def _long(text: str, row: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    codes, letter = np.zeros(0, np.uint32), np.zeros(0, bool)
    for at in range(0, len(text), SLICE):
        part = text[at : at + SLICE]
        part = (" " if at == 0 else "") + part + (" " if at + SLICE >= len(text) else "")
        new, _, is_letter = _slice([part], [row])
        if len(codes) and codes[-1] == SPACE == new[0]:
            new, is_letter = new[1:], is_letter[1:]
        codes, letter = (np.concatenate([a[-(LONGEST - 1) :], b]) for a, b in ((codes, new), (letter, is_letter)))
        yield codes, np.full(len(codes), row), letter


def grams(codes: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of the n-grams of each length, and their texts."""
    wide = codes.astype(np.uint64)
    key = np.zeros(len(wide), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, LONGEST + 1):
            if len(wide) < n:
                return
            last = len(wide) - n + 1
            key = (key[:last] + wide[n - 1 :]) * np.uint64(_FACTOR)
            key ^= key >> np.uint64(29)
            inside = rows[:last] == rows[n - 1 :]
            yield key[inside], rows[:last][inside]


class Spectrum:
    """Numbers of the known n-grams. Keys that share a slot of a table go to the next one."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys.astype(np.uint64), np.uint64(0))
        self.size = len(keys)
        self.tables: list[np.ndarray] = []
        left = np.arange(self.size)
        while len(left) and len(self.tables) < len(_SPREAD):
            slots = self._slots(self.keys[left], len(self.tables))
            table = np.full(1 << TABLE, self.size, np.int32)
            table[slots[::-1]] = left[::-1]
            self.tables.append(table)
            left = left[table[slots] != left]
        self.rest = {int(self.keys[i]): int(i) for i in left}

    @staticmethod
    def _slots(keys: np.ndarray, which: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys * np.uint64(_SPREAD[which])) >> np.uint64(64 - TABLE)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or ``size`` for unknown ones."""
        out = np.full(len(keys), self.size, np.int32)
        left = np.arange(len(keys))
        for which, table in enumerate(self.tables):
            wanted = keys[left]
            at = table[self._slots(wanted, which)]
            hit = self.keys[at] == wanted
            out[left] = np.where(hit, at, self.size)
            # A free slot was never passed over.
            left = left[~hit & (at < self.size)]
        for i in left.tolist() if self.rest else ():
            out[i] = self.rest.get(int(keys[i]), self.size)
        return out

    def presences(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Which n-grams occur in each text, and which texts have a letter."""
        found, letters = np.zeros((len(texts), self.size + 1), np.uint8), np.zeros(len(texts), bool)
        flat = found.reshape(-1)
        for codes, rows, letter in normal(texts):
            letters[rows[letter]] = True
            for keys, of in grams(codes, rows):
                flat[of * (self.size + 1) + self.places(keys)] = 1
        return found[:, : self.size], letters


@dataclass
class LanguageModel:
    """``weights``: of each n-gram for each language; the score of a text is the sum over its
    n-grams, divided by the root of their number."""

    spectrum: Spectrum
    languages: list[str]
    weights: np.ndarray
    sharpness: float = 1.0

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        found, letters = self.spectrum.presences(texts)
        scores = margins(found, self.weights)
        best = scores.argmax(1)
        score = softmax(scores * self.sharpness)[np.arange(len(texts)), best]
        names = [self.languages[b] if known else UNKNOWN for b, known in zip(best, letters)]
        return names, np.where(letters, score, 0.0)


def margins(found: np.ndarray, weights: np.ndarray) -> np.ndarray:
    x = found.astype(np.float32)
    return (x @ weights) / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x.astype(float) - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common n-grams, over the root of the product of the numbers of each."""
    a, b = a.astype(float), b.astype(float)
    return (a @ b.T) / np.sqrt(np.maximum(np.outer(a.sum(1), b.sum(1)), 1))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _drawn(docs: DataFrame) -> tuple[DataFrame, list[str], int]:
    """``lang, text, rank`` of the sample, the languages, the more frequent first, and the
    number of landmarks of each. A draw depends on the document alone; those that can be
    among the first of their language are found by its count, so that few texts move."""
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.filter(F.col("text").rlike(r"\p{L}")).select("lang", "text", "doc_id")
    # At most MAX_LANGUAGES rows.
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    languages = [r.lang for r in counts]
    each = max(1, min(SAMPLE, ALL_SAMPLES // max(1, len(languages))))
    share = {r.lang: min(1.0, (3 * each + 30) / r["count"]) for r in counts}
    if not languages:
        return known.select("lang", "text", F.lit(1).alias("rank")).limit(0), [], 0
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id", "text"), F.lit(1 << 40))
    limit = F.element_at(F.create_map(*[F.lit(v) for kv in share.items() for v in kv]), F.col("lang"))
    order = W.partitionBy("lang").orderBy("_draw", "doc_id", "text")
    some = (
        known.withColumn("_draw", draw)
        .filter(F.col("lang").isin(languages) & (F.col("_draw") < limit * (1 << 40)))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= each)
    )
    return some.select("lang", "text", "rank"), languages, max(1, min(LANDMARKS, ALL_LANDMARKS // len(languages)))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            yield batch.slice(at, BATCH)


def _distinct_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-grams of every text, each once."""
    for batch in batches:
        for text in batch.column(0):
            seen = np.zeros(0, np.uint64)
            for codes, rows, _ in normal([text.as_py()]):
                seen = np.unique(np.concatenate([seen, *[keys for keys, _ in grams(codes, rows)]]))
            for at in range(0, len(seen), SLICE):
                part = seen[at : at + SLICE]
                yield pa.RecordBatch.from_arrays([pa.array(part.view(np.int64))], ["gram"])


def fit(docs: DataFrame) -> LanguageModel:
    """A model of ``docs(doc_id, text, lang)`` outside the held-out fold."""
    ship(docs.sparkSession)
    drawn, languages, landmarks = _drawn(docs)
    if not languages:
        return LanguageModel(Spectrum(np.zeros(0, np.uint64)), [], np.zeros((0, 0)))
    drawn = durable(drawn)
    common = (
        drawn.filter(F.col("rank") <= landmarks)
        .select("text")
        .mapInArrow(_distinct_grams, "gram long")
        .groupBy("gram")
        .count()
        .orderBy(F.desc("count"), "gram")
        .limit(GRAMS)
        .select("gram")
        .toPandas()["gram"]
    )
    spectrum = Spectrum(np.sort(common.to_numpy(np.int64).view(np.uint64)))
    shared = docs.sparkSession.sparkContext.broadcast(spectrum)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _batches(batches):
            found, _ = shared.value.presences(part.column(1).to_pylist())
            bits = pa.array([row.tobytes() for row in np.packbits(found, axis=1)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), bits], ["lang", "rank", "bits"])

    def bits(rows: list) -> np.ndarray:
        packed = np.stack([np.frombuffer(r.bits, np.uint8) for r in rows])
        return np.unpackbits(packed, axis=1, count=spectrum.size)

    schema = "lang string, rank int, bits binary"
    seen = durable(drawn.select("lang", "text", "rank").mapInArrow(look, schema))
    # At most ALL_LANDMARKS rows, or one a language, of 8 KB.
    at = bits(seen.filter(F.col("rank") <= landmarks).orderBy("lang", "rank").collect())
    marks = docs.sparkSession.sparkContext.broadcast(at)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _batches(batches):
            packed = np.stack([np.frombuffer(b.as_buffer(), np.uint8) for b in part.column(2)])
            k = kernel(np.unpackbits(packed, axis=1, count=spectrum.size), marks.value).astype(np.float32)
            rows = pa.array([row.tobytes() for row in k], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), rows], ["lang", "rank", "k"])

    rows = seen.mapInArrow(compare, "lang string, rank int, k binary").orderBy("lang", "rank", "k").collect()
    x = np.stack([np.frombuffer(r.k, np.float32) for r in rows]).astype(float)
    y = np.array([languages.index(r.lang) for r in rows])
    calibration = np.array([r.rank % 5 == 0 for r in rows])
    weights, sharpness = regress(kernel(at, at), x, y, len(languages), calibration)
    # The score of a text is (its presences @ folded) / the root of its n-grams.
    folded = (at / np.sqrt(np.maximum(at.sum(1, keepdims=True), 1))).T @ weights
    return LanguageModel(spectrum, languages, folded.astype(np.float32), sharpness)


def regress(
    among: np.ndarray, x: np.ndarray, y: np.ndarray, n: int, calibration: np.ndarray
) -> tuple[np.ndarray, float]:
    """Weights of the landmarks for each language: Nystroem features, a ridge regression
    of each language against the rest, folded back; and the sharpness with the smallest
    cross entropy on ``calibration``."""
    values, vectors = np.linalg.eigh(among)
    keep = values > 1e-8 * max(values.max(initial=0.0), 1e-300)
    root = (vectors[:, keep] / np.sqrt(values[keep])) @ vectors[:, keep].T
    learn = ~calibration if (~calibration).any() else np.ones(len(x), bool)
    z = x[learn] @ root
    target = np.where(y[learn][:, None] == np.arange(n), 1.0, -1.0)
    weights = root @ np.linalg.solve(z.T @ z + RIDGE * len(z) * np.eye(z.shape[1]), z.T @ target)
    tried = calibration if calibration.any() else learn
    scores = x[tried] @ weights
    grid = np.geomspace(0.5, 32, 49)
    loss = [-np.log(np.maximum(softmax(scores * s)[np.arange(len(scores)), y[tried]], 1e-12)).mean() for s in grid]
    return weights, float(grid[np.argmin(loss)])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` added. The model's size is bounded by its
    parameters; it is broadcast."""
    ship(docs.sparkSession)
    keep = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    schema = T.StructType([*keep, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    at, names = [f.name for f in keep].index("text"), schema.names
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _batches(batches):
            lang, score = shared.value.judge(part.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score)], names)

    return docs.select(*[f"`{f.name}`" for f in keep]).mapInArrow(judge, schema)


@query("op12_language")
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; rows of the held-out fold are never learnt from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )

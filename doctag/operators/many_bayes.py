"""Many naive Bayes models at once: learning curves over shuffle splits.

A model is its sums of weights by class and term, and those add up. In every split a
training document lies in one step of the growing training part, so the sums of a term for
all splits, steps and classes are one array, made in one pass over the long-form weights;
running sums over the steps then are the models. Documents are judged by all models in one
join: blocks of documents meet blocks of terms, a task multiplies two blocks, and a
document's partial scores are added up. What the number of documents or terms may make
large stays in tables; the driver gets counts by split, step and class, and cuts of draws.

The rows of a model do not depend on the number of splits, and are those that the single
forms in :mod:`doctag.operators.sampling` draw.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doctag.operators.order import cut_table
from doctag.session import durable

SIZES = (0.2, 0.4, 0.6, 0.8, 1.0)
# Documents and terms of a block, documents scored at a time, and weights summed at a time.
DOC_BLOCK, TERM_BLOCK, DOCS, ROWS = 1024, 2048, 64, 1024
# Weights of a term that one task sums up; a more frequent term is split.
TERM_ROWS = 1_000_000


def split_steps(
    labels: DataFrame, key: str, splits: int, sizes: Sequence[float] = SIZES, test: float = 0.2, seed: int = 0
) -> DataFrame:
    """``key, tag, steps``: for every split the first of the ``sizes``, which rise, that uses
    the row; their number if none does, and one more for a test row."""
    sizes = list(sizes)
    if sizes != sorted(sizes):
        raise ValueError("sizes rise")

    def draw(split: Column, mark: str) -> Column:
        return F.md5(F.concat((split + seed).cast("string"), F.lit(mark), F.col(key).cast("string")))

    numbers = F.sequence(F.lit(0), F.lit(splits - 1))
    both = F.transform(numbers, lambda i: F.struct(draw(i, ":").alias("split"), draw(i, "/size:").alias("size")))
    each = labels.select(F.posexplode(both).alias("_split", "_d"))
    rows = cut_table(each, F.col("_d.split"), lambda n: [F.ceil(n * F.lit(test))], F.col("_split")).collect()
    cuts = {r.group: r.cuts[0] for r in rows}
    cut = F.array(*[F.lit(cuts.get(i, "")) for i in range(splits)])
    train = each.filter(F.col("_d.split") > F.get(cut, "_split"))
    ranks = lambda n: [F.floor(n * F.lit(float(size))) for size in sizes]
    rows = cut_table(train, F.col("_d.size"), ranks, F.col("_split")).collect()
    steps = {r.group: list(r.cuts) for r in rows}
    step_cuts = F.array(*[F.array(*[F.lit(c) for c in steps.get(i, [""] * len(sizes))]) for i in range(splits)])
    step = F.transform(
        both,
        lambda d, i: F.when(d["split"] <= F.get(cut, i), len(sizes) + 1).otherwise(
            F.size(F.filter(F.get(step_cuts, i), lambda c: d["size"] > c))
        ),
    )
    return labels.select(key, "tag", step.cast("array<tinyint>").alias("steps"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def term_sums(rows: DataFrame, splits: int, steps: int, classes: int) -> DataFrame:
    """``field, term, sums`` of ``rows(key, field, term, weight, cls, steps)``: for every split and
    step the weight of each class in what that step uses."""
    size = splits * steps * classes
    often = rows.groupBy("field", "term").count().filter(F.col("count") > TERM_ROWS)
    often = durable(often.select("field", "term", F.ceil(F.col("count") / TERM_ROWS).alias("_parts")))
    # At most one row for each TERM_ROWS weights.
    salted = rows.join(F.broadcast(often), ["field", "term"], "left")
    salt = F.pmod(F.xxhash64("key"), F.coalesce("_parts", F.lit(1)))

    def emit(terms: list[tuple], sums: np.ndarray) -> pa.RecordBatch:
        fields, names = zip(*terms)
        columns = [pa.array(fields, pa.string()), pa.array(names, pa.string())]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array([s.tobytes() for s in sums], pa.binary())], ["field", "term", "sums"]
        )

    def runs(part: pa.RecordBatch) -> tuple[list[tuple], np.ndarray]:
        terms = list(zip(*(part.column(i).to_pylist() for i in range(3))))
        change = np.array([True, *(a != b for a, b in zip(terms, terms[1:]))])
        return [terms[i] for i in np.flatnonzero(change)], np.cumsum(change) - 1

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.zeros(0)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                terms, of = runs(part)
                step = _matrix(part.column(5), splits)
                weight, cls = (part.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
                place = ((of[:, None] * splits + np.arange(splits)) * steps + step) * classes + cls[:, None]
                used = step < steps
                values = np.broadcast_to(weight[:, None], step.shape)[used]
                sums = np.bincount(place[used], values, len(terms) * size).reshape(-1, splits, steps, classes)
                sums = sums.cumsum(2).reshape(-1, size)
                if last == terms[0]:
                    sums[0] += held
                elif last:
                    yield emit([last[:2]], held[None])
                if len(terms) > 1:
                    yield emit([t[:2] for t in terms[:-1]], sums[:-1])
                last, held = terms[-1], sums[-1]
        if last:
            yield emit([last[:2]], held[None])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.zeros(0)
        for batch in batches:
            for field, term, sums in zip(*(c.to_pylist() for c in batch.columns)):
                sums = np.frombuffer(sums)
                if last == (field, term):
                    held = held + sums
                    continue
                if last:
                    yield emit([last], held[None])
                last, held = (field, term), sums
        if last:
            yield emit([last], held[None])

    schema, keys = "field string, term string, sums binary", ["field", "term", "_salt"]
    dealt = salted.withColumn("_salt", salt).repartition(*keys).sortWithinPartitions(*keys)
    sums = dealt.select(*keys, "weight", "cls", "steps").mapInArrow(sum_up, schema)
    if often.isEmpty():
        return sums
    return sums.repartition("field", "term").sortWithinPartitions("field", "term").mapInArrow(merge, schema)


def _total(sums: DataFrame, size: int) -> np.ndarray:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for row in batch.column(0):
                total += np.frombuffer(row.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    parts = sums.select("sums").mapInArrow(add, "sums binary").collect()
    return sum((np.frombuffer(r.sums) for r in parts), np.zeros(size))


def partial_scores(rows: DataFrame, sums: DataFrame, n_docs: int, n_terms: int, logs: np.ndarray) -> DataFrame:
    """``key, part``: what the terms of each block add to a document's scores in all models;
    ``logs`` are the logarithms of the models' sums of weights."""
    docs, terms = max(1, -(-n_docs // DOC_BLOCK)), max(1, -(-n_terms // TERM_BLOCK))
    of_term = F.pmod(F.xxhash64("field", "term"), F.lit(terms)).cast("int").alias("_t")
    of_doc = F.pmod(F.xxhash64("key"), F.lit(docs)).cast("int").alias("_d")
    left = rows.select("key", "field", "term", "weight", of_term, of_doc)
    right = sums.select("field", "term", "sums", of_term, F.explode(F.sequence(F.lit(0), F.lit(docs - 1))).alias("_d"))
    schema = T.StructType([rows.schema["key"], T.StructField("part", T.BinaryType())])

    def meet(weights: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(weights):
            return pd.DataFrame({"key": [], "part": []})
        model = np.log(np.stack([np.frombuffer(s) for s in block["sums"]]) + 1.0) - logs
        number = {t: i for i, t in enumerate(zip(block["field"], block["term"]))}
        column = np.array([number[t] for t in zip(weights["field"], weights["term"])])
        row, names = pd.factorize(weights["key"])
        order = np.argsort(row, kind="stable")
        row, column, weight = row[order], column[order], weights["weight"].to_numpy()[order]
        out = []
        for at in range(0, len(names), DOCS):
            a, b = np.searchsorted(row, [at, at + DOCS])
            dense = np.zeros((min(DOCS, len(names) - at), len(number)))
            np.add.at(dense, (row[a:b] - at, column[a:b]), weight[a:b])
            out += [s.tobytes() for s in dense @ model]
        return pd.DataFrame({"key": names, "part": out})

    return left.groupBy("_d", "_t").cogroup(right.groupBy("_d", "_t")).applyInPandas(meet, schema)


def confusion(labelled: DataFrame, parts: DataFrame, prior: np.ndarray) -> np.ndarray:
    """Documents by split, step, side (used for the model, held out), class and prediction."""
    splits, steps, classes = prior.shape
    shape = (splits, steps, 2, classes, classes)
    heads = labelled.select("key", "cls", "steps", F.lit(None).cast("binary").alias("part"), F.lit(0).alias("_kind"))
    more = parts.select("key", F.lit(None).cast("int").alias("cls"), F.lit(None).cast("array<tinyint>").alias("steps"), "part", F.lit(1).alias("_kind"))
    split, step = np.indices((splits, steps))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(shape, np.int64)
        now: list = []

        def count() -> None:
            if now:
                cls, used, scores = now
                said = (scores.reshape(prior.shape) + prior).argmax(2)
                for side, which in enumerate((used[:, None] <= step, np.broadcast_to((used == steps + 1)[:, None], step.shape))):
                    np.add.at(counts, (split[which], step[which], side, cls, said[which]), 1)

        for batch in batches:
            for cls, used, part in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if part is None:
                    count()
                    now = [cls, np.array(used), np.zeros(prior.size)]
                else:
                    now[2] = now[2] + np.frombuffer(part)
        count()
        yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()], pa.binary())], ["counts"])

    dealt = heads.unionByName(more).repartition("key").sortWithinPartitions("key", "_kind")
    found = dealt.select("cls", "steps", "part").mapInArrow(judge, "counts binary").collect()
    return sum((np.frombuffer(r.counts, np.int64) for r in found), np.zeros(np.prod(shape), np.int64)).reshape(shape)


def macro_f1(counts: np.ndarray) -> float | None:
    """The mean F1 of all classes that occur, of a table of classes and predictions."""
    both = counts.sum(0) + counts.sum(1)
    occur = both > 0
    return float((2 * np.diag(counts)[occur] / both[occur]).mean()) if occur.any() else None


def learning_curve(
    weights: DataFrame,
    labels: DataFrame,
    n_terms: int,
    key: str,
    sizes: Sequence[float] = SIZES,
    splits: int = 100,
    test: float = 0.2,
    seed: int = 0,
    alpha: float = 1.0,
) -> DataFrame:
    """``train_fraction, split, train_score, valid_score`` of naive Bayes over long-form
    ``weights(key, field, term, weight)`` and ``labels(key, tag)`` with one row a key: macro F1 on
    the used part of the training side, and on the test side, of each split. ``n_terms`` is
    the length of the vocabulary, which may hold terms without weights here."""
    if alpha != 1.0:
        raise ValueError("the sums are smoothed by 1")
    spark = weights.sparkSession
    sizes = list(sizes)
    classes = [r.tag for r in labels.select("tag").distinct().orderBy("tag").collect()]
    known = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("tag")) - 1
    steps = split_steps(labels, key, splits, sizes, test, seed)
    labelled = durable(steps.select(F.col(key).alias("key"), known.cast("int").alias("cls"), "steps"))
    rows = weights.select(F.col(key).alias("key"), "field", "term", "weight").join(labelled, "key")
    rows = durable(rows.select("key", "field", "term", "weight", "cls", "steps"))

    shape = (splits, len(sizes), len(classes))
    counts = np.zeros((splits, len(sizes) + 2, len(classes)))
    for r in labelled.select("cls", F.posexplode("steps").alias("i", "step")).groupBy("i", "step", "cls").count().collect():
        counts[r.i, r.step, r.cls] = r["count"]
    n = counts[:, : len(sizes)].cumsum(1)
    prior = np.log(n + alpha) - np.log(n.sum(2, keepdims=True) + alpha * len(classes))

    size = int(np.prod(shape))
    sums = durable(term_sums(rows, *shape))
    logs = np.log(_total(sums, size) + alpha * n_terms)
    parts = partial_scores(rows, sums, labelled.count(), n_terms, logs)
    found = confusion(labelled, parts, prior)
    curve = [
        (float(part), i, macro_f1(found[i, j, 0]), macro_f1(found[i, j, 1]))
        for i in range(splits)
        for j, part in enumerate(sizes)
    ]
    return spark.createDataFrame(
        curve, "train_fraction double, split int, train_score double, valid_score double"
    )

"""Hard negatives by inner product, from cover trees over norm-augmented candidates.

Candidates are dealt to blocks by the nearest of some drawn pivots, and each block
becomes a tree. A candidate x gets one more component, the square root of M^2 - |x|^2,
where M is the largest norm of its block: all candidates then lie on a sphere, and the
inner product with an anchor falls with the angle between them. A node of the tree is a
candidate with those that its ball holds; its children are further than half the
level's scale apart and cover it. The covering radius of a node, as an angle, bounds
the inner products of all below it on both sides.

A search descends best first. Every window of scores that an anchor asks for keeps its k
best; a node is skipped if, for every window, it lies outside or cannot reach the k-th
score, or if all below it have a label that does not count. What the descent reaches is
verified exactly, in whole numbers.

Anchors first look for their positives in the blocks that hold their label, then
for negatives in the blocks whose root the windows do not rule out. A task holds one tree
and some anchors, so its memory does not depend on the tables. Pivots only decide where
the blocks lie: results are exact for any.

Defined cases: rows with a null id or label, and vectors that are null or hold a null or
non-finite component (also after scaling), take no part; an empty vector scores 0 with
everything, and a missing component counts as 0; ties go to the smaller id; a repeated
row is a candidate as often as it occurs; an anchor id on several rows is asked once,
with its smallest label and vector, and leaves out all rows of its own; a positive that
occurs twice takes two places and is reported once; anchors without positives, or with
negative positive scores, whose windows are empty, give no rows; empty tables give an
empty result. Scores beyond the range of a long are cut to it. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doctag.llm.registry import durable, query, ship, table
from doctag.llm.topk import quantized, usable

POSITIVES, NEGATIVES = 5, 10
#: A negative's score in hundredths of the positive's.
LOW, HIGH = 30, 90
SCALE = 256
BLOCK = 1 << 14
#: Blocks are laid around at most this many drawn rows.
MAX_PIVOTS = 256
LEAF, ANCHORS = 16, 2048
# Anchors that share the scores of centers, and nodes that one expands at a time, at first.
BATCH, FRONT = 64, 256
# Tasks that searches are dealt to at most.
TASKS = 10_000
# Roots that meet a group of anchors at a time, and rows whose pivot is found at a time.
ROOTS, ROWS = 4096, 1024
# Angles of float arithmetic are trusted to this share of the largest score.
SLACK = 1e-6


def matrix(vectors: pd.Series | list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors):
        row[: len(vector)] = vector
    return out


@dataclass
class Tree:
    """Points in an order that makes every subtree a range. Node i holds the points from
    ``start[i]``, which is its center, to ``end[i]``; its children are the nodes from
    ``child[i]`` to ``last[i]``. ``label`` is that of all points, or -1 beside ``mixed``."""

    points: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    norm: float
    start: np.ndarray
    end: np.ndarray
    child: np.ndarray
    last: np.ndarray
    angle: np.ndarray
    label: np.ndarray
    mixed: np.ndarray


def build(points: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> Tree:
    order = np.lexsort((ids, labels))
    points, ids, labels = points[order], ids[order], labels[order]
    unit = np.abs(points).max(initial=0.0) or 1.0
    x = points / unit
    square = (x * x).sum(1)
    norm = float(np.sqrt(square.max(initial=0.0)))
    x = np.hstack([x, np.sqrt(np.maximum(norm * norm - square, 0))[:, None]])
    place = np.arange(len(x))
    nodes = [[0, len(x), 0, 0, 0.0]]
    at = 0
    while at < len(nodes):
        start, end, *_ = nodes[at]
        members = place[start:end].copy()
        away = np.sqrt(((x[members] - x[members[0]]) ** 2).sum(1)) if len(members) else np.zeros(1)
        radius = nodes[at][4] = float(away.max())
        if len(members) > LEAF and radius > 0:
            # The next level's scale: the power of two below the radius.
            scale = 2.0 ** (np.ceil(np.log2(radius)) - 1)
            nodes[at][2] = len(nodes)
            rest, distance, filled = members, away, start
            while len(rest):
                near = distance <= scale
                inside = rest[near]
                place[filled : filled + len(inside)] = inside
                nodes.append([filled, filled + len(inside), 0, 0, 0.0])
                filled += len(inside)
                rest = rest[~near]
                if len(rest):
                    distance = np.sqrt(((x[rest] - x[rest[0]]) ** 2).sum(1))
            nodes[at][3] = len(nodes)
        at += 1
    start, end, child, last, radius = (np.array(c) for c in zip(*nodes))
    # The chord that a radius is, as an angle on the sphere.
    angle = 2 * np.arcsin(np.clip(radius / (2 * norm), 0, 1)) if norm else np.zeros(len(radius))
    labels = labels[place]
    change = np.r_[0, np.cumsum(labels[1:] != labels[:-1])] if len(labels) else np.zeros(1, int)
    mixed = change[np.maximum(end - 1, 0)] != change[start]
    return Tree(
        points[place], ids[place], labels, norm * unit, start.astype(np.int64), end.astype(np.int64),
        child.astype(np.int64), last.astype(np.int64), angle, labels[start], mixed,
    )


def bounds(center: np.ndarray, angle: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of all within ``angle`` of centers with these
    scores, where ``most`` is the product of the norms."""
    if not np.isfinite(most):
        return np.full(len(center), -np.inf), np.full(len(center), np.inf)
    if not most:
        return np.zeros(len(center)), np.zeros(len(center))
    to = np.arccos(np.clip(center / most, -1, 1))
    slack = SLACK * most
    return most * np.cos(np.minimum(to + angle, np.pi)) - slack, most * np.cos(np.maximum(to - angle, 0)) + slack


def _loose(value: int | float, away: float) -> float:
    """The value as a float, moved outwards where a float may not hold it."""
    return float(value) if abs(value) < 2**53 else float(np.nextafter(float(value), away))


class Best:
    """The k best of each window of scores, ties by the smaller id."""

    def __init__(self, windows: list[tuple[int, int]], k: int):
        self.k, self.windows = k, windows
        # No score below the floor, or above the ceiling, can matter to a window.
        self.floor = np.array([_loose(low, -np.inf) for low, _ in windows])
        self.ceiling = np.array([_loose(high, np.inf) for _, high in windows])
        self.found = [(np.zeros(0), np.zeros(0, np.int64)) for _ in windows]

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores are whole numbers: floats that hold them exactly, or ints."""
        use = (scores >= self.floor.min()) & (scores <= self.ceiling.max())
        scores, ids = scores[use], ids[use]
        for w, (low, high) in enumerate(self.windows) if len(ids) else ():
            use = np.flatnonzero((scores >= self.floor[w]) & (scores >= low) & (scores <= high))
            if len(use) > self.k:
                cut = np.partition(scores[use], len(use) - self.k)[len(use) - self.k]
                use = use[scores[use] >= cut]
            if not len(use):
                continue
            old, own = self.found[w]
            score, who = np.append(old.astype(scores.dtype), scores[use]), np.append(own, ids[use])
            if score.dtype == object:
                first = sorted(range(len(who)), key=lambda i: (-score[i], who[i]))[: self.k]
            else:
                first = np.lexsort((who, -score))[: self.k]
            self.found[w] = score[first], who[first]
            if len(first) == self.k:
                self.floor[w] = max(self.floor[w], _loose(score[first[-1]], -np.inf))

    def wanted(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return ((high[:, None] >= self.floor) & (low[:, None] <= self.ceiling)).any(1)


def ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers of several ranges."""
    size = end - start
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


class Anchors:
    """Some anchors against one tree. The scores of a node's center are computed for all of
    them when the first one reaches it."""

    def __init__(self, tree: Tree, anchors: np.ndarray):
        self.tree, self.anchors = tree, anchors
        self.most = np.sqrt((anchors * anchors).sum(1)) * tree.norm
        self.known = np.zeros(len(tree.start), bool)
        self.centers = np.empty((len(anchors), len(tree.start)))

    def center(self, nodes: np.ndarray, which: int) -> np.ndarray:
        new = nodes[~self.known[nodes]]
        if len(new):
            with np.errstate(over="ignore", invalid="ignore"):
                self.centers[:, new] = self.anchors @ self.tree.points[self.tree.start[new]].T
            self.known[new] = True
        return self.centers[which][nodes]

    def scores(self, points: np.ndarray, which: int) -> np.ndarray:
        """Exact scores of some points: floats, or ints beyond what those hold."""
        # Sums below 2^53 are exact in any order.
        if self.most[which] < 2**52:
            return self.tree.points[points] @ self.anchors[which]
        anchor = [int(v) for v in self.anchors[which]]
        out = [sum(int(x) * y for x, y in zip(row, anchor)) for row in self.tree.points[points].tolist()]
        return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in out], object)

    def search(self, which: int, own: int, label: int, same: bool, best: Best) -> None:
        """Best-first descent of one anchor, some nodes at a time; the points of the leaves
        among them are verified."""
        tree, most = self.tree, float(self.most[which])
        front, promise, size = np.zeros(1, np.int64), np.full(1, np.inf), FRONT
        while len(front):
            if len(front) > size:
                order = np.argsort(-promise, kind="stable")
                front, promise = front[order], promise[order]
            now, front, promise, size = front[:size], front[size:], promise[size:], 2 * size
            leaf = tree.child[now] == tree.last[now]
            if leaf.any():
                points = ranges(tree.start[now[leaf]], tree.end[now[leaf]])
                points = points[((tree.labels[points] == label) == same) & (tree.ids[points] != own)]
                best.offer(self.scores(points, which), tree.ids[points])
            at = ranges(tree.child[now[~leaf]], tree.last[now[~leaf]])
            if len(at):
                at = at[tree.mixed[at] | ((tree.label[at] == label) == same)]
                low, high = bounds(self.center(at, which), tree.angle[at], most)
                use = best.wanted(low, high)
                front, promise = np.append(front, at[use]), np.append(promise, high[use])
            use = promise >= best.floor.min()
            front, promise = front[use], promise[use]


TREE = (
    "pivot int, part int, norm double, kind string, points binary, ids binary, labels binary, nodes binary, angles binary"
)


def _dump(tree: Tree) -> dict:
    """The tree's columns; points in the smallest type that holds them."""
    top = np.abs(tree.points).max(initial=0.0)
    kind = "<i2" if top < 2**15 else "<i4" if top < 2**31 else "<f8"
    nodes = np.stack([tree.start, tree.end, tree.child, tree.last])
    return {
        "norm": tree.norm, "kind": kind, "points": tree.points.astype(kind).tobytes(),
        "ids": tree.ids.astype("<i8").tobytes(), "labels": tree.labels.astype("<i8").tobytes(),
        "nodes": nodes.astype("<i4").tobytes(), "angles": tree.angle.astype("<f8").tobytes(),
    }


def _load(row: pd.Series, width: int) -> Tree:
    ids, labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
    points = np.frombuffer(row["points"], row["kind"]).reshape(len(ids), width).astype(float)
    start, end, child, last = np.frombuffer(row["nodes"], "<i4").reshape(4, -1).astype(np.int64)
    change = np.r_[0, np.cumsum(labels[1:] != labels[:-1])]
    angle = np.frombuffer(row["angles"], "<f8")
    return Tree(
        points, ids, labels, row["norm"], start, end, child, last, angle, labels[start], change[end - 1] != change[start]
    )


def _placed(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Each row with its nearest pivot."""
    width = pivots.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers = shared.value
        half = (centers * centers).sum(1) / 2
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = matrix(part.column(2).to_numpy(zero_copy_only=False), width)
                near = (half - x @ centers.T).argmin(1) if width else np.zeros(len(x))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(near.astype(np.int32))], [*batch.schema.names, "pivot"])

    schema = "vec_id long, label long, vector array<double>, _anchor boolean, pivot int"
    return rows.select("vec_id", "label", "vector", "_anchor").mapInArrow(nearest, schema)


FOUND = "anchor_id long, positive long, vec_id long, score long"


def _search(same: bool, k: int, width: int):
    def meet(asked: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        """Anchors against the tree of one block."""
        out: list[tuple] = []
        tree = _load(trees.iloc[0], width) if len(trees) and len(asked) else None
        for at in range(0, len(asked) if tree else 0, BATCH):
            rows = asked.iloc[at : at + BATCH]
            some = Anchors(tree, matrix(list(rows["vector"]), width))
            columns = (rows[c] for c in ("vec_id", "label", "lows", "highs", "marks"))
            for which, (own, label, lows, highs, marks) in enumerate(zip(*columns)):
                best = Best([(int(a), int(b)) for a, b in zip(lows, highs)], k)
                some.search(which, own, label, same, best)
                for mark, (score, who) in zip(marks, best.found):
                    out += [(own, mark, int(i), int(s)) for s, i in zip(score, who)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in FOUND.split(", ")], dtype=np.int64)

    return meet


def _ruled_in(asked: DataFrame, trees: DataFrame, width: int, groups: int, n_trees: int) -> DataFrame:
    """The anchors with the blocks whose root their windows do not rule out."""
    parts = -(-n_trees // ROOTS)
    root = F.expr(f"substring(points, 1, CASE kind WHEN '<i2' THEN 2 WHEN '<i4' THEN 4 ELSE 8 END * {width})")
    angle = F.expr("substring(angles, 1, 8)")
    roots = trees.select("pivot", "part", "norm", "kind", root.alias("point"), angle.alias("angle"))
    roots = roots.withColumn("_r", F.pmod(F.xxhash64("pivot", "part"), F.lit(parts)).cast("int"))
    roots = roots.withColumn("_a", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    all_asked = asked.withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    schema = "pivot int, part int, _a int, vec_id long, label long, vector array<double>, lows array<long>, highs array<long>, marks array<long>"
    names = [c.split()[0] for c in schema.split(", ")]

    def rule(asked: pd.DataFrame, roots: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(roots):
            q = matrix(list(asked["vector"]), width)
            size = np.sqrt((q * q).sum(1))
            for _, tree in roots.iterrows():
                center = q @ np.frombuffer(tree["point"], tree["kind"]).astype(float)
                turn = np.frombuffer(tree["angle"], "<f8")
                use = []
                for i, most in enumerate((size * tree["norm"]).tolist()):
                    low, high = bounds(center[i : i + 1], turn, most)
                    use.append(any(high[0] >= a and low[0] <= b for a, b in zip(asked["lows"].iat[i], asked["highs"].iat[i])))
                out.append(asked[np.array(use)].assign(pivot=np.int32(tree["pivot"]), part=np.int32(tree["part"])))
        return pd.concat(out)[names] if out else pd.DataFrame({c: [] for c in names})

    return all_asked.groupBy("_a", "_r").cogroup(roots.groupBy("_a", "_r")).applyInPandas(rule, schema)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of
    ``vectors(vec_id, label, vector)``, where ``vector`` is an array of whole doubles.
    A negative's score lies from ``low`` to ``high`` hundredths of the positive's."""
    ship(vectors.sparkSession)
    fit = usable(F.col("vector")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    rows = vectors.filter(fit).select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<double>"),
        F.coalesce(is_anchor, F.lit(False)).alias("_anchor"),
    )
    rows = durable(rows)
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    first = F.min(F.struct("label", "vector")).alias("_first")
    asked = rows.filter("_anchor").groupBy("vec_id").agg(first).select("vec_id", "_first.*")
    asked = durable(asked)
    n_asked = asked.count()
    if not n_asked:
        none = rows.select(F.col("vec_id").alias("anchor_id"), F.col("vec_id").alias("positive_id"), F.lit(1).alias("rank"))
        return none.select("*", *[F.col("anchor_id").alias(c) for c in ("negative_id", "positive_score", "negative_score")]).limit(0)

    draw = F.xxhash64("vec_id", "label")
    drawn = rows.orderBy(draw, "vec_id").limit(min(MAX_PIVOTS, -(-n // BLOCK))).select("vector").collect()
    placed = durable(_placed(rows, matrix([r.vector for r in drawn], width)))
    # At most MAX_PIVOTS rows; a crowded pivot is split by hash.
    crowd = {r.pivot: -(-r["count"] // BLOCK) for r in placed.groupBy("pivot").count().collect()}
    parts = F.element_at(F.create_map(*[F.lit(v) for kv in crowd.items() for v in kv]), F.col("pivot"))
    block = ["pivot", "part"]
    placed = placed.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), parts).cast("int"))

    def plant(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree = build(matrix(list(group["vector"]), width), group["vec_id"].to_numpy(), group["label"].to_numpy())
        return pd.DataFrame([{"pivot": key[0], "part": key[1], **_dump(tree)}])

    placed = durable(placed)
    trees = durable(placed.groupBy(*block).applyInPandas(plant, TREE))
    groups, n_trees = -(-n_asked // ANCHORS), trees.count()
    tasks = min(TASKS, n_trees * groups)
    asked = asked.withColumn("_a", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
    dealt = trees.withColumn("_a", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def found(some: DataFrame, same: bool, k: int) -> DataFrame:
        keys = [*block, "_a"]
        # Much work for few bytes: the tasks are as many as the pairs of trees and anchor groups.
        left, right = (side.repartition(tasks, *keys) for side in (some, dealt))
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_search(same, k, width), FOUND)

    def only(value: int) -> Column:
        return F.array(F.lit(value).cast("long"))

    # Positives: in the blocks that hold the label.
    everything = {"lows": only(-(2**63)), "highs": only(2**63 - 1), "marks": only(0)}
    homes = placed.select("label", *block).distinct()
    near = found(asked.join(homes, "label").withColumns(everything), True, positives)
    order = W.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= positives)
    near = durable(near.select("anchor_id", F.col("vec_id").alias("positive"), F.col("score").alias("_score")).distinct())

    # Whole numbers n with low * score <= 100 * n <= high * score; at most ``positives`` of them.
    score = F.col("_score").cast("decimal(20,0)")
    windows = near.select(
        F.col("anchor_id").alias("vec_id"),
        F.struct(
            F.ceil(score * low / 100).cast("long").alias("low"),
            F.floor(score * high / 100).cast("long").alias("high"),
            F.col("positive").alias("mark"),
        ).alias("_w"),
    ).filter("_w.low <= _w.high")
    windows = windows.groupBy("vec_id").agg(F.collect_list("_w").alias("_w"))
    windows = windows.select("vec_id", *[F.col(f"_w.{c}").alias(f"{c}s") for c in ("low", "high", "mark")])
    ruled = _ruled_in(asked.join(windows, "vec_id"), trees, width, groups, n_trees)
    far = found(ruled, False, negatives)
    order = W.partitionBy("anchor_id", "positive").orderBy(F.desc("score"), "vec_id")
    return (
        far.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= negatives)
        .join(near, ["anchor_id", "positive"])
        .select(
            "anchor_id",
            F.col("positive").alias("positive_id"),
            "rank",
            F.col("vec_id").alias("negative_id"),
            F.col("_score").alias("positive_score"),
            F.col("score").alias("negative_score"),
        )
    )


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same,
         list_sum(list_transform(list_zip(q.e, c.e), lambda z: coalesce(z[1] * z[2], 0)))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM pairs WHERE same)
  WHERE r <= 5),
negatives AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN pairs USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 10
"""


@query("op11_negatives", SQL)
def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of the five positives of every hundredth vector."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    # An infinite component stays infinite when scaled.
    rows = table(spark, sf_dir, "embeddings").filter(usable(F.col("embedding")))
    rows = rows.select("vec_id", moved.alias("label"), quantized(F.col("embedding"), SCALE).alias("vector"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)

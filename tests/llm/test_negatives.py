"""Hard negatives and the cover tree against plain loops."""

import numpy as np
import pytest
from doctag.llm import negatives
from pyspark.sql import functions as F

SCHEMA = "vec_id long, label int, vector array<double>, part int, score string"


def plain(rows, every=5):
    """All pairs, in whole numbers."""
    fit = [
        (i, lab, [int(x) for x in v])
        for i, lab, v, *_ in rows
        if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]

    def dot(a, b):
        return min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1)

    asked = {}
    for i, lab, v in fit:
        if i % every == 0:
            asked[i] = min(asked.get(i, (lab, v)), (lab, v))
    out = []
    for i, (lab, v) in asked.items():
        pairs = [(-dot(v, w), j, other == lab) for j, other, w in fit if j != i]
        for p, j, _ in sorted(set(sorted(x for x in pairs if x[2])[:5])):
            found = sorted(x for x in pairs if not x[2] and 30 * -p <= 100 * -x[0] <= 90 * -p)
            out += [(i, j, r + 1, k, -p, -n) for r, (n, k, _) in enumerate(found[:10])]
    return sorted(out)


def mined(spark, rows, every=5):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = negatives.hard_negatives(df, F.col("vec_id") % every == 0)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def drawn(n, seed, dims=6, labels=4):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(labels, dims))
    rows = []
    for i in range(n):
        v = np.floor(60 * (centers[rng.integers(labels)] + 0.4 * rng.normal(size=dims)))
        rows.append((i, int(rng.integers(labels)), v.tolist(), 1, "s"))
    return rows


@pytest.mark.parametrize("block", [16, 4096])
def test_plain_loops(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "BATCH", 3)
    monkeypatch.setattr(negatives, "FRONT", 2)
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    rows = drawn(150, 3)
    # Copies under other ids, a repeated row, an id with two vectors, vectors of other lengths.
    rows += [(200 + i, 2, rows[0][2], 1, "s") for i in range(20)] + rows[5:8]
    rows += [(30, 0, [9.0], 1, "s"), (300, 1, [], 1, "s"), (305, 1, [70.0] * 9, 1, "s"), (310, 3, [0.0] * 6, 1, "s")]
    # Rows that take no part.
    rows += [(None, 1, [1.0], 1, "s"), (315, None, [1.0], 1, "s"), (320, 1, None, 1, "s")]
    rows += [(325, 1, [1.0, None], 1, "s"), (330, 1, [float("nan")], 1, "s"), (335, 1, [float("inf")], 1, "s")]
    assert mined(spark, rows) == plain(rows) != []


def test_large_numbers(spark):
    rng = np.random.default_rng(5)
    for size in (2.0**30, 2.0**31, 1e120):
        rows = [(i, i % 2, np.floor(size * rng.random(3)).tolist(), 1, "s") for i in range(40)]
        assert mined(spark, rows) == plain(rows)


def test_empty_and_one_label(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0], 1, "s")]) == []
    assert mined(spark, [(i, 1, [float(i)], 1, "s") for i in range(9)]) == []
    assert mined(spark, [(0, 1, None, 1, "s")]) == []


@pytest.mark.parametrize("seed", range(6))
def test_tree_bounds_and_search(seed):
    rng = np.random.default_rng(seed)
    points = np.floor(rng.normal(size=(400, 5)) * (10 if seed % 2 else 300))
    points[50:120] = points[50]
    ids, labels = rng.permutation(400), rng.integers(0, 3, 400)
    tree = negatives.build(points, ids, labels)
    assert sorted(tree.ids.tolist()) == list(range(400))
    anchor = np.floor(rng.normal(size=5) * 50)
    most = float(np.linalg.norm(anchor)) * tree.norm
    low, high = negatives.bounds(tree.points[tree.start] @ anchor, tree.angle, most)
    for i, (a, b) in enumerate(zip(tree.start, tree.end)):
        below = tree.points[a:b] @ anchor
        assert low[i] <= below.min() and below.max() <= high[i]
        assert tree.mixed[i] == (len(set(tree.labels[a:b])) > 1)
        inner = [(tree.start[c], tree.end[c]) for c in range(tree.child[i], tree.last[i])]
        assert not inner or (inner[0][0], inner[-1][1]) == (a, b)
    all_scores = points @ anchor
    windows = [(-(2**63), 2**63 - 1), (int(all_scores.mean()), int(np.quantile(all_scores, 0.9)))]
    for same in (True, False):
        best = negatives.Best(windows, 7)
        negatives.Anchors(tree, anchor[None]).search(0, 5, 1, same, best)
        for (lo, hi), (score, who) in zip(windows, best.found):
            want = sorted((-s, i) for s, i, x in zip(all_scores, ids, labels) if lo <= s <= hi and (x == 1) == same and i != 5)
            assert [(-s, i) for s, i in zip(score, who)] == want[:7]


def test_search_skips_nodes(monkeypatch):
    """Best first: the anchor's cluster is verified, and little of far ones."""
    monkeypatch.setattr(negatives, "FRONT", 8)
    rng = np.random.default_rng(1)
    centers = np.floor(rng.normal(size=(10, 16)) * 500)
    points = np.floor(centers[np.arange(3000) % 10] + rng.normal(size=(3000, 16)) * 9)
    tree = negatives.build(points, np.arange(3000), np.zeros(3000, int))
    seen = []
    offer = negatives.Best.offer
    monkeypatch.setattr(negatives.Best, "offer", lambda self, s, i: (seen.extend(i), offer(self, s, i)))
    negatives.Anchors(tree, centers[3][None]).search(0, -1, 0, True, negatives.Best([(-(2**63), 2**63 - 1)], 5))
    assert len(seen) < 600 and 5 * sum(i % 10 == 3 for i in seen) > 3 * len(seen), len(seen)

"""The tree over long-form weights against plain loops."""

import math
import random

import pytest
from doctag.operators import trees
from pyspark.sql import functions as F


def plain(docs, classes, depth):
    """``{node: (counts, best)}`` and the leaf of every document."""
    at, nodes = {k: 1 for k in docs}, {}
    step = lambda w: math.ceil(round(w * 32, 6))
    for level in range(depth + 1):
        for node in sorted({n for n in at.values() if n >= 2**level}):
            here = [k for k in at if at[k] == node]
            use = [k for k in here if docs[k][0] in classes]
            if not use:
                continue
            count = lambda rows: [sum(docs[k][0] == c for k in rows) for c in classes]
            squares = lambda c: sum(x * x for x in c) / sum(c) if sum(c) else None
            best = None
            for field, term, cut in sorted({(f, t, step(w)) for k in use for (f, t), w in docs[k][1].items()}):
                right = [k for k in use if step(docs[k][1].get((field, term), 0)) >= cut]
                left = [k for k in use if k not in right]
                if not left or not right:
                    continue
                gain = round((squares(count(right)) + squares(count(left)) - squares(count(use))) / len(use), 12)
                if gain > 0 and (best is None or gain > best[0]):
                    best = (gain, field, term, cut)
            nodes[node] = (count(use), best if level < depth else None)
        if level < depth:
            for k in at:
                best = nodes.get(at[k], (0, None))[1]
                if at[k] >= 2**level and best:
                    at[k] = 2 * at[k] + (step(docs[k][1].get(best[1:3], 0)) >= best[3])
    return nodes, at


def drawn(seed, n=60):
    rng = random.Random(seed)
    docs = {}
    for k in range(n):
        tag = rng.choice(["a", "b", "c", None, "other"])
        terms = {(f, f"t{t}"): round(rng.random() * (0.4 + 0.6 * (t == "abc".find(tag or "x"))), 2) or 0.01 for f in "xy" for t in range(5) if rng.random() < 0.5}
        docs[k] = (tag, terms)
    docs[n] = ("a", {("x", "t0"): 1.0000000002})
    return docs


@pytest.mark.parametrize("depth", [0, 1, 4, 30])
def test_tree_is_that_of_plain_loops(spark, tmp_path, depth):
    docs, classes = drawn(depth), ("a", "b", "c")
    weights = [(k, f, t, w) for k, (_, terms) in docs.items() for (f, t), w in terms.items()]
    rows = trees.term_rows(
        spark.createDataFrame(weights, "doc long, field string, term string, weight double"),
        spark.createDataFrame([(k, v[0]) for k, v in docs.items()], "doc long, tag string"),
        "doc",
    )
    tree = trees.fit_tree(rows, "tag", classes, depth)
    nodes, at = plain(docs, classes, depth)
    got = {r.node: (list(r.counts), (r.gain, r.field, r.term, r.step) if r.term else None) for r in tree.nodes.collect()}
    assert got == nodes
    want = {k: classes[max(range(3), key=lambda i: (nodes[n][0][i], -i))] for k, n in at.items()}
    trees.save_tree(tree, str(tmp_path / "tree"))
    for model in (tree, trees.load_tree(spark, str(tmp_path / "tree"))):
        out = trees.predict_tree(rows, model)
        assert out.columns == ["doc", "tag", "predict"]
        assert {r.doc: r.predict for r in out.collect()} == want
    if depth == 30:
        # Grown to the end, it tells all documents apart that differ.
        right = out.filter(F.col("tag").isin(*classes)).agg(F.avg((F.col("tag") == F.col("predict")).cast("int"))).first()[0]
        assert right > 0.9


def test_nothing_to_learn_from(spark):
    rows = spark.createDataFrame([(1, None)], "doc long, tag string").withColumn(
        "terms", F.array().cast("array<struct<field:string,term:string,step:int>>")
    )
    tree = trees.fit_tree(rows, "tag", ("a", "b"), 3)
    assert tree.nodes.collect() == []
    assert [r.predict for r in trees.predict_tree(rows, tree).collect()] == [None]

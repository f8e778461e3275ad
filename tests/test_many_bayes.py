"""Learning curves from additive sums against one model after the other."""

import hashlib
import math
import random

import pytest
from doctag.operators import many_bayes as M


def digest(text):
    return hashlib.md5(text.encode()).hexdigest()


def plain(weights, labels, n_terms, sizes, splits, test, seed):
    classes = sorted(set(labels.values()))
    by_doc = {}
    for doc, field, term, w in weights:
        by_doc.setdefault(doc, []).append(((field, term), w))
    curve = []
    for split in range(splits):
        order = sorted(labels, key=lambda k: digest(f"{seed + split}:{k}"))
        n_test = math.ceil(len(order) * test)
        held, train = order[:n_test], sorted(order[n_test:], key=lambda k: digest(f"{seed + split}/size:{k}"))
        for size in sizes:
            used = train[: math.floor(len(train) * size)]
            count = {c: sum(labels[k] == c for k in used) for c in classes}
            sums = {c: {} for c in classes}
            for k in used:
                for t, w in by_doc.get(k, ()):
                    sums[labels[k]][t] = sums[labels[k]].get(t, 0) + w
            total = {c: sum(sums[c].values()) for c in classes}

            def judge(k):
                score = lambda c: math.log(count[c] + 1) + sum(
                    w * (math.log(sums[c].get(t, 0) + 1) - math.log(total[c] + n_terms)) for t, w in by_doc.get(k, ())
                )
                return max(classes, key=lambda c: (round(score(c), 9), -classes.index(c)))

            def f1(rows):
                pairs = [(labels[k], judge(k)) for k in rows]
                occur = [c for c in classes if any(c in p for p in pairs)]
                each = [2 * pairs.count((c, c)) / sum((c == a) + (c == b) for a, b in pairs) for c in occur]
                return round(sum(each) / len(each), 6) if each else None

            curve.append((size, split, f1(used), f1(held)))
    return sorted(curve)


@pytest.mark.parametrize("small", [False, True])
def test_curve_is_that_of_single_models(spark, monkeypatch, small):
    if small:
        for name, value in (("DOC_BLOCK", 7), ("TERM_BLOCK", 3), ("DOCS", 2), ("ROWS", 4), ("TERM_ROWS", 9)):
            monkeypatch.setattr(M, name, value)
    rng = random.Random(5)
    labels = {k: rng.choice("abc") for k in range(40)}
    weights = [
        (k, f, f"t{t}", rng.random() + (t % 3 == "abc".index(labels.get(k, "a"))))
        for k in range(44) for f in ("x", "y") for t in range(8) if rng.random() < 0.4 and k != 11
    ]
    sizes = (0.05, 0.5, 0.9)
    out = M.learning_curve(
        spark.createDataFrame(weights, "doc long, field string, term string, weight double").repartition(3),
        spark.createDataFrame(list(labels.items()), "doc long, tag string"),
        20, "doc", sizes, 6, 0.25, 3,
    )
    got = sorted((r.train_fraction, r.split, r.train_score and round(r.train_score, 6), r.valid_score and round(r.valid_score, 6)) for r in out.collect())
    assert got == plain(weights, labels, 20, sizes, 6, 0.25, 3)


def test_sizes_must_rise(spark):
    with pytest.raises(ValueError):
        M.split_steps(spark.createDataFrame([(1, "a")], "doc long, tag string"), "doc", 2, (0.5, 0.2))

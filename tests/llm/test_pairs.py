"""Pair operators against brute force: embeddings, Jaccard, lines, suffixes, top-k."""

import hashlib
import random

import numpy as np
import pytest
from doctag.llm.bytetext import SLICE
from doctag.llm.components import components, roots
from doctag.llm.embeddings import near_duplicates
from doctag.llm.jaccard import first_of_class, jaccard_classes
from doctag.llm.lines import _ends_alike, line_classes, within, without_repeats
from doctag.llm.suffixes import cleaned_texts, front_code, front_decode, merge_runs, of_documents
from doctag.llm.topk import quantized, top_k, usable
from pyspark.sql import functions as F

TEXT = "doc_id long, text string"


def groups(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 130)]
    df = spark.createDataFrame(links, "a long, b long")
    want = groups({n for link in links for n in link}, links)
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {n: c for n, c in want.items() if any(n in x and x[0] != x[1] for x in links)}
    a, b = np.array(links).T
    assert all(roots(131, a, b)[n] == c for n, c in want.items())


def cosine_links(rows):
    ok = {}
    for i, (vec_id, label, v) in enumerate(rows):
        if vec_id is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        if any(v):
            u = np.array(v, float)
            ok[i] = (label, len(v), u / np.linalg.norm(u))
    for i in ok:
        for j in ok:
            if i < j and ok[i][:2] == ok[j][:2] and ok[i][2] @ ok[j][2] >= 0.93:
                yield i, j


def test_embeddings(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(120, 16))
    near = base[:60] + rng.normal(size=(60, 16)) * 0.12
    rows = [(i, int(i) % 3, [float(x) for x in v]) for i, v in enumerate(np.vstack([base, near, base[:30] * 2]))]
    rows = [(i, 1 if i % 60 < 20 else label, v) for i, label, v in rows]
    rows += [(500, 1, None), (501, 1, []), (502, 1, [0.0] * 16), (503, 1, [float("nan")] * 16), (504, None, rows[0][2])]
    rows += [(505, 1, [1.0, None]), (506, 1, [1.0, 2.0]), (None, 1, rows[0][2]), rows[3], rows[3]]
    links = list(cosine_links(rows))
    assert len(links) > 60
    want = {i: [0, r[0]] for i, r in enumerate(rows)}
    for i, j in links:
        want[i][0] += 1
        want[j][0] += 1
    by_id = groups({r[0] for r in rows if r[0] is not None}, [(rows[i][0], rows[j][0]) for i, j in links])
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<double>").withColumn("node", F.lit("x"))
    got = near_duplicates(df).collect()
    key = lambda x: str(x)
    assert sorted([(r.vec_id, r.n_links, r.component_id) for r in got], key=key) == sorted(
        [(v, n, by_id.get(v)) for n, v in want.values()], key=key
    )
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert near_duplicates(df.limit(0)).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 2]) for i in range(200)]
    rows += [(300, None), (None, rows[0][1]), (320, [float("inf")]), (340, [1e30, -1e30]), (3, rows[3][1]), (20, rows[20][1]), (360, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ok = df.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    got = top_k(ok.select("vec_id", quantized(F.col("embedding")).alias("vector")), F.col("vec_id") % 20 == 0, 7).collect()
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(np.isfinite(v)):
            whole.setdefault(i, []).append([int(np.floor(64 * x)) for x in v])
    by: dict = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(by) == {i for i in whole if i % 20 == 0}
    cut = lambda s: max(-(2**63), min(2**63 - 1, s))
    for q, found in by.items():
        all_ = [(-cut(sum(a * b for a, b in zip(whole[q][0], v))), i) for i, vs in whole.items() if i != q for v in vs]
        assert sorted(found) == [(k + 1, i, -s) for k, (s, i) in enumerate(sorted(all_)[:7])]
    assert top_k(ok.limit(0).select("vec_id", F.col("embedding").alias("vector")), F.lit(True)).count() == 0


def words(rng, n):
    return " ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(n))


def grams(text):
    import re

    w = [x.lower() if x.isascii() else x for x in re.findall(r"[0-9A-Za-z_\u0080-\U0010ffff]+", text or "")]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def text_rows():
    rng = random.Random(8)
    rows, n = [], 0
    for _ in range(25):
        base = words(rng, rng.randint(3, 120)).split()
        for _ in range(rng.randint(1, 7)):
            copy = [x if rng.random() > 0.01 else "new" + str(rng.randint(0, 9)) for x in base]
            rows.append((n, " ".join(copy)))
            n += 1
    return rows + [(900, None), (901, ""), (902, "  ,; "), (903, "one two"), (904, "One, two!"), (None, rows[0][1]), (5, rows[5][1])]


def test_jaccard(spark):
    rows = text_rows()
    sets = [grams(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8
    ]
    assert len(links) > 40
    number = {i: sum(i in x for x in links) for i in range(len(rows))}
    joined = groups(range(len(rows)), links)
    low: dict = {}
    for i, c in joined.items():
        low[c] = min(low.get(c, 10**9), rows[i][0] if rows[i][0] is not None else 10**9)
    want = sorted(str((rows[i][0], low[joined[i]], number[i])) for i in range(len(rows)))
    df = spark.createDataFrame(rows, TEXT).withColumns({"key": F.lit(1), "node": F.lit(2), "_row": F.lit(3)})
    assert sorted(str(tuple(r)) for r in jaccard_classes(df).collect()) == want
    kept = first_of_class(df)
    assert kept.columns == df.columns
    heads = sorted(c for c in low.values() if c < 10**9)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == heads
    assert jaccard_classes(df.limit(0)).count() == first_of_class(df.limit(0)).count() == 0


def test_jaccard_of_a_long_text(spark):
    rng = random.Random(3)
    long = words(rng, 700_000)
    df = spark.createDataFrame([(1, long), (2, long + " more words here"), (3, "short text")], TEXT)
    assert {(r.doc_id, r.class_id, r.n_links) for r in jaccard_classes(df).collect()} == {(1, 1, 1), (2, 1, 1), (3, 3, 0)}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mutated(rng, s, k):
    s = list(s)
    for _ in range(k):
        p, what = rng.randrange(len(s) + 1), rng.randrange(3)
        if what == 0 or not s:
            s.insert(p, rng.choice("ab é😀"))
        elif what == 1:
            s.pop(min(p, len(s) - 1))
        else:
            s[min(p, len(s) - 1)] = rng.choice("abé😀")
    return "".join(s)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_band_distance(spark, edits):
    rng = random.Random(edits)
    rows = []
    for _ in range(1500):
        a = "".join(rng.choice("abé😀"[: rng.choice((1, 2, 4))]) for _ in range(rng.randint(0, 14)))
        rows.append((a, mutated(rng, a, rng.randint(0, 5))))
    df = spark.createDataFrame(rows, "a string, b string")
    for r in df.select("a", "b", within(F.col("a"), F.col("b"), edits).alias("w")).collect():
        assert r.w == (edit_distance(r.a, r.b) <= edits), r


def test_lines(spark):
    rng = random.Random(9)
    pool = ["".join(rng.choice("abc de") for _ in range(rng.choice((10, 38, 39, 40, 41, 47, 48, 49, 95, 96, 97)))) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = [mutated(rng, rng.choice(pool), rng.choice((0, 0, 1, 1, 2, 4))) for _ in range(rng.randint(1, 5))]
        rows.append((i, "\n".join(rng.choice(("", " ")) + x + rng.choice(("", "\r")) for x in lines)))
    rows += [(100, None), (101, ""), (None, pool[5] + pool[5]), (None, pool[5] + pool[5]), (7, rows[7][1])]
    found = []
    for d, t in rows:
        found += [(d, n, x.strip(" \t\r")) for n, x in enumerate(t.split("\n"))] if t is not None else []
    part = [i for i, x in enumerate(found) if len(x[2]) >= 40]
    links = [(i, j) for i in part for j in part if i < j and edit_distance(found[i][2], found[j][2]) <= 2]
    assert len(links) > 100
    number = {i: sum(i in x for x in links) for i in range(len(found))}
    order = lambda i: (found[i][0] is not None, found[i][0] or 0, found[i][1])
    joined = groups(range(len(found)), links)
    first: dict = {}
    for i, c in joined.items():
        first[c] = i if c not in first or order(i) < order(first[c]) else first[c]
    want = []
    for i, (d, n, _) in enumerate(found):
        f = found[first[joined[i]]]
        want.append(str((d, n, f[0], f[1], number[i], f[:2] == (d, n))))
    df = spark.createDataFrame(rows, TEXT).withColumns({"line": F.lit(1), "id": F.lit(2), "_doc": F.lit(3)})
    assert sorted(str(tuple(r)) for r in line_classes(df).collect()) == sorted(want)
    left = without_repeats(df)
    assert left.columns == df.columns
    assert line_classes(left).filter("n_links > 0").filter("doc_id <> class_doc_id").count() == 0
    assert line_classes(df.limit(0)).count() == without_repeats(df.limit(0)).count() == 0


def test_lines_of_null_and_repeated_ids_with_different_texts(spark):
    rng = random.Random(12)
    line = lambda: "".join(rng.choice("abcdefghij klm") for _ in range(60)).strip()
    again, both = line(), line()
    rows = [(1, again)]
    for doc_id in (None, 5):
        rows += [(doc_id, "\n".join(line() for _ in range(4))) for _ in range(6)]
        # A copy at line 2: line 2 of the others stays.
        rows.append((doc_id, "\n".join([line(), line(), again, line()])))
        # Copies at the same line: one of them stays.
        rows += [(doc_id, both + "\n" + line()) for _ in range(2)]
    got = without_repeats(spark.createDataFrame(rows, TEXT)).collect()
    left = sorted(x for r in got for x in r.text.split("\n"))
    assert left == sorted({x for _, t in rows for x in t.split("\n")})


def test_exact_copies_of_short_lines(spark):
    rows = [(1, "menu\n\nwords of one"), (2, " menu\n\nwords of two\nx"), (3, "x\nmenus\n\nmenu\t"), (4, "menu\n"), (5, "menu")]
    df = spark.createDataFrame(rows, TEXT)
    left = {r.doc_id: r.text for r in without_repeats(df).collect()}
    # Empty lines stay; a near copy of a short line is a different line.
    assert left == {1: rows[0][1], 2: "\nwords of two\nx", 3: "menus\n", 4: ""}
    got = {(r.doc_id, r.line_no): (r.class_doc_id, r.n_links, r.kept) for r in line_classes(df, shortest=1).collect()}
    assert got[3, 3] == (1, 4, False) and got[3, 1] == (3, 0, True) and got[3, 0] == (2, 1, False)
    assert got[1, 1] == (1, 0, True) and got[2, 1] == (2, 0, True)


def test_merging_front_coded_runs():
    rng = np.random.default_rng(1)
    for _ in range(100):
        runs = []
        for _ in range(rng.integers(1, 6)):
            k = rng.integers(1, 3, (rng.integers(0, 40), 6)).astype(np.uint8)
            k = k[np.lexsort(k.T[::-1])]
            shared, rest = front_code(k)
            assert (front_decode(shared, rest, 6) == k).all()
            runs.append((k, shared))
        order, common = merge_runs(runs, 6)
        keys = np.concatenate([k for k, _ in runs])
        assert (keys[order] == keys[np.lexsort(keys.T[::-1])]).all()
        assert (common == front_code(keys[order])[0]).all()


def test_suffixes(spark):
    rng = random.Random(10)
    pool = ["".join(rng.choice("abcdé \n") for _ in range(rng.randint(20, 160))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(pool) if rng.random() < 0.4 else words(rng, 15) for _ in range(rng.randint(1, 8)))) for i in range(50)]
    rows += [(60, None), (61, ""), (62, "a" * 500), (63, "a" * 49), (64, "a" * 120 + "b"), (65, "\0" * 70), (66, "\0" * 60)]
    rows += [(None, rows[1][1]), (None, words(rng, 60)), (None, rows[-1][1]), (3, rows[3][1]), (70, rows[3][1])]
    want, last = [], 2**63 - 1
    data = [(last if d is None else d, (t or "").encode()) for d, t in rows]
    first: dict = {}
    for d, b in data:
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            first[w] = min(first.get(w, last), d)
    for (d, b), (doc_id, _) in zip(data, rows):
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < d:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        want.append(str((doc_id, len(b), sum(gone), hashlib.sha256(kept).hexdigest())))
    df = spark.createDataFrame(rows, TEXT).withColumns({"tag": F.lit(1), "part": F.lit("x"), "digest": F.lit(0)})
    got = of_documents(df, cleaned_texts(df)).withColumn(
        "kept", F.when(F.col("whole"), F.lit("").cast("binary")).otherwise(F.col("kept"))
    )
    assert sorted(str((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), hashlib.sha256(r.kept).hexdigest())) for r in got.collect()) == sorted(want)
    assert cleaned_texts(df.limit(0)).count() == 0


def test_suffixes_of_a_long_text(spark):
    rng = random.Random(11)
    long = "".join(rng.choice("abcdefgh ") for _ in range(2_500_000))
    at = SLICE - 30
    rows = [(1, long[at : at + 60]), (2, long)]
    got = {r.first_id: r for r in cleaned_texts(spark.createDataFrame(rows, TEXT)).collect()}
    assert [(s.start, s.length) for s in got[2].spans] == [(at, 60)] and not got[1].spans


def test_lines_with_unlike_ends_are_no_pair(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(300):
        a = "".join(rng.choice("abé ") for _ in range(rng.randint(1, 40)))
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "é"])
        rows.append((a, "".join(b)))
    df = spark.createDataFrame([*rows, ("s" * 30 + "abcdefgh" * 2, "s" * 30 + "stuvwxyz" * 2)], "a string, b string")
    found = df.select("a", _ends_alike(F.col("a"), F.col("b"), 2).alias("alike"), (F.levenshtein("a", "b") <= 2).alias("near")).collect()
    assert all(r.alike for r in found if r.near) and not found[-1].alike

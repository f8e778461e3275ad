"""The conversation trie against plain loops."""

import hashlib
import random
import re
import zlib

import pytest
from doctag.llm import trie
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, path string, depth int"


def plain(rows):
    """The nodes by walking over every prefix of every conversation."""
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            key = (turn is not None, turn or 0)
            convs.setdefault(c, []).append((key, (role or "").encode(), (text or "").encode()))
    lists = {c: [t[1:] for t in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, own in lists.items():
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(lists.get(base, [])[:h] + own[h:])
    members, ends = {}, {}
    for c, seq in rebuilt.items():
        ends.setdefault(seq, []).append(c)
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    own = {n: (len(m) - 1) * (len(re.findall(rb"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0) for n, m in members.items()}
    saved, leaves = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        for d in range(len(node) + 1):
            saved[node[:d]] += own[node]
            leaves[node[:d]] += node not in children
    return sorted(
        (
            min(m), len(n), min(members[n[:-1]]) if n else -(10**9), len(m), len(children.get(n, [])), leaves[n],
            saved[n], hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest(),
        )
        for n, m in members.items()
    )


def nodes(spark, rows):
    out = trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert out.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    ]
    return sorted(tuple(-(10**9) if v is None else v for v in r) for r in out.collect())


def row(c, turn, role, text):
    return (c, turn, role, text, "x", 7)


def drawn(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-45, 90), 60):
        for turn in range(rng.randrange(1, 7)):
            text = rng.choice(["a b", "a  b c", "", None, "d", "é\t\nf"])
            rows.append(row(c, rng.choice([turn, None, 2]), rng.choice(["user", "assistant", None]), text))
    rows += rows[:15]
    # A long conversation, its copy and its beginning.
    long = [("user" if i % 2 else "assistant", f"w{i % 3} {'x ' * (i % 5)}") for i in range(40)]
    for c, n in ((200, 40), (400, 40), (600, 39), (800, 23), (1000, 1)):
        rows += [row(c, i, *t) for i, t in enumerate(long[:n])]
    rows += [row(None, 0, "user", "nobody")] * 3
    rng.shuffle(rows)
    return rows


def test_small_tables(spark, monkeypatch):
    rows = drawn(1)
    assert nodes(spark, rows) == plain(rows)
    # Paths in several chunks, and no key sent along.
    monkeypatch.setattr(trie, "CHUNK", 4)
    monkeypatch.setattr(trie, "SHARE", 0)
    assert nodes(spark, rows) == plain(rows)


def test_turnless_and_single(spark):
    # Of 21 and 22, whose base is missing, some keep no turn of their own.
    rows = [row(c, 0, "user", "only one") for c in range(21, 40)]
    assert nodes(spark, rows) == plain(rows)
    assert any(n[1] == 0 and n[7] != hashlib.sha256().hexdigest() for n in plain(rows))


def test_empty(spark):
    assert nodes(spark, []) == []
    assert nodes(spark, [row(None, None, None, None)]) == []


def test_long_texts_and_ties(spark):
    same = "z" * 300_000
    rows = [row(20, 1, "user", same + "b"), row(20, 1, "user", same + "a"), row(20, 1, "user", "y " * 200_000)]
    got = nodes(spark, rows)
    # Texts that differ only behind the part that decides ties are in the order of their digests.
    assert [n[1] for n in got] == [0, 1, 2, 3] and got[0][5] == 1
    assert nodes(spark, rows[::-1]) == got


def test_one_conversation_over_all_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [row(40, i, "user", f"t{i // 2}") for i in range(3000)] + [row(60, 0, "user", "t0")]
        turns = trie.ordered_turns(spark.createDataFrame(rows, SCHEMA)).filter("conv_id = 40")
        at = [r.at for r in turns.orderBy("at").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert at == list(range(3000))


@pytest.mark.parametrize("down", [False, True])
def test_running_sums_in_chunks(spark, monkeypatch, down):
    rows = [(p, d, n, d * d + p) for p, n in ((1, 30), (2, 0), (3, 11)) for d in range(n + 1)]
    df = spark.createDataFrame(rows, "path long, depth long, len long, x long").withColumn("y", F.col("x"))
    results = []
    for size in (4, 1000):
        monkeypatch.setattr(trie, "CHUNK", size)
        out = trie.running(df, ["x"], F.sum, lambda a, b: a + b, down, {"before": "y"})
        results.append(sorted(tuple(r) for r in out.select("path", "depth", "x", F.coalesce("before", F.lit(-1))).collect()))
    assert results[0] == results[1]
    for path, depth, x, _ in results[0]:
        n = {1: 30, 2: 0, 3: 11}[path]
        assert x == sum(d * d + path for d in (range(depth, n + 1) if down else range(depth + 1)))

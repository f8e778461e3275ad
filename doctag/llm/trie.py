"""Prefix trie of rebuilt conversations by whole-sequence collapse.

Every distinct sequence of first turns is a node. Identical conversations are grouped
into one weighted sequence with a list of ends; sequences that are proper prefixes of
others are found by an anti-join, and the rest are the leaves; weighted prefixes are
then summed per node.

A prefix is known by its fingerprint: the exclusive or of two halves of a digest of
(depth, role, text) over its turns, 120 bits that are computed as running sums, so
that no task needs a whole conversation. What has to be added up along a path is
added in chunks of ``CHUNK`` turns, and the chunks' totals are carried on. Texts leave
the plan after the first sort; from then on a turn is a row of numbers.

The saving below a node is the sum over the nodes of its subtree. Each node is counted
on one path, that of the smallest leaf below it, and each path hands every node on it
what it counts from there to its end; so the work is linear in the turns.

Skew: a conversation, or a node, with a thousandth of all rows or more is one of at
most a thousand, whose side of a join is sent along; all other keys are small. The
end list of a node is hashed as a stream over sorted ids: the hash is sequential, so
one task reads the ids, and only the ids, of one sequence.

Defined cases: a null ``conv_id`` takes no part; null roles and texts are empty;
turns are ordered by ``turn``, null first, then by role, the first ``TIE`` code points of the
text and the digest; repeated rows are turns of their own; a conversation may end up
without turns and then ends at the root; without any conversation there is no node.
Texts may be of any length. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doctag.llm.mixing import word_count
from doctag.llm.registry import durable, query, ship, table

BASE = 20
HEADS = 4
# Turns of a path that a task adds up, and code points of a text that decide a tie.
CHUNK, TIE = 4096, 64
# A key with this share of all rows is handled apart: there are at most so many.
SHARE = 1000
# Hex digits of a digest in each half of a fingerprint.
HALF = 15

NODE = ["hi", "lo", "depth"]


def join_split(rows: DataFrame, side: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Inner join with a stored table of one row a key, where ``size`` is at least the
    number of rows with that key and the sizes sum up to ``total``. Keys with a
    thousandth of it, at most a thousand, are sent along; no other makes a task large."""
    often = F.col(size) * SHARE >= total
    some, rest = F.broadcast(side.filter(often)), side.filter(~often)
    apart = rows.join(some, keys)
    return apart.unionByName(rows.join(some.select(*keys), keys, "left_anti").join(rest, keys))


def running(
    rows: DataFrame,
    columns: list[str],
    fold: Callable[[str], Column],
    both: Callable[[Column, Column], Column],
    down: bool = False,
    also: dict[str, str] | None = None,
) -> DataFrame:
    """``columns`` of the stored ``rows(path, depth, len)`` folded over their path up to
    each row's depth, or with ``down`` from its end to there. ``also`` names columns that
    get the value of the row before in that order. Paths of ``CHUNK`` turns or more
    go in chunks, whose first row repeats the last one of the chunk before as a guest
    that counts nothing."""
    also = also or {}
    turned = F.desc("depth") if down else F.asc("depth")

    def inside(part: DataFrame, *keys: str) -> DataFrame:
        order = W.partitionBy("path", *keys).orderBy(turned)
        upto = order.rowsBetween(W.unboundedPreceding, 0)
        found = {c: fold(c).over(upto) for c in columns}
        return part.withColumns(found | {out: F.lag(c).over(order) for out, c in also.items()})

    short = inside(rows.filter(F.col("len") < CHUNK))
    long = rows.filter(F.col("len") >= CHUNK).withColumn("_chunk", F.floor(F.col("depth") / CHUNK))
    # The row before a chunk, in the order, is a guest of it.
    edge = CHUNK - 1 if not down else 0
    step = 1 if not down else -1
    guest = (F.pmod("depth", F.lit(CHUNK)) == edge) & (F.col("_chunk") + step >= 0)
    guests = long.filter(guest).withColumn("_chunk", F.col("_chunk") + step)
    guests = guests.withColumns({c: F.lit(0).cast("long") for c in columns}).withColumn("_guest", F.lit(True))
    parts = inside(long.withColumn("_guest", F.lit(False)).unionByName(guests), "_chunk").filter("NOT _guest")
    totals = long.groupBy("path", "_chunk").agg(*[fold(c).alias(c) for c in columns])
    chunks = W.partitionBy("path").orderBy(F.desc("_chunk") if down else F.asc("_chunk"))
    before = chunks.rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select("path", "_chunk", *[F.coalesce(fold(c).over(before), F.lit(0)).alias(f"_{c}") for c in columns])
    parts = parts.join(carried, ["path", "_chunk"]).withColumns({c: both(F.col(c), F.col(f"_{c}")) for c in columns})
    return short.unionByName(parts.select(*short.columns))


NUMBERED = "conv_id long, at long, digest string, words long"


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The place of each row among the rows of its conversation in this partition."""
    last, seen = None, 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        if not len(ids):
            continue
        place = np.arange(len(ids))
        first = np.maximum.accumulate(np.where(np.r_[True, ids[1:] != ids[:-1]], place, 0))
        at = place - first
        if ids[0] == last:
            at[first == 0] += seen
        last, seen = ids[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(at), batch.column(1), batch.column(2)], ["conv_id", "at", "digest", "words"]
        )


def ordered_turns(rows: DataFrame) -> DataFrame:
    """``conv_id, at, digest, words``: each turn with its place, from 0. The rows are
    sorted over all tasks, and a conversation that goes on in a later partition adds
    what lies before; at most one conversation enters each partition."""
    ship(rows.sparkSession)
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    sized = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"),
        "turn",
        F.left(role, F.lit(TIE)).alias("_role"),
        F.left(text, F.lit(TIE)).alias("_text"),
        F.md5(sized).alias("digest"),
        word_count(F.col("text")).alias("words"),
    )
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("_role"), F.asc("_text"), F.asc("digest")]
    placed = (
        turns.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "digest", "words")
        .mapInArrow(_number, NUMBERED)
        .withColumn("_part", F.spark_partition_id())
    )
    placed = durable(placed)
    counts = placed.groupBy("conv_id", "_part").agg(F.count(F.lit(1)).alias("_n"))
    upto = W.partitionBy("conv_id").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = counts.withColumn("_before", F.sum("_n").over(upto)).filter("_before IS NOT NULL").drop("_n")
    # At most one row a partition.
    return placed.join(F.broadcast(before), ["conv_id", "_part"], "left").select(
        "conv_id", (F.col("at") + F.coalesce("_before", F.lit(0))).alias("at"), "digest", "words"
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, digest, words, len`` of stored ``turns``: every conversation's
    first turns come from the one that its block of ``BASE`` ids starts with. Depth 0 is
    the start of every conversation."""
    heads = (
        turns.filter(F.col("at") < HEADS - 1)
        .groupBy(F.col("conv_id").alias("_base"))
        .agg(F.array_sort(F.collect_list(F.struct("at", "digest", "words"))).alias("_heads"))
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"))
    convs = convs.select("conv_id", "_n", h, (F.col("conv_id") - F.col("conv_id") % BASE).alias("_base"))
    empty = F.expr("array()").cast("array<struct<at: bigint, digest: string, words: bigint>>")
    mine = F.slice(F.coalesce("_heads", empty), F.lit(1), F.col("h").cast("int"))
    convs = convs.join(heads, "_base", "left").withColumn("_heads", mine).drop("_base")
    taken = F.size("_heads").cast("long")
    own = F.greatest(F.col("_n") - F.col("h"), F.lit(0))
    convs = durable(convs.withColumn("len", taken + own))
    shift = convs.select("conv_id", "_n", "h", (taken - F.col("h")).alias("_shift"), "len")
    tails = join_split(turns, shift, ["conv_id"], "_n", turns.count()).filter("at >= h").select(
        "conv_id", (F.col("at") + F.col("_shift") + 1).alias("depth"), "digest", "words", "len"
    )
    first = convs.select("conv_id", "len", F.explode("_heads").alias("_t")).select(
        "conv_id", (F.col("_t.at") + 1).alias("depth"), "_t.digest", "_t.words", "len"
    )
    start = convs.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("digest"),
        F.lit(0).cast("long").alias("words"), "len",
    )
    return tails.unionByName(first).unionByName(start)


def prefixes(turns: DataFrame) -> DataFrame:
    """``path, depth, hi, lo, words, len``: the fingerprint of every prefix; the
    empty one has 0."""
    term = F.md5(F.concat_ws(":", "depth", "digest"))

    def half(at: int) -> Column:
        bits = F.conv(F.substring(term, at, HALF), 16, 10).cast("long")
        return F.when(F.col("depth") > 0, bits).otherwise(F.lit(0).cast("long"))

    terms = turns.select(F.col("conv_id").alias("path"), "depth", half(1).alias("hi"), half(17).alias("lo"), "words", "len")
    return running(durable(terms), ["hi", "lo"], F.bit_xor, lambda a, b: a.bitwiseXOR(b))


ENDS = "hi long, lo long, len long, path long, weight long, ends_sha256 string"


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each run of equal sequences, whose ids come in rising order."""
    now, first, n, digest = None, 0, 0, hashlib.sha256()
    for batch in batches:
        done = []
        hi, lo, length, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        start = np.flatnonzero(np.r_[True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]) | (length[1:] != length[:-1])])
        for a, b in zip(start.tolist(), np.append(start[1:], len(ids)).tolist()):
            if a == b:
                continue
            key = (int(hi[a]), int(lo[a]), int(length[a]))
            listed = ",".join(map(str, ids[a:b].tolist()))
            if key == now:
                n += b - a
                digest.update(f",{listed}".encode())
                continue
            if now:
                done.append((*now, first, n, digest.hexdigest()))
            now, first, n, digest = key, int(ids[a]), b - a, hashlib.sha256(listed.encode())
        yield _ends(done)
    if now:
        yield _ends([(*now, first, n, digest.hexdigest())])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in ENDS.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    types = [pa.int64()] * 5 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def sequences(ends: DataFrame) -> DataFrame:
    """``hi, lo, len, path, weight, ends_sha256`` of ``ends(hi, lo, len, path)``, a row for
    each conversation: the distinct sequences, their smallest conversation, how many
    there are, and the hash of their ids."""
    ship(ends.sparkSession)
    keys = ["hi", "lo", "len"]
    return ends.repartition(*keys).sortWithinPartitions(*keys, "path").select(*keys, "path").mapInArrow(_collapse, ENDS)


def trie(rows: DataFrame) -> DataFrame:
    """The nodes of ``rows(conv_id, turn, role, text)``: ``conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    all_prefixes = durable(prefixes(rebuilt(durable(ordered_turns(rows)))))
    total = all_prefixes.count()
    whole = durable(sequences(all_prefixes.filter("depth = len").select("hi", "lo", "len", "path")))

    # Leaves are the sequences that are no proper prefix.
    proper = all_prefixes.filter("depth < len").select("hi", "lo", F.col("depth").alias("len")).distinct()
    leaves = whole.join(proper, ["hi", "lo", "len"], "left_anti").select("path", F.lit(1).alias("_leaf"))
    marked = durable(
        whole.select("path", "weight", (F.col("len") + 1).alias("_rows"), F.col("len").alias("_len"))
        .join(leaves, "path", "left")
        .select("path", "weight", "_rows", F.coalesce("_leaf", F.lit(0)).alias("leaf"))
    )
    weighted = durable(join_split(all_prefixes, marked, ["path"], "_rows", total).drop("_rows"))

    below = F.when(F.col("leaf") == 1, F.col("path"))
    nodes = weighted.groupBy(*NODE).agg(
        F.min("path").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.sum("leaf").cast("long").alias("n_leaves"),
        F.min(below).alias("_owner"),
        F.max("words").alias("_words"),
    )
    nodes = durable(nodes)
    paths = weighted.filter("leaf = 1").select("path", "len", *NODE)
    counted = (F.col("path") == F.col("_owner")).alias("_own")
    saved = F.when(F.col("path") == F.col("_owner"), (F.col("n_convs") - 1) * F.col("_words")).otherwise(F.lit(0))
    side = nodes.select(*NODE, "conv_id", "n_convs", "n_leaves", "_owner", "_words")
    steps = join_split(paths, side, NODE, "n_leaves", total).select(
        "path", "len", *NODE, counted, saved.cast("long").alias("_saved"), F.col("conv_id").alias("_conv")
    )
    # From the end of each path towards the root; the row before is the child.
    up = running(durable(steps), ["_saved"], F.sum, lambda a, b: a + b, True, {"_child": "_conv", "_child_own": "_own"})
    up = durable(up)

    # A node's saving and children come from the paths through it.
    none = F.lit(None).cast("long")
    sums = up.groupBy(*NODE).agg(
        F.sum("_saved").alias("saved_tokens"),
        F.count_if(F.coalesce("_child_own", F.lit(False))).alias("n_children"),
    )
    # The path that counts a child tells it its parent.
    parents = up.filter("_child_own").select((F.col("depth") + 1).alias("depth"), F.col("_child").alias("conv_id"), F.col("_conv").alias("parent_conv_id"))
    ends = whole.select("hi", "lo", F.col("len").alias("depth"), "ends_sha256")
    nothing = hashlib.sha256().hexdigest()
    return (
        nodes.join(sums, NODE)
        .join(parents, ["depth", "conv_id"], "left")
        .join(ends, NODE, "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") > 0, F.col("parent_conv_id")).otherwise(none).alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )


# The crc32 of a string before its last inversion. A byte is followed by eight marks, a step each.
CRC = """list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(string_split({0}, ''),
      lambda ch: list_concat([ascii(ch)::BIGINT], [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END)"""
SQL = f"""
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT c, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, r, x) AS l FROM t GROUP BY c),
crc AS (SELECT c, l, xor({CRC.format("c::VARCHAR")}, 4294967295) % 4 AS h FROM lists),
re AS (
  SELECT a.c, list_concat(coalesce(b.l[1:a.h], []), a.l[a.h + 1:]) AS l
  FROM crc a LEFT JOIN lists b ON b.c = a.c - a.c % 20),
members AS (SELECT c, d, l[1:d] AS k, len(l) = d AS ends FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM re)),
nodes AS (
  SELECT k, d, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256,
         len(regexp_extract_all(coalesce(k[d].x, ''), '[^\\x20\\x09-\\x0D]+')) AS words
  FROM members GROUP BY k, d),
children AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
below AS (
  SELECT k[1:u] AS k, sum((n_convs - 1) * words) AS saved, count(*) FILTER (childless) AS leaves FROM (
    SELECT v.k, v.n_convs, v.words, ch.n IS NULL AS childless, unnest(range(0, v.d + 1)) AS u
    FROM nodes v LEFT JOIN children ch ON v.k = ch.k) GROUP BY 1)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n, 0) AS n_children,
       b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON n.k = b.k LEFT JOIN children ch ON n.k = ch.k
LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.k = n.k[1:n.d - 1]
"""


@query("op13_trie", SQL)
def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return trie(table(spark, sf_dir, "conversations"))

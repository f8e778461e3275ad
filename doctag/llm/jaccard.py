"""N-gram Jaccard join with Bayesian candidate pruning.

A text is the set of its word n-grams, hashed. Texts with equal sets are one node.
Nodes that agree in a band of MinHash values meet in a bucket; there, values are
compared a few at a time, and a pair is dropped as soon as the posterior probability
that its similarity reaches the threshold falls below the tolerance. Buckets only
decide which nodes hang together: members are compared with a leader, and those
that do not join it become leaders themselves, so a bucket of near copies costs one
comparison per member. In each connected cluster all pairs are then pruned in the
same way and the rest is verified on the whole sets, exactly.

A pair at the threshold shares no band with a probability of (1 - 0.8^5)^28 < 2e-5.

Words are runs of letters, digits, underscores and all non-ASCII characters, with
ASCII letters lowered. A text of fewer words than n has one n-gram, all its words.

Defined cases: null texts and texts without words have no n-gram and link with
nothing; a null document id is a document, linked like any other, whose class is
null when no document of the class has an id; repeated rows are documents linked
with each other; an empty table gives an empty result. Only ``doc_id`` and ``text``
are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doctag.llm import bytetext
from doctag.llm.components import components, roots
from doctag.llm.registry import durable, query, ship, table

NGRAM = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 28, 5
HASHES = BANDS * BAND_ROWS
TOLERANCE = 1e-6
# MinHash values compared between two looks at the posterior.
STEP = 20
SEED = 41
# Rows of a bucket, and of a cluster, that one task compares with each other at most.
BUCKET_BLOCK, CLUSTER_BLOCK = 20_000, 512
# Distinct n-grams that are counted at a time when sets are intersected.
COLUMNS = 4096

WORD = np.zeros(256, bool)
WORD[ord("0") : ord("9") + 1] = WORD[ord("A") : ord("Z") + 1] = WORD[ord("a") : ord("z") + 1] = True
WORD[ord("_")] = True
WORD[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the n + 1 offsets of the texts in them."""
    parts, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for data, starts, rows in bytetext.slices(texts):
        data = LOWER[data]
        inside = WORD[data]
        before = np.r_[False, inside[:-1]]
        before[starts] = False
        after = np.r_[inside[1:], False]
        after[starts[1:] - 1] = False
        begin, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        parts.append(bytetext.span_hashes(data, begin, end))
        owners.append(rows[np.searchsorted(starts, begin, "right") - 1])
    counts = np.bincount(np.concatenate(owners), minlength=len(texts))
    return np.concatenate(parts), np.r_[0, np.cumsum(counts)]


def ngram_sets(texts: pa.Array, n: int = NGRAM) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of every text."""
    words, offsets = word_hashes(texts)
    with np.errstate(over="ignore"):
        factors = np.cumprod(np.full(n, 0x9E3779B97F4A7C15, np.uint64))
        grams = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for i, f in enumerate(factors):
            grams += words[i : i + len(grams)] * f
        grams = bytetext.mixed(grams)
        out = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if b - a >= n:
                out.append(np.unique(grams[a : b - n + 1]))
            else:
                out.append(bytetext.mixed((words[a:b] * factors[: b - a]).sum(keepdims=True))[: b - a])
    return out


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """16-bit MinHash values, a row per set that is not empty."""
    rng = np.random.default_rng(SEED)
    factor = rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 2**63, HASHES, dtype=np.uint64)
    out = np.empty((len(sets), HASHES), np.uint16)
    at = 0
    while at < len(sets):
        # About as many values at a time as a cache holds.
        stop, size = at + 1, len(sets[at])
        while stop < len(sets) and size + len(sets[stop]) <= 1 << 15:
            size += len(sets[stop])
            stop += 1
        flat = np.concatenate(sets[at:stop])
        first = np.r_[0, np.cumsum([len(s) for s in sets[at : stop - 1]])].astype(np.int64)
        with np.errstate(over="ignore"):
            for i in range(HASHES):
                low = np.minimum.reduceat((flat * factor[i] + shift[i]) >> np.uint64(32), first)
                out[at:stop, i] = low & np.uint64(0xFFFF)
        at = stop
    return out


def least_matches(threshold: float, tolerance: float) -> np.ndarray:
    """For each number n of compared values the smallest number of equal ones at which
    the posterior of the similarity, from a flat prior, still gives the threshold at
    least the tolerance. P(s >= t) for Beta(m + 1, n - m + 1) is the probability of at
    most m successes in n + 1 trials of chance t."""
    out = np.zeros(HASHES + 1, np.int64)
    for n in range(1, HASHES + 1):
        total = 0.0
        for m in range(n + 1):
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                out[n] = m
                break
    return out


LEAST = least_matches(THRESHOLD, TOLERANCE)


def prune(a: np.ndarray, b: np.ndarray, least: np.ndarray = LEAST) -> np.ndarray:
    """True for the pairs of rows of ``a`` and ``b`` that survive."""
    alive, equal = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n in range(0, HASHES, STEP):
        equal = equal + (a[alive, n : n + STEP] == b[alive, n : n + STEP]).sum(1)
        keep = equal >= least[min(n + STEP, HASHES)]
        alive, equal = alive[keep], equal[keep]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def intersections(left: list[np.ndarray], right: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of ``left[i]`` and ``right[j]`` for the pairs (i, j)."""
    if len(pairs) <= 4 * (len(left) + len(right)):
        return np.array([len(np.intersect1d(left[i], right[j], True)) for i, j in pairs], np.int64)
    flat = np.concatenate(left + right)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    column, owner = column[(keep := times[column] > 1)], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        hit = np.zeros((len(left) + len(right), COLUMNS), np.float32)
        hit[owner[a:b], column[a:b] - low] = 1
        common += hit[: len(left)] @ hit[len(left) :].T
    return common[pairs[:, 0], pairs[:, 1]].astype(np.int64)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The groups of a partition sorted by its first ``keys`` integer columns."""
    rest: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        first = np.r_[0, _changes(rows, keys)]
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            yield rows.slice(a, b - a)
        rest = rows.slice(int(first[-1])).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


def _changes(rows: pa.Table, keys: int) -> np.ndarray:
    change = np.zeros(max(0, rows.num_rows - 1), bool)
    for i in range(keys):
        column = rows.column(i).to_numpy()
        change |= column[1:] != column[:-1]
    return np.flatnonzero(change) + 1


def _signature(column: pa.ChunkedArray, kind=np.uint16) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_buffer(), kind) for x in column])


def _ref() -> Column:
    """Names a document by its id and its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.concat_ws("#", F.col("doc_id").cast("string"), F.md5(text))


READ = "doc_id long, ref string, key binary, signature binary, bands array<long>"


def _signed(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, ref, key, signature, bands`` of every document with n-grams. The
    key is a digest of the set; ``ref`` finds the row again."""
    names = [c.split()[0] for c in READ.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = ngram_sets(part.column(2), n)
                some = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
                if not len(some):
                    continue
                sets = [sets[i] for i in some]
                signature = minhashes(sets)
                bands = signature.reshape(-1, BAND_ROWS).copy().view(np.uint8)
                at_band = np.arange(len(bands)) * bands.shape[1]
                hashed = bytetext.span_hashes(bands.ravel(), at_band, at_band + bands.shape[1])
                # The number of the band is part of the bucket's name.
                hashed = bytetext.mixed(hashed ^ np.tile(np.arange(BANDS, dtype=np.uint64), len(sets)))
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(some)),
                        part.column(1).take(pa.array(some)),
                        pa.array(keys, pa.binary()),
                        pa.array([row.tobytes() for row in signature], pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(hashed.view(np.int64))
                        ),
                    ],
                    names,
                )

    return docs.select(F.col("doc_id").cast("long"), _ref().alias("ref"), "text").mapInArrow(read, READ)


LINKS = "a long, b long"


def _bucket_links(buckets: DataFrame, least: np.ndarray) -> DataFrame:
    """Stars of the nodes that hang together in a bucket."""

    def star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 3):
            node, first = np.unique(group.column(3).to_numpy(), return_index=True)
            signature = _signature(group.column(4).take(pa.array(first)))
            label = np.arange(len(node))
            for leader in range(len(node)):
                # All with the first leader have met it; the others lead in turn.
                if leader and label[leader] == label[0]:
                    continue
                others = np.flatnonzero(label != label[leader])
                near = prune(np.repeat(signature[leader][None], len(others), 0), signature[others], least)
                for old in np.unique(label[others[near]]):
                    low, high = sorted((old, label[leader]))
                    label[label == high] = low
            far = label != np.arange(len(node))
            yield pa.RecordBatch.from_arrays([pa.array(node[far]), pa.array(node[label[far]])], ["a", "b"])

    return buckets.mapInArrow(star, LINKS)


def _paired_blocks(rows: DataFrame, size: str, node: str, block: int) -> DataFrame:
    """Deals groups of ``size`` rows into blocks and every row to all pairs of blocks
    that hold its own: adds ``_own, _i, _j``."""
    count = F.ceil(F.col(size) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(node), count).cast("int")
    return (
        rows.withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), count - 1)))
        .withColumn("_i", F.least("_own", "_other"))
        .withColumn("_j", F.greatest("_own", "_other"))
        .drop("_other")
    )


def _grouped(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of equal keys side by side in one partition."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, *keys).sortWithinPartitions(*keys)


VERIFIED = "node long, root long, links long"


def _verify(rows: DataFrame, threshold: float, least: np.ndarray) -> DataFrame:
    """Link counts of the nodes of each cluster, and a star per connected part."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 3):
            i, j = group.column(1)[0].as_py(), group.column(2)[0].as_py()
            node, copies, own = (group.column(c).to_numpy() for c in (3, 4, 5))
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column(6)]
            signature, size = _signature(group.column(7)), np.array([len(s) for s in sets])
            left, right = (np.flatnonzero(own == k) for k in (i, j))
            pairs = []
            for a in left:
                others = right[right > a] if i == j else right
                ratio = np.minimum(size[a], size[others]) / np.maximum(size[a], size[others])
                others = others[ratio >= threshold]
                near = prune(np.repeat(signature[a][None], len(others), 0), signature[others], least)
                pairs.append(np.stack([np.full(near.sum(), a), others[near]], 1))
            pairs = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
            place = np.zeros(len(node), np.int64)
            place[right], at_left = np.arange(len(right)), np.searchsorted(left, pairs[:, 0])
            common = intersections(
                [sets[k] for k in left], [sets[k] for k in right], np.stack([at_left, place[pairs[:, 1]]], 1)
            )
            union = size[pairs[:, 0]] + size[pairs[:, 1]] - common
            a, b = pairs[common / union >= threshold].T
            links = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
            some = links > 0
            root = node[roots(len(node), a, b)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[some]), pa.array(root[some]), pa.array(links[some].astype(np.int64))],
                ["node", "root", "links"],
            )

    return rows.mapInArrow(verify, VERIFIED)


def _classes(docs: DataFrame, threshold: float, n: int, tolerance: float) -> DataFrame:
    """``doc_id, ref, first, n_links`` of the documents with n-grams; ``first`` is the
    first document of the class: the one with the smallest id."""
    ship(docs.sparkSession)
    least = least_matches(threshold, tolerance)
    signed = durable(_signed(docs, n))
    # Documents without an id come last.
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "ref")
    nodes = durable(
        signed.groupBy("key")
        .agg(
            F.min(own).alias("first"),
            F.count(F.lit(1)).alias("copies"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    # Buckets of several nodes; the nodes in them get their signatures back.
    bands = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    meeting = durable(bands.join(shared, "bucket").groupBy("node").agg(
        F.collect_list(F.struct("bucket", "_n")).alias("_in")
    ))
    members = meeting.join(nodes.select("node", "signature"), "node").select(
        "node", "signature", F.inline("_in")
    )
    dealt = _paired_blocks(members, "_n", "node", BUCKET_BLOCK).select("bucket", "_i", "_j", "node", "signature")
    hanging = components(_bucket_links(_grouped(dealt, "bucket", "_i", "_j"), least))
    sizes = hanging.groupBy("component").agg(F.count(F.lit(1)).alias("_n"))
    clusters = durable(
        hanging.join(sizes, "component")
        .join(nodes.drop("bands"), "node")
        .select("component", "_n", "node", "copies", F.col("first.ref").alias("ref"), "signature")
    )
    found = durable(_verify(_with_sets(docs, clusters, n), threshold, least))
    links = found.groupBy("node").agg(F.sum("links").alias("_links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    ids = nodes.select("node", "key", "first", "copies")
    named = joined.join(ids, "node").groupBy("component").agg(F.min("first").alias("_class"))
    known = (
        ids.join(links, "node", "left")
        .join(joined.join(named, "component").select("node", "_class"), "node", "left")
        .select(
            "key",
            F.coalesce("_class", "first").alias("first"),
            (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        )
    )
    return signed.select("doc_id", "ref", "key").join(known, "key").drop("key")


def jaccard_classes(
    docs: DataFrame, threshold: float = THRESHOLD, n: int = NGRAM, tolerance: float = TOLERANCE
) -> DataFrame:
    """``doc_id, class_id, n_links``, a row per row of ``docs(doc_id, text)``: the
    smallest document id that links reach, and the number of other documents that are
    linked directly."""
    docs = docs.select("doc_id", "text")
    some = _classes(docs, threshold, n, tolerance)
    return some.select("doc_id", F.col("first.doc_id").alias("class_id"), "n_links").unionByName(_wordless(docs))


def first_of_class(
    docs: DataFrame, threshold: float = THRESHOLD, n: int = NGRAM, tolerance: float = TOLERANCE
) -> DataFrame:
    """``docs`` with one row of each class. Documents without n-grams all stay."""
    classes = _classes(docs.select("doc_id", "text"), threshold, n, tolerance)
    gone = durable(
        classes.filter("n_links > 0")
        .select(F.col("ref").alias("_ref"), (F.col("ref") == F.col("first.ref")).alias("_stays"))
        .distinct()
    )
    whole = docs.select(_ref().alias("_ref"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = whole.join(gone, "_ref", "left").filter("coalesce(_stays, true)")
    # Equal rows follow each other here; where they form a class the first one stays.
    again = F.row_number().over(W.partitionBy("_ref").orderBy(F.lit(1)))
    return rows.withColumn("_again", again).filter("_stays IS NULL OR _again = 1").select("_row.*")


def _wordless(docs: DataFrame) -> DataFrame:
    word = F.coalesce(F.col("text"), F.lit("")).rlike(r"[0-9A-Za-z_\x{80}-\x{10FFFF}]")
    return docs.filter(~word).select(
        F.col("doc_id").cast("long"), F.col("doc_id").cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links")
    )


SETS = "component long, _n long, node long, copies long, grams binary, signature binary"


def _with_sets(docs: DataFrame, clusters: DataFrame, n: int) -> DataFrame:
    """``component, _i, _j, node, copies, _own, grams, signature``: the clustered nodes,
    with their sets made anew from one of their texts, dealt to pairs of blocks."""
    texts = docs.select(_ref().alias("ref"), "text").join(clusters, "ref")
    names = [c.split()[0] for c in SETS.split(", ")]
    columns = ["text", "component", "_n", "node", "copies", "signature"]

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                grams = pa.array([s.tobytes() for s in ngram_sets(part.column(0), n)], pa.binary())
                columns = [*(part.column(c) for c in range(1, 5)), grams, part.column(5)]
                yield pa.RecordBatch.from_arrays(columns, names)

    sets = texts.select(*columns).mapInArrow(again, SETS).dropDuplicates(["node"])
    dealt = _paired_blocks(sets, "_n", "node", CLUSTER_BLOCK)
    order = ["component", "_i", "_j", "node", "copies", "_own", "grams", "signature"]
    return _grouped(dealt.select(*order), "component", "_i", "_j")


SQL = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z_\x{80}-\x{10FFFF}]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM texts WHERE len(w) > 0)),
sizes AS (SELECT id, count(*) AS n FROM grams GROUP BY id),
shared AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.id <> b.id GROUP BY a.id, b.id),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.id JOIN sizes y ON b = y.id WHERE c / (x.n + y.n - c) >= 0.8::DOUBLE),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
firsts AS (SELECT r.a, min(t.doc_id) AS first FROM reached r JOIN texts t ON r.b = t.id GROUP BY r.a)
SELECT t.doc_id, least(t.doc_id, f.first) AS class_id, coalesce(n, 0) AS n_links
FROM texts t LEFT JOIN counts c ON t.id = c.a LEFT JOIN firsts f ON t.id = f.a
"""


@query("op10_jaccard", SQL)
def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class and its links."""
    return jaccard_classes(table(spark, sf_dir, "documents"))

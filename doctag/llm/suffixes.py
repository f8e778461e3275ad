r"""Removal of repeated byte strings by a distributed sort of sampled suffixes.

A byte goes when a string of ``length`` bytes that covers it also starts in a
document with a smaller id. Strings are judged on the input.

1. Sampling. In every window of length - gram + 1 grams the grams with the smallest
   hash are anchors. Equal windows have equal anchors, so every string that repeats
   contains an anchor that repeats. Each task sorts the anchor hashes of its texts;
   the sorted, difference-coded runs are dealt by hash range, and a range finds the
   anchors that occur more than once. Only these go on: a few per cent of all
   positions.
2. Sorting. The suffixes at repeated anchors, up to the length of a string, are
   sorted in runs, front-coded (the length of the prefix shared with the one before,
   and the rest) and dealt by a hash of their first gram. Runs are merged by a loser
   tree that keeps with each contender the length of the prefix that it shares with
   the last winner: the longer shared prefix wins unread, and two equal ones are
   compared from there on. So no known prefix is compared again, and the merge knows
   the common prefix of all neighbours.
3. Judging. Suffixes that share a string from o bytes before the anchor on share
   ``length - o`` bytes of prefix, which the merge has told, and o bytes before it,
   told likewise by a sort of the reversed bytes before. The smallest document of
   each such class removes the string from the others.

Texts that occur more than once take part once, with their smallest document; the
further copies lose everything if they have ``length`` bytes.

Defined cases: null text is empty; texts shorter than ``length`` lose nothing; a null
id is larger than all others, and documents without ids, or of the same id, remove
nothing from each other; repeated rows are treated alike; an empty table gives an
empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doctag.llm.bytetext import SLICE, mixed, powers, text_buffer
from doctag.llm.registry import durable, query, ship, table

LENGTH = 50
GRAM = 20
# Anchors that a task sorts at a time, bytes of text in one group, and the shift that
# leaves 48 bits of a hash.
RUN, GROUP_BYTES, DROP = 1 << 19, 1 << 23, np.uint64(16)
# Rows that are made distinct at a time.
ROWS = 2000
LAST = np.iinfo(np.int64).max


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return pick(x[:-rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of one stretch of bytes."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = powers(len(data))
    n = len(data) - gram + 1
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        hashes = mixed((sums[gram:] - sums[:-gram]) * down[:n])
    width = length - gram + 1
    order = (hashes >> np.uint64(32)).astype(np.uint32)
    low = _sliding(order, width, np.minimum)
    pad = np.zeros(width - 1, np.uint32)
    at = np.flatnonzero(order == _sliding(np.concatenate([pad, low, pad]), width, np.maximum))
    return at, hashes[at]


def _stretches(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """``begin, end`` of stretches of whole texts, or of overlapping parts of a long
    one, so that every string of a text lies in one of them; and the first row."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1)
        begin, end = int(offsets[row]), int(offsets[stop])
        for at in range(begin, max(begin + 1, end), SLICE):
            yield at, min(end, at + SLICE + length), row
        row = stop


def text_anchors(texts: pa.Array, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``data, offsets`` of the texts, and ``row, position, hash`` of their anchors;
    positions count in ``data``."""
    data, offsets = text_buffer(texts)
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for begin, end, _ in _stretches(data, offsets, length):
        at, h = anchors(data[begin:end], length, gram)
        places.append(at + begin)
        hashes.append(h)
    at, first = np.unique(np.concatenate(places), return_index=True)
    hashes = np.concatenate(hashes)[first]
    row = np.searchsorted(offsets, at, "right") - 1
    # Grams across the end of a text belong to none.
    own = at + gram <= offsets[row + 1]
    return data, offsets, row[own], at[own], hashes[own]


def encode_sorted(values: np.ndarray) -> bytes:
    """Sorted numbers below 2^48 as differences of 32 bits, or of 64 where needed."""
    steps = np.diff(values, prepend=np.uint64(0))
    small = len(steps) == 0 or int(steps[1:].max(initial=0)) < 2**32
    head = values[:1].astype("<u8").tobytes()
    return bytes([small]) + head + steps[1:].astype("<u4" if small else "<u8").tobytes()


def decode_sorted(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, "<u4" if data[0] else "<u8", offset=9).astype(np.uint64)
    return np.cumsum(np.r_[np.frombuffer(data[1:9], "<u8"), steps])


def _repeated(docs: DataFrame, n: int, length: int, gram: int) -> DataFrame:
    """``part, tags, hashes``: for the texts of a part, which anchors occur again."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            hashes, tags = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.argsort(hashes, kind="stable")
            hashes, tags = hashes[order], tags[order]
            cut = np.searchsorted(hashes, bounds)
            rows = [(b, encode_sorted(hashes[x:y]), tags[x:y].tobytes()) for b, (x, y) in enumerate(zip(cut, cut[1:])) if x < y]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
                ["range", "hashes", "tags"],
            )

        for batch in _once(batches):
            tag = batch.column(0).to_numpy().astype(np.uint64)
            _, _, row, _, hashes = text_anchors(batch.column(2), length, gram)
            held.append((hashes >> DROP, tag[row].astype(np.uint32)))
            if sum(len(h) for h, _ in held) >= RUN:
                yield from flush()
        if sum(len(h) for h, _ in held):
            yield from flush()

    bounds = np.array([((1 << 48) * i) // n for i in range(n + 1)], np.uint64)

    def meet(key: tuple, group: pa.Table) -> pa.Table:
        hashes = np.concatenate([decode_sorted(x.as_py()) for x in group.column("hashes")])
        tags = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in group.column("tags")])
        order = np.argsort(hashes, kind="stable")
        hashes, tags = hashes[order], tags[order]
        same = hashes[1:] == hashes[:-1]
        again = np.r_[same, False] | np.r_[False, same] if len(hashes) else np.zeros(0, bool)
        hashes, tags = hashes[again], tags[again]
        part = tags % n
        order = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[order], np.arange(n + 1))
        some = np.flatnonzero(np.diff(cut))
        of = [order[cut[p] : cut[p + 1]] for p in some]
        pa.default_memory_pool().release_unused()
        return pa.table(
            {
                "part": pa.array(some, pa.int32()),
                "tags": pa.array([tags[o].tobytes() for o in of], pa.binary()),
                "hashes": pa.array([encode_sorted(hashes[o]) for o in of], pa.binary()),
            }
        )

    return (
        _rows(docs)
        .mapInArrow(runs, "range int, hashes binary, tags binary")
        .groupBy("range")
        .applyInArrow(meet, "part int, tags binary, hashes binary")
    )


def front_code(keys: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Of sorted rows of bytes: shared prefix lengths, and the rests."""
    shared = np.zeros(len(keys), np.uint8)
    if len(keys) > 1:
        differ = keys[1:] != keys[:-1]
        shared[1:] = np.where(differ.any(1), differ.argmax(1), keys.shape[1])
    return shared, keys[np.arange(keys.shape[1]) >= shared[:, None]].tobytes()


def front_decode(shared: np.ndarray, rest: bytes, width: int) -> np.ndarray:
    keys = np.zeros((len(shared), width), np.uint8)
    new = np.arange(width) >= shared[:, None]
    keys[new] = np.frombuffer(rest, np.uint8)
    # A byte that is shared comes from the last row that had its own.
    source = np.maximum.accumulate(np.where(new, np.arange(len(shared))[:, None], 0), axis=0)
    return np.take_along_axis(keys, source, 0)


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The order in which ``(keys, shared)`` runs merge, as places in their
    concatenation, and the length of the prefix that each shares with the one before.

    A loser tree over the runs: ``state[r]`` is the prefix that the head of run r
    shares with the last winner. The next head of the winner's run comes with its
    shared prefix from the front coding. Of two heads the one that shares more is
    smaller; when they share the same, bytes decide from there on, and the loser keeps
    the prefix that it shares with the one that beat it."""
    runs = [r for r in runs if len(r[0])]
    base = np.cumsum([0] + [len(k) for k, _ in runs]).tolist()
    heads = [[row.tobytes() for row in k] for k, _ in runs]
    shared = [s.tolist() for _, s in runs]
    leaves = 1 << max(0, len(runs) - 1).bit_length()
    at = [0] * len(runs)
    state = [0] * leaves
    over = [False] * len(runs) + [True] * (leaves - len(runs))
    total = base[-1] if runs else 0
    order, common = np.empty(total, np.int64), np.empty(total, np.uint8)

    def beats(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's state is brought up to date."""
        if over[a]:
            return b, a
        if over[b]:
            return a, b
        x, y = state[a], state[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        p, q = heads[a][at[a]], heads[b][at[b]]
        if p[x:] == q[x:]:
            low, high, k = min(a, b), max(a, b), width
        else:
            k = x
            while p[k] == q[k]:
                k += 1
            low, high = (a, b) if p[k] < q[k] else (b, a)
        state[high] = k
        return low, high

    loser = [0] * leaves
    winner = list(range(leaves)) if leaves == 1 else [0] * leaves + list(range(leaves))
    for node in range(leaves - 1, 0, -1):
        winner[node], loser[node] = beats(winner[2 * node], winner[2 * node + 1])
    top = winner[1] if leaves > 1 else 0
    for i in range(total):
        order[i], common[i] = base[top] + at[top], state[top]
        at[top] += 1
        if at[top] < len(heads[top]):
            state[top] = shared[top][at[top]]
        else:
            over[top] = True
        node = (top + leaves) // 2
        while node:
            top, loser[node] = beats(top, loser[node])
            node //= 2
    return order, common


def judge(keys, common, before, doc, length: int, gram: int) -> Iterator[tuple[np.ndarray, int]]:
    """``rows, o``: the sorted suffixes whose string from o bytes before the anchor on
    also lies in a document with a smaller number. ``keys`` and ``before`` are padded
    with 0, which no text holds here."""
    n = len(keys)
    right = (keys > 0).sum(1)
    left = (before > 0).sum(1)
    reverse = before[:, ::-1]
    back = np.lexsort(reverse.T[::-1])
    differ = reverse[back][1:] != reverse[back][:-1]
    shared = np.r_[0, np.where(differ.any(1), differ.argmax(1), before.shape[1])]
    for o in range(length - gram + 1):
        rows = np.flatnonzero((left >= o) & (right >= length - o))
        if not len(rows):
            continue
        ahead = np.cumsum(common < length - o)
        behind = np.empty(n, np.int64)
        behind[back] = np.cumsum(shared < o)
        key = ahead[rows] * np.int64(n + 1) + behind[rows]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        least = np.minimum.reduceat(doc[rows][order], first)
        least = np.repeat(least, np.diff(np.append(first, len(key))))
        yield rows[order[doc[rows][order] > least]], o


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``tag, first_id, text``: the texts, once per batch of rows, with the smallest
    document id there; so that a text that very many rows share stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            rows = pa.table([part.column(0).fill_null(LAST), part.column(1), part.column(2)], ["i", "tag", "text"])
            rows = rows.group_by(["tag", "text"]).aggregate([("i", "min")])
            yield from rows.select(["tag", "i_min", "text"]).rename_columns(["tag", "first_id", "text"]).to_batches()


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    tag = F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF))
    return docs.select(F.col("doc_id").cast("long"), tag.alias("tag"), text.alias("text"))


class _Part:
    """The distinct texts of a part, by digest, with their first documents."""

    def __init__(self, rows: pa.Table):
        first: dict[bytes, tuple[int, int]] = {}
        texts = rows.column("text").combine_chunks()
        for at, (doc, text) in enumerate(zip(rows.column("first_id").to_pylist(), texts)):
            digest = hashlib.md5(text.as_buffer()).digest()
            known = first.get(digest)
            first[digest] = (doc, at) if known is None else (min(doc, known[0]), known[1])
        at = np.array([a for _, a in first.values()], np.int64)
        self.digests, self.ids = list(first), np.array([d for d, _ in first.values()], np.int64)
        self.texts = texts.take(pa.array(at))
        self.tags = rows.column("tag").combine_chunks().take(pa.array(at)).to_numpy().astype(np.uint64)


def _pairs(tags: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(hashes + (tags << np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15))


RUN_ROW = (
    "bucket int, part int, shared binary, rest binary, before binary, owner binary, place binary,"
    " digests binary, ids binary"
)
MARKS = "part int, digest binary, place binary, mask binary"


def _suffix_runs(texts: DataFrame, again: DataFrame, n: int, buckets: int, length: int, gram: int) -> DataFrame:
    """Sorted, front-coded runs of the suffixes at repeated anchors, dealt to buckets."""
    back = length - gram
    names = [c.split()[0] for c in RUN_ROW.split(", ")]

    def runs(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        part, rows = _Part(left), []
        wanted = [np.zeros(0, np.uint64)]
        for tags, hashes in zip(right.column("tags"), right.column("hashes")):
            wanted.append(_pairs(np.frombuffer(tags.as_buffer(), np.uint32).astype(np.uint64), decode_sorted(hashes.as_py())))
        allowed = np.unique(np.concatenate(wanted))
        if len(part.digests) and len(allowed):
            data, offsets, row, at, hashes = text_anchors(part.texts, length, gram)
            pairs = _pairs(part.tags[row], hashes >> DROP)
            hit = allowed[np.minimum(np.searchsorted(allowed, pairs), len(allowed) - 1)] == pairs
            row, at, hashes = row[hit], at[hit], hashes[hit]
            bucket = (mixed(hashes) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cut)).tolist():
                pick = order[cut[b] : cut[b + 1]]
                rows.append((b, key[0].as_py(), *_run(data, offsets, row[pick], at[pick], part, length, back)))
        columns = list(zip(*rows)) or [[] for _ in names]
        pa.default_memory_pool().release_unused()
        return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.int32()] * 2 + [pa.binary()] * 7)], names)

    return texts.groupBy("part").cogroup(again.groupBy("part")).applyInArrow(runs, RUN_ROW)


def _windows(data: np.ndarray, low: np.ndarray, high: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` bytes from ``low``, each byte plus 1; 0 from ``high`` on."""
    at = low[:, None] + np.arange(width)
    inside = at < high[:, None]
    return np.where(inside, data[np.where(inside, at, 0)] + 1, 0).astype(np.uint8)


def _run(data, offsets, row, at, part: _Part, length: int, back: int) -> tuple:
    ahead = _windows(data, at, offsets[row + 1], length)
    # The bytes before an anchor, the nearest first.
    place = at[:, None] - 1 - np.arange(back)
    inside = place >= offsets[row][:, None]
    before = np.where(inside, data[np.where(inside, place, 0)] + 1, 0).astype(np.uint8)
    order = np.argsort(np.ascontiguousarray(ahead).view(f"S{length}").ravel(), kind="stable")
    ahead, before, row, at = ahead[order], before[order], row[order], at[order]
    shared, rest = front_code(ahead)
    texts, owner = np.unique(row, return_inverse=True)
    return (
        shared.tobytes(),
        rest,
        before.tobytes(),
        owner.astype(np.uint32).tobytes(),
        (at - offsets[row]).astype(np.uint32).tobytes(),
        b"".join(part.digests[t] for t in texts),
        part.ids[texts].tobytes(),
    )


def _marks(runs: DataFrame, length: int, gram: int) -> DataFrame:
    """``part, digest, place, mask``: for each text its anchors with, as bits, the
    offsets of the repeated strings before them."""
    back = length - gram
    names = [c.split()[0] for c in MARKS.split(", ")]

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        keys, before, owner, place, digests, ids, parts = [], [], [], [], [], [], []
        for r in group.to_batches():
            for i in range(r.num_rows):
                get = lambda name, kind: np.frombuffer(r.column(name)[i].as_buffer(), kind)  # noqa: B023, E731
                shared = get("shared", np.uint8)
                keys.append((front_decode(shared, get("rest", np.uint8).tobytes(), length), shared))
                before.append(get("before", np.uint8).reshape(-1, back))
                owner.append(get("owner", np.uint32).astype(np.int64) + sum(map(len, ids)))
                place.append(get("place", np.uint32))
                ids.append(get("ids", np.int64))
                digests.append(get("digests", np.uint8).reshape(-1, 16))
                parts.append(np.full(len(ids[-1]), r.column("part")[i].as_py(), np.int32))
        order, common = merge_runs(keys, length)
        heads = np.concatenate([k for k, _ in keys])[order]
        before, owner, place = (np.concatenate(x)[order] for x in (before, owner, place))
        ids, digests, parts = (np.concatenate(x) for x in (ids, digests, parts))
        mask = np.zeros(len(order), np.uint64)
        for rows, o in judge(heads, common, before[:, ::-1], ids[owner], length, gram):
            mask[rows] |= np.uint64(1 << o)
        hit = np.flatnonzero(mask)
        hit = hit[np.argsort(owner[hit], kind="stable")]
        first = np.flatnonzero(np.r_[True, np.diff(owner[hit]) != 0]) if len(hit) else hit
        out = [hit[a:b] for a, b in zip(first, np.append(first[1:], len(hit)))]
        pa.default_memory_pool().release_unused()
        return pa.table(
            [
                pa.array([parts[owner[o[0]]] for o in out], pa.int32()),
                pa.array([digests[owner[o[0]]].tobytes() for o in out], pa.binary()),
                pa.array([place[o].tobytes() for o in out], pa.binary()),
                pa.array([mask[o].tobytes() for o in out], pa.binary()),
            ],
            names,
        )

    return runs.groupBy("bucket").applyInArrow(merge, MARKS)


CLEANED = "digest string, first_id long, n_bytes long, spans array<struct<start:long,length:long>>, kept binary"


def _cut(texts: DataFrame, marks: DataFrame, length: int, gram: int) -> DataFrame:
    offsets_of = np.arange(length - gram + 1)

    def cut(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        part = _Part(left)
        found: dict[bytes, list[tuple[np.ndarray, np.ndarray]]] = {}
        for digest, place, mask in zip(*(right.column(c) for c in ("digest", "place", "mask"))):
            pair = np.frombuffer(place.as_buffer(), np.uint32), np.frombuffer(mask.as_buffer(), np.uint64)
            found.setdefault(digest.as_py(), []).append(pair)
        rows = []
        for digest, first_id, text in zip(part.digests, part.ids.tolist(), part.texts):
            data = np.frombuffer(text.as_buffer() or b"", np.uint8)
            depth = np.zeros(len(data) + 1, np.int64)
            for place, mask in found.get(digest, ()):
                r, o = np.nonzero((mask[:, None] >> offsets_of.astype(np.uint64)) & np.uint64(1))
                start = place[r].astype(np.int64) - o
                np.add.at(depth, start, 1)
                np.add.at(depth, start + length, -1)
            gone = np.cumsum(depth)[:-1] > 0
            edge = np.diff(np.r_[0, gone.astype(np.int8), 0])
            begin, end = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
            spans = [{"start": a, "length": b - a} for a, b in zip(begin.tolist(), end.tolist())]
            rows.append((digest.hex(), first_id, len(data), spans, data[~gone].tobytes()))
        pa.default_memory_pool().release_unused()
        span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        types = [pa.string(), pa.int64(), pa.int64(), span, pa.binary()]
        columns = list(zip(*rows)) or [[] for _ in types]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], ["digest", "first_id", "n_bytes", "spans", "kept"])

    return texts.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(cut, CLEANED)


def cleaned_texts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``digest, first_id, n_bytes, spans, kept``: every different text of ``docs(doc_id,
    text)``, by its md5, as its first document keeps it: the spans that go and the
    bytes that stay. Further copies keep nothing if they have ``length`` bytes."""
    ship(docs.sparkSession)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(n, -(-total // GROUP_BYTES))

    def parted() -> DataFrame:
        texts = _rows(docs).mapInArrow(_once, "tag long, first_id long, text string")
        return texts.withColumn("part", F.pmod("tag", F.lit(n)).cast("int"))

    again = durable(_repeated(docs, n, length, gram))
    runs = _suffix_runs(parted(), again, n, n, length, gram)
    marks = durable(_marks(runs, length, gram))
    return _cut(parted(), marks, length, gram)


def of_documents(docs: DataFrame, texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, whole, ...``: a row per document with the columns of its text; ``whole``
    tells that all of it goes, as it copies a document with a smaller id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), F.md5(text).alias("digest"))
    later = F.coalesce(F.col("doc_id"), F.lit(LAST)) > F.col("first_id")
    return (
        rows.join(texts, "digest")
        .withColumn("whole", later & (F.col("n_bytes") >= length))
        .drop("digest", "first_id")
    )


@query("op8_suffixes")
def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the bytes that repeat earlier documents."""
    docs = table(spark, sf_dir, "documents")
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    texts = cleaned_texts(docs).select(
        "digest", "first_id", "n_bytes", gone.alias("gone"), F.size("spans").alias("spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    whole = F.col("whole")
    return of_documents(docs, durable(texts)).select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.col("gone")).alias("n_removed"),
        F.when(whole, 1).otherwise(F.col("spans")).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )

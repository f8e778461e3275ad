"""Files that are one JSON list of objects each, read by many tasks.

A file is cut at every closing brace, wherever it stands; its splits go to different tasks.
What lies before a split decides what its braces mean: how deep they are nested, and whether
they stand in a string. So a first pass notes for every split how it changes both, once for
either case; sums over the splits of a file then tell each what it starts with. A second
pass cuts the records out. One that goes on over the end of a split is put together from
its parts, by the split that it began in.

Only numbers about splits are kept between the passes. A task holds one record at a time, of
any length. A file that is not one list of objects is an error; one without a byte, which the
engine does not list, holds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doctag.session import durable

CUT = "}"
_ESCAPE = re.compile(r"\\.", re.DOTALL)
_FIRST, _NEXT = (re.compile(rf"\s*{mark}\s*(?=\{{)") for mark in (r"\[", ","))
# The end of a list, which no brace follows: the cut adds one.
_END, _EMPTY = re.compile(r"\s*\]\s*\}"), re.compile(r"\s*\[\s*\]\s*\}")
# Bytes that a reader skips at the start of a file.
_MARK = 3
ROWS = 1024


def levels(piece: str) -> tuple[int, int, int]:
    """Of a piece that ends in a brace: 1 if it changes whether a string is open, and how much
    deeper it leads, if it starts outside of a string or inside of one."""
    parts = _ESCAPE.sub("", piece).split('"')
    deeper = []
    for outside in (parts[0::2], parts[1::2]):
        text = "".join(outside)
        deeper.append(text.count("{") + text.count("[") - text.count("}") - text.count("]"))
    return (len(parts) - 1) & 1, deeper[0], deeper[1]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("lineSep", CUT).text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


CHANGES = "file string, block long, turns int, deeper0 long, deeper1 long, least0 long, least1 long, bytes long"


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each split changes the state, and the least depth outside of a string that one of
    its pieces ends at."""
    names = [c.split()[0] for c in CHANGES.split(", ")]
    types = [pa.string(), pa.int64(), pa.int32()] + [pa.int64()] * 5
    now, rows = None, []
    for batch in batches:
        for file, block, piece, size in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now[:2] != [file, block]:
                now = [file, block, 0, 0, 0, 1 << 62, 1 << 62, 0]
                rows.append(now)
            turns, out, inside = levels(piece + CUT)
            # Entered outside, and inside, of a string.
            first, second = (out, inside) if now[2] == 0 else (inside, out)
            now[3] += first
            now[4] += second
            now[2] ^= turns
            at = 3 if now[2] == 0 else 4
            now[at + 2] = min(now[at + 2], now[at])
            now[7] += size + 1
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def split_states(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, inside, depth, begun, open``: what every split starts with, the split
    that its first record began in, and whether a record is open. Errors for files that
    are no list as a whole."""
    pieces = _pieces(spark, path).withColumn("_size", F.octet_length("value"))
    changes = durable(pieces.mapInArrow(_changes, CHANGES))
    by_file = W.partitionBy("file").orderBy("block")
    before = by_file.rowsBetween(W.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("turns").over(before), F.lit(0)) % 2).cast("int")
    deeper = F.when(F.col("inside") == 0, F.col("deeper0")).otherwise(F.col("deeper1"))
    least = F.when(F.col("inside") == 0, F.col("least0")).otherwise(F.col("least1"))
    states = (
        changes.withColumn("inside", inside)
        .withColumn("_deeper", deeper)
        .withColumn("depth", F.coalesce(F.sum("_deeper").over(before), F.lit(0)))
        .withColumn("_ends", F.col("depth") + least <= 1)
    )
    first = F.row_number().over(by_file) == 1
    states = states.withColumn("open", ~first & ((F.col("inside") == 1) | (F.col("depth") != 1)))
    begins = F.coalesce(F.lead("open").over(by_file), F.lit(False)) & (~F.col("open") | F.col("_ends"))
    states = states.withColumn("_begins", F.when(begins, F.col("block")))
    states = states.withColumn("begun", F.last("_begins", ignorenulls=True).over(before))
    states = durable(states)
    # Without its last bracket's brace, a file is a byte shorter than its pieces.
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("_path"), "length")
    totals = states.groupBy("file").agg(
        (F.sum("turns") % 2).alias("turns"), F.sum("_deeper").alias("deeper"), F.sum("bytes").alias("bytes")
    )
    plain = lambda c: F.regexp_replace(F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B"))), "^file:/+", "/")
    size = F.col("length") + 1
    fine = (F.col("turns") == 0) & (F.col("deeper") == -1) & F.col("bytes").isin(size, size - _MARK)
    broken = files.join(totals, plain("_path") == plain("file"), "left").filter(~F.coalesce(fine, F.lit(False)))
    for row in broken.limit(1).collect():
        raise ValueError(f"{row._path}: a document file is a JSON list")
    return states.select("file", "block", "inside", "depth", "begun", "open")


RECORDS = "file string, begun long, block long, part int, value string"
# A part: a whole record, the end of one, its middle, or its beginning.
WHOLE, END, MIDDLE, BEGIN = range(4)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RECORDS.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
    split, out = None, []
    for batch in batches:
        for file, block, piece, inside, depth, begun, is_open in zip(*(c.to_pylist() for c in batch.columns)):
            if split is None or (split.file, split.block) != (file, block):
                out += split.rest() if split else []
                split = _Split(file, block, inside, depth, begun, is_open)
            out += split.read(piece + CUT)
            if len(out) >= ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
    out += split.rest() if split else []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


class _Split:
    """The records of one split, piece by piece."""

    def __init__(self, file: str, block: int, inside: int, depth: int, begun: int | None, is_open: bool):
        self.file, self.block, self.inside, self.depth = file, block, inside, depth
        # The pieces of the record that is open, and whether it began in this split.
        self.pieces: list[str] = []
        self.open, self.begun = is_open, begun

    def _row(self, part: int) -> tuple:
        text, self.pieces = "".join(self.pieces), []
        return self.file, self.begun, self.block, part, text

    def read(self, piece: str) -> list[tuple]:
        if not self.open:
            mark = (_NEXT if self.depth else _FIRST).match(piece)
            if not mark:
                if not (_END if self.depth else _EMPTY).fullmatch(piece):
                    raise ValueError(f"{self.file}: no JSON list of objects at {piece[:80]!r}")
                self.depth = -1
                return []
            self.open, self.begun, self.depth = True, self.block, 1
            piece = piece[mark.end() :]
        turns, out, inside = levels(piece)
        self.depth += inside if self.inside else out
        self.inside ^= turns
        self.pieces.append(piece)
        if self.inside or self.depth != 1:
            return []
        self.open = False
        return [self._row(WHOLE if self.begun == self.block else END)]

    def rest(self) -> list[tuple]:
        if not self.open:
            return []
        return [self._row(BEGIN if self.begun == self.block else MIDDLE)]


def read_list_items(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the text of every object in files that are a JSON list each."""
    states = split_states(spark, path)
    # A row a split; all pieces of a split have the same.
    known = _pieces(spark, path).join(F.broadcast(states), ["file", "block"])
    parts = known.select("file", "block", "value", "inside", "depth", "begun", "open").mapInArrow(_records, RECORDS)
    whole = parts.filter(F.col("part") == WHOLE).select("value")
    if states.filter("open").isEmpty():
        return whole
    pieces = F.array_sort(F.collect_list(F.struct("block", "value")))
    joined = parts.filter(F.col("part") != WHOLE).groupBy("file", "begun").agg(F.array_join(pieces["value"], "").alias("value"))
    return whole.unionByName(joined.select("value"))

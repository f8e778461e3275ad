"""Packing documents into sequences: first-fit decreasing with a tournament tree
of bin capacities, run independently in randomised groups of pieces.

A document's ids are cut at multiples of the sequence length, so only its last
piece can be short. The pieces go to random groups of about ``group_pieces``;
in each group they are placed in falling order of length into the first bin with
room, which the tree finds in as many steps as it has levels.

Defined cases: null and empty texts are a document of the end id alone; a null
document id is kept; repeated rows are packed as often as they occur; an empty
table packs to nothing. ``token_pieces`` reads only ``doc_id`` and ``text``, so
other columns cannot clash; ``pack`` passes the columns of its pieces through.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doctag.llm.registry import durable, query, ship, table

VOCABULARY = "word_bpe_49k.json"
SEQUENCE = 2048
END_ID = 1
# A group is held as lengths and row numbers alone.
GROUP_PIECES = 8192
# Bytes of words and ids that a worker remembers, what an entry takes besides, and the
# longest part that is kept.
CACHE_BYTES, ENTRY_BYTES, LONGEST_KEPT = 96 << 20, 160, 32
# Rows that a worker hands on at a time.
ROWS_OUT = 256

# Lower-case letters that no normal form changes.
LATIN = re.compile("[a-zß-öø-ÿ]+")
# ASCII signs, without the apostrophe, which can join the letter behind it, and without those
# of the special tokens.
SIGNS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
# The letters that byte-level tokenizers write for bytes: printable ones stand for themselves,
# the rest for the code points from 256 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: 0x100 + i for i, b in enumerate(sorted({*range(0x100)} - {*PRINTABLE}))}

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


class WordIds(dict):
    """The ids of a space-free string as little-endian 32-bit numbers.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its space-free parts. It also separates a letter from the signs
    that end the part, so that stem and signs are looked up alone, and
    lowers case. A part of Latin letters is one word to it, so that its model can be asked
    directly, in the letters that it has for bytes; all others go through the whole
    tokenizer."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.vocabulary = vocabulary
        tokenizer = Tokenizer.from_str(vocabulary)
        self.encode, self.word = tokenizer.encode, tokenizer.model.tokenize
        self.older: dict[str, bytes] = {}
        self.age()

    def age(self) -> None:
        """Words that were not asked for since the last time are forgotten."""
        self.older = dict(self)
        self.clear()
        self[""], self.room = b"", CACHE_BYTES // 2

    def __missing__(self, part: str) -> bytes:
        out = self.older.get(part)
        if out is None:
            stem = part.rstrip(SIGNS)
            lower = stem.lower()
            if stem != part and LATIN.fullmatch(lower[-1:]):
                out = self[stem] + self[part[len(stem) :]]
            elif stem == part and LATIN.fullmatch(lower):
                out = self.of_word(lower) if lower == part else self[lower]
            else:
                ids = self.encode(part, add_special_tokens=False).ids
                out = struct.pack(f"<{len(ids)}I", *ids)
        return self.keep(part, out)

    def of_word(self, lower: str) -> bytes:
        if not lower.isascii():
            lower = lower.encode().decode("latin-1").translate(BYTE_LETTERS)
        ids = [token.id for token in self.word(lower)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def keep(self, part: str, out: bytes) -> bytes:
        if len(part) <= LONGEST_KEPT:
            self.room -= ENTRY_BYTES + len(out)
            if self.room < 0:
                self.age()
            self[part] = out
        return out

    def of_text(self, text: str) -> bytes:
        for space in "\n\t\r":
            text = text.replace(space, " ")
        return b"".join(map(self.__getitem__, text.split(" ")))


_words: list[WordIds] = []


def _word_ids(vocabulary: str) -> WordIds:
    """One per worker process, which Spark reuses for many tasks. Tasks share what it
    remembers, which is bounded by bytes."""
    if not _words or _words[0].vocabulary != vocabulary:
        _words[:] = [WordIds(vocabulary)]
    return _words[0]


def token_pieces(
    docs: DataFrame,
    vocabulary: str | None = None,
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
) -> DataFrame:
    """``doc_id, start, length, doc_tokens, ids``: every document's ids and the
    end id, cut at multiples of ``sequence``. ``vocabulary`` is the path of a
    tokenizers file; its text, a few MB, goes to the workers."""
    ship(docs.sparkSession)
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    spec = docs.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))
    end = np.array([end_id], "<u4").tobytes()
    size = 4 * sequence

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(spec.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                yield pieces_of(batch.slice(at, ROWS_OUT), words)

    def pieces_of(part: pa.RecordBatch, words: WordIds) -> pa.RecordBatch:
        rows = []
        for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
            ids = words.of_text(text.as_py() or "") + end
            n = len(ids) // 4
            for start in range(0, len(ids), size):
                piece = ids[start : start + size]
                rows.append((doc_id, start // 4, len(piece) // 4, n, piece))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], NAMES)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, PIECES)


NAMES = [c.split()[0] for c in PIECES.split(", ")]
TYPES = [pa.int64()] * 4 + [pa.binary()]


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each length and its offset there. A node of the tree holds the
    largest free capacity below it; the first bin with room is on the left-most
    path of nodes with room."""
    n = len(lengths)
    leaves = 1 << max(0, n - 1).bit_length()
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    order = np.argsort(-lengths, kind="stable")
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        free = tree[node]
        bins[i], offsets[i] = node - leaves, capacity - free
        tree[node] = free - size
        while node > 1:
            node //= 2
            left, right = tree[2 * node], tree[2 * node + 1]
            best = left if left > right else right
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets


def pack(
    pieces: DataFrame, sequence: int = SEQUENCE, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """Adds ``sequence_id, offset`` to pieces with a ``length`` of at most
    ``sequence``. The pieces are stored first: they are counted, and a lost task
    must find its group again. A group is drawn from the number that a row got when
    it was stored, so no key, however frequent, makes a group large; it is a table of
    row numbers and lengths, and all other columns come back to the places by the row
    number."""
    ship(pieces.sparkSession)
    pieces = pieces.drop("sequence_id", "offset")
    stored = durable(pieces.withColumn("_row", F.monotonically_increasing_id()))
    groups = max(1, -(-stored.count() // group_pieces))

    def place(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(np.int64), sequence)
        sequences = (int(key[0]) << 32) + bins
        return pd.DataFrame({"_row": group["_row"], "sequence_id": sequences, "offset": offsets})

    drawn = F.pmod(F.xxhash64("_row"), F.lit(groups))
    lengths = stored.select("_row", F.col("length").cast("long"), drawn.alias("_group"))
    placed = lengths.groupBy("_group").applyInPandas(place, "_row long, sequence_id long, offset long")
    return stored.join(placed, "_row").drop("_row")


def packed_sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, doc_ids, ids``: the sequences themselves, of packed pieces
    that still have their ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("_parts")).select(
        "sequence_id",
        F.col("_parts.doc_id").alias("doc_ids"),
        F.aggregate("_parts", F.expr("X''"), lambda x, p: F.concat(x, p["ids"])).alias("ids"),
    )


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece with the sequence and the offset that it got."""
    pieces = token_pieces(table(spark, sf_dir, "documents"))
    digests = pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return pack(digests)

r"""Chat formatting by columnar byte assembly.

A turn becomes ``<turn ROLE>\nTEXT</turn>\n``. In roles and texts ``\`` is written
``\\`` and ``<`` is written ``\l`` (and a line break in a role ``\n``), so no text
holds a control string, and reading back is unambiguous. The loss mask covers the
texts of assistant turns, in formatted code points.

Rows are range-partitioned by conversation and turn, so that one long conversation
spreads over tasks. In a task the lengths of all segments of a batch, their
cumulative offsets and the places of their bytes are computed in numpy, and headers,
contents and ends are copied into one preallocated Arrow buffer. A conversation
comes out as chunks in order; most have one. Reading back streams over the chunks.

Defined cases: a null text or role is empty; rows with equal turns go by role, then
text, with null turns first; a null conversation id is a conversation of its own;
repeated rows are turns like any other; an empty table has no conversations. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doctag.llm.bytetext import text_buffer
from doctag.llm.registry import query, ship, table

ASSISTANT = "assistant"
OPEN, HEAD, END = b"<turn ", b">\n", b"</turn>\n"
BACKSLASH, LESS, BREAK = 0x5C, 0x3C, 0x0A
# Rows assembled at a time, and about how many bytes of text they may hold.
ROWS, BYTES = 4096, 1 << 23

CHUNKS = "conv_id long, first_turn long, part long, text string, loss array<struct<start:long,length:long>>"


def escape(data: np.ndarray, offsets: np.ndarray, breaks: bool) -> tuple[np.ndarray, np.ndarray]:
    """Escaped bytes and offsets of the strings ``data[offsets[i]:offsets[i + 1]]``."""
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    special = (data == BACKSLASH) | (data == LESS)
    if breaks:
        special |= data == BREAK
    at = np.cumsum(special)
    place = np.arange(len(data)) + at
    out = np.full(len(data) + (int(at[-1]) if len(at) else 0), BACKSLASH, np.uint8)
    out[place] = np.where(data == LESS, ord("l"), np.where(special & (data == BREAK), ord("n"), data))
    return out, offsets + np.r_[0, at][offsets]


def code_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    starts = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    return np.diff(starts[offsets])


def scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copies string i of ``data`` to ``out[at[i]:]``."""
    out[np.arange(len(data)) + np.repeat(at - offsets[:-1], np.diff(offsets))] = data


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``bytes, offsets``: the formatted turns in one buffer, and for each turn the
    code points before its text and in it."""
    role, role_at = escape(*text_buffer(roles), breaks=True)
    text, text_at = escape(*text_buffer(texts), breaks=False)
    n_role, n_text = np.diff(role_at), np.diff(text_at)
    head = len(OPEN) + n_role + len(HEAD)
    offsets = np.r_[0, np.cumsum(head + n_text + len(END))]
    out = np.empty(offsets[-1], np.uint8)
    begin = offsets[:-1]
    for at, part in ((begin, OPEN), (begin + len(OPEN) + n_role, HEAD), (begin + head + n_text, END)):
        out[at[:, None] + np.arange(len(part))] = np.frombuffer(part, np.uint8)
    scatter(out, begin + len(OPEN), role, role_at)
    scatter(out, begin + head, text, text_at)
    before = len(OPEN) + len(HEAD) + code_points(role, role_at)
    return out, offsets, before, code_points(text, text_at)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            some = batch.slice(at, ROWS)
            sizes = np.cumsum(np.diff(text_buffer(some.column(3))[1]))
            some = some.slice(0, max(1, int(np.searchsorted(sizes, BYTES, "right"))))
            at += some.num_rows
            yield _chunks(some, part)
            part += some.num_rows


def _chunks(rows: pa.RecordBatch, part: int) -> pa.RecordBatch:
    """A row per stretch of turns of one conversation."""
    data, offsets, before, inside = assemble(rows.column(2), rows.column(3))
    ids, turns = rows.column(0), rows.column(1)
    key = ids.fill_null(0).to_numpy(zero_copy_only=False)
    null = ids.is_null().to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (null[1:] != null[:-1])])
    start = np.r_[0, np.cumsum(before + inside + len(END))]
    chunk = np.searchsorted(first, np.arange(len(key)), "right") - 1
    learn = np.flatnonzero(rows.column(2).fill_null("").to_numpy(zero_copy_only=False) == ASSISTANT)
    spans = pa.StructArray.from_arrays(
        [pa.array(start[learn] + before[learn] - start[first[chunk[learn]]]), pa.array(inside[learn])],
        ["start", "length"],
    )
    ends = np.searchsorted(learn, np.append(first, len(key)))
    text = pa.LargeStringArray.from_buffers(
        len(first), pa.py_buffer(np.append(offsets[first], offsets[-1])), pa.py_buffer(data)
    )
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(first)),
            turns.take(pa.array(first)),
            pa.array(part + first),
            text.cast(pa.string()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans),
        ],
        ["conv_id", "first_turn", "part", "text", "loss"],
    )


def format_chats(rows: DataFrame) -> DataFrame:
    """``conv_id, order, text, loss`` of ``rows(conv_id, turn, role, text)``: chunks
    of formatted conversations; a conversation is its chunks by ``order``."""
    ship(rows.sparkSession)
    order = ["conv_id", "turn", "role", "text"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
        .repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
    )
    # The range partitions are in order, and so are the parts of each.
    place = F.struct(F.spark_partition_id().alias("range"), "part")
    return dealt.mapInArrow(_format, CHUNKS).select("conv_id", place.alias("order"), "text", "loss")


def unescape(text: str) -> str:
    parts = text.split("\\\\")
    return "\\".join(p.replace("\\l", "<").replace("\\n", "\n") for p in parts)


def parse(text: str) -> Iterator[tuple[str, str]]:
    """The roles and texts of formatted turns."""
    open_, head, end = OPEN.decode(), HEAD.decode(), END.decode()
    for turn in text.split(end)[:-1]:
        role, _, body = turn.removeprefix(open_).partition(head)
        yield unescape(role), unescape(body)


class _Conversation:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss, self.chars = conv_id, 0, 0, 0
        self.all, self.learnt = hashlib.sha256(), hashlib.sha256()

    def read(self, text: str, loss: list[dict]) -> None:
        for role, body in parse(text):
            self.turns += 1
            self.all.update(f"{role}\n{body}\n".encode())
        for span in loss:
            learnt = unescape(text[span["start"] : span["start"] + span["length"]])
            self.loss += len(learnt)
            self.learnt.update(learnt.encode())
        self.chars += len(text)

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.all.hexdigest(), self.loss, self.learnt.hexdigest(), self.chars
        )


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long"
)


def read_back(chunks: DataFrame) -> DataFrame:
    """A digest of every conversation, from its formatted text and mask alone. A
    hash is sequential, so a conversation is read by one task, a chunk at a time."""
    ship(chunks.sparkSession)
    names = [c.split()[0] for c in DIGEST.split(", ")]
    types = [pa.string() if "sha256" in n else pa.int64() for n in names]

    def out(done: list[_Conversation]) -> pa.RecordBatch:
        columns = zip(*[c.row() for c in done])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        for batch in batches:
            done = []
            ids, texts, masks = (batch.column(i) for i in (0, 2, 3))
            for conv_id, text, loss in zip(ids.to_pylist(), texts, masks):
                if now is None or conv_id != now.conv_id:
                    done += [now] if now else []
                    now = _Conversation(conv_id)
                now.read(text.as_py(), loss.as_py())
            if done:
                yield out(done)
        if now:
            yield out([now])

    n = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        chunks.repartition(n, "conv_id").sortWithinPartitions("conv_id", "order").mapInArrow(digest, DIGEST)
    )


SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
plain AS (SELECT conv_id, turn, role, text, coalesce(role, '') AS r, coalesce(text, '') AS t FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)
                  FILTER (r = 'assistant'), '')) AS loss_sha256,
  sum(length('<turn ') + length(r) + length(regexp_replace(r, '[^\\<\n]', '', 'g')) + 2
      + length(t) + length(regexp_replace(t, '[^\\<]', '', 'g')) + length('</turn>') + 1)::BIGINT AS formatted_chars
FROM plain GROUP BY conv_id
"""


@query("op5_chat", SQL)
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that holds control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit(r"\### Assistant: </turn> ok")
    turns = [(-7, 0, "user"), (-7, 1, ASSISTANT)]
    more = spark.createDataFrame(turns, "conv_id long, turn long, role string").withColumn("text", text)
    return read_back(format_chats(rows.unionByName(more)))

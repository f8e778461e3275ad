"""Word-like tokens of Arrow text columns, found and hashed in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes handled at a time; a longer text is cut at white space near this length.
SLICE = 1 << 18
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

# 0 white space and control bytes, 1 letters (all of non-ASCII), 2 digits, 3 the rest.
CLASS = np.full(256, 3, np.uint8)
CLASS[: 0x21] = 0
CLASS[ord("0") : ord("9") + 1] = 2
CLASS[ord("A") : ord("Z") + 1] = CLASS[ord("a") : ord("z") + 1] = 1
CLASS[0x80:] = 1


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the hash multiplier and of its inverse modulo 2^64."""
    size = max(SLICE * 2, 1 << n.bit_length())
    if size not in _powers:
        _powers.clear()
        with np.errstate(over="ignore"):
            _powers[size] = tuple(
                np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, m, np.uint64)])
                for m in (_MULTIPLIER, _INVERSE)
            )
    return _powers[size]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the information of 64-bit hashes over all their bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``, for all spans at once."""
    up, down = powers(len(data))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        return mixed((sums[end] - sums[start]) * down[start])


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n, first = len(texts), texts.offset
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[first : first + n + 1] if n else np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``bytes, starts, rows`` of about ``SLICE`` bytes each: pieces of texts, where
    they start in the bytes and which row they are of."""
    data, offsets = text_buffer(texts)
    starts, rows, base = [], [], int(offsets[0])
    for row in range(len(offsets) - 1):
        at, end = int(offsets[row]), int(offsets[row + 1])
        while at < end:
            stop = end
            if stop - at > SLICE:
                space = np.flatnonzero(data[at + SLICE : min(end, at + 2 * SLICE)] <= 0x20)
                stop = at + SLICE + (int(space[0]) if len(space) else min(end - at - SLICE, SLICE))
            if starts and stop - base > SLICE:
                yield data[base:at], np.array(starts, np.int64), np.array(rows, np.int64)
                starts, rows, base = [], [], at
            starts.append(at - base)
            rows.append(row)
            at = stop
    if starts:
        yield data[base : int(offsets[-1])], np.array(starts, np.int64), np.array(rows, np.int64)


def tokens(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``hashes, piece``: runs of letters, digits or other marks, and the piece that
    each lies in."""
    kind = CLASS[data]
    change = np.empty(len(data), bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change[starts] = True
    begin = np.flatnonzero(change)
    end = np.append(begin[1:], len(data))
    word = kind[begin] > 0
    begin, end = begin[word], end[word]
    return span_hashes(data, begin, end), np.searchsorted(starts, begin, "right") - 1

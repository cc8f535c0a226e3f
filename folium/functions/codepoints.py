"""Arrow strings as numpy code-point arrays, and the token rule over them.

The token rule is the number of matches of ``[\\p{L}\\p{N}]+|[^\\p{L}\\p{N} \\t\\r\\n]``. All of it is
vectorised over a whole Arrow batch: the text buffer is decoded once, classes come from a lookup
table, and boundaries from comparisons of neighbours.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N} \t\r\n]"
SYMBOL, WORD, SPACE = 0, 1, 2


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """uint8 of every code point: WORD for letters and numbers, SPACE for blank, tab, CR, LF, else SYMBOL."""
    cat = unicodedata.category
    out = np.frombuffer(bytes(cat(chr(i))[0] in "LN" for i in range(0x110000)), dtype=np.uint8).copy()
    out[[32, 9, 13, 10]] = SPACE
    return out


#: Bytes of text that are held as code points at once.
SLICE_BYTES = 2_000_000


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of whole rows of about ``limit`` bytes of text, so that memory does not follow the batch."""
    n = batch.num_rows
    if not n:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), n]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(lo, hi - lo)


@dataclass
class Points:
    """Code points of a batch: ``cps`` of all rows in a row, ``off`` of n+1 row bounds, ``null`` mask."""

    cps: np.ndarray
    off: np.ndarray
    null: np.ndarray

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.off)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.off) - 1), self.lengths)


def from_arrow(col: pa.Array | pa.ChunkedArray) -> Points:
    """Decode an Arrow string column; nulls become empty rows with ``null`` set."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    null = np.asarray(col.is_null())
    if null.any():
        col = col.fill_null("")
    n = len(col)
    if n == 0:
        return Points(np.zeros(0, np.uint32), np.zeros(1, np.int64), null)
    _, offs, data = col.buffers()
    bounds = np.frombuffer(offs, np.int64)[col.offset : col.offset + n + 1]
    lo, hi = int(bounds[0]), int(bounds[-1])
    raw = np.frombuffer(data, np.uint8)[lo:hi] if data is not None and hi > lo else np.zeros(0, np.uint8)
    lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    cps = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return Points(cps, lead[bounds - lo].astype(np.int64), null)


def to_arrow(p: Points) -> pa.Array:
    """Encode code points as an Arrow string column."""
    c = p.cps
    width = 1 + (c >= 0x80).astype(np.int64) + (c >= 0x800) + (c >= 0x10000)
    ends = np.concatenate([[0], np.cumsum(width)])
    data = c.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    offs = ends[p.off].astype(np.int64)
    mask = None if not p.null.any() else pa.array(~p.null).buffers()[1]
    out = pa.LargeStringArray.from_buffers(len(p.off) - 1, pa.py_buffer(offs.tobytes()), pa.py_buffer(data), mask)
    return out.cast(pa.string()) if len(data) < 2**31 else out


@dataclass
class Tokens:
    """Tokens of a batch: ``start`` and ``end`` in ``Points.cps``, ``row`` of each, ``count`` per row."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    count: np.ndarray


def tokens(p: Points) -> Tokens:
    n = len(p.off) - 1
    if not len(p.cps):
        z = np.zeros(0, np.int64)
        return Tokens(z, z, z, np.zeros(n, np.int64))
    kind = class_table()[p.cps]
    prev = np.empty_like(kind)
    prev[0], prev[1:] = SPACE, kind[:-1]
    nonempty = p.off[:-1][p.lengths > 0]
    prev[nonempty] = SPACE
    first = (kind == SYMBOL) | ((kind == WORD) & (prev != WORD))
    start = np.flatnonzero(first)
    # a token ends where the next begins or where a non-word follows its last letter
    nxt = np.empty_like(kind)
    nxt[-1], nxt[:-1] = SPACE, kind[1:]
    nxt[nonempty[nonempty > 0] - 1] = SPACE
    end = np.flatnonzero((kind == SYMBOL) | ((kind == WORD) & (nxt != WORD))) + 1
    total = np.concatenate([[0], np.cumsum(first)])
    count = total[p.off[1:]] - total[p.off[:-1]]
    return Tokens(start, end, np.repeat(np.arange(n), count), count)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 values (splitmix finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def token_hashes(p: Points, t: Tokens) -> np.ndarray:
    """A 64-bit hash of each token's characters and their positions."""
    if not len(t.start):
        return np.zeros(0, np.uint64)
    size = t.end - t.start
    where = np.repeat(t.start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))
    pos = where - np.repeat(t.start, size)
    power = np.full(int(size.max()), 0x100000001B3, np.uint64)
    power[0] = 1
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(power)
        value = (p.cps[where].astype(np.uint64) + np.uint64(1)) * _MIX * power[pos]
        sums = np.add.reduceat(value, np.concatenate([[0], np.cumsum(size)[:-1]]))
        return mix64(sums + size.astype(np.uint64))


def shingle_hashes(p: Points, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` tokens within a row, and the row of each (repeats kept)."""
    t = tokens(p)
    h = token_hashes(p, t)
    if len(h) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(h) - width + 1
    acc = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            acc = mix64(acc + h[k : k + n] + np.uint64(k + 1) * _MIX)
    ok = t.row[:n] == t.row[width - 1 :]
    return acc[ok], t.row[:n][ok]

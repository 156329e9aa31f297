"""Whole-column text work on Arrow buffers: word, line and shingle hashes.

Inside a task a batch of texts is one UTF-8 byte buffer plus offsets. These
helpers find words and lines in it and hash them with numpy, without a Python
loop over words. All hashes are fixed functions of the bytes: the same in any
task, run or partitioning.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20          # text worked on at once (a longer text stands alone)

_U = np.uint64
_RADIX = _U(0x9E3779B97F4A7C15)
_MIX1 = _U(0xFF51AFD7ED558CCD)
_MIX2 = _U(0xC4CEB9FE1A85EC53)
_S33, _S29 = _U(33), _U(29)

_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32             # A-Z
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER_VALUE = _BYTE_VALUE[LOWER]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> _S33)) * _MIX1
    h = (h ^ (h >> _S29)) * _MIX2
    return h ^ (h >> _S33)


def _powers(n: int) -> np.ndarray:
    p = np.full(max(n, 1), _RADIX, dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    if not wide and not pa.types.is_string(col.type):
        col = col.cast(pa.string())
    _, offs, data = col.buffers()
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


@functools.cache
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):       # another C library
        return None


def release() -> None:
    """Give freed memory back to the system. Python workers are used again by
    later stages; without this each keeps what its largest batch once took."""
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def chunks(batch: pa.RecordBatch, name: str = "text",
           most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) pieces of a batch with at most
    ``most`` bytes of text each, or a single row."""
    buf, offs = text_buffer(column(batch, name))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi
    release()


def _span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Polynomial hash of buf[start:end] for ascending, disjoint spans."""
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint64)
    some = np.flatnonzero(lengths > 0)
    if len(some):
        size = lengths[some]
        first = np.cumsum(size) - size
        within = np.arange(int(size.sum())) - np.repeat(first, size)
        terms = values[buf[within + np.repeat(starts[some], size)]]
        terms *= _powers(int(size.max()))[within]
        out[some] = np.add.reduceat(terms, first)
    return mix(out + lengths.astype(np.uint64) * _MIX2)


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row offsets into them) of the words ``[^ \\t-\\r]+``."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    solid = ~IS_SPACE[buf]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offs] = True
    prev = np.empty(n, dtype=bool)
    prev[0], prev[1:] = False, solid[:-1]
    starts = np.flatnonzero(solid & (~prev | edge[:n]))
    follow = np.empty(n, dtype=bool)
    follow[-1], follow[:-1] = False, solid[1:]
    ends = np.flatnonzero(solid & (~follow | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(buf: np.ndarray, offs: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, row offsets); A-Z count as a-z when ``lower``."""
    starts, ends, rows = words(buf, offs)
    return _span_hashes(buf, starts, ends, _LOWER_VALUE if lower else _BYTE_VALUE), rows


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _span_hashes(buf, starts, ends, _BYTE_VALUE)


def chain(hashes: list[np.ndarray]) -> np.ndarray:
    """Order-sensitive combination of aligned hash arrays."""
    h = np.full(len(hashes[0]), len(hashes), dtype=np.uint64) * _MIX1
    for x in hashes:
        h = mix(h * _RADIX + x)
    return h


def shingles(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every ``k``-word shingle inside a row. A row with fewer
    words, but some, has its whole sequence as one shingle."""
    n_words = np.diff(rows)
    row = np.repeat(np.arange(len(n_words)), n_words)
    n = len(hashes)
    if n >= k:
        end = np.repeat(rows[1:], n_words)
        at = np.flatnonzero(np.arange(n) + k <= end)
        full = chain([hashes[at + i] for i in range(k)])
        full_row = row[at]
    else:
        full, full_row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    parts, part_rows = [full], [full_row]
    for m in range(1, k):
        short = np.flatnonzero(n_words == m)
        if len(short):
            parts.append(chain([hashes[rows[short] + i] for i in range(m)]))
            part_rows.append(short)
    h, r = np.concatenate(parts), np.concatenate(part_rows)
    if len(parts) > 1:
        order = np.argsort(r, kind="stable")
        h, r = h[order], r[order]
    return h, r


def lines(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end without the newline, row offsets) of every line; a row of n
    newlines has n + 1 lines, also the empty row one empty line."""
    breaks = np.flatnonzero(buf == 10)
    row_of_break = np.searchsorted(offs, breaks, side="right") - 1
    starts = np.concatenate([offs[:-1], breaks + 1])
    ends = np.concatenate([offs[1:], breaks])
    rank = np.concatenate([np.arange(len(offs) - 1), row_of_break])
    s_order = np.lexsort((starts, rank))
    e_order = np.lexsort((ends, rank))
    return starts[s_order], ends[e_order], np.searchsorted(rank[s_order], np.arange(len(offs)))

"""Texts of an Arrow batch as flat numpy arrays: bytes, words, hashes, runs.

Word rules of this package are classes of UTF-8 bytes, so words are found and hashed for
a whole slice of documents at once. Slices are cut by bytes, which bounds the memory of
a task whatever the length of the texts; one text longer than a slice is a slice.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

# of the C library, where it has it
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)

_STEP = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_TABLE = np.random.default_rng(0x5EED).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: anything but blank, tab, line and page ends
SPACED = np.ones(256, bool)
SPACED[[32, *range(9, 14)]] = False

#: ASCII letters and digits, and every character beyond ASCII
LETTERED = np.zeros(256, bool)
LETTERED[48:58] = LETTERED[65:91] = LETTERED[97:123] = LETTERED[128:] = True


def texts_of(batch: pa.RecordBatch, column: str | tuple[str, int] = "text") -> pa.Array:
    """The column, or the field of that place in a struct column, as 64-bit offset strings,
    null as the empty text."""
    given = batch.column(column) if isinstance(column, str) else batch.column(column[0]).field(column[1])
    return pc.fill_null(given.cast(pa.large_string()), "")


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and the n + 1 offsets of their ends."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[ends[0] : ends[-1]], ends - ends[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `limit` bytes together, or of one row."""
    _, ends = flat(texts)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield start, stop
        start = stop


def batches(stream, column: str | tuple[str, int] = "text", limit: int = SLICE_BYTES):
    """(rows, texts, bytes, offsets) of each slice of each batch of a task."""
    for batch in stream:
        texts = texts_of(batch, column)
        for start, stop in slices(texts, limit):
            part = texts.slice(start, stop - start)
            yield (batch.slice(start, stop - start), part, *flat(part))
        batch = texts = part = None
        release()


def release() -> None:
    """Give what freed batches leave in the allocators back: a worker lives on for the tasks of
    later stages, beside those of its neighbours."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n + 1:
        size = 1 << int(n + 1).bit_length()
        tables = []
        for base in (_STEP, pow(_STEP, -1, 1 << 64)):
            table = np.full(size, base & _MASK, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        if size > 1 << 21:  # tables for one huge text are not kept
            return tables[0], tables[1]
        _powers = (tables[0], tables[1])
    return _powers


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; equal bytes give equal hashes anywhere."""
    up, down = _power_tables(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(
    data: np.ndarray, offsets: np.ndarray, kind: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and per text the index of its first word (n + 1)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind[data]
    edge = inside[1:] != inside[:-1]
    starts = np.flatnonzero(edge & inside[1:])
    ends = np.flatnonzero(edge & inside[:-1])
    # a word does not run on into the next text
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    if len(cuts):
        starts, ends = np.sort(np.append(starts, cuts)), np.sort(np.append(ends, cuts))
    return starts, ends, np.searchsorted(starts, offsets)


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` neighbours; one value per start that has a whole run."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out *= np.uint64(_STEP)
        out += hashes[i : i + n]
    return mix(out)


def run_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of `size` words that lie within one text, and their texts."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    return ranges(first[:-1], counts), owner


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (counts[0] of them), starts[1], ..."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(before - starts, counts)


def string_column(values) -> pa.Array:
    return pa.array(values, pa.string())

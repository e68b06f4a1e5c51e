"""Vectorised word and phrase hashing over Arrow string columns.

A whole Arrow batch is hashed with a fixed number of numpy passes: no loop over
documents or words.  Hashes are 64-bit and the same on every executor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PHRASE = np.uint64(0xD1342543DE82EF95)
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 2**64))


def flat_utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64, count=len(column) + 1, offset=8 * column.offset)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first) of the maximal runs of non-separator bytes.

    separators: for each byte whether it is one, by default space and the
    controls 9 to 13.  Words never cross documents; ``first[d] : first[d+1]`` are the words of
    document d.
    """
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[:-1] = inside
    edge[1:-1] &= ~inside[:-1]
    at_document = offsets[:-1][offsets[:-1] < offsets[1:]]
    edge[at_document] = inside[at_document]
    starts = np.flatnonzero(edge[:-1])
    close = np.zeros(len(data) + 1, dtype=bool)
    close[1:] = inside
    close[1:-1] &= ~inside[1:]
    before = at_document[at_document > 0]
    close[before] = inside[before - 1]
    ends = np.flatnonzero(close)
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    at = np.repeat(np.cumsum(lens) - lens, lens)
    within = np.arange(len(at)) - at
    values = _BYTE[data[within + np.repeat(starts, lens)]] * powers(_BASE, int(lens.max()))[within]
    return mix(np.add.reduceat(values, np.cumsum(lens) - lens) + lens.astype(np.uint64))


def phrase_hashes(words: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of words[i:i+n] for every i; callers mask phrases that cross documents."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    base = mix(np.array([int(_PHRASE) + salt], np.uint64))[0] | np.uint64(1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum((words ^ np.uint64(salt)) * powers(base, len(words)), out=total[1:])
    return mix((total[n:] - total[:-n]) * powers(inverse(base), count))


def phrase_mask(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """True where a phrase of n words that starts there stays in its document."""
    last = np.repeat(first[1:], np.diff(first))
    count = max(total - n + 1, 0)
    return (np.arange(count) + n) <= last[:count]

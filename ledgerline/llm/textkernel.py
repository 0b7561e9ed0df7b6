"""Vectorised word, shingle and byte kernels over Arrow text columns (numpy, whole batches).

Texts are handled as the UTF-8 bytes Arrow already holds. White space is the six ASCII bytes
0x20 and 0x09-0x0D, letters A-Z are lowered; both are byte-level facts in UTF-8, so no text is
decoded. All hashes are 64 bit and fixed by the constants below: the same words give the same
hash in every task, run and process.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
try:
    _LIBC = ctypes.CDLL("libc.so.6")
except OSError:                      # another C library: nothing to trim
    _LIBC = None
SLAB_BYTES = 1 << 20          # working set of one kernel call; a longer text is a slab of its own


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _table(seed: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=np.uint64) + U64(seed)) * U64(0x9E3779B97F4A7C15))


BYTE = _table(17, 256)                      # a random number for each byte
BASE = U64(0x9E3779B97F4A7C15 | 1)
ORDER = _table(5000, 64) | U64(1)           # a factor for each place in an n-gram
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LOWER_BYTE = np.where(SPACE, U64(0), BYTE[LOWER])


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64, count=n + 1 + column.offset)[column.offset:]
    if data is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def joined(column, kind) -> np.ndarray:
    """All values of an Arrow binary column, end to end, as one array (no copy of a single chunk)."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = []
    for c in chunks:
        _, offs, data = c.buffers()
        if len(c) and data is not None:
            o = np.frombuffer(offs, np.int32, count=len(c) + 1 + c.offset)[c.offset:]
            parts.append(np.frombuffer(data, np.uint8)[o[0]:o[-1]])
    whole = parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    return whole.view(kind)


def trim() -> None:
    """Give freed memory back to the system between the steps of a long-lived worker."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def slabs(offsets: np.ndarray, limit: int = SLAB_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of documents with at most ``limit`` bytes, or one longer document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """Words of all documents of a slab: (hash, start, doc index, words per document)."""
    n_docs = len(offsets) - 1
    word = ~SPACE[raw]
    start = word.copy()
    start[1:] &= ~word[:-1]
    edges = offsets[:-1][offsets[:-1] < len(raw)]
    start[edges] = word[edges]
    starts = np.flatnonzero(start)
    if not len(starts):
        z = np.zeros(0, np.int64)
        return np.zeros(0, U64), z, z, np.zeros(n_docs, np.int64)
    lens = np.diff(np.append(starts, len(raw)))
    power = np.empty(int(lens.max()), U64)
    power[0] = 1
    power[1:] = BASE
    np.cumprod(power, out=power)
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, lens)
    table = _LOWER_BYTE if lower else np.where(SPACE, U64(0), BYTE)
    value = table[raw[starts[0]:]]
    value *= power[place]
    h = mix64(np.add.reduceat(value, starts - starts[0]))
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return h, starts, doc, np.bincount(doc, minlength=n_docs)


def ngrams(h: np.ndarray, doc: np.ndarray, counts: np.ndarray, n: int):
    """n-grams inside each document, in text order: (hash, doc index).

    A document of one to n-1 words gives its whole word sequence as its only gram.
    """
    first = np.concatenate([[0], np.cumsum(counts)])
    size = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    gdoc = np.repeat(np.arange(len(counts)), size)
    if not len(gdoc):
        return np.zeros(0, U64), gdoc
    place = np.arange(len(gdoc)) - np.repeat(np.cumsum(size) - size, size)
    at = first[gdoc] + place
    out = np.zeros(len(gdoc), U64)
    left = counts[gdoc]
    padded = np.concatenate([h, np.zeros(n, U64)])
    short = left < n
    for k in range(n):
        term = padded[at + k] * ORDER[k]
        if short.any():
            term[short & (left <= k)] = 0
        out += term
    out += np.minimum(left, n).astype(U64) * ORDER[n]
    return mix64(out), gdoc


def distinct(h: np.ndarray, doc: np.ndarray, n_docs: int):
    """Sorted distinct hashes of each document: (hash, pointer of length n_docs + 1)."""
    ends = np.searchsorted(doc, np.arange(n_docs + 1))
    h = h.copy()
    for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if e - s > 1:
            h[s:e].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], np.concatenate([[0], np.cumsum(np.bincount(doc[keep], minlength=n_docs))]).astype(np.int64)


def shingle_sets(column, n: int = 5) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, sorted distinct n-gram hashes of documents i..j-1, pointer) slab by slab."""
    raw, offsets = text_bytes(column)
    for i, j in slabs(offsets):
        off = offsets[i:j + 1]
        h, _, doc, counts = words(raw[off[0]:off[-1]], off - off[0])
        g, gdoc = ngrams(h, doc, counts, n)
        yield (i, j, *distinct(g, gdoc, j - i))


def segment_sum(v: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sum (mod 2^64) of each segment ptr[k]..ptr[k+1]."""
    total = np.concatenate([np.zeros(1, v.dtype), np.cumsum(v, dtype=v.dtype)])
    return total[ptr[1:]] - total[ptr[:-1]]

"""Vectorised text helpers: words of many documents at once, as byte ranges and hashes.

A batch of documents is handled as one flat byte array plus each document's
byte range, the layout an Arrow string column already has.  Hashes are
polynomials modulo 2**64 over random byte values, taken from prefix sums, so a
range of any length costs the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes (or tokens) hashed at a time; keeps the temporaries in cache.
SEGMENT = 1 << 19

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

#: Word bytes of `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing A-Z).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = np.asarray(x, dtype=U64) + U64((0x632BE59BD9B4E019 * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: A random value for each byte.
BYTE_VALUE = mix(np.arange(256, dtype=U64), seed=7) | U64(1)


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i up to n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, SEGMENT + 1)
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            p = np.full(size, b, dtype=U64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            out.append(p)
        have = _POWERS[base] = (out[0], out[1])
    return have


def prefix_hash(values: np.ndarray, base: int = _BASE) -> np.ndarray:
    """H with ``(H[j] - H[i]) * base**-i`` the hash of ``values[i:j]``."""
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * powers(len(values), base)[0][:len(values)], out=out[1:])
    return out


def range_hash(h: np.ndarray, start, end, base: int = _BASE) -> np.ndarray:
    """Hashes of the ranges [start, end) from their prefix sums."""
    return (h[end] - h[start]) * powers(len(h), base)[1][start]


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """A text column as (bytes, n + 1 byte offsets); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, text: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of a few MB of text, so that memory stays bounded."""
    _, offsets = flat(batch.column(batch.schema.get_field_index(text)))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte stays."""
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the n + 1 offsets of each document's words."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = table[data]
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True  # a document's first byte, or the end
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:n]
    ends = inside
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = np.empty(len(start), dtype=U64)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + SEGMENT, side="right")))
        lo, hi = int(start[a]), int(end[b - 1])
        h = prefix_hash(BYTE_VALUE[data[lo:hi]])
        s, e = start[a:b] - lo, end[a:b] - lo
        out[a:b] = mix(range_hash(h, s, e) + (e - s).astype(U64))
        a = b
    return out


def shingles(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k consecutive words, and each document's n + 1 offsets of them.
    A document of fewer words, but not none, has its whole sequence as one shingle."""
    n_words = np.diff(bounds)
    n_out = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    at = np.concatenate([[0], np.cumsum(n_out)]).astype(np.int64)
    out = np.zeros(at[-1], dtype=U64)
    full = n_words >= k
    if full.any():
        doc = np.repeat(np.arange(len(n_words)), np.where(full, n_out, 0))
        i = np.arange(len(doc)) - np.repeat(np.cumsum(np.where(full, n_out, 0)) - np.where(full, n_out, 0), np.where(full, n_out, 0))
        p = bounds[doc] + i
        h = np.zeros(len(p), dtype=U64)
        for j in range(k):
            h = mix(h * U64(0x100000001B3) + words[p + j], seed=k)
        out[at[doc] + i] = h
    for d in np.flatnonzero((n_words > 0) & ~full):
        h = np.zeros(1, dtype=U64)
        for w in words[bounds[d]:bounds[d + 1]]:
            h = mix(h * U64(0x100000001B3) + w, seed=int(n_words[d]))
        out[at[d]] = h[0]
    return out, at

"""Word shingles of many texts at once, as 64-bit hashes in array operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
_TABLE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x100000001B3)
_WORD_BYTE = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose outputs look independent of their inputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, *columns: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose text columns come to about ``size`` bytes; a longer text is a run of its own."""
    if not batch.num_rows:
        return
    lengths = sum(pc.fill_null(pc.binary_length(batch[c]), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    run = (np.cumsum(lengths) - lengths) // size
    cuts = np.r_[0, np.flatnonzero(np.diff(run)) + 1, batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(int(a), int(b - a))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in lower case, nulls as empty, and where each text begins and ends."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays([c.cast(pa.large_string()) for c in texts.chunks]) if texts.num_chunks else pa.array([], pa.large_string())
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and where each text's words begin and end.

    Words are runs of ASCII letters and digits and of any characters beyond ASCII, in lower case.
    """
    data, offsets = text_buffer(texts)
    inside = _WORD_BYTE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < data.size]
    begins[heads] |= inside[heads]
    starts = np.flatnonzero(begins)
    if not starts.size:
        return np.empty(0, np.uint64), np.zeros(offsets.size, np.int64)
    at = np.flatnonzero(inside)
    place = at - starts[np.cumsum(begins[at]) - 1]
    powers = np.cumprod(np.r_[np.uint64(1), np.full(int(place.max()), _BASE)], dtype=np.uint64)
    parts = _TABLE[data[at]] * powers[place]
    hashes = mix(np.add.reduceat(parts, np.flatnonzero(place == 0)))
    return hashes, np.searchsorted(starts, offsets)


def shingle_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every five consecutive words, sorted within each text, and where each text's begin and end.

    A text of one to four words has one shingle of all its words; one without words has none.
    """
    words, bounds = word_hashes(texts)
    counts = np.diff(bounds)
    step = np.uint64(0x9E3779B97F4A7C15)
    shingles = np.zeros(words.size, np.uint64)
    reach = np.zeros(words.size, np.int64)
    owner = np.repeat(np.arange(counts.size), counts)
    left = bounds[1:][owner] - np.arange(words.size) if words.size else reach
    for k in range(SHINGLE):
        stop = words.size - k
        if stop <= 0:
            break
        has = left[:stop] > k
        joined = (shingles[:stop] ^ (shingles[:stop] >> np.uint64(29))) * step + words[k:]
        shingles[:stop] = np.where(has, joined, shingles[:stop])
    first = np.zeros(words.size, bool)
    first[bounds[:-1][counts > 0]] = True
    keep = (left >= SHINGLE) | (first & (left < SHINGLE))
    out = mix(shingles[keep])
    sizes = np.where(counts >= SHINGLE, counts - SHINGLE + 1, (counts > 0).astype(np.int64))
    ends = np.r_[0, np.cumsum(sizes)]
    for a, b in zip(ends[:-1], ends[1:]):
        out[a:b].sort()
    return out, ends


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted bags: the sum of the smaller counts over the sum of the larger ones; 0 if either is empty."""
    if not a.size or not b.size:
        return 0.0
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    at = np.minimum(np.searchsorted(y, x), y.size - 1)
    shared = int(np.minimum(n, m[at])[y[at] == x].sum())
    return shared / (a.size + b.size - shared)

"""Sets of word shingles for all texts of a batch at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Bytes between words: ASCII white space, or all of ASCII but letters and digits.
WHITE = np.isin(np.arange(256), [*range(9, 14), 32])
MARKS = (np.arange(256) < 128) & ~np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123)])


def word_hashes(values: np.ndarray, offsets: np.ndarray, between: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every word (A-Z lower-cased, parted by the bytes ``between``), and the row of each."""
    upper = (values - np.uint8(65)) < 26
    data = np.where(upper, values | 0x20, values)
    gap = between[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = gap[1:] != gap[:-1]
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    at = np.flatnonzero(cut)
    if not len(at):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    tiles = pa.Array.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(data)]
    ).dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(w, 42) for w in tiles.dictionary.to_pylist()], np.uint64)
    words = ~gap[at]
    rows = np.searchsorted(offsets, at[words], side="right") - 1
    return known[tiles.indices.to_numpy()[words]], rows


def shingle_hashes(values: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every shingle of ``width`` words; a row with fewer words has one of all its words.

    Rows without words have none. Repeats are kept.
    """
    words, rows = word_hashes(values, offsets)
    count = np.bincount(rows, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    order = np.arange(len(words)) - first[rows]
    begins = (order + width <= count[rows]) | ((order == 0) & (count[rows] > 0))
    at = np.flatnonzero(begins)
    size = np.minimum(count[rows[at]], width)
    h = size.astype(np.uint64)
    for k in range(width):
        inside = k < size
        word = words[np.minimum(at + k, len(words) - 1)] if len(words) else words
        h = np.where(inside, mix(h * np.uint64(0x9E3779B97F4A7C15) + word), h)
    return h, rows[at]


def shingle_sets(values: np.ndarray, offsets: np.ndarray, width: int, order: np.ndarray | None = None):
    """Distinct shingles (hash, row), sorted by row and then by hash.

    With ``order``, a table of counts by the hashes' leading bits, rarer ones come first.
    """
    h, rows = shingle_hashes(values, offsets, width)
    if order is None:
        rank = np.lexsort((h, rows))
    else:
        rank = np.lexsort((h, order[slots(h, len(order))], rows))
    h, rows = h[rank], rows[rank]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    return h[new], rows[new]


def slots(h: np.ndarray, size: int) -> np.ndarray:
    """Place of a hash in a table whose size is a power of two."""
    return (h >> np.uint64(64 - (size.bit_length() - 1))).astype(np.int64)


def common_counts(h1: np.ndarray, r1: np.ndarray, h2: np.ndarray, r2: np.ndarray, rows: int) -> np.ndarray:
    """Per row the number of hashes that two tables of sets share."""
    h, r = np.concatenate([h1, h2]), np.concatenate([r1, r2])
    rank = np.lexsort((h, r))
    h, r = h[rank], r[rank]
    same = (h[1:] == h[:-1]) & (r[1:] == r[:-1])
    return np.bincount(r[1:][same], minlength=rows)

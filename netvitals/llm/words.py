"""Word splitting and hashing of whole Arrow batches with numpy.

A word is a run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; in UTF-8 no other character
contains those bytes, so this equals splitting the text by code points.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: What parts the terms of a search: ASCII other than letters and digits.
TERM_BREAKS = np.ones(256, bool)
TERM_BREAKS[128:] = TERM_BREAKS[48:58] = TERM_BREAKS[65:91] = TERM_BREAKS[97:123] = False
#: Longer words are hashed one by one.
_LONG = 64
_FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (a public finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(
    data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte spans of the words, and for each text (and one past the
    last) the index of its first word. ``breaks`` tells the bytes that are in no word."""
    solid = ~breaks[data]
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    before[inner] = False  # a text begins a word of its own
    start = np.flatnonzero(solid & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    after[ends] = False
    end = np.flatnonzero(solid & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each word's bytes, A-Z folded to a-z if asked: equal words have equal
    hashes wherever they stand.

    Words are read in blocks of eight bytes, each mixed into the hash before the next, so that no
    algebra of positions makes words collide; words of up to eight bytes and one length never do.
    Long ones get a cryptographic hash each.
    """
    if not len(start):
        return np.zeros(0, np.uint64)
    if fold:
        data = _LOWER[data]
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    block = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # eight bytes from each place
    n = end - start
    h = mix((n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ (block[start] & _FIRST_BYTES[np.minimum(n, 8)]))
    live = np.flatnonzero((n > 8) & (n <= _LONG))
    at = 8
    while len(live):
        own = block[start[live] + at] & _FIRST_BYTES[np.minimum(n[live] - at, 8)]
        h[live] = mix(h[live] * np.uint64(0x9FB21C651E98DF25) ^ own)
        at += 8
        live = live[n[live] > at]
    for i in np.flatnonzero(n > _LONG).tolist():
        digest = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest()
        h[i] = int.from_bytes(digest, "little")
    return h


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the shingles of ``size`` words of each text, in order. A text with
    fewer words has one shingle, its whole sequence; a text without words has none."""
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    begin = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=begin[1:])
    rank = np.arange(begin[-1]) - np.repeat(begin[:-1], count)
    at = np.repeat(first[:-1], count) + rank
    length = np.repeat(np.minimum(n, size), count)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    h = length.astype(np.uint64)
    for i in range(size):
        nxt = mix((h ^ padded[at + i]) * np.uint64(0x9FB21C651E98DF25) + np.uint64(i + 1))
        h = np.where(i < length, nxt, h)
    return h, begin


def distinct_by_text(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, first): the distinct values of each text, sorted."""
    out, size = [], np.zeros(len(first), np.int64)
    for i in range(len(first) - 1):
        own = np.unique(values[first[i] : first[i + 1]])
        out.append(own)
        size[i + 1] = len(own)
    return (np.concatenate(out) if out else values[:0]), np.cumsum(size)


def pieces(column, limit: int = 1 << 20):
    """(first row, last row + 1, bytes, offsets) of runs of texts of about ``limit`` bytes
    together, so that the arrays built from them stay small; a longer text is a run alone."""
    data, offsets = utf8(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        own = offsets[at : to + 1]
        yield at, to, data[own[0] : own[-1]], own - own[0]
        at = to


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, first): the sorted distinct shingles of each text, words folded to lower case."""
    start, end, first = spans(data, offsets)
    hashes, begin = shingle_hashes(word_hashes(data, start, end), first, size)
    return distinct_by_text(hashes, begin)

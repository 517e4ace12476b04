"""64-bit hashes of all words of Arrow text columns, without a Python object per word.

Words are runs of bytes other than ASCII white space, A-Z lower-cased.  A word is read eight bytes at a time into
two chains, each of which mixes all its bits with every eight bytes; the word's hash is the sum of their ends.  (Neither chain
is a polynomial, so no family of words collides by construction, and words that agree in one chain differ in the
sum.)  The first chain's end is the word's check: hash and check together are 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20
BLOCK_BYTES = 1 << 20
U = np.uint64
_GOLDEN = U(0x9E3779B97F4A7C15)
#: Words of more bytes are hashed by BLAKE2b, one by one.
LONG_WORD = 512


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a) * U(3) + b)


_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
#: 2: ASCII letters, 3: marks, 1: all else; the product of two neighbours is 6 where they differ.
_KIND = np.ones(256, np.uint8)
_KIND[65:91] = _KIND[97:123] = 2
_KIND[list(b".,;:!?%$#&*")] = 3
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Keeps the first 0 to 8 bytes of a little-endian lane.
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], U)


def _other_mix(x: np.ndarray) -> np.ndarray:
    """A second bijection of 64-bit values."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def hash_bytes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and checks of the runs ``data[begin[i]:end[i]]``."""
    lanes = np.ndarray(len(data), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    size = end - begin
    one, two = mix(size.astype(U) + _GOLDEN), _other_mix(size.astype(U) * _GOLDEN + U(1))
    live, at = np.flatnonzero((size > 0) & (size <= LONG_WORD)), 0
    while len(live):
        value = lanes[begin[live] + at] & _KEEP[np.minimum(size[live] - at, 8)]
        one[live], two[live] = mix(one[live] ^ value), _other_mix(two[live] * _GOLDEN + value)
        at += 8
        live = live[size[live] > at]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[begin[i]:end[i]].tobytes(), digest_size=16).digest()
        one[i], two[i] = np.frombuffer(digest, "<u8")
    return one + two, one


def find_words(data: np.ndarray, bounds: np.ndarray, fold: bool = True, split_marks: bool = False):
    """Hashes and checks of the words of consecutive texts ``data[bounds[i]:bounds[i + 1]]``, where their bytes
    begin and end, and per text where its words begin (one more entry than texts).  ``fold``: A-Z count as a-z.
    ``split_marks``: words also end between an ASCII letter and a mark, either way round."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, U), np.zeros(0, U), none, none, np.zeros(len(bounds), np.int64)
    inside = ~_WHITE[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    starts = inside & edge[:-1]
    starts[1:] |= inside[1:] & ~inside[:-1]
    ends = inside & edge[1:]
    ends[:-1] |= inside[:-1] & ~inside[1:]
    if split_marks:
        kind = _KIND[data]
        parted = kind[1:] * kind[:-1] == 6
        starts[1:] |= parted
        ends[:-1] |= parted
    s, e = np.flatnonzero(starts), np.flatnonzero(ends)
    h, check = hash_bytes(_FOLD[data] if fold else data, s, e + 1)
    return h, check, s, e + 1, np.searchsorted(s, bounds).astype(np.int64)


def hash_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of consecutive texts and where each text's words begin, ``BLOCK_BYTES`` at a time."""
    parts, where, i = [], [np.zeros(1, np.int64)], 0
    while i < len(bounds) - 1:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + BLOCK_BYTES, side="right")) - 1)
        h, _, _, _, at = find_words(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])
        parts.append(h)
        where.append(at[1:] + where[-1][-1])
        i = j
    return np.concatenate(parts or [np.zeros(0, U)]), np.concatenate(where)


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """A text column in runs of rows of about ``most`` bytes (a longer text is a run of its own):
    ``(first row, last row + 1, word hashes, where each row's words begin)``.  Nulls have no words."""
    for i, j, data, bounds in byte_chunks(column, most):
        yield i, j, *hash_words(data, bounds)


def byte_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The same runs as ``(first row, last row + 1, bytes, where each row begins in them and the last ends)``."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    column = column.fill_null("") if column.null_count else column
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, side="right")) - 1)
        yield i, j, raw[at[i]:at[j]], at[i:j + 1] - at[i]
        i = j


def shingle_hashes(words: np.ndarray, where: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words of each text, and where each text's begin; a text of 1 to
    ``k`` - 1 words has one shingle, all its words."""
    n = np.diff(where)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    begin = np.concatenate([[0], np.cumsum(count)])
    if not begin[-1]:
        return np.zeros(0, U), begin
    owner = np.repeat(np.arange(len(n)), count)
    first = where[owner] + np.arange(begin[-1]) - begin[owner]
    size = np.minimum(n[owner], k)
    h = np.zeros(begin[-1], U)
    for j in range(k):
        use = size > j
        h = np.where(use, pair_hash(h, words[np.minimum(first + j, len(words) - 1)]), h)
    return h, begin

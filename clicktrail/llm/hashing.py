"""Word and shingle hashes of whole Arrow batches of texts, in numpy.

Texts are taken from Arrow's own buffers. A word's hash is a polynomial over
its bytes, read off prefix sums (arithmetic modulo 2**64), then mixed; a
shingle's hash is a polynomial over its words' hashes, mixed again. Work goes
through blocks of a few megabytes, so memory does not follow a text's length
except for eight bytes a word.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
_U = np.uint64
_BASE, _STEP = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that every bit of a hash depends on all of its input."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


@functools.cache
def _byte_values(lower: bool) -> np.ndarray:
    values = mixed(np.arange(1, 257, dtype=_U) * _BASE) | _U(1)
    if lower:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


@functools.cache
def _spaces() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, _U), np.ones(1, _U))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0..n-1 and their inverses modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        inverse = _U(pow(int(_BASE), -1, 1 << 64))
        made = []
        for base in (_BASE, inverse):
            factors = np.full(size, base, _U)
            factors[0] = 1
            made.append(np.cumprod(factors, dtype=_U))
        _powers = tuple(made)
    return _powers


def _block_words(data: np.ndarray, cuts: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of a block; ``cuts`` are places where a text begins."""
    n = len(data)
    if not n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    letter = ~_spaces()[data]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    inner = cuts[(cuts > 0) & (cuts < n)]
    begins[inner] |= letter[inner]
    ends = letter.copy()
    ends[:-1] &= ~letter[1:]
    ends[inner - 1] |= letter[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power, inverse = powers(n)
    sums = np.zeros(n + 1, _U)
    np.cumsum(_byte_values(lower)[data] * power[:n], out=sums[1:])
    h = (sums[end] - sums[start]) * inverse[start]
    return mixed(h + (end - start).astype(_U) * _STEP), start


def _cut_at_space(data: np.ndarray, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Blocks of one long text, cut at white space (a single word may exceed a block)."""
    while end - begin > BLOCK_BYTES:
        at = begin + BLOCK_BYTES
        back = np.flatnonzero(_spaces()[data[begin:at]])
        if len(back):
            cut = begin + int(back[-1]) + 1
        else:
            cut = at
            while cut < end and not _spaces()[data[cut]]:
                cut += 1
        yield begin, cut
        begin = cut
    yield begin, end


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string array, without copying; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind, len(texts) + 1 + texts.offset)[texts.offset :].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def text_slices(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes together, a longer text by itself."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of some texts after one another, and where each text's words begin (one entry more than texts)."""
    base, stop = int(offsets[0]), int(offsets[-1])
    if stop - base > BLOCK_BYTES and len(offsets) == 2:
        parts = [_block_words(data[a:b], np.zeros(0, np.int64), lower)[0] for a, b in _cut_at_space(data, base, stop)]
        hashes = np.concatenate(parts)
        return hashes, np.array([0, len(hashes)])
    hashes, start = _block_words(data[base:stop], offsets[1:-1] - base, lower)
    return hashes, np.searchsorted(start, offsets - base)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words, texts' borders ignored."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    h = words[:n].copy()
    for j in range(1, k):
        h *= _STEP
        h += words[j : j + n]
    return mixed(h + _U(k))


def inside(bounds: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of the first n places have their k words within one text."""
    ok = np.ones(max(n, 0), bool)
    for end in bounds[1:-1]:
        ok[max(0, end - k + 1) : end] = False
    return ok


def shingle_sets(texts: pa.Array, k: int, lower: bool) -> Iterator[np.ndarray]:
    """Per text, its sorted distinct shingles; a text of fewer words has their sequence as its only one, if any."""
    data, offsets = text_buffers(texts)
    for i, j in text_slices(offsets):
        words, bounds = word_hashes(data, offsets[i : j + 1], lower)
        whole = shingles(words, k)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= k:
                yield np.unique(whole[a : b - k + 1])
            elif b > a:
                yield shingles(words[a:b], int(b - a))
            else:
                yield np.zeros(0, _U)


def long_column(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64) if values.dtype == _U else values.astype(np.int64))


def binary_column(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Byte strings out of one byte array and offsets into it."""
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(data, dtype=np.uint8))]
    )


def binary_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column without nulls."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind, len(column) + 1 + column.offset)[column.offset :].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets

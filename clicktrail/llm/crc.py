"""CRC-32 of many byte spans at once, by position tables.

A CRC is linear over XOR but for a constant of the length: the CRC of a span is
that constant XOR the contributions of its bytes, and what a byte contributes
depends on its value and its distance from the span's end only. So a table
(distance, byte) is made once, the contributions of all spans' bytes are looked
up side by side, and ``bitwise_xor.reduceat`` folds each span. Spans longer
than the table are cut into blocks of its length, counted from the end; the
blocks' values are moved to their places by tables for "so many zero bytes
follow" and folded in pairs.
"""

from __future__ import annotations

import functools
import itertools
import zlib

import numpy as np

#: Distances from the end that the table covers.
REACH = 64
#: Bytes of spans that are expanded at once.
AT_ONCE = 1 << 20


@functools.cache
def position_table() -> np.ndarray:
    """Contribution of each byte value (second index) at each distance from the end (first)."""
    table = np.empty((REACH, 256), np.uint32)
    for d in range(REACH):
        zeros = zlib.crc32(bytes(d + 1))
        table[d] = [zlib.crc32(bytes([b]) + bytes(d)) ^ zeros for b in range(256)]
    return table


@functools.cache
def _short_constants() -> np.ndarray:
    return np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32)


def constants(lengths: np.ndarray) -> np.ndarray:
    """The part of a CRC that depends on the length only."""
    out = _short_constants()[np.minimum(lengths, REACH)]
    far = np.flatnonzero(lengths > REACH)
    if len(far):
        values, at = np.unique(lengths[far], return_inverse=True)
        out[far] = np.array([_zeros(int(n)) for n in values], np.uint32)[at]
    return out


def _zeros(n: int) -> int:
    crc = 0
    for a in range(0, n, AT_ONCE):
        crc = zlib.crc32(bytes(min(AT_ONCE, n - a)), crc)
    return crc


def _applied(tables: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit values, given by its images of each byte in each of the four places."""
    out = tables[0][values & 255]
    for place in range(1, 4):
        out = out ^ tables[place][(values >> np.uint32(8 * place)) & 255]
    return out


@functools.cache
def _followed_by(doublings: int) -> np.ndarray:
    """Tables for "REACH * 2**doublings zero bytes follow"."""
    if doublings:
        half = _followed_by(doublings - 1)
        return np.stack([_applied(half, half[place]) for place in range(4)])
    step = np.arange(256, dtype=np.uint32)
    one = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(bytes(1)) for b in range(256)], np.uint32)
    tables = [step << np.uint32(8 * place) for place in range(4)]
    for _ in range(REACH):  # one zero byte shifts a value by a byte
        tables = [(t >> np.uint32(8)) ^ one[t & 255] for t in tables]
    return np.stack(tables)


def _short(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Folded contributions of spans of 1 to REACH bytes."""
    table, out = position_table().ravel(), np.empty(len(starts), np.uint32)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, total, AT_ONCE), side="right"), len(starts)))
    for a, b in itertools.pairwise(cuts.tolist()):
        own = lengths[a:b]
        stop = np.cumsum(own)
        begin = stop - own
        n = int(stop[-1])
        at = np.arange(n)
        byte = data[np.repeat(starts[a:b] - begin, own) + at]
        distance = np.repeat(stop - 1, own) - at
        out[a:b] = np.bitwise_xor.reduceat(table[(distance << 8) + byte], begin)
    return out


def _long(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Folded contributions of longer spans, block by block."""
    blocks = -(-lengths // REACH)
    span = np.repeat(np.arange(len(starts)), blocks)
    place = np.repeat(np.cumsum(blocks) - 1, blocks) - np.arange(len(span))  # blocks that follow in the span
    stop = (starts + lengths)[span] - place * REACH
    begin = np.maximum(stop - REACH, starts[span])
    values, doublings = _short(data, begin, stop - begin), 0
    while len(span) > len(starts):
        odd = (place & 1).astype(bool)
        values[odd] = _applied(_followed_by(doublings), values[odd])
        place >>= 1
        first = np.flatnonzero(np.append(True, (span[1:] != span[:-1]) | (place[1:] != place[:-1])))
        values, span, place = np.bitwise_xor.reduceat(values, first), span[first], place[first]
        doublings += 1
    return values


def span_crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 (unsigned) of each span of some bytes; spans may overlap, and an empty one has 0."""
    out = np.zeros(len(starts), np.uint32)
    near = np.flatnonzero((lengths > 0) & (lengths <= REACH))
    out[near] = _short(data, starts[near], lengths[near])
    far = np.flatnonzero(lengths > REACH)
    if len(far):
        out[far] = _long(data, starts[far], lengths[far])
    return out ^ constants(lengths)

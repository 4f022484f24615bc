"""Word and line handling over whole Arrow string columns.

A column is cut into pieces of about one megabyte (a longer text is a piece of its own), and every step on a piece is
a numpy pass over its UTF-8 bytes, so no Python object is made per word. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20


def _class(member) -> np.ndarray:
    return np.array([bool(member(b)) for b in range(256)])


#: Bytes of words that end at [\x20\x09-\x0D].
SPACED = _class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Bytes of words that end at ASCII other than letters and digits.
ALNUM = _class(lambda b: b >= 0x80 or chr(b).isalnum())
#: First bytes of code points.
LEADS = _class(lambda b: not 0x80 <= b < 0xC0)
#: A-Z become a-z, all else stays.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scramble of 64-bit words (splitmix64's finish)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _GOLD + np.uint64(seed))


class _Powers:
    """Powers of _BASE and of its inverse, grown as longer pieces come."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, PIECE_BYTES + 1)
            row = lambda base: np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, base, np.uint64))])
            self.up, self.down = row(np.uint64(_BASE)), row(np.uint64(pow(_BASE, -1, 1 << 64)))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()
_VALUES = [_byte_values(s) for s in (11, 29)]


class Piece(NamedTuple):
    """Rows ``lo`` to ``hi`` of a column; the text of row ``lo + i`` is ``data[off[i]:off[i + 1]]``."""

    lo: int
    hi: int
    data: np.ndarray
    off: np.ndarray


def pieces(column: pa.Array, size: int = PIECE_BYTES) -> Iterator[Piece]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, "right")) - 1)
        hi = min(hi, len(column), lo + 65536)
        yield Piece(lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        lo = hi


class Spans(NamedTuple):
    """Words of a piece: ``start[i]:end[i]`` in its data; row ``d`` has words ``bound[d]:bound[d + 1]``."""

    start: np.ndarray
    end: np.ndarray
    bound: np.ndarray


def runs(member: np.ndarray, off: np.ndarray) -> Spans:
    """Maximal runs of true bytes that don't cross from one row into the next."""
    first, last = member.copy(), member.copy()
    if len(member):
        first[1:] &= ~member[:-1]
        last[:-1] &= ~member[1:]
        filled = off[:-1] < off[1:]
        first[off[:-1][filled]] = member[off[:-1][filled]]
        last[off[1:][filled] - 1] = member[off[1:][filled] - 1]
    start = np.flatnonzero(first)
    return Spans(start, np.flatnonzero(last) + 1, np.searchsorted(start, off))


def words(piece: Piece, table: np.ndarray) -> Spans:
    return runs(table[piece.data], piece.off)


def lines(piece: Piece) -> Spans:
    """Lines between line feeds; an empty text is one empty line."""
    cut = np.flatnonzero(piece.data == 10)
    start = np.sort(np.concatenate([piece.off[:-1], cut + 1]), kind="stable")
    # a feed that ends a row opens an empty last line at the next row's offset; order within equal starts is settled by counts
    per_row = np.diff(np.searchsorted(cut, piece.off)) + 1
    bound = np.concatenate([[0], np.cumsum(per_row)])
    end = np.sort(np.concatenate([piece.off[1:], cut]), kind="stable")
    return Spans(start, end, bound)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each span's bytes, from one running sum over the data."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _POWERS.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[seed][data] * up[:-1], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _GOLD)


def shingles(hashes: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of ``k`` words (one run of all its words where it has fewer), and their row bounds."""
    count = np.diff(bound)
    n = len(hashes)
    have = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    out_bound = np.concatenate([[0], np.cumsum(have)])
    if not n:
        return np.zeros(0, np.uint64), out_bound
    row = np.repeat(np.arange(len(count)), have)
    at = np.arange(out_bound[-1]) - out_bound[row] + bound[row]
    last = bound[row + 1]
    value = np.zeros(len(at), np.uint64)
    for j in range(k):
        step = mix(np.array([j + 1], np.uint64) * _GOLD)[0] | np.uint64(1)
        there = at + j < last
        value += np.where(there, hashes[np.minimum(at + j, n - 1)] * step, np.uint64(0))
    return mix(value), out_bound


def sums(flags: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between neighbouring bounds."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bound[1:]] - total[bound[:-1]]


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key occurs more than once, and whether an equal one stands before it."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later = np.zeros(len(keys), bool)
    any_ = np.zeros(len(keys), bool)
    later[order[1:]] = same
    any_[order[1:]] = same
    any_[order[:-1]] |= same
    return any_, later


def by_row(values: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Values salted with their row, so that equal keys mean equal values of one row."""
    row = np.repeat(np.arange(len(bound) - 1, dtype=np.uint64), np.diff(bound))
    return mix(values + mix(row * _GOLD + np.uint64(1)))

"""Periodic runs in word sequences by internal pattern matching (operator 12).

A run is a stretch of words with smallest period q (words q apart are identical), at least four periods and at least
``LEAST`` words long, that no neighbouring word extends. The words of a batch of texts, numbered and with a mark of its own
after each text, form one sequence. Its suffix array is built by prefix doubling, as far as half the longest text, and a
wavelet matrix over it answers range successor: the first place at or after x among the suffixes of a range.

A dyadic block is the 2**k words at a multiple of 2**k; the suffixes that begin with it are one range. The block's
occurrences in the windows of twice its length that begin one length before it and at it are asked for. Occurrences in
such a window form an arithmetic progression, whose step is the distance of two that follow each other; it is a period
candidate. A run of at least four periods q holds a whole block of q to 2q - 1 words that recurs q words before or after
within the run, so each is found at the level of that block, and a candidate's step is a smallest period, as a smaller one
would bring a nearer occurrence. Candidates of one run are merged and lengthened word by word to both sides.

Words are numbered by their bytes (a dictionary, no hash), so runs are exact.

Memory: about 60 bytes for each word of a piece (``PIECE_BYTES`` of text, or one longer text).

Defined cases: null, empty or blank text has no words and no runs; repeated rows are handled one by one; runs never cross
texts; an empty table gives an empty result; columns other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .storage import bounded_batches

LEAST, PERIODS = 6, 4
PIECE_BYTES = 1 << 20


class Runs(NamedTuple):
    """Runs of a sequence: ``start[i]:start[i] + length[i]`` has the smallest period ``period[i]``."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


class Wavelet:
    """Wavelet matrix of numbers below 2**bits: bits are packed, with a count of ones before each 64 of them."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.n, self.bits, self.levels = len(values), bits, []
        for b in reversed(range(bits)):
            one = (values >> b) & 1 == 1
            packed = np.packbits(one, bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view(np.uint64)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int32)])[:-1].astype(np.int32)
            self.levels.append((packed, before, self.n - int(one.sum())))
            values = np.concatenate([values[~one], values[one]])

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(packed[word] & mask)

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The least value that is at least ``x`` among values ``lo:hi``, -1 where there is none."""
        below = np.zeros(len(x), np.int64)  # how many are less than x
        a, b = lo.astype(np.int64), hi.astype(np.int64)
        for (packed, before, zeros), bit in zip(self.levels, reversed(range(self.bits)), strict=True):
            a1, b1 = self._ones(packed, before, a), self._ones(packed, before, b)
            one = (x >> bit) & 1 == 1
            below += np.where(one, (b - a) - (b1 - a1), 0)
            a, b = np.where(one, zeros + a1, a - a1), np.where(one, zeros + b1, b - b1)
        there = np.flatnonzero(below < hi - lo)
        out = np.full(len(x), -1, np.int64)
        a, b, rank, value = lo[there].astype(np.int64), hi[there].astype(np.int64), below[there], np.zeros(len(there), np.int64)
        for (packed, before, zeros), bit in zip(self.levels, reversed(range(self.bits)), strict=True):
            a1, b1 = self._ones(packed, before, a), self._ones(packed, before, b)
            low = (b - a) - (b1 - a1)
            one = rank >= low
            rank = np.where(one, rank - low, rank)
            value |= one.astype(np.int64) << bit
            a, b = np.where(one, zeros + a1, a - a1), np.where(one, zeros + b1, b - b1)
        out[there] = value
        return out


def _suffixes(words: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The suffix array (to the depth that blocks of half of ``longest`` need) and, for each k from 1, the places of the
    dyadic blocks that occur more than once with the ranges of the suffixes that begin with them.

    A class is a range of the suffixes that agree so far; its rank is where the range begins. Only suffixes of classes of
    two or more are sorted again. Marks are unique, so a suffix is alone in its class before it reaches past the end.
    """
    n = len(words)
    sa = np.argsort(words, kind="stable")
    new = np.concatenate([[True], words[sa][1:] != words[sa][:-1]])
    rank, size = np.empty(n, np.int64), 1
    rank[sa] = np.flatnonzero(new)[np.cumsum(new) - 1]
    slots = np.arange(n)  # of classes that may have two or more
    blocks = []
    while True:
        first = np.searchsorted(slots, rank[sa[slots]])  # among slots, where each one's class begins
        many = np.bincount(first, minlength=len(slots))[first] > 1
        slots = slots[many]
        if not len(slots):
            break
        if size > 1:
            place = sa[slots]
            lo = rank[place]
            edge = np.flatnonzero(np.concatenate([[True], lo[1:] != lo[:-1]]))
            hi = lo + np.repeat(np.diff(np.append(edge, len(lo))), np.diff(np.append(edge, len(lo))))
            own = place & (size - 1) == 0
            blocks.append((place[own], lo[own], hi[own]))
        if 2 * size > longest // 2 + 1:
            break
        place = sa[slots]
        old, nxt = rank[place], rank[np.minimum(place + size, n - 1)]
        order = np.lexsort((place, nxt, old))
        place, old, nxt = place[order], old[order], nxt[order]
        sa[slots] = place
        new = np.concatenate([[True], (old[1:] != old[:-1]) | (nxt[1:] != nxt[:-1])])
        rank[place] = slots[np.flatnonzero(new)[np.cumsum(new) - 1]]
        size *= 2
    return sa, blocks


def _candidates(words: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, from, to): stretches whose words equal those a period further on."""
    sa, blocks = _suffixes(words, longest)
    if not blocks:
        return (np.zeros(0, np.int64),) * 3
    tree = Wavelet(sa, max(1, int(len(words) - 1).bit_length()))
    found = []
    for k, (at, lo, hi) in enumerate(blocks, 1):
        size = 1 << k
        # the window that begins at the block has the block itself first; in the one before it, the first may be the block again
        before = tree.successor(lo, hi, np.maximum(at - size, 0))
        early = np.flatnonzero(before < at)
        for one, which in ((at, slice(None)), (before[early], early)):
            two = tree.successor(lo[which], hi[which], one + 1)
            step = two - one
            # a smaller step belongs to a smaller block
            good = (two >= 0) & (step <= size) & (step > (size >> 1 if size > 2 else 0))
            found.append((step[good], one[good], one[good] + size))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _lengthened(words: np.ndarray, period: np.ndarray, edge: np.ndarray, way: int) -> np.ndarray:
    """How many more words before (-1) or from (1) each edge equal those a period further on."""
    out = np.zeros(len(edge), np.int64)
    live, width, n = np.arange(len(edge)), 8, len(words)
    while len(live):
        more = []
        for part in np.array_split(live, -(-len(live) * width // (1 << 20))):
            here = edge[part, None] + way * (out[part, None] + np.arange(width)) - (way < 0)
            there = here + period[part, None]
            same = (here >= 0) & (there < n)
            same &= words[np.where(same, here, 0)] == words[np.where(same, there, 0)]
            run = np.where(same.all(axis=1), width, same.argmin(axis=1))
            out[part] += run
            more.append(part[run == width])
        live, width = np.concatenate(more), min(2 * width, 1 << 16)
    return out


def find(words: np.ndarray, longest: int) -> Runs:
    """All runs of a sequence of texts' words, each text closed by a number that occurs once; ``longest`` is the number of
    words of the longest text. By start, then period."""
    period, lo, hi = _candidates(words, longest)
    order = np.lexsort((lo, period))
    period, lo, hi = period[order], lo[order], hi[order]
    # stretches of one period that touch are one: the furthest end so far, kept apart for each period
    shift = period * (len(words) + 1)
    reach = np.maximum.accumulate(hi + shift) if len(hi) else hi
    new = np.concatenate([[True], (lo + shift)[1:] > reach[:-1]]) if len(lo) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    period, lo, hi = period[first], lo[first], (reach - shift)[np.append(first[1:], len(reach)) - 1] if len(first) else hi
    lo = lo - _lengthened(words, period, lo, -1)
    hi = hi + _lengthened(words, period, hi, 1)
    length = hi - lo + period
    good = length >= np.maximum(LEAST, PERIODS * period)
    start, period, length = np.unique(np.stack([lo[good], period[good], length[good]]), axis=1)
    return Runs(start, length, period)


def numbered(piece: T.Piece) -> tuple[np.ndarray, T.Spans, np.ndarray]:
    """The words of a piece as numbers, with a mark after each text; their spans; where each text begins in the sequence."""
    spans = T.words(piece, T.SPACED)
    member = T.SPACED[piece.data]
    size = spans.end - spans.start
    offsets = np.concatenate([[0], np.cumsum(size)])
    letters = np.ascontiguousarray(piece.data[member])
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode().indices.to_numpy()
    rows = len(piece.off) - 1
    start = spans.bound + np.arange(rows + 1)
    words = np.empty(len(size) + rows, np.int64)
    words[start[1:] - 1] = len(size) + np.arange(rows)
    inside = np.ones(len(words), bool)
    inside[start[1:] - 1] = False
    words[inside] = coded
    return words, spans, start


def _collapsed(piece: T.Piece, spans: T.Spans, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, one space between."""
    size = np.where(kept, spans.end - spans.start + 1, 0)
    total = np.concatenate([[0], np.cumsum(size)])
    out = np.full(total[-1], 0x20, np.uint8)
    letters = np.repeat(kept, spans.end - spans.start)
    place = np.ones(total[-1], bool)
    place[total[1:][kept] - 1] = False
    out[place] = piece.data[T.SPACED[piece.data]][letters]
    off = total[spans.bound]
    return [out[a:max(a, b - 1)].tobytes() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def scan_piece(piece: T.Piece) -> tuple[np.ndarray, pa.Array, list[bytes]]:
    """Number of words, runs and collapsed text of each row."""
    words, spans, start = numbered(piece)
    n = np.diff(spans.bound)
    found = find(words, int(n.max(initial=0)))
    row = np.searchsorted(start, found.start, "right") - 1
    # what follows a run's first period goes: +1 and -1 at its ends, summed over the words
    edge = np.bincount(found.start + found.period - row, minlength=len(spans.start) + 1) - np.bincount(found.start + found.length - row, minlength=len(spans.start) + 1)
    kept = np.cumsum(edge)[:len(spans.start)] == 0
    runs = pa.StructArray.from_arrays([pa.array(x) for x in (found.start - start[row], found.length, found.period)], fields=list(_RUN))
    bound = np.searchsorted(row, np.arange(len(n) + 1)).astype(np.int32)
    return n, pa.ListArray.from_arrays(pa.array(bound), runs), _collapsed(piece, spans, kept)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in T.pieces(batch.column("text"), PIECE_BYTES):
            n, runs, collapsed = scan_piece(piece)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(piece.lo, piece.hi - piece.lo), pa.array(n, pa.int64()), runs, pa.array(collapsed, pa.string())],
                                             ["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row: runs by start, then period; collapsed is the text without the words
    that follow the first period of a run, one space between words. One pass, no shuffle."""
    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(_scan, _SCHEMA)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period, of equals the one with the smallest start, then period; or null."""
    def better(a: Column, b: Column) -> Column:
        wide = lambda x, y: x["length"].cast("decimal(19,0)") * y["period"].cast("decimal(19,0)")
        return F.when(a.isNull() | (wide(b, a) > wide(a, b)), b).otherwise(a)

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def with_planted_tail(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every tenth text (h = crc32 of its id's decimal, h % 10 = 0) periodic from a word on: with n words and
    g = h div 10, word i from a = g % n becomes word a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8). A null id is the
    empty string."""
    h = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10).cast("bigint")
    words = F.regexp_extract_all(F.col(text), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n = F.size("_words").cast("bigint")
    a = F.col("_g") % F.col("_n")
    p = F.lit(1) + F.floor((F.col("_n") - F.col("_a")) / (F.lit(3) + F.col("_g") % 8)).cast("bigint")
    at = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1), lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")))
    # the words first, each derived value once, and none of it for the other texts
    one = docs.withColumn("_words", F.when(h % 10 == 0, words)).withColumn("_g", g).withColumn("_n", n)
    one = one.withColumn("_a", F.when(F.col("_n") > 0, a)).withColumn("_p", F.when(F.col("_n") > 0, p))
    periodic = F.array_join(F.transform(at, lambda i: F.element_at("_words", (i + 1).cast("int"))), " ")
    return one.withColumn(text, F.when(F.col("_n") > 0, periodic).otherwise(F.col(text))).drop("_words", "_g", "_n", "_a", "_p")

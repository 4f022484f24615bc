"""SentencePiece encoding and decoding of merge-type (BPE) models (operator 13).

A model's own encoder merges neighbouring symbols, best score first, over a whole text. Here a stretch of text is encoded
from left to right by backtracking instead. One Aho-Corasick pass gives the longest piece that starts at each position;
a piece is taken if merging it together with the piece before gives back these two (``compatible``), else its longest
shorter prefix is tried; where none fits, the position is marked in a bitfield as failed, the piece before is given up and
its next shorter prefix tried. A sequence whose neighbours are all compatible is the merge result itself, and a text's
prefix has one such sequence only, so a failed position fails whichever way it is reached and is entered once.

Two neighbouring characters that stand side by side in no piece are never merged over, so texts are cut there (and where
a run of spaces begins, as no piece has a space after another character). The distinct units of a batch are encoded once, a
bounded memo keeps those of up to ``MEMO_CHARS`` characters, and a long text is taken in slices of ``SLICE_BYTES`` between
units. Characters without a piece become their bytes' pieces. The model must have byte pieces, leave texts as they are but
for spaces, which become U+2581, and put one space before a text; any other is refused.

Decoding is the library's ``decode`` over the ids.

Defined cases: null or empty text has the begin and the end id alone and decodes to the empty string; U+2581 is read as a
space, as the library reads it; repeated rows are encoded row by row; an empty table gives an empty result; columns other
than the two named are not read.
"""

from __future__ import annotations

import functools
import struct
from collections.abc import Iterator
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .storage import bounded_batches

SPACE = "▁"
MEMO_UNITS = 800_000
MEMO_PAIRS = 300_000
MEMO_CHARS = 48
SLICE_BYTES = 1 << 20


class Pieces:
    """A model's vocabulary and the backtracking encoder over it."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        probe = "  ﬁ①é \t\n x "
        if sp.normalize(probe) != SPACE + probe.replace(" ", SPACE) or any(sp.is_unused(i) for i in ids):
            raise ValueError(f"{path} changes texts or has pieces that are not in use")
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(sp.is_byte(i) for i in self.byte):
            raise ValueError(f"{path} has no pieces for bytes")
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        self.ids = {sp.id_to_piece(i): i for i in plain}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.own: dict[str, bool] = {}
        self.shorter: dict[str, str | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memo: dict[str, bytes] = {}
        self.matches = ahocorasick.Automaton()
        for p in self.ids:
            if self.reachable(p):
                self.matches.add_word(p, p)
        self.matches.make_automaton()
        # characters of pieces of two or more, numbered from 1, and which of them stand side by side in a piece
        long = [p.replace(SPACE, " ") for p in self.ids if len(p) > 1]
        chars = sorted(set("".join(long)))
        self.number = np.zeros(0x110000, np.int16)
        self.number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.together = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p in long:
            n = self.number[[ord(c) for c in p]]
            self.together[n[:-1], n[1:]] = True

    def merged(self, text: str) -> list[str]:
        """The model's own merging: always the best-scored neighbours, the leftmost of equals."""
        parts, score, none = list(text), self.score.get, float("-inf")
        scores = [score(a + b, none) for a, b in pairwise(parts)]
        while scores and (best := max(scores)) > none:
            i = scores.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = score(parts[i - 1] + parts[i], none)
            if i < len(scores):
                scores[i] = score(parts[i] + parts[i + 1], none)
        return parts

    def reachable(self, piece: str) -> bool:
        """Whether merging the piece's characters gives the piece."""
        if (known := self.own.get(piece)) is None:
            known = self.own[piece] = self.merged(piece) == [piece]
        return known

    def compatible(self, left: str, right: str) -> bool:
        if (known := self.pairs.get((left, right))) is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merged(left + right) == [left, right]
        return known

    def prefix(self, piece: str) -> str | None:
        """The longest shorter prefix that can stand alone; a single character always can."""
        if piece not in self.shorter:
            if len(self.shorter) >= MEMO_PAIRS:
                self.shorter.clear()  # pieces and single characters: more than the bound only with a larger vocabulary
            cut = next((piece[:k] for k in range(len(piece) - 1, 1, -1) if piece[:k] in self.ids and self.reachable(piece[:k])), piece[:1])
            self.shorter[piece] = cut if len(piece) > 1 else None
        return self.shorter[piece]

    def split(self, unit: str) -> list[str]:
        """The unit's pieces (and characters that have none)."""
        n, known, longest = len(unit), self.pairs.get, self.matches.iter_long
        failed: bytearray | None = None
        taken: list[str] = []
        at, last, ahead = 0, None, longest(unit)
        while at < n:  # a sequence that fits leads here; first its longest next piece, as a character without a piece stands for itself
            ahead = ahead or longest(unit, at)
            end, piece = next(ahead, (n, ""))
            if end + 1 - len(piece) != at:
                piece, ahead = unit[at], None
            while True:
                end = at + len(piece)
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    if last is None or (ok := known((last, piece))) or (ok is None and self.compatible(last, piece)):
                        taken.append(piece)
                        at, last = end, piece
                        break
                ahead, piece = None, self.prefix(piece)
                while piece is None:  # nothing fits here; the start never fails, as the merge result is a sequence that fits
                    failed = failed or bytearray((n >> 3) + 1)
                    failed[at >> 3] |= 1 << (at & 7)
                    gone = taken.pop()
                    at -= len(gone)
                    last = taken[-1] if taken else None
                    piece = self.prefix(gone)
        return taken

    def unit(self, unit: str) -> bytes:
        """The unit's ids, four bytes each."""
        ids, out = self.ids, []
        for p in self.split(unit):
            if (i := ids.get(p)) is not None:
                out.append(i)
            else:
                out += [self.byte[b] for b in p.encode("utf-8")]
        coded = struct.pack(f"<{len(out)}I", *out)
        if len(unit) <= MEMO_CHARS:
            if len(self.memo) >= MEMO_UNITS:
                self.memo.clear()
            self.memo[unit] = coded
        return coded

    def _slice(self, data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units that start at ``start``, and where each unit's ids begin."""
        offsets = np.append(start, len(data)).astype(np.int64)
        units = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        known = self.memo.get
        coded = [known(u) or self.unit(u) for u in pc.replace_substring(units.dictionary, " ", SPACE).to_pylist()]
        which = units.indices.to_numpy()
        size = np.fromiter(map(len, coded), np.int64, len(coded)) >> 2
        first = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(coded), "<u4")
        total = np.concatenate([[0], np.cumsum(size[which])])
        return flat[np.repeat(first[which] - total[:-1], size[which]) + np.arange(total[-1])], total

    def _starts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Where the units of a piece begin."""
        lead = np.flatnonzero(T.LEADS[data])
        number = self.number[np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)]
        cut = np.zeros(len(data) + 1, bool)
        cut[lead[1:]] = ~self.together[number[:-1], number[1:]]
        cut[off[:-1]] = True
        return np.flatnonzero(cut[:-1])

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids (uint32) of each text, with the begin and the end id."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ")
        texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, ""))
        for piece in T.pieces(texts, SLICE_BYTES):
            data, off = np.ascontiguousarray(piece.data), piece.off
            start = self._starts(data, off)
            parts, bounds, done, lo = [], [], 0, 0
            while lo < len(start):  # one slice, unless a single text is longer
                hi = max(lo + 1, int(np.searchsorted(start, start[lo] + SLICE_BYTES)))
                base, stop = start[lo], start[hi] if hi < len(start) else len(data)
                ids, total = self._slice(data[base:stop], start[lo:hi] - base)
                parts.append(ids)
                bounds.append(total[:-1] + done)
                done += len(ids)
                lo = hi
            ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
            bound = np.append(np.concatenate(bounds) if bounds else np.zeros(0, np.int64), done)[np.searchsorted(start, off)]
            for a, b in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
                out = np.empty(b - a + 2, "<u4")
                out[0], out[-1] = self.begin, self.end
                out[1:-1] = ids[a:b]
                yield out

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One vocabulary for each worker process."""
    return Pieces(path)


_SCHEMA = "doc_id bigint, ids binary, n_tokens bigint, decoded string"


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    coder = pieces(path)
    for batch in batches:
        ids = list(coder.encode(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64()), pa.array([coder.decode(x) for x in ids], pa.string())],
            ["doc_id", "ids", "n_tokens", "decoded"])


def encode_documents(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, n_tokens, decoded) for each row: ids are little-endian unsigned 32-bit integers, decoded is what the
    library reads from them. One pass, no shuffle; ``model`` is a path that every executor has."""
    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(lambda it: _encoded(it, model), _SCHEMA)

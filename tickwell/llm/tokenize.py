"""Token ids of whole Arrow string columns with a tokenizer of the tokenizers library.

The tokenizers meant here drop white space and cut the rest into runs of letters, single digits and runs of other
characters before any merge (the word BPE does), so a text's ids are those of its atoms, one after another. Atoms are
found and hashed (to 128 bits) by passes over the bytes; only atoms that a bounded memo lacks are given to the
tokenizer, each once.

An atom is a run of sure letters (a-z, A-Z and the letters of Latin-1) or of ASCII punctuation other than the
apostrophe. A stretch between white space that holds anything else (digits, apostrophes, other characters) is one atom
as a whole, and a text that may hold a special token's string is encoded whole: what the tokenizer does there is left to
it.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa

from . import text as T

MEMO_ATOMS = 400_000
PIECE_BYTES = 1 << 20

_SPACE, _LETTER, _MARK, _MIXED = 0, 1, 2, 3


def _kind(b: int) -> int:
    if b == 0x20 or 0x09 <= b <= 0x0D:
        return _SPACE
    if b < 0x80 and chr(b).isalpha():
        return _LETTER
    return _MARK if 0x21 <= b <= 0x7E and not chr(b).isalnum() and chr(b) != "'" else _MIXED


_KINDS = np.array([_kind(b) for b in range(256)], np.int8)


def atoms(piece: T.Piece) -> tuple[T.Spans, np.ndarray]:
    """The atoms of a piece, and which are runs of sure letters."""
    data, off = piece.data, piece.off
    kind = _KINDS[data]
    # C3 and a continuation byte are a Latin-1 letter, but for the signs for times (97) and divided by
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    chunks = T.runs(kind != _SPACE, off)
    mixed = T.sums(kind == _MIXED, np.concatenate([[0], chunks.end])) > 0  # no mixed byte lies between chunks
    first = kind != _SPACE
    kind[first] = np.where(np.repeat(mixed, chunks.end - chunks.start), _MIXED, kind[first])
    first[1:] &= kind[1:] != kind[:-1]
    first[chunks.start] = True
    start = np.flatnonzero(first)
    last = kind != _SPACE
    last[:-1] &= kind[1:] != kind[:-1]
    last[chunks.end - 1] = True
    return T.Spans(start, np.flatnonzero(last) + 1, np.searchsorted(start, off)), kind[start] == _LETTER


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        #: For runs of sure letters, which normalization only lower-cases and pre-tokenization keeps as one.
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Lowercase()
        self.letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._clear()

    def _clear(self) -> None:
        self.key = np.zeros(0, np.uint64)  # sorted
        self.check = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)
        self.flat = np.zeros(1 << 20, np.uint32)
        self.used = 0

    def _forget(self) -> None:
        """Keeps the half of the memo that has been used most; older uses count less."""
        keep = np.sort(np.argsort(-self.uses, kind="stable")[:MEMO_ATOMS // 2])
        size = self.size[keep]
        start = np.cumsum(size) - size
        self.used = int(size.sum())
        self.flat[:self.used] = self.flat[np.repeat(self.start[keep] - start, size) + np.arange(self.used)]
        self.key, self.check, self.start, self.size, self.uses = self.key[keep], self.check[keep], start, size, self.uses[keep] // 2

    def _coded(self, words: list[str], pure: np.ndarray) -> list[np.ndarray]:
        out: list = [None] * len(words)
        plain = np.flatnonzero(pure).tolist()
        if plain:
            coded = self.letters.encode([words[i] for i in plain], is_pretokenized=True, add_special_tokens=False)
            ids, of = np.array(coded.ids, np.uint32), np.array(coded.word_ids, np.int64)
            edge = np.searchsorted(of, np.arange(len(plain) + 1)).tolist()
            for i, a, b in zip(plain, edge[:-1], edge[1:], strict=True):
                out[i] = ids[a:b]
        other = np.flatnonzero(~pure).tolist()
        for i, coded in zip(other, self.whole.encode_batch([words[i] for i in other], add_special_tokens=False), strict=True):
            out[i] = np.array(coded.ids, np.uint32)
        return out

    def _learn(self, piece: T.Piece, start: np.ndarray, end: np.ndarray, pure: np.ndarray, key: np.ndarray, check: np.ndarray) -> None:
        """Adds atoms that the memo lacks; ``key`` is sorted."""
        raw = piece.data.tobytes()
        words = [raw[a:b].decode("utf-8") for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        coded = self._coded(words, pure)
        size = np.array([len(c) for c in coded], np.int64)
        ids = np.concatenate(coded) if coded else np.zeros(0, np.uint32)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        self.flat[self.used:self.used + len(ids)] = ids
        at = np.searchsorted(self.key, key)
        self.key, self.check = np.insert(self.key, at, key), np.insert(self.check, at, check)
        self.start, self.size = np.insert(self.start, at, self.used + np.cumsum(size) - size), np.insert(self.size, at, size)
        self.uses = np.insert(self.uses, at, 0)
        self.used += len(ids)

    def _piece(self, piece: T.Piece) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a piece's rows and their bounds."""
        spans, pure = atoms(piece)
        if not len(spans.start):
            return np.zeros(0, np.uint32), np.zeros(len(piece.off), np.int64)
        low = T.LOWER[piece.data]
        key, check = (T.hash_spans(low, spans.start, spans.end, s) for s in (0, 1))
        distinct, first, which = np.unique(key, return_index=True, return_inverse=True)
        if (check[first][which] != check).any():
            raise ValueError("two atoms share a 64-bit hash")
        at = np.searchsorted(self.key, distinct)
        known = at < len(self.key)
        known[known] = self.key[at[known]] == distinct[known]
        if (self.check[at[known]] != check[first[known]]).any():
            raise ValueError("two atoms share a 64-bit hash")
        new = first[~known]
        if len(new):
            if len(self.key) + len(new) > MEMO_ATOMS and len(self.key) > MEMO_ATOMS // 2:
                self._forget()
                return self._piece(piece)
            self._learn(piece, spans.start[new], spans.end[new], pure[new], distinct[~known], check[new])
            at = np.searchsorted(self.key, distinct)
        self.uses[at] += np.bincount(which, minlength=len(distinct))
        size = self.size[at][which]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.start[at][which] - total[:-1], size) + np.arange(total[-1])]
        return ids, total[spans.bound]

    def _rows(self, piece: T.Piece) -> tuple[np.ndarray, np.ndarray]:
        """As ``_piece``; rows that may hold a special token's string, and pieces with a hash collision, are encoded whole."""
        opens = np.flatnonzero((piece.data[:-1] == ord("<")) & (piece.data[1:] == ord("|")))
        rows = np.unique(np.searchsorted(piece.off, opens, "right") - 1).tolist()
        try:
            ids, bound = self._piece(piece)
        except ValueError:
            ids, bound, rows = np.zeros(0, np.uint32), np.zeros(len(piece.off), np.int64), list(range(len(piece.off) - 1))
        if not rows:
            return ids, bound
        parts = np.split(ids, bound[1:-1])
        for i in rows:
            text = piece.data[piece.off[i]:piece.off[i + 1]].tobytes().decode("utf-8")
            parts[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint32) of all texts, each followed by ``end``, and the texts' bounds in them. Null counts as empty."""
        parts, sizes = [], []
        for piece in T.pieces(texts, PIECE_BYTES):
            ids, bound = self._rows(piece)
            size = np.diff(bound)
            with_end = np.full(len(ids) + len(size), end, np.uint32)
            with_end[np.arange(len(ids)) + np.repeat(np.arange(len(size)), size)] = ids
            parts.append(with_end)
            sizes.append(size + 1)
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path)

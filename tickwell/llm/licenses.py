"""License scans (operator 8).

Words are runs of non-ASCII characters, digits and letters, A-Z lower-cased. One Aho-Corasick automaton finds all
phrases of the table at word boundaries, overlapping ones too. Where it meets an identifier tag, the longest expression
that begins there and stands on that line is read: an operand after an operand, a bracket that closes none and a comment
mark end it. A shunting-yard parser orders and / or / with by their strength, and the expression is valued over the identifiers' classes (or: the freer side, and: the stricter, with: an exception loosens by one class).

Only texts that hold some phrase's rarest word are cut into words; the others are counted by a pass over their bytes.

The score is the best evidence met: an expression 1.0, none or one that breaks off (``MIT OR``) 0.5, a notice phrase its
own weight in the table; 0 where there is none.

Defined cases: null or empty text has no words; repeated rows are scanned one by one; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .storage import bounded_batches

# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: The method's own notice phrases: label and weight.
NOTICES = {
    "mit license": ("mit", 0.8),
    "permission is hereby granted free of charge": ("mit", 0.9),
    "gnu general public license": ("gpl", 0.8),
    "gnu general public license version 2": ("gpl-2", 0.9),
    "gnu general public license version 3": ("gpl-3", 0.9),
    "gnu lesser general public license": ("lgpl", 0.9),
    "gnu affero general public license": ("agpl-3", 0.9),
    "mozilla public license": ("mpl-2", 0.9),
    "eclipse public license": ("epl-2", 0.9),
    "bsd 2 clause": ("bsd-2-clause", 0.8),
    "bsd 3 clause": ("bsd-3-clause", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
    "isc license": ("isc", 0.8),
    "cc by 4 0": ("cc-by", 0.8),
    "cc by sa": ("cc-by-sa", 0.8),
    "cc by nd": ("cc-by-nd", 0.8),
    "creative commons attribution": ("cc-by", 0.7),
    "cc0 1 0": ("cc0", 0.9),
    "all rights reserved": ("proprietary", 0.6),
}
BASE_WEIGHT = 0.9
TAG = "spdx license identifier"
#: Identifiers of expressions, lower-cased: label and class (0 public domain, 1 permissive, 2 weak copyleft, 3 strong, 4 restricted).
IDENTIFIERS = {
    "mit": ("mit", 1), "isc": ("isc", 1), "apache-2.0": ("apache-2", 1), "bsd-2-clause": ("bsd-2-clause", 1), "bsd-3-clause": ("bsd-3-clause", 1),
    "unlicense": ("unlicense", 0), "cc0-1.0": ("cc0", 0), "0bsd": ("0bsd", 0), "zlib": ("zlib", 1),
    "mpl-2.0": ("mpl-2", 2), "epl-2.0": ("epl-2", 2), "lgpl-2.1-only": ("lgpl", 2), "lgpl-2.1-or-later": ("lgpl", 2), "lgpl-3.0-only": ("lgpl", 2), "lgpl-3.0-or-later": ("lgpl", 2),
    "gpl-2.0": ("gpl-2", 3), "gpl-2.0-only": ("gpl-2", 3), "gpl-2.0-or-later": ("gpl-2", 3), "gpl-3.0": ("gpl-3", 3), "gpl-3.0-only": ("gpl-3", 3), "gpl-3.0-or-later": ("gpl-3", 3), "agpl-3.0-only": ("agpl-3", 3), "agpl-3.0-or-later": ("agpl-3", 3),
    "cc-by-4.0": ("cc-by", 1), "cc-by-sa-4.0": ("cc-by-sa", 3), "cc-by-nc-4.0": ("cc-by-nc", 4), "cc-by-nd-4.0": ("cc-by-nd", 4),
}
_UNKNOWN_CLASS = 4

_CASE = str.maketrans(T.ASCII_UPPER, T.ASCII_LOWER)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TOKEN = re.compile(r"\*/|-->|#|\(|\)|(?:(?!-->)[A-Za-z0-9.+:-])+")
_ENDS = ("*/", "-->", "#")
_AFTER_TAG = re.compile(r"[ \t:=]*")
_LEVEL = {"or": 1, "and": 2, "with": 3}


def _tokens(text: str, lo: int, hi: int) -> Iterator[str]:
    """Lower-cased tokens up to a comment mark, without the full stop or colon of the sentence around them."""
    for m in _TOKEN.finditer(text, lo, hi):
        if m[0] in _ENDS:
            return
        if t := m[0].lower().rstrip(".:"):
            yield t


def leading(tokens: Iterable[str]) -> tuple[list[str], bool]:
    """The longest expression that the tokens begin with, and whether it is all that could belong to it."""
    taken, whole, depth, operand = [], 0, 0, True
    for t in tokens:
        if t == ")":
            if operand or not depth:
                break
            depth -= 1
        elif t in _LEVEL:
            if operand:
                break
            operand = True
        elif not operand:
            break
        elif t == "(":
            depth += 1
        else:
            operand = False
        taken.append(t)
        if not operand and not depth:
            whole = len(taken)
    return taken[:whole], whole == len(taken)


def parse(expression: str) -> list[str] | None:
    """The expression in postfix order, lower-cased, or null if it isn't one. A trailing comment mark ends it."""
    return _postfix(_tokens(expression, 0, len(expression)))


def _postfix(tokens: Iterable[str]) -> list[str] | None:
    out, waiting, operand = [], [], True
    for t in tokens:
        if t == "(":
            if not operand:
                return None
            waiting.append(t)
        elif t == ")":
            if operand:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif t in _LEVEL:
            if operand:
                return None
            while waiting and waiting[-1] != "(" and _LEVEL[waiting[-1]] >= _LEVEL[t]:
                out.append(waiting.pop())
            waiting.append(t)
            operand = True
        else:
            if not operand:
                return None
            out.append(t)
            operand = False
    if operand or "(" in waiting:
        return None
    return out + waiting[::-1]


#: What an identifier that isn't listed looks like: a reference, or parts of which one tells a version.
_LIKE_ONE = re.compile(r"(?:documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+|(?=[^-]*-)(?=\D*\d)[a-z0-9.]+(?:-[a-z0-9.]+)+\+?")


def identifiers(postfix: list[str]) -> tuple[int, int]:
    """How many of an expression's licenses are listed or look like identifiers, and how many there are."""
    names = [t for i, t in enumerate(postfix) if t not in _LEVEL and postfix[i + 1:i + 2] != ["with"]]
    return sum(t.removesuffix("+") in IDENTIFIERS or _LIKE_ONE.fullmatch(t) is not None for t in names), len(names)


def value(postfix: list[str]) -> tuple[int, set[str]]:
    """Class of the whole and the labels of its identifiers; the right side of ``with`` names an exception, no license. A word
    that doesn't look like an identifier has the strictest class and no label."""
    stack: list[tuple[int, set[str]]] = []
    for t in postfix:
        if t in _LEVEL:
            b, a = stack.pop(), stack.pop()
            if t == "with":
                stack.append((max(0, a[0] - 1), a[1]))
            else:
                stack.append((min(a[0], b[0]) if t == "or" else max(a[0], b[0]), a[1] | b[1]))
        else:
            label, kind = IDENTIFIERS.get(t.removesuffix("+"), (t, _UNKNOWN_CLASS))
            stack.append((kind, {label} if kind != _UNKNOWN_CLASS or t.removesuffix("+") in IDENTIFIERS or _LIKE_ONE.fullmatch(t) else set()))
    return stack[0]


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES, TAG}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


#: Every phrase holds one of these, as bytes of the lower-cased text; "cc" must be followed by "by" as the next word.
_RARE = (b"licens", b"hereby", b"bsd", b"redistribution", b"creative", b"cc0", b"reserved")
_CC_BY = re.compile(rb"cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+by")


def _suspect(low: bytes) -> bool:
    return any(r in low for r in _RARE) or (b"cc" in low and _CC_BY.search(low) is not None)


def scan_text(text: str) -> dict:
    """n_base, first_word, last_word, base_labels, labels, score, license_class of one text."""
    low = text.translate(_CASE)
    words = list(_WORD.finditer(low))
    line = " " + " ".join(m[0] for m in words) + " "
    start = np.cumsum([0, *[len(m[0]) + 1 for m in words]])
    places, base_labels, labels, score, kinds = [], set(), set(), 0.0, []
    for end, phrase in _automaton().iter(line):
        first = int(np.searchsorted(start, end - len(phrase) - 1))
        if phrase in BASE:
            places.append(first)
            base_labels.add(BASE[phrase])
            score = max(score, BASE_WEIGHT)
        if phrase in NOTICES:
            label, weight = NOTICES[phrase]
            labels.add(label)
            score = max(score, weight)
        if phrase == TAG:
            after = words[first + len(TAG.split()) - 1].end()
            stop = text.find("\n", after)
            stop = len(text) if stop < 0 else stop
            tokens, complete = leading(_tokens(text, _AFTER_TAG.match(text, after, stop).end(), stop))
            postfix = _postfix(tokens)
            like, every = identifiers(postfix) if postfix else (0, 1)
            score = max(score, 1.0 if complete and like == every else 0.5)
            if like:  # prose behind the tag is no expression
                kind, names = value(postfix)
                kinds.append(kind)
                labels |= names
    return {"n_base": len(places), "first_word": min(places, default=None), "last_word": max(places, default=None), "base_labels": ",".join(sorted(base_labels)),
            "labels": ",".join(sorted(base_labels | labels)), "score": score, "license_class": max(kinds, default=None)}


_NONE = {"n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "license_class": None}
_FIELDS = {"n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "license_class": pa.int64()}
_SCHEMA = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, license_class bigint"


def scan_column(column: pa.Array) -> tuple[np.ndarray, list[dict]]:
    counts, found = [], [_NONE] * len(column)
    for piece in T.pieces(column):
        counts.append(np.diff(T.words(piece, T.ALNUM).bound))
        low = T.LOWER[piece.data].tobytes()
        off = piece.off.tolist()
        for i in range(len(off) - 1):
            if _suspect(low[off[i]:off[i + 1]]):
                found[piece.lo + i] = scan_text(piece.data[off[i]:off[i + 1]].tobytes().decode("utf-8"))
    return np.concatenate(counts) if counts else np.zeros(0, np.int64), found


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, found = scan_column(batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words), *[pa.array([f[c] for f in found], kind) for c, kind in _FIELDS.items()]], ["doc_id", "n_words", *_FIELDS])


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, license_class), a row for each row of ``docs``."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_scan, _SCHEMA)

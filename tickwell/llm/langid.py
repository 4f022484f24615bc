"""Language identification by prediction by partial matching (operator 3).

For each language a byte context tree of orders 0 to ``order`` holds how often each byte followed each context in a
training sample. The code length of a byte is taken at the longest context that the language knows, with escape
probability distinct / (total + distinct), and one context shorter after each escape, down to one of 256 bytes. The
statistics are frozen after training, so a tree compiles into a table: a row for each context, its code lengths in
1/512 bit for every byte and language. A text's state is its longest known context; the sum over its bytes is exact
integer arithmetic. The language with the shortest code wins; the score is its posterior under equal priors.

The sample: pieces of labelled documents in the order of a hash, at most ``SAMPLE_BYTES`` bytes for each language. A
document up to ``limit / PIECES`` characters is one piece, a longer one is cut into such pieces and each is drawn by
itself, so every part of every text has the same chance and a long text neither fills the sample nor bars the others
from it. The sample bounds the model, which is collected and sent to the tasks; every byte of every text is scored.

Defined cases: null texts and texts without a letter are ``und`` with score 0, and so is everything if there is no
labelled text; ties go to the first language by name; a null doc_id is not held out; rows that share a doc_id are scored
one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .storage import Scratch

SAMPLE_BYTES = 1_000_000
PIECES = 32
ORDER = 3
SCALE = 512
UNKNOWN = "und"
_LETTER = T._class(lambda b: b < 0x80 and chr(b).isalpha())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, limit: int = SAMPLE_BYTES) -> DataFrame:
    """At most ``limit`` bytes of pieces for each language with a text, taken by a hash. ``docs``: doc_id, lang, text."""
    size = max(1, limit // PIECES)
    draw = lambda k: F.pmod(F.xxhash64("key", k), F.lit(1 << 30)) / float(1 << 30)
    sized = docs.where("lang is not null and text != ''").withColumns({"bytes": F.octet_length("text").cast("bigint"), "key": F.xxhash64("doc_id", "text")})
    total = sized.groupBy("lang").agg(F.sum("bytes").alias("total"), F.min(draw(F.lit(0))).alias("least"))
    total = Scratch(docs.sparkSession, "langid").save(total, "total")
    # about twice the limit passes this, and one piece at least; the running sum then looks at that little
    passes = lambda k: (draw(k) * F.col("total") < 2.0 * limit) | (draw(k) <= F.col("least"))
    drawn = F.filter(F.sequence(F.lit(0), F.floor((F.char_length("text") - 1) / size).cast("int")), passes)
    near = sized.join(total, "lang").withColumn("k", F.explode(drawn)).select(
        "lang", "doc_id", "k", draw(F.col("k")).alias("draw"), F.substring("text", F.col("k") * size + 1, F.lit(size)).alias("text"))
    order = Window.partitionBy("lang").orderBy("draw", "doc_id", "k", "text").rowsBetween(Window.unboundedPreceding, 0)
    return near.withColumn("upto", F.sum(F.octet_length("text").cast("bigint")).over(order)).where(F.col("upto") <= limit).select("lang", "text")


def _contexts(piece: T.Piece, order: int) -> np.ndarray:
    """The bytes of a piece with ``order`` line feeds before each row, and where its own bytes stand: two rows."""
    rows = np.repeat(np.arange(1, len(piece.off), dtype=np.int64), np.diff(piece.off))
    at = np.arange(len(piece.data)) + order * rows
    padded = np.full(len(piece.data) + order * (len(piece.off) - 1), 10, np.int64)
    padded[at] = piece.data
    return padded, at


def _counted(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """(lang, len, gram, n): how often each byte string of 1 to order + 1 bytes occurs."""
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        codes = langs.indices.to_numpy()
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            for piece in T.pieces(batch.column("text").filter(pa.array(codes == i))):
                padded, at = _contexts(piece, order)
                gram = np.zeros(len(at), np.int64)
                for k in range(order + 1):
                    gram += padded[at - k] << (8 * k)
                    values, n = np.unique(gram, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array(np.full(len(n), k + 1)), pa.array(values), pa.array(n)], ["lang", "len", "gram", "n"])


def train(docs: DataFrame, limit: int = SAMPLE_BYTES, order: int = ORDER) -> dict:
    """Frozen statistics: languages, order, and by length of byte string its strings and their counts by language."""
    store = Scratch(docs.sparkSession, "langid")
    counts = sample(docs, limit).mapInArrow(lambda it: _counted(it, order), "lang string, len bigint, gram bigint, n bigint")
    table = store.save(counts.groupBy("lang", "len", "gram").agg(F.sum("n").alias("n")), "counts").toArrow()  # bounded by the sample
    langs = sorted(set(table.column("lang").to_pylist()))
    code = np.array([langs.index(x) for x in table.column("lang").to_pylist()], np.int64)
    length, gram, n = (table.column(c).to_numpy() for c in ("len", "gram", "n"))
    grams = []
    for k in range(1, order + 2):
        mine = length == k
        values, at = np.unique(gram[mine], return_inverse=True)
        by_lang = np.zeros((len(langs), len(values)), np.int64)
        by_lang[code[mine], at] = n[mine]
        grams.append((values, by_lang))
    return {"langs": langs, "order": order, "grams": grams}


class Model:
    """The compiled trees: symbols (bytes seen in training, and one for the rest), states and code lengths."""

    def __init__(self, stats: dict) -> None:
        self.langs, self.order = stats["langs"], stats["order"]
        grams = stats["grams"]
        seen = grams[0][0]
        self.symbol = np.zeros(256, np.int64)  # 0: never seen
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        bits = self.bits = max(1, len(seen).bit_length())
        width = 1 << bits
        levels, rows = [], 0  # by context length: its first row, the next shorter context's rows, and where its counts go
        state = np.zeros(1, np.int32)  # the row of the longest known end of each context of this length
        for k, (values, _) in enumerate(grams):
            packed = sum(self.symbol[(values >> (8 * j)) & 255] << (bits * j) for j in range(k + 1))
            known, at = np.unique(packed >> bits, return_inverse=True)
            end = (1 << (bits * max(0, k - 1))) - 1
            levels.append((rows, state[known & end], at, packed & (width - 1)))
            state = state[np.arange(1 << (bits * k)) & end]
            state[known] = rows + np.arange(len(known))
            rows += len(known)
        self.state = state
        self.cost = np.empty((rows * width, len(self.langs)), np.uint16)
        for lang in range(len(self.langs)):
            table = np.empty((rows, width), np.float32)
            for k, (first, shorter, at, last) in enumerate(levels):
                n = np.zeros((len(shorter), width), np.float32)
                n[at, last] = grams[k][1][lang]
                total, distinct = n.sum(axis=1, keepdims=True), (n > 0).sum(axis=1, keepdims=True)
                below = table[shorter] if k else np.full((len(shorter), width), 8, np.float32)  # at last, one of 256
                with np.errstate(divide="ignore", invalid="ignore"):
                    here = np.where(n > 0, -np.log2(n / (total + distinct)), below - np.log2(distinct / (total + distinct)))
                table[first:first + len(shorter)] = np.where(total > 0, here, below)
            self.cost[:, lang] = np.minimum(np.rint(table * SCALE), 65535).astype(np.uint16).reshape(-1)

    def code_lengths(self, piece: T.Piece) -> np.ndarray:
        """Code length in 1/SCALE bit of each row under each language."""
        out = np.zeros((len(piece.off) - 1, len(self.langs)), np.int64)
        if not len(piece.data):
            return out
        padded, at = _contexts(piece, self.order)
        symbols = self.symbol[padded].astype(np.int32)
        context = np.zeros(len(symbols), np.int32)
        for k in range(1, self.order + 1):
            context[k:] += symbols[:-k] << (self.bits * (k - 1))
        place = (self.state[context[at]] << self.bits) + symbols[at]
        filled = np.flatnonzero(np.diff(piece.off))
        for lo in range(0, len(self.langs), 16):
            part = self.cost[:, lo:lo + 16][place]
            out[filled, lo:lo + 16] = np.add.reduceat(part, piece.off[:-1][filled], axis=0, dtype=np.int64)
        return out


@functools.lru_cache(maxsize=1)
def _compiled(broadcast) -> Model:
    return Model(broadcast.value)


def _has_letter(piece: T.Piece) -> np.ndarray:
    ascii_ = T.sums(_LETTER[piece.data], piece.off) > 0
    for i in np.flatnonzero(~ascii_ & (T.sums(piece.data >= 0x80, piece.off) > 0)):
        ascii_[i] = any(c.isalpha() for c in piece.data[piece.off[i]:piece.off[i + 1]].tobytes().decode("utf-8", "ignore"))
    return ascii_


def predict_column(model: Model, column: pa.Array) -> tuple[list[str], np.ndarray]:
    langs, scores = [], []
    for piece in T.pieces(column, 1 << 19):
        letter = _has_letter(piece)
        if not model.langs:
            langs += [UNKNOWN] * len(letter)
            scores.append(np.zeros(len(letter)))
            continue
        bits = model.code_lengths(piece) / SCALE
        best = bits.argmin(axis=1)
        score = 1 / np.exp2(-np.minimum(bits - bits.min(axis=1, keepdims=True), 1000)).sum(axis=1)
        langs += [model.langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letter.tolist(), strict=True)]
        scores.append(np.where(letter, score, 0.0))
    return langs, np.concatenate(scores) if scores else np.zeros(0)


def _predict(batches: Iterator[pa.RecordBatch], broadcast) -> Iterator[pa.RecordBatch]:
    model = _compiled(broadcast)
    for batch in batches:
        langs, scores = predict_column(model, batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores)], ["doc_id", "held_out", "lang_pred", "score"])


def identify(docs: DataFrame, limit: int = SAMPLE_BYTES, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for ``docs`` (doc_id, text, lang), learned from those not held out."""
    docs = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    stats = train(docs.where("not held_out").select("doc_id", "lang", "text"), limit, order)
    broadcast = docs.sparkSession.sparkContext.broadcast(stats)
    return docs.select("doc_id", "held_out", "text").mapInArrow(lambda it: _predict(it, broadcast), "doc_id bigint, held_out boolean, lang_pred string, score double")

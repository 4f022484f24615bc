"""Quality rules with adaptive thresholds (operator 10).

Per document the base counts are taken in one pass over its bytes. Each measure's distribution over the documents that
pass the base rule goes into KLL quantile sketches, one for each (language, source). A group's fence is its ``TAIL``
quantile plus a multiple of that quantile's distance from the median, so the data alone set it. A document's fence adds
what one event (a repeated sentence, a shouted line) makes of its length; that is all there is where the spread is 0.

No group sets its own bar: a language's middle fence is the lower median over its sources' fences, one vote for each
source of ``min_group`` documents and one for the smaller ones together; the middle of all is that of the languages. No
fence lies above ``SLACK`` times the middle one of its language, or of all, however many rows its source or language
holds. A group of n documents is held to its own fence by the weight n / (n + ``min_group``) and to its parent's by the
rest: a source to its language's smaller ones together, these to its middle, and that to the middle of all, which is
held to a stated prior by a corpus of few documents. So one rule serves every size without a switch; the prior fades. What most sources of most languages have in
common counts as usual: nothing in the counts tells it from good text.
A document is kept if it passes the base rule and no measure lies above its fence.

Defined cases: null text has no words and fails the base rule; null language or source is a group of its own; rows that
repeat a doc_id are judged one by one; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .storage import Scratch, bounded_batches, columns_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
REPEAT_WORDS = 3
SYMBOLS = T._class(lambda b: chr(b) in "#*$%&|<>")
CAPITALS = T._class(lambda b: 0x41 <= b <= 0x5A)

#: Measure: its expression over the counts, the count that one event adds to it, and the prior of its fence.
MEASURES = {
    "symbol_share": ("n_symbols / n_words", 3, 0.1),
    "capital_share": ("n_capitals / word_chars", 20, 0.4),
    "dup_line_share": ("n_dup_lines / n_lines", 3, 0.5),
    "repeat_share": ("n_repeat_words / n_words", 30, 0.45),
    "word_length": ("word_chars / n_words", 40, 12.0),
}
TAIL = 0.9
SPREADS = 4.0
SLACK = 1.5
MIN_GROUP = 200
SKETCH_K = 400

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def count_piece(piece: T.Piece) -> dict[str, np.ndarray]:
    """The counts of each row of a piece."""
    data, off = piece.data, piece.off
    inside = T.SPACED[data]
    spans = T.runs(inside, off)
    n_words = np.diff(spans.bound)
    lines = T.lines(piece)
    filled = np.searchsorted(spans.start, lines.end) > np.searchsorted(spans.start, lines.start)
    keys = T.by_row(T.hash_spans(data, lines.start, lines.end), lines.bound)
    # lines without a word are no lines of this count: their own index is a key that nothing equals
    _, later = T.repeated(np.where(filled, keys, T.mix(np.arange(len(keys), dtype=np.uint64))))
    grams, bound = T.shingles(T.hash_spans(data, spans.start, spans.end), spans.bound, REPEAT_WORDS)
    twice, _ = T.repeated(T.by_row(grams, bound))
    covered = np.zeros(len(spans.start) + REPEAT_WORDS, bool)
    row = np.repeat(np.arange(len(n_words)), np.diff(bound))
    long_enough = n_words[row] >= REPEAT_WORDS
    at = (np.arange(len(grams)) - bound[row] + spans.bound[row])[twice & long_enough]
    for j in range(REPEAT_WORDS):
        covered[at + j] = True
    return {
        "n_words": n_words,
        "word_chars": T.sums(inside & T.LEADS[data], off),
        "n_symbols": T.sums(SYMBOLS[data], off),
        "n_dup_lines": T.sums(later & filled, lines.bound),
        "n_repeat_words": T.sums(covered[:len(spans.start)], spans.bound),
        "n_lines": np.diff(lines.bound),
        "n_capitals": T.sums(CAPITALS[data], off),
    }


def count_column(column: pa.Array) -> dict[str, np.ndarray]:
    parts = [count_piece(p) for p in T.pieces(column)]
    return {c: np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64) for c in COUNTS}


def with_counts(docs: DataFrame, text: str = "text", prefix: str = "", keep_text: bool = False) -> DataFrame:
    """``docs`` (without the text, unless it is to be kept) and the counts, their names prefixed."""
    fields = [f for f in docs.schema if keep_text or f.name != text]
    names = [f.name for f in fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{prefix}{c}` bigint" for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = count_column(batch.column(text))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(counts[c], pa.int64()) for c in COUNTS],
                                             names + [f"{prefix}{c}" for c in COUNTS])

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def base_failed(prefix: str = "") -> Column:
    return F.expr(f"{prefix}n_words < {MIN_WORDS} or 100 * {prefix}n_repeat_words > {MAX_REPEAT_PERCENT} * {prefix}n_words")


def _measure(m: str, prefix: str = "") -> Column:
    top, under = MEASURES[m][0].split(" / ")
    return F.expr(f"if({prefix}{under} > 0, {prefix}{top} / {prefix}{under}, 0D)")


def _event(m: str, prefix: str = "") -> Column:
    under = prefix + MEASURES[m][0].split(" / ")[1]
    return F.expr(f"if({under} > 0, {MEASURES[m][1]} / {under}, 0D)")


def _read(sketches: DataFrame, keys: list[str], spreads: float) -> DataFrame:
    """The number of documents and each measure's fence."""
    def fence(m: str) -> Column:
        mid, high = (F.kll_sketch_get_quantile_double(F.col(m), F.lit(q)) for q in (0.5, TAIL))
        return high + F.lit(spreads) * (high - mid)

    return sketches.select(*keys, "n", *[F.when(F.col("n") > 0, fence(m)).alias(f"own_{m}") for m in MEASURES])


def _merged(sketches: DataFrame, *keys: str) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[F.kll_merge_agg_double(m).alias(m) for m in MEASURES])


def _middle(votes: DataFrame, *keys: str) -> DataFrame:
    """Lower medians over the votes, whatever number of rows stands behind each."""
    return votes.groupBy(*keys).agg(*[F.percentile_approx(f"own_{m}", 0.5, 10000).alias(f"mid_{m}") for m in MEASURES])


def fences(counts: DataFrame, spreads: float = SPREADS, min_group: int = MIN_GROUP) -> DataFrame:
    """A row for each (doc_lang, doc_source) with a fence for each measure. ``counts`` needs those two and the counts.

    The sketches are partial aggregates, so a source with a third of all rows sends one sketch from each task.
    """
    store = Scratch(counts.sparkSession, "quality")
    sketches = store.save(counts.where(~base_failed()).groupBy("doc_lang", "doc_source").agg(
        F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(_measure(m), F.lit(SKETCH_K)).alias(m) for m in MEASURES]), "sketches")
    own = store.save(_read(sketches, ["doc_lang", "doc_source"], spreads), "own")
    pools = store.save(_merged(sketches.where(F.col("n") < min_group), "doc_lang"), "pools")
    pooled = _read(pools, ["doc_lang"], spreads)
    big = F.col("n") >= min_group
    voted = store.save(_middle(own.where(big).drop("doc_source").unionByName(pooled.where(big)), "doc_lang").withColumnRenamed("doc_lang", "l"), "languages")
    # languages of small sources only have no vote of their own: together they have one, which is the only one of a small corpus
    unvoted = pools.join(voted, pools.doc_lang.eqNullSafe(voted.l), "left_anti")
    votes = voted.select(F.lit(True).alias("sure"), *[F.col(f"mid_{m}").alias(f"own_{m}") for m in MEASURES])
    votes = votes.unionByName(_read(_merged(unvoted), [], spreads).withColumn("sure", big).drop("n"))
    top = lambda m: F.coalesce(F.percentile_approx(F.when(F.col("sure"), F.col(f"own_{m}")), 0.5, 10000), F.max(f"own_{m}"))
    every = votes.agg(*[top(m).alias(f"mid_{m}") for m in MEASURES]).first()  # one row of numbers, whatever the input
    n = own.agg(F.sum("n")).first()[0] or 0
    common = {m: F.lit(None if every[f"mid_{m}"] is None else (n * every[f"mid_{m}"] + min_group * MEASURES[m][2]) / (n + min_group)).cast("double") for m in MEASURES}

    def blend(n: str, mine: str, parent: Column) -> Column:
        rows = F.coalesce(F.col(n), F.lit(0))
        weight = rows / (rows + F.lit(min_group))
        return F.when(rows > 0, weight * F.col(mine) + (1 - weight) * parent).otherwise(parent)

    middles = voted.unionByName(_read(unvoted, ["doc_lang"], spreads).select(F.col("doc_lang").alias("l"), *[F.col(f"own_{m}").alias(f"mid_{m}") for m in MEASURES]))
    rows = own.groupBy(F.col("doc_lang").alias("r")).agg(F.sum("n").alias("rows"))
    pool = _read(pools, ["doc_lang"], spreads).select(F.col("doc_lang").alias("p"), F.col("n").alias("pooled"), *[F.col(f"own_{m}").alias(f"pool_{m}") for m in MEASURES])
    lang = middles.join(rows, middles.l.eqNullSafe(rows.r)).join(pool, middles.l.eqNullSafe(pool.p), "left")
    lang = lang.select("l", "pooled", *[f"pool_{m}" for m in MEASURES], *[blend("rows", f"mid_{m}", common[m]).alias(f"mid_{m}") for m in MEASURES])

    def fence(m: str) -> Column:
        middle = F.col(f"mid_{m}")
        return F.least(blend("n", f"own_{m}", blend("pooled", f"pool_{m}", middle)), F.lit(SLACK) * middle, F.lit(SLACK) * common[m])

    table = own.join(lang, own.doc_lang.eqNullSafe(lang.l), "left").select("doc_lang", "doc_source", *[fence(m).alias(f"fence_{m}") for m in MEASURES])
    return store.save(table, "fences")


def judged(counts: DataFrame, table: DataFrame, prefix: str = "") -> DataFrame:
    """``counts`` joined with its group's fences: measures, fences, base_failed and kept, their names prefixed."""
    table = table.withColumnsRenamed({c: f"{prefix}{c}" for c in table.columns if c.startswith("fence_")} | {"doc_lang": "__lang", "doc_source": "__source"})
    on = counts[f"{prefix}doc_lang"].eqNullSafe(table["__lang"]) & counts[f"{prefix}doc_source"].eqNullSafe(table["__source"])
    out = counts.join(table, on, "left").drop("__lang", "__source")
    out = out.withColumns({f"{prefix}fence_{m}": F.col(f"{prefix}fence_{m}") + _event(m, prefix) for m in MEASURES})
    out = out.withColumns({f"{prefix}{m}": _measure(m, prefix) for m in MEASURES}).withColumn(f"{prefix}base_failed", base_failed(prefix))
    within = F.lit(True)
    for m in MEASURES:
        within = within & F.coalesce(F.col(f"{prefix}{m}") <= F.col(f"{prefix}fence_{m}"), F.lit(True))
    return out.withColumn(f"{prefix}kept", ~F.col(f"{prefix}base_failed") & within)


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document: doc_id, the counts, measures, fences, base_failed and kept."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("doc_lang"), F.col(source).alias("doc_source"), F.col(text).alias("text"))
    counts = Scratch(docs.sparkSession, "quality").save(with_counts(narrow), "counts")
    return judged(counts, fences(counts))


def keep_documents(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they were. Texts are counted twice, never shuffled."""
    narrow = docs.select(F.col(lang).alias("doc_lang"), F.col(source).alias("doc_source"), F.col(text).alias("text"))
    table = fences(with_counts(narrow))
    wide = docs.withColumns({"__q_doc_lang": F.col(lang), "__q_doc_source": F.col(source)})
    return judged(with_counts(wide, text, "__q_", keep_text=True), table, "__q_").where("__q_kept").select(columns_of(docs))

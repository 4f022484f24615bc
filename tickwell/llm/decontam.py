"""Benchmark decontamination over a positional inverted index (operator 7), in DataFrame functions only.

A word is a run of non-ASCII characters, digits and letters, A-Z lower-cased. A window is ``window`` consecutive words
of a benchmark item (all its words, if it has fewer). A document word inside any occurrence of a window is hit.

1. How often each benchmark term occurs in the documents is counted, joined before anything is shuffled.
2. Each window keeps its two rarest terms; a window with a term that no document has can't occur. Windows that share
   their two terms and the distance between them share the work of the next steps.
3. The documents' postings of those terms are stored: a row for each (term, document) with its positions.
4. The rarest term's list is intersected with the other's, shifted by their distance and by up to ``slop`` words more.
5. The few places that remain are compared with the document's own words. An exact match has the window's words one
   after another. A proximity match has all of them in order, with 1 to ``slop`` other words between them in all; from
   the place of the rarest term the nearest next (and previous) word is taken each time, so its span is the shortest
   there. Both come with place, span, phrase and items. Places name a list of items; each distinct list that a document
   needs comes to it once, however many windows and places share it.

Terms are folded by the stated rule in the index as in step 5: lower() would do more, and by context (a final sigma).
The benchmark's terms are a written table, so they are broadcast only where that file is small; else the words are
joined by a shuffle.

Defined cases: null or empty texts have no words; an item without words is no item; a null item_id is listed as empty
text; rows that share a doc_id are each judged by their own text; empty tables give no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sieve import sift
from .storage import Scratch, columns_of
from .text import ASCII_LOWER, ASCII_UPPER

WINDOW = 10
SLOP = 3
#: What separates words; A-Z are word characters here, so a text can be cut before it is folded.
CUT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_NULL_ID = -(1 << 63)
_NEVER = 1 << 20


def _cut(text: Column) -> Column:
    """Words of a text; the first and the last may be empty."""
    return F.split(F.coalesce(text, F.lit("")), CUT, -1)


def _folded(words: Column) -> Column:
    return F.translate(F.array_join(words, " "), ASCII_UPPER, ASCII_LOWER)


def _term(word: Column) -> Column:
    """A word folded; on ASCII lower() does the same and is faster."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, ASCII_UPPER, ASCII_LOWER))


def benchmark_windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct windows: wid, phrase, size, items, list (a number for equal items), terms."""
    words = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.filter(_cut(F.col(text)), lambda w: w != "").alias("words")).where("size(words) > 0")
    size = F.least(F.size("words"), F.lit(window))
    at = words.withColumn("size", size).select("item", "words", "size", F.explode(F.sequence(F.lit(1), F.size("words") - size + 1)).alias("at"))
    cut = at.select("item", F.col("size").cast("bigint").alias("size"), F.slice("words", F.col("at"), F.col("size")).alias("w"))
    phrase = cut.withColumn("phrase", _folded(F.col("w"))).groupBy("phrase", "size").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return phrase.select(F.xxhash64("phrase").alias("wid"), "phrase", "size", "items", F.xxhash64("items").alias("list"), F.split("phrase", " ").alias("terms"))


def _tokens(docs: DataFrame) -> DataFrame:
    return docs.select("id", F.posexplode(_cut(F.col("text"))).alias("pos", "term")).withColumn("term", _term(F.col("term")))


def _anchors(windows: DataFrame, freq: DataFrame, store: Scratch) -> DataFrame:
    """The windows that can occur, with their rarest terms: wid, term, off, other, gap."""
    each = windows.select("wid", F.posexplode("terms").alias("off", "term")).join(freq, "term", "left").fillna(0, ["n"])
    order = Window.partitionBy("wid").orderBy("n", "off")
    ranked = each.withColumn("rank", F.row_number().over(order)).where("rank <= 2")
    pick = lambda r, c: F.max(F.when(F.col("rank") == r, F.col(c)))
    two = ranked.groupBy("wid").agg(pick(1, "n").alias("n"), pick(1, "term").alias("term"), pick(1, "off").alias("off"), pick(2, "term").alias("t2"), pick(2, "off").alias("o2"))
    return store.save(two.where("n > 0").select("wid", "term", "off", F.coalesce("t2", "term").alias("other"), (F.coalesce("o2", "off") - F.col("off")).alias("gap")), "anchors")


def find_places(docs: DataFrame, windows: DataFrame, store: Scratch, slop: int) -> DataFrame:
    """(id, places, lists): where a window may stand in a document, by its two rarest terms in its order and near enough,
    and the lists of items that these places name."""
    vocabulary = store.save(windows.select(F.explode("terms").alias("term")).distinct(), "vocabulary")
    freq = store.save(_tokens(docs).select("term").join(vocabulary, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n")), "frequencies")
    anchors = _anchors(windows, freq, store)
    wanted = store.save(anchors.select(F.explode(F.array("term", "other")).alias("term")).distinct(), "wanted")
    postings = store.save(_tokens(docs).join(wanted, "term").groupBy("term", "id").agg(F.collect_list("pos").alias("pos")), "postings")
    pairs = anchors.select("term", "other", "gap").distinct()
    first = postings.join(pairs, "term").select(F.col("other").alias("term"), "id", F.col("term").alias("rare"), "gap", F.col("pos").alias("here"))
    both = first.join(postings, ["term", "id"])
    wider = F.transform(F.sequence(F.lit(0), F.lit(slop)), lambda d: F.transform("pos", lambda p: p - F.col("gap") - F.signum("gap").cast("int") * d))
    met = both.select("id", "rare", F.col("term").alias("other"), "gap", F.array_intersect("here", F.flatten(wider)).alias("at")).where("size(at) > 0")
    met = store.save(met, "met")
    at = met.select("id", "rare", "other", "gap", F.explode("at").alias("pos")).join(
        anchors.select(F.col("term").alias("rare"), "other", "gap", "wid", "off"), ["rare", "other", "gap"])
    spots = at.where("pos >= off").select("id", "wid", (F.col("pos") - F.col("off")).cast("bigint").alias("start"), F.col("off").cast("bigint").alias("off"))
    place = F.struct("start", "size", "phrase", "list", "off")
    placed = store.save(spots.join(windows.select("wid", "phrase", "size", "list"), "wid"), "placed")
    named = windows.select("list", "items").distinct()
    lists = placed.select("id", "list").distinct().join(named, "list").groupBy("id").agg(F.collect_list(F.struct("list", "items")).alias("lists"))
    return store.save(placed.groupBy("id").agg(F.collect_set(place).alias("places")).join(lists, "id"), "places")


def _steps(terms: Column, words: Column) -> Column:
    """How many of ``words`` it takes to meet all ``terms`` in order, each at its first place after the one before; _NEVER if they don't."""
    def step(at: Column, term: Column) -> Column:
        found = F.array_position(F.slice(words, at + 1, _NEVER), term).cast("int")
        return F.when(found > 0, at + found).otherwise(F.lit(_NEVER))

    return F.aggregate(terms, F.lit(0), step)


def _near(place: Column, words: Column, slop: int) -> Column:
    """The shortest stretch around a place that holds its window's words in order: start, span, size, phrase, list."""
    terms, off, size = F.split(place["phrase"], " ", -1), place["off"].cast("int"), place["size"].cast("int")
    pos = (place["start"] + place["off"]).cast("int")
    folded = lambda part: F.split(_folded(part), " ", -1)
    after = _steps(F.slice(terms, off + 2, size), folded(F.slice(words, pos + 2, size - off - 1 + slop)))
    first = F.greatest(F.lit(0), pos - off - slop)
    before = _steps(F.reverse(F.slice(terms, F.lit(1), off)), F.reverse(folded(F.slice(words, first + 1, pos - first))))
    return F.struct((pos - before).cast("bigint").alias("start"), (before + after + 1).cast("bigint").alias("span"), place["size"].alias("size"), place["phrase"].alias("phrase"), place["list"].alias("list"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """``docs`` and, named __d_...: n_words, matches (start, size, phrase, items), n_hit, items, near (start, span, size,
    phrase, items), near_items (those found exactly or nearly)."""
    store = Scratch(docs.sparkSession, "decontam")
    windows = store.save(benchmark_windows(benchmark, item_id, item_text, window), "windows")
    ident = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NULL_ID))
    found = find_places(docs.select(ident.alias("id"), F.col(text).alias("text")), windows, store, slop)
    found = found.select(F.col("id").alias("__d_key"), F.col("places").alias("__d_places"), F.col("lists").alias("__d_lists"))
    # only texts that may have places move to them; the rest stay where they are read
    marked = sift(docs.withColumn("__d_id", ident), "__d_id", found, "__d_key")
    columns = [*columns_of(docs), "__d_places", "__d_lists"]
    moved = marked.where("__may").join(found, F.col("__d_id") == F.col("__d_key"), "left").select(columns)
    empty = {c: F.array().cast(found.schema[c].dataType) for c in ("__d_places", "__d_lists")}
    stayed = marked.where("not __may").withColumns(empty).select(columns)
    out = stayed.unionByName(moved).withColumn("__d_words", _cut(F.col(text)))
    words = F.col("__d_words")
    edge = lambda at: F.when(F.element_at(words, at) == "", 1).otherwise(0)
    n_words = (F.size(words) - edge(1) - F.when(F.size(words) > 1, edge(-1)).otherwise(0)).cast("bigint")
    same = lambda p: _folded(F.slice(words, (p["start"] + 1).cast("int"), p["size"].cast("int"))) == p["phrase"]
    places, lists = (F.coalesce(c, empty[c]) for c in ("__d_places", "__d_lists"))
    bare = lambda p: F.struct(p["start"].alias("start"), p["size"].alias("size"), p["phrase"].alias("phrase"), p["list"].alias("list"))
    # places are those of all rows of the doc_id, so the rarest term itself is looked up too
    rarest = lambda p: _folded(F.slice(words, (p["start"] + p["off"] + 1).cast("int"), 1)) == F.get(F.split(p["phrase"], " ", -1), p["off"].cast("int"))
    inexact = F.filter(places, lambda p: ~same(p) & rarest(p)) if slop else F.slice(places, 1, 0)
    nearly = F.transform(inexact, lambda p: _near(p, words, slop))
    out = out.withColumns({
        "__d_n_words": n_words,
        "__d_lists": lists,
        "__d_exact": F.array_sort(F.transform(F.filter(places, same), bare)),
        "__d_nearly": F.array_sort(F.array_distinct(F.filter(nearly, lambda p: p["span"] <= p["size"] + slop))),
    })
    upto = lambda a, p: F.greatest(a["upto"], p["start"] + p["size"])
    grow = lambda a, p: F.struct(upto(a, p).alias("upto"), (a["n"] + F.greatest(F.lit(0).cast("bigint"), p["start"] + p["size"] - F.greatest(a["upto"], p["start"]))).alias("n"))
    zero = F.struct(F.lit(0).cast("bigint").alias("upto"), F.lit(0).cast("bigint").alias("n"))
    listed = lambda p: F.element_at(F.filter("__d_lists", lambda x: x["list"] == p["list"]), 1)["items"]
    with_items = lambda c, *names: F.transform(c, lambda p: F.struct(*[p[n].alias(n) for n in names], listed(p).alias("items")))
    union = lambda used: F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter("__d_lists", lambda x: F.array_contains(used, x["list"])), lambda x: x["items"]))))
    exactly, nearby = (F.transform(c, lambda p: p["list"]) for c in ("__d_exact", "__d_nearly"))
    return out.withColumns({
        "__d_n_hit": F.aggregate("__d_exact", zero, grow, lambda a: a["n"]),
        "__d_matches": with_items("__d_exact", "start", "size", "phrase"),
        "__d_near": with_items("__d_nearly", "start", "span", "size", "phrase"),
        "__d_items": union(exactly),
        "__d_near_items": union(F.concat(exactly, nearby)),
    }).drop("__d_words", "__d_places", "__d_lists", "__d_exact", "__d_nearly")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no window of the benchmark."""
    return decontaminate(docs, benchmark, slop=0).where("__d_n_hit = 0").select(columns_of(docs))

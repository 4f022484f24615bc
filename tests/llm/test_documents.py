"""Operators on documents against brute force, on awkward small tables."""

import os
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

from tickwell.llm import decontam, line_dedup, near_dup, quality  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, docs, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "en" if i is None or i % 3 else None, f"s{(i or 0) % 2}", len(t or "")) for i, t in docs], schema)


@pytest.fixture(scope="module")
def docs():
    return brute.documents()


def test_counts_equal_brute_force(docs):
    got = quality.count_column(pa.array([t for _, t in docs], pa.string()))
    want = [brute.counts(t) for _, t in docs]
    for c in want[0]:
        assert got[c].tolist() == [w[c] for w in want], c


def test_quality_verdict_follows_its_fences(spark, docs):
    rows = quality.quality_rules(table(spark, docs * 4)).collect()
    assert len(rows) == 4 * len(docs)
    for r in rows:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed
        assert r.kept == (not failed and all(r[m] <= r[f"fence_{m}"] for m in quality.MEASURES))


def test_fences_follow_the_data_and_no_junk_source_raises_its_own(spark):
    clean = [(i, " ".join(f"word{i}x{j}" for j in range(80))) for i in range(300)]
    junk = [(i, " ".join("### || $$" for _ in range(40))) for i in range(300, 340)]
    rows = [(i, t, "en", "junk" if i >= 300 else "good") for i, t in clean + junk]
    out = quality.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string"), "doc_id").collect()
    assert all(r.kept == (r.doc_id < 300) for r in out)


def judge(spark, rows):
    """Rows (text, lang, source); doc_id is the place."""
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, text string, lang string, source string")
    return sorted(quality.quality_rules(frame).collect(), key=lambda r: r.doc_id)


def prose(i, n=100, letters=0):
    return " ".join(f"w{i}x{j}" + "abcdefgh"[:letters + (j < 5 * (i % 5))] for j in range(n))


def test_the_sketches_set_the_bar(spark):
    rows = [(prose(i), "en", "short") for i in range(300)] + [(prose(i, letters=1), "en", "long") for i in range(300)]
    rows += [(prose(700) + " #" * 10, "en", "short"), (prose(701), "en", "short"), (prose(702, letters=4), "en", "short")]
    out = judge(spark, rows)
    assert [r.kept for r in out] == [True] * 600 + [False, True, False]
    assert 0.5 < out[300].fence_word_length - out[0].fence_word_length < 1.5
    assert out[600].symbol_share < 0.1 and out[600].fence_symbol_share < 0.04 and out[602].word_length < 12


def test_no_large_source_or_language_sets_its_own_bar(spark):
    junk = lambda i: prose(i) + " ##" * 30
    rows = [(prose(i), "en", "a") for i in range(400)] + [(junk(i), "en", "b") for i in range(400, 600)]
    assert [r.kept for r in judge(spark, rows)] == [True] * 400 + [False] * 200
    rows = [(prose(i), ("en", "fr")[i % 2], f"s{i % 3}") for i in range(1500)] + [(junk(i), "en", "big") for i in range(1500, 2300)]
    rows += [(junk(i), lang, "s0") for lang in (None, "zz") for i in range(250)]
    rows += [(prose(i), "de", f"t{i % 90}") for i in range(250)] + [(junk(i), "de", "big") for i in range(300)]
    assert [r.kept for r in judge(spark, rows)] == [True] * 1500 + [False] * 1300 + [True] * 250 + [False] * 300


def plain_fences(rows):
    """The documented fences by exact quantiles of the rows' own measures: {(lang, source): {measure: fence}}."""
    import math
    low = lambda values, q=0.5: sorted(values)[math.ceil(q * len(values)) - 1]
    good = [r for r in rows if not r.base_failed]
    c, out = quality.MIN_GROUP, {(r.doc_lang, r.doc_source): {} for r in good}
    size = {g: sum((r.doc_lang, r.doc_source) == g for r in good) for g in out}
    for m in quality.MEASURES:
        def fence(groups):
            values = [r[m] for r in good if (r.doc_lang, r.doc_source) in groups]
            return low(values, quality.TAIL) + quality.SPREADS * (low(values, quality.TAIL) - low(values))

        middle, unvoted = {}, set()
        for lang in {g[0] for g in out}:
            mine = {g for g in out if g[0] == lang}
            small = {g for g in mine if size[g] < c}
            votes = [fence({g}) for g in mine - small] + ([fence(small)] if sum(size[g] for g in small) >= c else [])
            unvoted |= set() if votes else mine
            middle[lang] = low(votes) if votes else fence(mine)
        tops = [middle[lang] for lang in middle if lang not in {g[0] for g in unvoted}]
        common = low(tops + ([fence(unvoted)] if sum(size[g] for g in unvoted) >= c or not tops else [])) if out else None
        blend = lambda n, own, parent: n / (n + c) * own + c / (n + c) * parent
        common = blend(len(good), common, quality.MEASURES[m][2]) if out else None
        for g in out:
            mid = blend(sum(size[h] for h in out if h[0] == g[0]), middle[g[0]], common)
            small = {h for h in out if h[0] == g[0] and size[h] < c}
            parent = blend(sum(size[h] for h in small), fence(small), mid) if small else mid
            out[g][m] = min(blend(size[g], fence({g}), parent), quality.SLACK * mid, quality.SLACK * common)
    return out


@pytest.mark.parametrize("sizes", [{("en", "a"): 3}, {("en", "a"): 1, ("fr", "b"): 40, (None, None): 25},
                                   {("en", "a"): 210, ("en", "b"): 90, ("en", "c"): 7, ("fr", "a"): 60, ("fr", "b"): 150, ("de", "a"): 30, (None, "b"): 1}])
def test_one_rule_at_every_size_equals_exact_quantiles(spark, sizes):
    rows = [(prose(i + 7 * k, 60 + i % 50, k % 3) + " #" * (i % 4) + "\nAGAIN THIS LINE" * (i % 9 // 3), *g) for k, (g, n) in enumerate(sizes.items()) for i in range(n)]
    rows += [("too short", "en", "a"), (prose(5) + " ###" * 60, *next(iter(sizes)))]
    out = judge(spark, rows)
    want = plain_fences(out)
    unit = {"symbol_share": "n_words", "capital_share": "word_chars", "dup_line_share": "n_lines", "repeat_share": "n_words", "word_length": "n_words"}
    for r in out:
        if not r.base_failed:
            bars = {m: want[r.doc_lang, r.doc_source][m] + quality.MEASURES[m][1] / r[unit[m]] for m in unit}
            assert all(abs(r[f"fence_{m}"] - bars[m]) < 1e-9 for m in unit)
            assert r.kept == all(r[m] <= r[f"fence_{m}"] for m in unit)


def test_line_dedup_equals_brute_force(spark, docs):
    got = line_dedup.dedup_lines(table(spark, docs)).select("doc_id", "__n_lines", "__n_dropped", F.sha2("text", 256)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.line_dedup(docs))


def test_line_dedup_repeated_rows_and_null_ids(spark):
    line = "this line is long enough to count"
    rows = [(None, line), (1, line), (1, line), (2, line + " "), (3, "short"), (3, None)]
    got = sorted((r.doc_id or 0, r.text) for r in line_dedup.dedup_lines(table(spark, rows)).collect())
    assert got == [(0, ""), (1, ""), (1, ""), (2, line + " "), (3, ""), (3, "short")]
    two = line_dedup.dedup_lines(table(spark, [(1, line), (1, line), (2, line)])).where("__n_dropped > 0")
    assert two.count() == 0


def test_perfect_hash_is_minimal_and_splits_hot_shards(spark, monkeypatch):
    import numpy as np
    from tickwell.llm import text as T
    hi, lo = T.mix(np.arange(5000, dtype=np.uint64)), T.mix(np.arange(5000, 10000, dtype=np.uint64))
    shard = line_dedup.Shard(line_dedup.pack_shard(hi, lo, np.arange(5000), np.arange(5000) * 2))
    assert sorted(shard.mph.slots(hi, lo).tolist()) == list(range(5000))
    counts, keepers = shard.probe(hi, lo)
    assert (counts == np.arange(5000)).all() and (keepers == 2 * counts).all()
    with pytest.raises(ValueError):
        shard.probe(lo, hi)
    monkeypatch.setattr(line_dedup, "SHARD_PROBES", 7)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 5)
    docs = brute.documents(seed=3, n=60)
    got = line_dedup.dedup_lines(table(spark, docs)).select("doc_id", "__n_lines", "__n_dropped", F.sha2("text", 256)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.line_dedup(docs))


def test_near_duplicates_equal_brute_force(spark, docs):
    got = near_dup.near_duplicates(table(spark, docs), k=4).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute.near_dup(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def chain(n=60, words=40, step=4):
    """Documents each linked with the next few only, so that no star covers the class."""
    return [(i + 1, " ".join(f"w{j}" for j in range(i * step, i * step + words))) for i in range(n)]


def test_near_duplicates_lose_no_link_of_a_chain(spark):
    docs = chain()
    got = near_dup.near_duplicates(table(spark, docs), k=4).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute.near_dup(docs)
    assert {r.component_id for r in got} == {1}


def test_near_duplicates_repeated_rows_nulls_and_pipeline_filter(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(None, text), (2, text), (1, text.upper()), (1, "other words here"), (5, "other words here"), (3, None), (4, "")]
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dup.near_duplicates(table(spark, rows), k=4).collect()}
    assert got == {(None, 7): (None, True), (2, 7): (1, False), (1, 7): (1, True), (1, 1): (1, True), (5, 1): (1, False), (3, 0): (3, True), (4, 0): (4, True)}
    kept = near_dup.keep_one(table(spark, rows))
    assert kept.columns == SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 1, 3, 4]


def items(docs):
    return [(1, " ".join(brute.ALNUM.findall(docs[30][1])[3:25])), (2, "one"), (3, None), (4, ""), (10, "A, B; C"), (10, "!!"), (None, docs[-1][1][500:700]),
            (7, " ".join(brute.ALNUM.findall(docs[-1][1])[100:109])), (8, docs[-1][1][500:700]), (9, "no such words stand in any of these documents at all ever")]


def test_decontamination_equals_brute_force(spark, docs):
    bench = items(docs)
    out = decontam.decontaminate(table(spark, docs), spark.createDataFrame(bench, "item_id bigint, text string"))
    got = out.select("doc_id", "__d_n_words", "__d_n_hit", F.size("__d_items"), F.sha2(F.array_join("__d_items", ","), 256)).collect()
    want = brute.decontaminate(docs, bench)
    assert sorted(map(tuple, got)) == sorted(want)
    assert sum(w[2] > 0 for w in want) > 3


def test_decontamination_folds_by_the_contract_only(spark):
    words = "ΟΙ ΝΟΜΟΣ ΑΛΛΟ ΛΟΓΟΣ ΤΗΣ ΠΟΛΗΣ İSTANBUL \u212aELVIN ÉTÉ Word"
    bench = [(1, words), (2, words.replace(" ", ".")), (3, "νομος λογος της")]
    docs = [(1, words), (2, words.replace(" ", ".")), (3, words.replace("ΝΟΜΟΣ ", "ΝΟΜΟΣ:").replace("Word", "wORD")), (4, words.lower()), (5, "x ΝΟΜΟΣ'ΑΛΛΟ.ΛΟΓΟΣ")]
    out = decontam.decontaminate(table(spark, docs), spark.createDataFrame(bench, "item_id bigint, text string"))
    got = out.select("doc_id", "__d_n_words", "__d_n_hit", F.size("__d_items"), F.sha2(F.array_join("__d_items", ","), 256)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.decontaminate(docs, bench))
    assert sum(r["__d_n_hit"] > 0 for r in got) == 3


def test_decontamination_proximity(spark):
    item = [(1, " ".join(f"w{i}" for i in range(12))), (2, "w3 w4 gap"), (3, "w3")]
    near = " ".join(["w0", "gap", *[f"w{i}" for i in range(1, 12)]])
    far = " ".join(f"w{i} x x x x x" for i in range(12))
    turned = " ".join(f"w{i}" for i in reversed(range(12)))
    out = decontam.decontaminate(table(spark, [(1, near), (2, far), (3, item[0][1]), (4, turned)]), spark.createDataFrame(item, "item_id bigint, text string"))
    got = {r.doc_id: r for r in out.collect()}
    assert got[1]["__d_n_hit"] == 11 and [(p.start, p.span, p.size, p.phrase, p["items"]) for p in got[1]["__d_near"]] == [(0, 11, 10, " ".join(f"w{i}" for i in range(10)), ["1"])]
    assert got[3]["__d_n_hit"] == 12 and not got[3]["__d_near"]
    assert all(got[i]["__d_n_hit"] == 1 and not got[i]["__d_near"] and got[i]["__d_near_items"] == ["3"] for i in (2, 4))


def test_proximity_equals_brute_force(spark):
    import random
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(14)]
    passages = [[rng.choice(vocabulary) for _ in range(n)] for n in (1, 2, 3, 6, 10, 12, 25, 10)]
    docs = []
    for i in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(30))]
        for w in rng.choice(passages):
            words += [w] + [rng.choice(vocabulary) for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2]))]
        docs.append((i, rng.choice([" ", ", ", ". "]).join(words).upper() + rng.choice(["", "."])))
    docs += [(120, None), (121, ""), (122, "..."), (122, docs[0][1])]
    bench = [(i, " ".join(p)) for i, p in enumerate(passages)] + [(None, "v1 v2 V3"), (7, "v0 v0 v0 v0")]
    out = decontam.decontaminate(table(spark, docs), spark.createDataFrame(bench, "item_id bigint, text string")).collect()
    want = brute.near_items(docs, bench)
    assert sorted((r.doc_id, r["__d_near_items"]) for r in out) == sorted(want)
    assert sum(len(r["__d_near_items"]) > len(r["__d_items"]) for r in out) > 20
    assert all(p.size < p.span <= p.size + 3 for r in out for p in r["__d_near"])


@pytest.mark.parametrize("which", ["documents", "benchmark"])
def test_empty_tables(spark, docs, which):
    none = table(spark, [])
    some = table(spark, docs[:20])
    bench = spark.createDataFrame(items(docs) if which == "documents" else [], "item_id bigint, text string")
    d = none if which == "documents" else some
    assert decontam.decontaminate(d, bench).where("__d_n_hit > 0").count() == 0
    assert quality.quality_rules(none).count() == line_dedup.dedup_lines(none).count() == near_dup.near_duplicates(none).count() == 0
    assert quality.keep_documents(none).columns == none.columns


def test_clashing_columns_stay(spark, docs):
    wide = table(spark, docs[9:60]).withColumns({c: F.lit(c) for c in ("id", "hi", "rep", "key", "n_words", "kept", "words", "doc_lang", "component", "term")})
    bench = spark.createDataFrame(items(docs), "item_id bigint, text string")
    for out in (quality.keep_documents(wide), line_dedup.dedup_lines(wide).select(wide.columns), near_dup.keep_one(wide), decontam.drop_contaminated(wide, bench)):
        assert out.columns == wide.columns
        assert all(r.kept == "kept" and r.n_words == "n_words" for r in out.collect())


def test_near_duplicates_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 2)
    monkeypatch.setattr(near_dup, "CHUNK", 3)
    docs = [*chain(24), *[(100 + i, t) for i, t in chain(12, words=44, step=7)], *brute.documents(seed=11, n=60)[9:]]
    docs = [(i, t) for i, (_, t) in enumerate(docs)]
    got = near_dup.near_duplicates(table(spark, docs), k=4).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute.near_dup(docs)


def test_sieve_lets_every_partner_through(spark, monkeypatch):
    from tickwell.llm import sieve
    monkeypatch.setattr(sieve, "BITS", 1 << 10)
    rows = spark.range(-500, 500).selectExpr("if(id = 7, null, id) as k", "'x' as v")
    ids = spark.range(0, 300, 3).selectExpr("id as wanted")
    got = {r.k: r["__may"] for r in sieve.sift(rows, "k", ids, "wanted").collect()}
    assert len(got) == 1000 and all(got[i] for i in range(0, 300, 3))
    assert sum(got.values()) < 400
    assert not any(r["__may"] for r in sieve.sift(rows, "k", ids.limit(0), "wanted").collect())


def test_sieve_over_many_pages_grows_with_its_ids(spark, monkeypatch):
    from tickwell.llm import sieve
    assert sieve.size_for(0) == sieve.size_for(1_000_000) == sieve.BITS and sieve.size_for(1_100_000) == 2 * sieve.BITS
    assert sieve.size_for(10**12) == sieve.MOST
    monkeypatch.setattr(sieve, "BITS", 1 << 10)
    monkeypatch.setattr(sieve, "PAGE", 1 << 4)
    ids = spark.range(0, 40_000, 2).selectExpr("id as wanted")  # 2^20 bits: 1,024 pages of 16 words
    got = sieve.sift(spark.range(40_000).selectExpr("id as k"), "k", ids, "wanted").groupBy(F.col("k") % 2).agg(F.sum(F.col("__may").cast("int"))).collect()
    passed = {r[0]: r[1] for r in got}
    assert passed[0] == 20_000 and 0 < passed[1] < 20_000 / 16


def test_sketches_keep_every_linked_pair_and_bar_most_others():
    import numpy as np
    rng = np.random.default_rng(5)

    def agreed(size, common):
        """Agreeing slots of two sets with ``common`` of ``size`` elements in their union shared."""
        union = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        mine = rng.permutation(len(union))[common:]
        left = np.isin(np.arange(len(union)), mine[::2])
        right = np.isin(np.arange(len(union)), mine[1::2])
        a, b = near_dup.sketch(union[~left]), near_dup.sketch(union[~right])
        return near_dup.SKETCH - sum(int(x).bit_count() for x in (a ^ b).view(np.uint64))

    least = near_dup._agree(near_dup.SKETCH, 80, 0.5)
    for size in (5, 10, 15, 100, 500, 3000):
        assert min(agreed(size, size * 4 // 5) for _ in range(150)) >= least, size
    assert sum(agreed(300, 150) >= least for _ in range(200)) < 4  # similarity 0.5


def test_only_texts_that_lose_lines_move(spark):
    """And shards beyond the task bound share tasks."""
    shared = "a line of twenty or more characters"
    rows = [(i, f"own text number {i}") for i in range(200)] + [(1000 + i, f"{shared}\nown {i}") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = line_dedup.dedup_lines(df)
    got = {r.doc_id: (r.text, r["__n_dropped"]) for r in out.collect()}
    assert got == {i: (t, 0) if i < 1000 or i == 1004 else (t.split("\n")[1], 1) for i, t in rows}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan


def test_shards_share_tasks_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 3)
    monkeypatch.setattr(line_dedup, "MAX_TASKS", 1)
    docs = brute.documents()
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert sorted((r.doc_id, r["__n_lines"], r["__n_dropped"], brute.sha(r.text)) for r in got.collect()) == sorted(brute.line_dedup(docs))

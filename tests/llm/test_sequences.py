"""Conversation repair, periodic runs and SentencePiece encoding against brute force and the library."""

import functools
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tickwell.llm import pieces as P
from tickwell.llm import queries, repair
from tickwell.llm import runs as R
from tickwell.llm import text as T

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TURNS = "conv_id bigint, turn bigint, role string, text string, audit int, digest string, place int"
DOCS = "doc_id bigint, text string, runs int, ids string, _words int, collapsed string"


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# --- conversations -----------------------------------------------------------------------------------------------------

def cheapest(initials, faults):
    """(cost, audit) by a search over rows and the state of the grammar, for short conversations."""
    @functools.cache
    def go(i, state, inserts):
        out = [(0, "")] if i == len(initials) and state in ("", "a") else []
        nxt = "a" if state == "u" else "u"

        def add(cost, letter, rest):
            out.append((cost + rest[0], letter + rest[1]))

        if inserts < 3:
            add(3, "I", go(i, nxt, inserts + 1))
        if i < len(initials):
            extra = 3 if faults[i] == "t" else 0
            add(4, "D", go(i + 1, state, 0))
            if faults[i] not in "bd":
                if initials[i] == nxt or (initials[i] == "s" and state == ""):
                    add(extra, "K", go(i + 1, initials[i], 0))
                add(3 + extra, "R", go(i + 1, nxt, 0))
        return min(out, default=(10**9, ""))

    return go(0, "", 0)


WHITE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        out += [(c, t, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def repaired(rows):
    """The contract's columns of one conversation's rows, damaged and in order."""
    initials, faults, seen = "", "", set()
    for _, _, role, text in rows:
        body = text.strip(WHITE)
        faults += "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "-"
        initials += role[:1] if role[:1] in ("s", "u", "a") else "-"
        seen.add((role, text))
    cost, audit = cheapest(initials, faults)
    out, left = [], iter(rows)
    size = len(audit) - audit.count("D")
    for letter in audit:
        row = next(left) if letter != "I" else None
        if letter != "D":
            at = len(out) - size % 2
            name = "system" if at < 0 else ("user", "assistant")[at % 2]
            out.append(f"{row[2] if letter == 'K' else name}:{row[3] if row else ''}")
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [initials[i:i + 2] for i in range(len(initials) - 1)]
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha("\n".join(out))


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def expected(rows):
    by = {c: [] for c, *_ in rows}
    for row in damage(rows):
        by[row[0]].append(row)
    key = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest())
    return {c: repaired(sorted(x, key=key)) for c, x in by.items()}


def report(spark, rows):
    turns = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS)
    out = repair.repair_report(repair.damaged(turns), turns.select("conv_id").distinct()).collect()
    assert len(out) == len({r.conv_id for r in out})
    return {r.conv_id: tuple(r[f] for f in FIELDS) for r in out}


def awkward(seed=11, conversations=150):
    r = random.Random(seed)
    texts = ["Yes.", "No", "", " \t\n", None, "same.", "same.", "é?", "what!\u0085", "end.\n\n", "a:b\nuser:c.", "…"]
    out = []
    for c in range(conversations):
        roles = r.choice([["user", "assistant"], ["system", "user", "assistant"], ["user"], ["system"], ["tool", "", None, "Assistant", "ux", "user"]])
        for t in range(r.randint(1, 12)):
            role = roles[t % len(roles)] if r.random() < 0.7 else r.choice(roles)
            out.append((c, r.choice([t, t, t, 2 * t, None]), role, r.choice(texts) if r.random() < 0.6 else f"t{r.randrange(9)}."))
    out += [(None, 0, "user", "q."), (None, None, "assistant", "a."), (500, 0, "user", "x."), (500, 0, "user", "x."), (501, None, None, None), (502, -(1 << 62), "user", "x."), (502, 1 << 62, "assistant", "y.")]
    return out


def test_repair_against_search(spark):
    rows = awkward()
    want, got = expected(rows), report(spark, rows)
    assert got == want
    assert {len(a[6]) - a[6].count("D") for a in got.values()} > {0, 2, 3, 4}


def test_repair_query_on_given_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[f] for f in FIELDS) for r in queries.queries()["op11_conversation_repair"](spark, SF).collect()}
    assert got == expected(rows)


def test_alignment_of_every_short_conversation():
    r = random.Random(3)
    for _ in range(1500):
        n = r.randint(0, 12)
        initials = "".join(r.choice(r.choice(["sua-", "ua", "s", "uuua"])) for _ in range(n))
        faults = "".join(r.choice(r.choice(["-", "-bdt", "t"])) for _ in range(n))
        assert repair.align(initials, faults) == cheapest(initials, faults)


def test_long_conversation_and_every_row_of_it(spark):
    r = random.Random(4)
    rows = [(1, t, r.choice(["user", "assistant"]) if r.random() < 0.2 else ("user", "assistant")[t % 2], f"{t}." if r.random() < 0.8 else r.choice(["", "cut"])) for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    audits = repair.audit_conversations(df)
    out = sorted(repair.repair_conversations(df, audits).collect(), key=lambda x: x.place)
    assert [x.place for x in out] == list(range(len(out)))
    assert re.fullmatch("s?(ua)+", "".join(x.role[0] for x in out))
    audit = audits.first().audit
    assert audit.replace("D", "") == "".join(x.edit for x in out)
    gone = {t for t, e in zip(range(3000), audit.replace("I", ""), strict=True) if e == "D"}
    assert [x.turn for x in out if x.edit != "I"] == [t for t in range(3000) if t not in gone]
    assert all(x.text == rows[x.turn][3] for x in out if x.edit != "I")


def test_repair_of_an_empty_table(spark):
    assert report(spark, []) == {}
    turns = spark.createDataFrame([], TURNS)
    assert repair.repair_conversations(turns, repair.audit_conversations(turns)).count() == 0


# --- periodic runs -----------------------------------------------------------------------------------------------------

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def all_runs(w):
    out = set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q) and not any(all(w[i + k] == w[i + k + p] for k in range(length - p)) for p in range(1, q)):
                out.add((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda x: (x[0], x[2]))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def words_with_runs(r, vocabulary):
    out = []
    for _ in range(r.randint(0, 5)):
        block = [r.choice(vocabulary) for _ in range(r.randint(1, r.choice([2, 5, 20])))]
        out += block * r.choice([1, 1, 2, 4, 5, 9]) + block[:r.randint(0, len(block))]
    return out


@pytest.mark.parametrize("size", [20, 200, 1 << 20])
def test_runs_of_pieces(size):
    r = random.Random(size)
    vocabulary = ["a", "bé", "c", "\u0085x"] + [str(i) for i in range(40)]
    docs = [words_with_runs(r, vocabulary[:r.choice([1, 2, 3, 30])]) for _ in range(300)]
    fib = ["a", "b"]
    while len(fib) < 600:
        fib = (fib + fib[:len(fib) * 618 // 1000 + 1])[:600]
    docs += [fib, ["x"] * 5, ["x"] * 6, ["a", "b"] * 4, ["a", "b", "c"] * 4 + ["a"]]
    texts = [r.choice(["", " ", "\n"]) + r.choice([" ", "\t\n"]).join(w) if w or r.random() < 0.5 else None for w in docs]
    got = []
    for piece in T.pieces(pa.array(texts, pa.string()), size):
        n, found, kept = R.scan_piece(piece)
        got += zip(n.tolist(), [[(x["start"], x["length"], x["period"]) for x in y] for y in found.to_pylist()], kept, strict=True)
    for w, (n, found, kept) in zip(docs, got, strict=True):
        assert (n, found, kept.decode()) == (len(w), all_runs(w), collapsed(w, all_runs(w)))


def test_range_successor():
    r = np.random.default_rng(2)
    for n in (1, 2, 63, 64, 65, 1000):
        values = r.permutation(n)
        tree = R.Wavelet(values, max(1, (n - 1).bit_length()))
        lo = r.integers(0, n, 200)
        hi = np.minimum(lo + r.integers(0, 70, 200), n)
        x = r.integers(0, n, 200)
        want = [min((v for v in values[a:b] if v >= y), default=-1) for a, b, y in zip(lo, hi, x, strict=True)]
        assert tree.successor(lo, hi, x).tolist() == want


def test_runs_query(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.queries()["op12_periodic_runs"](spark, SF).collect()}
    planted = 0
    for doc_id, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        w = SPACED.findall(text or "")
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and w:
            planted += 1
            g, n = h // 10, len(w)
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if len(w) > 1500:
            continue
        found = all_runs(w)
        best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        assert got[doc_id] == (len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(collapsed(w, found)))
    assert planted > 5


def test_runs_of_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "a " * 9, 1, "x", 2, "y"), (1, "a " * 9, 1, "x", 2, "y"), (None, None, 1, "x", 2, "y"), (3, "", 0, "", 0, ""), (4, "\n", 0, "", 0, "")]
    df = spark.createDataFrame(rows, DOCS)
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in R.find_runs(df).collect()))
    assert got == [(0, 0, [], ""), (1, 9, [(0, 9, 1)], "a"), (1, 9, [(0, 9, 1)], "a"), (3, 0, [], ""), (4, 0, [], "")]
    assert R.find_runs(df.limit(0)).count() == 0
    assert R.with_planted_tail(spark.createDataFrame([(i, None if i % 2 else "") for i in range(40)], "doc_id bigint, text string")).where("text <> ''").count() == 0


# --- sentence pieces ---------------------------------------------------------------------------------------------------

def strange_texts():
    r = random.Random(1)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    some = [library.id_to_piece(i) for i in range(259, 32000)]
    out = ["", " ", "  a  b ", "é́ ﬁ ① ​ x\ty\n\0z", "▁a▁▁", "<s> <0x0A></s>", "a" * 100, " " * 37 + "x" + " " * 50, "aaaaabaaab" * 20, "😀\U000e0001", None, "\n\n\n    def x():\n"]
    out += ["".join(r.choice("aab  eétn▁\n.,1ing  thz的😀") for _ in range(r.randint(0, 60))) for _ in range(600)]
    out += ["".join(r.choice(some).replace("▁", " " if r.random() < 0.5 else "") for _ in range(r.randint(0, 12))) for _ in range(600)]
    return out + ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(160, 0x500), r.randrange(0x3000, 0x9FFF)])) for _ in range(r.randint(0, 30))) for _ in range(300)], library


def test_ids_equal_the_library(monkeypatch):
    texts, library = strange_texts()
    for slice_bytes in (1 << 20, 50):
        monkeypatch.setattr(P, "SLICE_BYTES", slice_bytes)
        coder = P.Pieces(MODEL)
        for text, ids in zip(texts, coder.encode(pa.array(texts, pa.string())), strict=True):
            assert ids.tolist() == [1, *library.encode(text or ""), 2]


def test_small_memos_change_nothing(monkeypatch):
    texts, library = strange_texts()
    for name, most in (("MEMO_UNITS", 3), ("MEMO_PAIRS", 5), ("MEMO_CHARS", 4)):
        monkeypatch.setattr(P, name, most)
    for text, ids in zip(texts, P.Pieces(MODEL).encode(pa.array(texts, pa.string())), strict=True):
        assert ids.tolist() == [1, *library.encode(text or ""), 2]


def test_backtracking_over_a_vocabulary_that_misleads():
    """Long pieces that end in dead ends: every split must be the merge result."""
    coder = P.Pieces(MODEL)
    r = random.Random(6)
    for _ in range(40):
        letters = "abc"
        made = sorted({"".join(r.choice(letters) for _ in range(r.randint(2, 5))) for _ in range(12)})
        coder.ids = {p: i for i, p in enumerate([*letters, *made])}
        coder.score = {p: -float(i) for i, p in enumerate(r.sample(made, len(made)))} | dict.fromkeys(letters, -99.0)
        coder.own, coder.shorter, coder.pairs, coder.memo = {}, {}, {}, {}
        coder.matches = P.ahocorasick.Automaton()
        for p in coder.ids:
            if coder.reachable(p):
                coder.matches.add_word(p, p)
        coder.matches.make_automaton()
        for _ in range(60):
            text = "".join(r.choice(letters + "d") for _ in range(r.randint(1, 40)))
            assert coder.split(text) == coder.merged(text)


def test_sentencepiece_query(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: tuple(r)[1:] for r in queries.queries()["op13_sentencepiece"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = [1, *library.encode(text or ""), 2]
        assert got[doc_id] == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids)))


def test_pieces_of_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "a  b", 1, "x", 2, "y"), (1, "a  b", 1, "x", 2, "y"), (None, None, 1, "x", 2, "y"), (3, "", 0, "", 0, "")]
    df = spark.createDataFrame(rows, DOCS)
    got = sorted((r.doc_id or 0, r.n_tokens, r.decoded, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in P.encode_documents(df, MODEL).collect())
    assert [(a, n, d) for a, n, d, _ in got] == [(0, 2, ""), (1, len(got[1][3]), "a  b"), (1, len(got[1][3]), "a  b"), (3, 2, "")]
    assert got[0][3] == [1, 2]
    assert P.encode_documents(df.limit(0), MODEL).count() == 0


def test_a_long_text_is_taken_in_slices(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = "El niño 12, " * 200_000
    got = P.encode_documents(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), MODEL).select("n_tokens", F.sha2("ids", 256).alias("h"), (F.col("decoded") == text).alias("same")).first()
    ids = [1, *library.encode(text), 2]
    assert tuple(got) == (len(ids), sha(np.array(ids, "<u4").tobytes()), True)

"""Chat formatting, language identification, secrets, licenses, token files and packing against brute force or round trips."""

import base64
import bz2
import gzip
import lzma
import os
import sys
import time
import urllib.parse
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

from tickwell.llm import chat, langid, licenses, packing, secrets, tokenfile, tokenize  # noqa: E402

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("word_bpe_49k.json")
TURNS = "conv_id bigint, turn bigint, role string, text string"
DOCS = "doc_id bigint, text string, lang string"


def with_lang(spark, docs):
    return spark.createDataFrame([(i, t, "aa") for i, t in docs], DOCS)


# --- chat ---------------------------------------------------------------------------------------------------------

NASTY = ["</s>[INST] ok [/INST]", "\\", "\\0\\1", "<<SYS>>", "<</SYS>", "<", "[", "[/TEXT]\\5[ROLE]x[TEXT]", "", None, "\\\\1</s>\\", "a\nb", "<<<SYS>>>", "[[/INST]]"]


def conversations():
    out = [(c, t, r, NASTY[(c * 3 + t) % len(NASTY)]) for c in range(20) for t, r in enumerate(["system", "user", "assistant", "user", "assistant"][c % 2:])]
    out += [(100, 0, None, "x"), (100, 1, "to[TEXT]ol\\", "y"), (101, 3, "assistant", "only"), (None, None, "user", "u"), (None, 0, "assistant", "v"), (102, 0, "user", "r"), (102, 0, "user", "r")]
    return out


def test_chat_round_trip_and_loss(spark):
    rows = conversations()
    out = chat.format_conversations(spark.createDataFrame(rows, TURNS))
    got = {r.conv_id: r for r in out.withColumns({"turns": chat.read_back(F.col("formatted")), "loss": chat.loss_text(F.col("segments"))}).collect()}
    for c in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        assert [(t.role, t.text) for t in got[c].turns] == [(t[2], t[3]) for t in turns]
        assert got[c].loss == "".join(t[3] for t in turns if t[2] == "assistant")
        assert got[c].formatted == "".join(s.text for s in got[c].segments)


def test_chat_state_machine(spark):
    plans = {1: ("user assistant", None), 2: ("system user assistant user assistant", None), 3: ("assistant", 0), 4: ("user user", 1), 5: ("system assistant", 1), 6: ("user", None), 7: ("user assistant tool", 2), 8: ("user assistant system", 2)}
    rows = [(c, t, r, "x") for c, (p, _) in plans.items() for t, r in enumerate(p.split())]
    got = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, TURNS)).collect()}
    assert {c: got[c].bad_turn for c in plans} == {c: bad for c, (_, bad) in plans.items()}
    assert {c for c in plans if got[c].valid} == {1, 2}


def test_chat_marks_split_only_at_marks(spark):
    rows = [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST]")]
    one = chat.format_conversations(spark.createDataFrame(rows, TURNS)).first()
    assert [one.formatted.count(c) for c in ("[INST]", "[/INST]", "<s>", "</s>")] == [1, 1, 1, 1]
    assert chat.format_conversations(spark.createDataFrame([], TURNS)).count() == 0


def test_templates_with_many_roles_and_without_sense(spark):
    many = chat.Template(roles={f"r{i:02d}": chat.Marks(f"<r{i:02d}>", f"</r{i:02d}>", loss=i % 2 == 0) for i in range(60)}, general=("<any>", "<says>", "</any>"),
                         steps=frozenset({("start", "r00")}), accept=frozenset({"r00"}))
    assert len(many.codes) == len(many.controls) == 123 and len({len(c) for c in many.codes}) == 1
    rows = [(1, i, f"r{i:02d}", "".join(many.controls[i:] + ["\\", "\\11", "\\0"])) for i in range(60)] + [(1, 99, "else", "".join(many.controls))]
    got = chat.format_conversations(spark.createDataFrame(rows, TURNS), many).withColumn("turns", chat.read_back(F.col("formatted"), many)).first()
    assert [(t.role, t.text) for t in got.turns] == [(r, t) for _, _, r, t in rows]
    for bad in ({"a": chat.Marks("", "</a>")}, {"a": chat.Marks("<a>", "\\")}, {"a": chat.Marks("<a>", "</a>"), "b": chat.Marks("x<a>", "</b>")}, {"a": chat.Marks("<a>", "</a>"), "b": chat.Marks("<a>", "</b>")}):
        with pytest.raises(ValueError):
            chat.Template(roles=bad, general=("[R]", "[T]", "[E]"), steps=frozenset(), accept=frozenset())


# --- languages ------------------------------------------------------------------------------------------------------

def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 20
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_held_out_is_crc32_of_the_id(spark):
    got = {r.id: r.h for r in spark.range(200).select("id", langid.held_out(F.col("id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}


def test_code_lengths_equal_a_plain_context_tree(spark):
    texts = {"aa": ["abab abab abba", "baab ab"], "bb": ["xyxy xyyx éx", "yyxx"]}
    rows = [(i, t, k) for i, (k, t) in enumerate((k, t) for k, ts in texts.items() for t in ts)]
    stats = langid.train(spark.createDataFrame(rows, DOCS), order=2)
    model = langid.Model(stats)
    counts = {k: {} for k in texts}
    for k, ts in texts.items():
        for t in ts:
            raw = b"\n\n" + t.encode()
            for i in range(2, len(raw)):
                for n in range(3):
                    at = counts[k].setdefault(raw[i - n:i], {})
                    at[raw[i]] = at.get(raw[i], 0) + 1

    def bits(k, context, b):
        at = counts[k].get(context)
        shorter = lambda: bits(k, context[1:], b) if context else 8.0
        if not at:
            return shorter()
        total = sum(at.values()) + len(at)
        return -np.log2(at[b] / total) if b in at else -np.log2(len(at) / total) + shorter()

    probes = ["abxy", "", "é!", "yx ab", "\n"]
    column = pa.array(probes)
    got = np.concatenate([model.code_lengths(p) for p in langid.T.pieces(column)]) / langid.SCALE
    for row, t in zip(got, probes, strict=True):
        raw = b"\n\n" + t.encode()
        want = [sum(bits(k, raw[i - 2:i], raw[i]) for i in range(2, len(raw))) for k in stats["langs"]]
        assert np.allclose(row, want, atol=0.01 * (len(raw) + 1))


def test_language_of_odd_texts(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(None, "aa"), ("", "aa"), ("12 34!", "aa"), ("aaa bbb aaa", "aa"), ("ж", None), ("aaa bbb", "aa"), ("ccc ddd ccc", "bb"), ("ccc ddd", "bb"), ("ddd", "bb")])]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, DOCS)).collect()}
    assert [got[i].lang_pred for i in range(3)] == ["und"] * 3 and got[4].lang_pred in ("aa", "bb")
    assert got[3].lang_pred == "aa" and got[6].lang_pred == "bb"
    nothing = langid.identify(spark.createDataFrame([(0, "abc", None)], DOCS)).first()
    assert (nothing.lang_pred, nothing.score) == ("und", 0.0)
    assert langid.identify(spark.createDataFrame([], DOCS)).count() == 0


def test_language_sample_is_bounded(spark):
    rows = [(i, "word " * 20, "aa" if i % 3 else "bb") for i in range(600)]
    got = langid.sample(spark.createDataFrame(rows, DOCS), limit=2000).groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    assert {r.lang for r in got} == {"aa", "bb"} and all(1000 <= r.n <= 2000 for r in got)


def test_long_documents_neither_bar_nor_lose_a_language(spark):
    limit = 4000
    rows = [(i, f"only long texts {i} " * 1200, "aa") for i in range(20)]
    rows += [(100 + i, f"word {i} " * 10, "bb") for i in range(200)] + [(400 + i, f"huge é {i} " * 20000, "bb") for i in range(3)]
    rows += [(500, "alone " * 5000, "cc"), (501, "é", "dd"), (502, "", "ee")]
    got = langid.sample(spark.createDataFrame(rows, DOCS), limit).groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    got = {r.lang: r.n for r in got}
    assert set(got) == {"aa", "bb", "cc", "dd"} and got["dd"] == 2
    assert all(0.8 * limit <= got[x] <= limit for x in ("aa", "bb", "cc"))


# --- secrets --------------------------------------------------------------------------------------------------------

def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in secrets.ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in secrets.ACCESS.finditer(text) if len(m[0]) >= 16]
    return sorted(found + [(m.start(), 2, m.end()) for m in secrets.HEX.finditer(text) if len(m[0]) >= 32])


SECRET = 'password = "hunter2hunter2"'
TEXTS = [None, "", "é" + SECRET, "token:abc token==abcdefgh1 SECRET='x' Api_Key=12345678", "AKIAAKIA AKIA" + "A" * 11 + " AKIA" + "B" * 12 + "c", "0" * 31 + " " + "f" * 32 + "g" + "a1" * 40,
         "ſecret=abcdefghi toKen=abcdefghi", "secret=token=a secret=token=abcdefgh", "no secrets", "100%% sure \\ and %zz"]


def test_base_spans_equal_the_patterns():
    counts, base, every = secrets.scan_column(pa.array(TEXTS, pa.string()))
    for i, t in enumerate(TEXTS):
        want = plain_spans(t or "")
        assert base[i] == secrets.joined(want)
        assert counts[i].tolist() == [sum(k == n for _, k, _ in want) for n in range(3)]
        assert set(filter(None, base[i].split(","))) <= set(every[i].split(","))


def b64(raw):
    return base64.b64encode(raw).decode()


@pytest.mark.parametrize("wrap", [
    lambda s: "".join(f"%{b:02X}" for b in s.encode()),
    lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    lambda s: "".join(f"\\x{ord(c):02x}" for c in s),
    lambda s: b64(s.encode()),
    lambda s: b64(gzip.compress(s.encode())),
    lambda s: b64(zlib.compress(s.encode())),
    lambda s: b64(b64(s.encode()).encode()),
    lambda s: b64(gzip.compress(b64(zlib.compress("".join(f"%{b:02x}" for b in s.encode()).encode())).encode())),
    lambda s: "".join(f"%{b:02X}" for b in b64(s.encode()).encode()),
])
def test_layers_are_unwrapped_and_mapped(wrap):
    hidden = wrap(SECRET)
    text = f"ünï line\nsee {hidden} here"
    base, every = secrets.all_spans(text)
    assert not base
    assign = [(a, b) for a, k, b in every if k == 0]
    lo = text.index(hidden)
    assert assign and all(lo <= a < b <= lo + len(hidden) for a, b in assign)


def test_span_of_a_partly_escaped_secret_is_exact():
    text = "x pass%77ord%3Dhunter2hunter2 y"
    assert secrets.joined(secrets.all_spans(text)[1]) == f"assign:2:{text.index(' y')}"
    coded = b64(b"xyz" + SECRET.encode() + b"xyz")
    (a, _, b), = secrets.all_spans(coded)[1]
    assert a == 4 and b64(b"xyz" + SECRET.encode()).rstrip("=")[:b - 1] == coded[:b - 1]


def hidden(text):
    return [s for s in secrets.all_spans(text)[1] if s[1] == 0]


def test_compressed_layers_are_read_to_their_end(monkeypatch):
    late = b64(gzip.compress(("é" * 11 + "\n") .encode() * (1 << 20) + SECRET.encode()))
    assert hidden(late) == [(0, 0, len(late))]
    members = b64(gzip.compress(b"first\n") + gzip.compress(b"second\n") + b"\0" * 5 + gzip.compress(SECRET.encode()))
    assert hidden(members) == [(0, 0, len(members))]
    nested = b64(gzip.compress(zlib.compress(gzip.compress(SECRET.encode()))))
    assert hidden(nested) == [(0, 0, len(nested))]
    monkeypatch.setattr(secrets, "CHUNK", 500)
    lines = "\n".join(["some plain words"] * 100 + [base64.encodebytes(b"x y z " * 200 + SECRET.encode()).decode()] + ["some plain words"] * 100)
    assert hidden(b64(zlib.compress(lines.encode())))


def test_a_stream_that_inflates_to_itself_ends(monkeypatch):
    quine = b"\x1f\x8b\x08 and so on"
    monkeypatch.setattr(secrets, "_inflated", lambda blocks: iter([b"".join(blocks)]))
    assert hidden(b64(quine)) == []


@pytest.mark.parametrize("wrap", [
    lambda s: base64.encodebytes(b"x y " * 30 + s).decode(),
    lambda s: base64.encodebytes(b"x y " * 30 + s).decode().replace("\n", "\\n"),
    lambda s: base64.encodebytes(gzip.compress(bytes(np.random.default_rng(1).integers(32, 127, 300, np.uint8)) + b"\n" + s)).decode().replace("\n", "\r\n  "),
    lambda s: "-----BEGIN CERTIFICATE-----\n" + base64.encodebytes(b"x y " * 30 + s).decode(),
    lambda s: "https://x/ab/" + b64(s), lambda s: "https://x/abc/" + b64(gzip.compress(s)), lambda s: "id-" + b64(s), lambda s: "some_id_" + b64(zlib.compress(s)),
    lambda s: "".join(f"%{b:02X}" for b in gzip.compress(s)), lambda s: urllib.parse.quote(zlib.compress(s)), lambda s: urllib.parse.quote_plus(gzip.compress(s), safe=""),
    lambda s: "".join(f"\\x{b:02x}" for b in gzip.compress(s)), lambda s: repr(zlib.compress(s)), lambda s: "".join(f"\\u{b:04x}" for b in gzip.compress(s)),
])
def test_layers_over_lines_at_any_alignment_and_under_escapes(wrap):
    coded = wrap(SECRET.encode())
    spans = hidden(f"see\n{coded}\nhere")
    assert spans and all(4 <= a < b <= 4 + len(coded) for a, _, b in spans)


@pytest.mark.parametrize("wrap", [
    lambda s: gzip.compress(s).decode("latin-1"), lambda s: zlib.compress(s).decode("latin-1"), lambda s: zlib.compress(s, 1).decode("latin-1"), lambda s: zlib.compress(s, 3).decode("latin-1"),
    lambda s: zlib.compress(s, 9).decode("latin-1"), lambda s: bz2.compress(s).decode("latin-1"), lambda s: lzma.compress(s).decode("latin-1"), lambda s: b64(bz2.compress(s)), lambda s: b64(lzma.compress(s)),
    lambda s: b64(s.decode().encode("utf-16")), lambda s: b64(s.decode().encode("utf-16-le")), lambda s: b64(s.decode().encode("utf-16-be")), lambda s: b64(gzip.compress(lzma.compress(bz2.compress(s)))),
    lambda s: "".join(f"%{b:02X}" for b in bz2.compress(s)), lambda s: "".join(f"\\x{b:02x}" for b in lzma.compress(s)), lambda s: repr(bz2.compress(s)), lambda s: urllib.parse.quote(zlib.compress(s, 3)),
])
def test_every_kind_of_stream_is_found_by_the_column_scan(wrap):
    """Also where nothing else in the text makes it a suspect; random tails make streams that look different."""
    r = np.random.default_rng(5)
    texts = [f"note {wrap(SECRET.encode() + bytes(r.integers(97, 123, r.integers(0, 40), np.uint8)))}" for _ in range(40)]
    _, _, every = secrets.scan_column(pa.array(texts, pa.string()))
    for text, found in zip(texts, every, strict=True):
        assert "assign:" in found and found == secrets.joined(secrets.all_spans(text)[1])


def test_the_column_scan_passes_over_nothing():
    r = np.random.default_rng(9)
    parts = ["x^2", "%41", "\\x41", "x\x01", "x\xda", "\x1f\x8b\x08", SECRET, b64(SECRET.encode()), "é", " ", "a" * 40, "0f" * 20, "\n", zlib.compress(SECRET.encode()).decode("latin-1"), "'", '"']
    texts = ["".join(parts[i] for i in r.integers(0, len(parts), r.integers(0, 8))) for _ in range(800)]
    _, _, every = secrets.scan_column(pa.array(texts, pa.string()))
    assert every == [secrets.joined(secrets.all_spans(t)[1]) for t in texts]


@pytest.mark.parametrize("unit", ["\\alpha x^2 + ", "x^", "%41 x^", "%78%01", "\\x78\\x01", "x\x01", "\x1f\x8b\x08\x08", "%1f%8b%08%08", "x\xda", "BZh91AY&SY", "'\\x78\\x01", "%", "\\", "QUJD"])
def test_a_long_line_takes_time_in_proportion(unit):
    text = unit * ((1 << 20) // len(unit))
    began = time.process_time()
    secrets.all_spans(text)
    assert time.process_time() - began < 40


def test_layers_end():
    text = b64(b64(b64(b"harmless words without any")  .encode()).encode()) * 3 + "%25" * 400
    assert secrets.all_spans(text)[0] == []


def test_secret_query_rows(spark):
    rows = [(i, t, None) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], None)]
    got = secrets.scan_secrets(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain_spans(TEXTS[r.doc_id] or "")
        assert r.base_sha256 == brute.sha(secrets.joined(want))
    assert secrets.scan_secrets(spark.createDataFrame([], DOCS)).count() == 0


# --- licenses -------------------------------------------------------------------------------------------------------

LICENSE_TEXTS = [None, "", "Under the MIT License, under the mit license", "Apache License; Version 2.0 and CC--BY\nNC", "under the mit licenses", "éunder the mit license", "xcc by nc", "CC BY-NC 4.0 cc by nc cc by nc",
                 "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nunder the mit license", "SPDX-License-Identifier: MIT OR", "all words, no notice"]


def test_base_phrases_equal_brute_force(spark):
    docs = list(enumerate(LICENSE_TEXTS)) + [(50 + i, t) for i, t in brute.documents()]
    got = {r.doc_id: r for r in licenses.scan_licenses(with_lang(spark, docs)).collect()}
    for i, t in docs:
        words = brute.ALNUM.findall((t or "").translate(brute.CASE))
        places, labels = [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            here = [a for a in range(len(words) - len(p) + 1) if words[a:a + len(p)] == p]
            places += here
            labels |= {label} if here else set()
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert got[8].labels == "apache-2,gpl-2,mit" and got[8].score == 1.0 and got[8].license_class == 2
    assert got[9].score == 0.5


@pytest.mark.parametrize(("text", "postfix", "level"), [
    ("MIT", ["mit"], 1), ("MIT OR GPL-3.0-only AND CC0-1.0", ["mit", "gpl-3.0-only", "cc0-1.0", "and", "or"], 1), ("(MIT OR GPL-3.0-only) AND MPL-2.0", ["mit", "gpl-3.0-only", "or", "mpl-2.0", "and"], 2),
    ("GPL-2.0-only WITH x", ["gpl-2.0-only", "x", "with"], 2), ("MIT AND", None, None), ("(MIT", None, None), ("MIT)", None, None), ("MIT MIT", None, None), ("", None, None), ("OR MIT", None, None), ("()", None, None)])
def test_license_expressions(text, postfix, level):
    assert licenses.parse(text) == postfix
    if postfix:
        assert licenses.value(postfix)[0] == level


@pytest.mark.parametrize(("line", "labels", "level", "score"), [
    ("MIT, see LICENSE", "mit", 1, 1.0), ("MIT Copyright 2021 X", "mit", 1, 1.0), ("MIT.", "mit", 1, 1.0), ("Apache-2.0: x", "apache-2", 1, 1.0), ("MIT */ function f(a) { return (a) }", "mit", 1, 1.0),
    ("(MIT OR GPL-3.0-only) (c) 2020", "gpl-3,mit", 1, 1.0), ("MIT) and more", "mit", 1, 1.0), ("GPL-2.0-only WITH x-1.0 AND MIT. All (rest", "gpl-2,mit", 2, 1.0),
    ("MIT OR", "mit", 1, 0.5), ("(MIT", "", None, 0.5), ("OR MIT", "", None, 0.5), ("-->", "", None, 0.5), ("MIT--> x", "mit", 1, 1.0)])
def test_identifier_tag_reads_the_longest_expression(line, labels, level, score):
    got = licenses.scan_text(f"x\n// SPDX-License-Identifier: {line}\nGPL-2.0")
    assert (got["labels"], got["license_class"], got["score"]) == (labels, level, score)


# --- tokens ---------------------------------------------------------------------------------------------------------

def token_texts():
    texts = [t for _, t in brute.documents()] + ["Don't they'll I'VE 'tis", "A.B. c,d ... x., y.,", "<|endoftext|> a <|startoftext|>b", "<|ENDOFTEXT|>", "İstanbul ΣΑΣ ς́ é ́x", "a b c\u0085d", "x" * 5000, "12 3.4 5,6. %% a. 1."]
    return texts


def whole_ids(texts, end):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(BPE)
    return [[*tok.encode(t or "", add_special_tokens=False).ids, end] for t in texts]


def test_ids_equal_the_tokenizer(monkeypatch):
    monkeypatch.setattr(tokenize, "MEMO_ATOMS", 50)
    monkeypatch.setattr(tokenize, "PIECE_BYTES", 2000)
    texts = token_texts()
    ids, bound = tokenize.Encoder(BPE).encode(pa.array(texts, pa.string()), 1)
    assert [ids[a:b].tolist() for a, b in zip(bound[:-1], bound[1:], strict=True)] == whole_ids(texts, 1)
    ids, bound = tokenize.Encoder(BPE).encode(pa.array([], pa.string()), 1)
    assert len(ids) == 0 and bound.tolist() == [0]


def test_token_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(tokenfile, "RANGE_BYTES", 4000)
    texts = token_texts()
    docs = [(3 * i - 40, t) for i, t in enumerate(texts)] + [(None, "null id"), (5, "again"), (5, "and again")]
    docs = [d for d in docs if d[0] != 5] + [d for d in docs if d[0] == 5]
    manifest = tokenfile.write_documents(with_lang(spark, docs).repartition(4), BPE)
    files = manifest.orderBy("bucket", "part").collect()
    assert len(files) > 3 and sum(f.n_docs for f in files) == len(docs)
    got = sorted(tokenfile.read_documents(manifest).collect(), key=lambda r: r.start)
    ids = {}
    for (i, _), x in zip(docs, whole_ids([t for _, t in docs], 1), strict=True):
        ids.setdefault(i, []).append(x)
    at = 0
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    assert [r.doc_id for r in got] == [d[0] for d in order]
    for r in got:
        x = next(x for x in ids[r.doc_id] if brute.crc(x) == r.ids_crc32)
        assert (r.start, r.n_tokens) == (at, len(x))
        at += len(x)
    file = next(f for f in files if f.path and tokenfile.Reader(f.path).doc_ids[0] <= 11 <= tokenfile.Reader(f.path).doc_ids[-1])
    assert [x.tolist() for x in tokenfile.Reader(file.path).document(11)] == ids[11]
    empty = tokenfile.write_documents(with_lang(spark, []), BPE)
    assert tokenfile.read_documents(empty).count() == 0


def test_token_file_refuses_damage(spark, tmp_path):
    import zstandard
    w = tokenfile.Writer(f"file://{tmp_path}", "a.zst")
    data = np.arange(1000, dtype="<u4").tobytes()
    w.add(7, zstandard.compress(data), 1000, tokenfile.xxhash.xxh64_intdigest(data) & 0xFFFFFFFF)
    w.close()
    path = tmp_path / "a.zst"
    assert tokenfile.Reader(f"file://{path}").document(7)[0].tolist() == list(range(1000))
    assert zstandard.ZstdDecompressor().stream_reader(path.read_bytes(), read_across_frames=True).read() == data
    raw = bytearray(path.read_bytes())
    raw[40] ^= 255
    path.write_bytes(bytes(raw))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        tokenfile.Reader(f"file://{path}").document(7)


# --- packing --------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("lengths", [[], [1], [4096], [4097], [3, 5], [1] * 5000, [9000, 1, 2, 3, 300, 299, 4095, 2049], list(np.random.default_rng(5).geometric(0.002, 3000))])
def test_packing_is_gapless_and_whole(lengths):
    lengths = [int(x) for x in lengths]
    rows = packing.pack(lengths)
    sizes = [sum(n for _, _, n in r) for r in rows]
    assert all(s <= 4096 and s & (s - 1) == 0 for s in sizes) and sum(sizes) == sum(lengths)
    pieces = sorted((d, s, n) for r in rows for d, s, n in r)
    at = {}
    for d, s, n in pieces:
        assert n > 0 and s == at.get(d, 0)
        at[d] = s + n
    assert at == {d: n for d, n in enumerate(lengths) if n}


def test_packed_documents(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_TOKENS", 9000)
    texts = token_texts()
    docs = list(enumerate(texts)) + [(None, "null"), (4, texts[4])]
    rows = packing.pack_documents(with_lang(spark, docs).repartition(3), BPE).collect()
    ids = {i: x for (i, _), x in zip(docs, whole_ids([t for _, t in docs], 2), strict=True)}
    copies = {i: sum(d == i for d, _ in docs) for i in ids}
    seen, sequences = {}, {}
    for r in rows:
        x = ids[r.doc_id]
        assert r.doc_tokens == len(x) and brute.crc(x[r.start:r.start + r.length]) == r.ids_crc32
        seen.setdefault(r.doc_id, []).extend(range(r.start, r.start + r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert {i: sorted(v) for i, v in seen.items()} == {i: sorted(list(range(len(x))) * copies[i]) for i, x in ids.items()}
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096
    assert packing.pack_documents(with_lang(spark, []), BPE).count() == 0


def test_steps_are_full_and_balanced_over_all_groups(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(packing, "GROUP_TOKENS", 9000)
    rng = np.random.default_rng(8)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "of"], int(n)))) for i, n in enumerate(rng.geometric(0.002, 400))]
    rows = packing.pack_documents(with_lang(spark, docs).repartition(7), BPE, step_tokens=1 << 14).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    assert all(len({(r.window, r.step_id) for r in q}) == 1 and sum(r.length for r in q) == q[0].window for q in sequences.values())
    steps = {}
    for q in sequences.values():
        steps.setdefault(q[0].step_id, []).append((q[0].window, sum(r.length ** 2 for r in q)))
    assert sorted(steps) == list(range(len(steps)))
    windows = [q[0].window for q in sequences.values()]
    for window in set(windows):
        mine = [s for s in steps.values() if s[0][0] == window]
        assert all(len({w for w, _ in s}) == 1 for s in mine)
        assert len(mine) == -(-windows.count(window) * window // (1 << 14))  # no more steps than the tokens need
        tokens, work = [window * len(s) for s in mine], [sum(x for _, x in s) for s in mine]
        assert max(tokens) - min(tokens) <= window and max(tokens) <= 1 << 14
        assert max(work) - min(work) <= max(x for s in mine for _, x in s) + window * window


def test_files_are_read_by_as_many_tasks_and_one_id_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(tokenfile, "RANGE_BYTES", 1000)
    rows = [(None, f"same id {i}") for i in range(400)] + [(7, f"again {i % 50}") for i in range(300)] + [(i, f"text number {i}") for i in range(100, 400)]
    manifest = tokenfile.write_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), BPE, end=1)
    files = manifest.count()
    assert files > 5
    out = tokenfile.read_documents(manifest).withColumn("task", F.spark_partition_id())
    got = sorted(out.collect(), key=lambda r: r.start)
    assert len({r.task for r in got}) == files
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(-1 if i is None else i for i, _ in rows)
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])])[:-1].tolist()
    buckets = {(r.doc_id or -1): set() for r in got}
    for r in got:
        buckets[r.doc_id or -1].add(r.task)
    assert len(buckets[-1]) > 1 and len(buckets[7]) > 1
    coder = tokenize.encoder(BPE)
    want = sorted(brute.crc(coder.encode(pa.array([t]), 1)[0]) for _, t in rows)
    assert sorted(r.ids_crc32 for r in got) == want


def test_buckets_ascend_with_id_and_tie():
    r = np.random.default_rng(3)
    bounds = np.sort(r.integers(0, 9, 12))
    ids, tie = r.integers(-2, 11, 3000), r.integers(0, 1 << 62, 3000) * 2
    order = np.lexsort((tie, ids))
    buckets = tokenfile._buckets(bounds, ids, tie)[order]
    assert (np.diff(buckets) >= 0).all() and buckets.min() >= 0 and buckets.max() <= len(bounds)


@pytest.mark.parametrize(("after", "labels", "score", "kind"), [
    ("see the file", "", 0.5, None), ("TODO fill in", "", 0.5, None), ("MIT", "mit", 1.0, 1), ("LicenseRef-Acme-1", "licenseref-acme-1", 1.0, 4), ("EUPL-1.2", "eupl-1.2", 1.0, 4),
    ("MIT OR none", "mit", 0.5, 1), ("none AND MIT", "mit", 0.5, 4), ("GPL-2.0-only WITH some-exception", "gpl-2", 1.0, 2), ("a-word-without-number", "", 0.5, None), ("AGPL-3.0+", "agpl-3.0+", 1.0, 4),
])
def test_words_behind_a_tag_are_no_labels(after, labels, score, kind):
    got = licenses.scan_text(f"// SPDX-License-Identifier: {after}\n")
    assert (got["labels"], got["score"], got["license_class"]) == (labels, score, kind)

"""Secret scans with a recursive decoding worklist (operator 5).

The base patterns run over every text. Encoded layers are unwrapped and scanned in turn: URL escapes and Unicode
escapes (the line that holds them, decoded), base64 tokens (over line breaks too; where one doesn't decode whole, what is
readable or compressed at any of its four alignments; UTF-16 text too), and what is compressed inside them, under escapes
or as code points (gzip, zlib, bzip2, xz).
Every layer keeps, for each of its code points, the span of the original text it came from, so what is found in a layer
is reported where it stands in the document. Layers go on a worklist until no new one appears; a text or compressed
stream that has been seen at the same place is not opened again, so cycles end.

Texts that can hold neither a base match nor an encoded layer are passed over after one look at their bytes: every
pattern needs a key word, ``AKIA``, a long enough run of its characters, an escape, or the first bytes of a compressed
stream as code points.

A run of escapes is decoded once, and the beginnings of streams are looked for in its bytes; a beginning is tried on its
first bytes before the rest is touched, so a line's time is in proportion to its length.

A compressed stream is read to its end, all its members, in chunks of ``CHUNK`` bytes, so a decompression bomb takes time
but no memory. Chunks are cut between lines that are no base64; where there is no such place in ``CARRY`` characters,
neighbours share ``OVERLAP`` characters, and an encoded layer longer than that may be cut there.

Defined cases: null or empty text has no spans; repeated rows are scanned one by one; an empty table gives an empty
result.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .storage import bounded_batches

KINDS = ("assign", "access", "hex")
# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32

URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\u\{([0-9A-Fa-f]{1,6})\}")
MIN_BASE64 = 16
# line breaks, real or written as escapes, join full lines of base64 with a last one of any length
BREAK = re.compile(r"[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{%d,}+(?:%s[A-Za-z0-9+/_-]{%d,}+)*+(?:%s[A-Za-z0-9+/_-]+(?=[=\s\"'\\<,;)\]}]|$))?={0,2}" % (MIN_BASE64, BREAK.pattern, MIN_BASE64, BREAK.pattern))
#: Readable stretches of bytes that can hold a match or a layer.
READABLE = re.compile(rb"(?:[\t\r\n\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}){12,}")
# how compressed streams begin: as bytes, and as code points in UTF-8
HEAD = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\0")
POINT_HEAD = re.compile(rb"\x1f\xc2\x8b\x08|x(?:\x01|\x5e|\xc2\x9c|\xc3\x9a)|BZh[1-9]1AY&SY|\xc3\xbd7zXZ\0")
# runs that stand for bytes, and one byte's characters in them: code points, URL escapes, string escapes
POINTS = re.compile("[\x00-\xff]+"), re.compile("[\x00-\xff]")
URL_RUN = re.compile(r"(?:%[0-9a-f]{2}|[a-z0-9_.~!*'()$+,;:@/^-])+", re.IGNORECASE | re.ASCII), re.compile(r"%[0-9A-Fa-f]{2}|[^%]")
STRING_RUN = re.compile(r"""(?:\\x[0-9A-Fa-f]{2}|\\[abfnrtv0'"\\]|[\x20-\x5b\x5d-\x7e])+"""), re.compile(r"\\x[0-9A-Fa-f]{2}|\\.|[^\\]")
BLOCK = 64 << 10
CHUNK = 4 << 20
CARRY = 32 << 20
OVERLAP = 1 << 20
#: An xz stream that asks for a larger dictionary counts as faulty.
XZ_MEMORY = 128 << 20

_HEX_BYTE = T._class(lambda b: chr(b) in "0123456789abcdef")
_B64_BYTE = T._class(lambda b: b < 0x80 and (chr(b).isalnum() or chr(b) in "+/_-"))

Span = tuple[int, int, int]  # start, index of kind, end


def base_spans(text: str) -> list[Span]:
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    # a run of 32 or more is the whole of a maximal run, which is what the base pattern matches
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


class Layer:
    """A text and, for each code point, the original span it stands for."""

    __slots__ = ("end", "start", "text")

    def __init__(self, text: str, start: np.ndarray, end: np.ndarray) -> None:
        self.text, self.start, self.end = text, start, end


def _joined(parent: Layer, parts: list[tuple[str, int, int, bool]]) -> Layer:
    """A layer from pieces (text, from, to, plain) of the parent: plain ones keep their places, others share theirs."""
    starts, ends = [], []
    for text, a, b, plain in parts:
        if plain:
            starts.append(parent.start[a:b])
            ends.append(parent.end[a:b])
        else:
            starts.append(np.full(len(text), parent.start[a]))
            ends.append(np.full(len(text), parent.end[b - 1]))
    return Layer("".join(p[0] for p in parts), np.concatenate(starts), np.concatenate(ends))


def _line(text: str, at: int) -> tuple[int, int]:
    end = text.find("\n", at)
    return text.rfind("\n", 0, at) + 1, len(text) if end < 0 else end


def _lines_with(layer: Layer, pattern: re.Pattern, decode) -> Iterator[Layer]:
    """Each line that holds a match, with its matches decoded."""
    at = 0
    while m := pattern.search(layer.text, at):
        lo, hi = _line(layer.text, m.start())
        parts, done, changed = [], lo, False
        for m in pattern.finditer(layer.text, lo, hi):
            for text, a, b in decode(m):
                if text is None:
                    continue
                if a > done:
                    parts.append((layer.text[done:a], done, a, True))
                parts.append((text, a, b, False))
                done, changed = b, True
        if done < hi:
            parts.append((layer.text[done:hi], done, hi, True))
        if changed:
            yield _joined(layer, parts)
        at = hi + 1


def _url(m: re.Match) -> Iterator[tuple[str | None, int, int]]:
    raw, at = bytes.fromhex(m[0].replace("%", "")), m.start()
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        yield None, at, m.end()
        return
    for c in text:
        n = 3 * len(c.encode("utf-8"))
        yield c, at, at + n
        at += n


def _escape(m: re.Match) -> Iterator[tuple[str | None, int, int]]:
    code = int(m[1] or m[2] or m[3], 16)
    yield (chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None), m.start(), m.end()


def _readable(raw: bytes) -> str | None:
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and sum(c.isprintable() or c in "\t\r\n" for c in text) >= 0.9 * len(text) else None


class Stream:
    """Bytes that may be compressed, readable again and again, and the original span they stand for."""

    __slots__ = ("end", "make", "start")

    def __init__(self, make: Callable[[], Iterator[bytes]], start: int, end: int) -> None:
        self.make, self.start, self.end = make, start, end


def _compressed(raw: bytes) -> bool:
    return (bytes(raw[:2]) == b"\x1f\x8b" or (len(raw) > 2 and raw[0] & 15 == 8 and (raw[0] << 8 | raw[1]) % 31 == 0)
            or bytes(raw[:3]) == b"BZh" or bytes(raw[:6]) == b"\xfd7zXZ\0")


def _blocks(raw: bytes, at: int = 0) -> Iterator[bytes]:
    for lo in range(at, len(raw), BLOCK):
        yield raw[lo:lo + BLOCK]


class _Zlib:
    """A zlib or gzip member with the interface of the other decompressors."""

    def __init__(self) -> None:
        self.member, self.rest = zlib.decompressobj(47), b""

    def decompress(self, data: bytes, most: int) -> bytes:
        out = self.member.decompress(self.rest + data, most)
        self.rest = self.member.unconsumed_tail
        self.full = len(out) == most
        return out

    needs_input = property(lambda self: not self.rest and not self.full)
    eof = property(lambda self: self.member.eof)
    unused_data = property(lambda self: self.member.unused_data)


def _member(head: bytes):
    return bz2.BZ2Decompressor() if head[:3] == b"BZh" else lzma.LZMADecompressor(lzma.FORMAT_XZ, XZ_MEMORY) if head[:1] == b"\xfd" else _Zlib()


#: What the decompressors raise at a fault.
FAULTS = (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError)


def _inflated(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """What a compressed stream and the members after it hold, up to their end or a fault."""
    member, rest, first = None, b"", True
    for block in blocks:
        rest += block
        while rest:
            if member is None:
                rest = rest if first else rest.lstrip(b"\0")
                if len(rest) < 6:
                    break
                if not _compressed(rest):
                    return
                member, first = _member(rest), False
            try:
                out, rest = member.decompress(rest, CHUNK), b""
                yield out
                while not member.eof and not member.needs_input:  # all input taken, more output waits
                    yield member.decompress(b"", CHUNK)
            except FAULTS:
                return
            if member.eof:
                rest, member = member.unused_data, None


def _deflate_at(raw: bytes, at: int) -> int:
    """Where the data behind a gzip header begins; past the end where the header has none."""
    flags, at = (raw[at + 3] if at + 3 < len(raw) else 0), at + 10
    if flags & 4:
        at += 2 + int.from_bytes(raw[at:at + 2], "little")
    for flag in (8, 16):
        if flags & flag:
            end = raw.find(b"\0", at)
            at = len(raw) + 1 if end < 0 else end + 1
    return at + 2 * (flags >> 1 & 1)


class _Opener:
    """Tells where in some bytes a compressed stream begins that gives anything."""

    def __init__(self, raw: bytes) -> None:
        self.raw, self.last, self.faulty = raw, raw.rfind(b"\0"), set()

    def __call__(self, at: int) -> bool:
        raw = self.raw
        if not _compressed(raw[at:at + 6]):
            return False
        start = at
        if raw[at] == 0x1F:
            if raw[at + 3:at + 4] and raw[at + 3] & 24 and self.last < at + 10:
                return False  # its name has no end
            start = _deflate_at(raw, at)
            if start >= len(raw) or start in self.faulty:
                return False
        try:  # a fault in the first bytes is one of the whole
            if raw[at] == 0x1F:
                zlib.decompressobj(-15).decompress(raw[start:start + 256], 4096)
            else:
                _member(raw[at:at + 6]).decompress(raw[at:at + 256], 4096)
        except FAULTS:
            self.faulty.add(start)
            return False
        if any(_inflated(_blocks(raw, at))):
            return True
        self.faulty.add(start)
        return False


def _opens(raw: bytes) -> bool:
    return _Opener(raw)(0)


def _cut(text: str) -> int:
    """The end of the last line that no base64 goes on from; 0 if there is none."""
    end = text.rfind("\n")
    while end >= 0:
        lo = text.rfind("\n", 0, end) + 1
        if not BASE64.fullmatch(text[lo:end].strip()):
            return end + 1
        end = lo - 1
    return 0


def _texts(chunks: Iterator[bytes]) -> Iterator[str]:
    decode, text = codecs.getincrementaldecoder("utf-8")("replace").decode, ""
    for chunk in chunks:
        text += decode(chunk)
        if len(text) >= CHUNK and (cut := _cut(text)):
            yield text[:cut]
            text = text[cut:]
        elif len(text) >= CARRY:
            yield text
            text = text[-OVERLAP:]
    text += decode(b"", True)
    if text:
        yield text


def _unpacked(stream: Stream) -> Iterator[Layer | Stream]:
    inner = lambda: _inflated(stream.make())
    if _compressed(next(filter(None, inner()), b"")):
        yield Stream(inner, stream.start, stream.end)
    for text in _texts(inner()):
        yield Layer(text, np.broadcast_to(np.int64(stream.start), len(text)), np.broadcast_to(np.int64(stream.end), len(text)))


def _escaped_streams(layer: Layer) -> Iterator[Stream]:
    """Compressed bytes written as URL or string escapes, or as code points."""
    text = layer.text
    for (pattern, one), decode, mark in ((URL_RUN, lambda t: unquote_to_bytes(t.replace("+", " ")), "%"),
                                         (STRING_RUN, lambda t: codecs.escape_decode(t.encode())[0], "\\"), (POINTS, lambda t: t.encode("latin-1"), "")):
        if mark not in text:
            continue  # what stands in it without escapes is code points
        for m in pattern.finditer(text):
            if mark not in m[0]:
                continue
            raw, places, done = decode(m[0]), None, 0
            heads = HEAD.finditer(raw)
            opens = None
            for head in heads:
                at = head.start()
                opens = opens or _Opener(raw)
                if at < done or not opens(at):
                    continue
                if places is None:
                    places = np.arange(len(raw) + 1) if not mark else np.append(np.fromiter((x.start() for x in one.finditer(m[0])), np.int64, len(raw)), len(m[0]))
                done = len(raw)
                lo = m.start() + int(places[at])
                quote = text[lo - 1:lo] if lo else ""
                if pattern is STRING_RUN[0] and quote in ("'", '"') and quote:
                    close = re.compile(r"(?<!\\)(?:\\\\)*" + quote).search(text, lo, m.end())
                    done = int(np.searchsorted(places, close.end() - 1 - m.start())) if close else done
                yield Stream(lambda raw=raw, at=at, done=done: _blocks(raw[:done], at), int(layer.start[lo]), int(layer.end[m.start() + int(places[done]) - 1]))


def _utf16(raw: bytes) -> tuple[str, int] | None:
    """UTF-16 text and how many bytes stand before it."""
    skip = 2 if raw[:2] in (b"\xff\xfe", b"\xfe\xff") else 0
    body = raw[skip:len(raw) - len(raw) % 2]
    for kind, high in (("utf-16-le", 1), ("utf-16-be", 0)):
        if len(body) >= 16 and (raw[:2] == codecs.BOM_UTF16_LE if skip and high else raw[:2] == codecs.BOM_UTF16_BE if skip else body[high::2].count(0) >= len(body) // 4):
            try:
                text = body.decode(kind)
            except UnicodeDecodeError:
                continue
            if sum(c.isprintable() or c in "\t\r\n" for c in text) >= 0.9 * len(text):
                return text, skip
    return None


def _base64(layer: Layer) -> Iterator[Layer | Stream]:
    for m in BASE64.finditer(layer.text):
        cuts = [m.start(), *chain.from_iterable(b.span() for b in BREAK.finditer(layer.text, *m.span())), m.end()]
        parts = list(zip(cuts[::2], cuts[1::2], strict=True))
        word = "".join(layer.text[a:b] for a, b in parts).rstrip("=").replace("-", "+").replace("_", "/")
        place = np.concatenate([np.arange(a, b) for a, b in parts])

        def decoded(at: int) -> bytes:
            part = word[at:len(word) - ((len(word) - at) % 4 == 1)]
            return base64.b64decode(part + "=" * (-len(part) % 4))

        def stream(raw: bytes, at: int, lo: int) -> Stream:
            return Stream(lambda: _blocks(raw, lo), int(layer.start[place[at + lo // 3 * 4 + lo % 3]]), int(layer.end[m.end() - 1]))

        def inner(text: str, size: np.ndarray, at: int, lo: int) -> Layer:
            stop = lo + np.cumsum(size)
            first, last = at + (stop - size) // 3 * 4 + (stop - size) % 3, at + (stop - 1) // 3 * 4 + (stop - 1) % 3 + 1
            return Layer(text, layer.start[place[first]], layer.end[place[last]])

        raw = decoded(0)
        if _opens(raw):
            yield stream(raw, 0, 0)
            continue
        if (text := _readable(raw)) is not None:
            yield inner(text, _sizes(text), 0, 0)
            continue
        if (wide := _utf16(raw)) is not None:
            yield inner(wide[0], np.array([2 if c < "\U00010000" else 4 for c in wide[0]]), 0, wide[1])
            continue
        for at in range(4):
            raw = decoded(at)
            opens = _Opener(raw)
            for head in HEAD.finditer(raw):
                if opens(head.start()):
                    yield stream(raw, at, head.start())
            for run in READABLE.finditer(raw):
                try:
                    text = run[0].decode("utf-8")
                    yield inner(text, _sizes(text), at, run.start())
                except UnicodeDecodeError:  # forms that UTF-8 forbids: byte by byte
                    yield inner(run[0].decode("latin-1"), np.ones(len(run[0]), np.int64), at, run.start())


def _sizes(text: str) -> np.ndarray:
    return np.ones(len(text), np.int64) if text.isascii() else np.array([len(c.encode("utf-8")) for c in text])


def _inside(found: Layer | Stream) -> Iterator[Layer | Stream]:
    if isinstance(found, Stream):
        return _unpacked(found)
    return chain(_lines_with(found, URL, _url), _lines_with(found, ESCAPE, _escape), _base64(found), _escaped_streams(found))


def _key(found: Layer | Stream) -> tuple:
    if isinstance(found, Layer):
        return xxhash.xxh3_128_digest(found.text), int(found.start[0]), int(found.end[-1])
    digest = xxhash.xxh3_128()
    for chunk in found.make():
        digest.update(chunk)
    return "stream", digest.digest(), found.start, found.end


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans, and with them those of every layer, mapped to the text."""
    base = base_spans(text)
    found, place = set(base), np.arange(len(text))
    whole = Layer(text, place, place + 1)
    work, seen = [_inside(whole)], {(xxhash.xxh3_128_digest(text), 0, len(text))}
    while work:
        inner = next(work[-1], None)
        if inner is None:
            work.pop()
        elif (key := _key(inner)) not in seen:
            seen.add(key)
            if isinstance(inner, Layer):
                found.update((int(inner.start[a]), k, int(inner.end[b - 1])) for a, k, b in base_spans(inner.text))
            work.append(_inside(inner))
    return base, sorted(found)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _suspects(piece: T.Piece) -> np.ndarray:
    """Rows that may hold a base match or a layer."""
    out = np.zeros(len(piece.off) - 1, bool)
    for table, least in ((_HEX_BYTE, MIN_HEX), (_B64_BYTE, MIN_BASE64)):
        spans = T.runs(table[piece.data], piece.off)
        out |= T.sums(spans.end - spans.start >= least, spans.bound) > 0
    for i in np.flatnonzero(~out):
        raw = piece.data[piece.off[i]:piece.off[i + 1]].tobytes()
        low = raw.lower()
        out[i] = any(k in low for k in KEYWORDS) or b"AKIA" in raw or b"\\" in raw or POINT_HEAD.search(raw) is not None or (b"%" in raw and re.search(rb"%[0-9A-Fa-f]{2}", raw) is not None)
    return out


def scan_column(column: pa.Array) -> tuple[np.ndarray, list[str], list[str]]:
    """Counts of base spans by kind, the base spans and all spans, joined, of each row."""
    counts, base_out, all_out = np.zeros((len(column), len(KINDS)), np.int64), [""] * len(column), [""] * len(column)
    for piece in T.pieces(column):
        for i in np.flatnonzero(_suspects(piece)):
            base, every = all_spans(piece.data[piece.off[i]:piece.off[i + 1]].tobytes().decode("utf-8"))
            if every:
                row = piece.lo + i
                counts[row] = np.bincount([k for _, k, _ in base], minlength=len(KINDS))
                base_out[row], all_out[row] = joined(base), joined(every)
    return counts, base_out, all_out


_SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, base, every = scan_column(batch.column("text"))
        digest = [hashlib.sha256(b.encode()).hexdigest() for b in base]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(counts[:, k]) for k in range(len(KINDS))], pa.array(digest, pa.string()), pa.array(every, pa.string())],
                                         ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), a row for each row of ``docs``."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_scan, _SCHEMA)

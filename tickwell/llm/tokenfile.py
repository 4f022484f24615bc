"""Token ids in seekable Zstandard files (operator 6).

A file holds one independent frame for each document (its ids as little-endian unsigned 32-bit integers, with the
frame's own checksum), then a skippable frame with the doc_ids, then the seek table of Zstandard's seekable format: a
skippable frame with each frame's compressed size, size and checksum, and a footer. A reader takes the footer, the
table, and the frames of the documents it wants.

Documents are encoded where they are read and move as finished frames. They are dealt by ranges of doc_id whose bounds
come from a quantile sketch, sorted, and streamed into files of a bounded size; each attempt of a task writes files of
its own name, and only those that the written manifest names count.

Defined cases: null or empty text is the end id alone; rows that share a doc_id are written one after another, by a hash
of their ids; a null doc_id comes first and reads back as null; an empty table writes no file.

Files are written through pyarrow's filesystems, by the URI in spark.checkpoint.dir (file, hdfs, s3, gs).
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokenize
from .storage import Scratch

END = 1
#: Text of a range of ids, which one task sorts and writes; and compressed ids after which it starts another file.
RANGE_BYTES = 32 << 20
FILE_BYTES = 1 << 28
NULL_ID = -(1 << 63)

_SKIPPABLE, _SEEK_TABLE, _FOOT = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_CHECKSUMS = 0x80


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


class Writer:
    """Streams frames into one file; holds a table entry and a doc_id for each."""

    def __init__(self, folder: str, name: str) -> None:
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        self.path, self.bytes, self.tokens = f"{folder}/{name}", 0, 0
        self.out = system.open_output_stream(f"{path}/{name}", compression=None)
        self.entries, self.ids = [], []

    def add(self, doc_id: int, frame: bytes, n_tokens: int, check: int) -> None:
        self.out.write(frame)
        self.entries.append((len(frame), 4 * n_tokens, check))
        self.ids.append(doc_id)
        self.bytes += len(frame)
        self.tokens += n_tokens

    def close(self) -> dict:
        index = _skippable(_SKIPPABLE, zstandard.compress(np.array(self.ids, "<i8").tobytes()))
        self.entries.append((len(index), 0, 0))
        table = np.array(self.entries, "<u4").tobytes() + struct.pack("<IBI", len(self.entries), _CHECKSUMS, _FOOT)
        self.out.write(index + _skippable(_SEEK_TABLE, table))
        self.out.close()
        return {"path": self.path, "n_docs": len(self.ids), "n_tokens": self.tokens}


class Reader:
    def __init__(self, uri: str) -> None:
        system, path = fs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        count, flags, foot = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if foot != _FOOT or not flags & _CHECKSUMS:
            raise ValueError(f"no seek table in {uri}")
        self.entries = np.frombuffer(self.file.read_at(12 * count, size - 9 - 12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.entries[:, 0])])
        self.n_tokens = self.entries[:-1, 1] // 4
        index = self.file.read_at(int(self.entries[-1, 0]), int(self.offset[-2]))
        self.doc_ids = np.frombuffer(zstandard.decompress(index[8:]), "<i8")
        self._unpack = zstandard.ZstdDecompressor()

    def frame(self, i: int, raw: bytes | None = None) -> np.ndarray:
        """Ids of the i-th document; ``raw``: its frame, if it has been read."""
        size, length, check = self.entries[i].tolist()
        raw = self.file.read_at(size, int(self.offset[i])) if raw is None else raw
        data = self._unpack.decompress(raw, max_output_size=length)
        if len(data) != length or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {i} doesn't match its checksum")
        return np.frombuffer(data, "<u4")

    def document(self, doc_id: int) -> list[np.ndarray]:
        """The ids of each document of this id; no other frame is read."""
        lo, hi = np.searchsorted(self.doc_ids, [doc_id, doc_id + 1])
        return [self.frame(i) for i in range(lo, hi)]

    def all(self, block: int = 1 << 22) -> Iterator[tuple[int, np.ndarray]]:
        i, n = 0, len(self.doc_ids)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.offset, self.offset[i] + block, "right")) - 1)
            j = min(j, n)
            raw = self.file.read_at(int(self.offset[j] - self.offset[i]), int(self.offset[i]))
            for k in range(i, j):
                lo = int(self.offset[k] - self.offset[i])
                yield int(self.doc_ids[k]), self.frame(k, raw[lo:lo + int(self.entries[k, 0])])
            i = j


_FRAMES = "bucket bigint, id bigint, tie bigint, n_tokens bigint, check bigint, frame binary"
_MANIFEST = "bucket bigint, part bigint, path string, n_docs bigint, n_tokens bigint"


def _buckets(bounds: np.ndarray, ids: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """The range of each id. A bound that occurs several times is an id with as many ranges of rows; they are dealt to
    these by their tie (0 to 2**63), so that (id, tie) still ascends with the range."""
    low, high = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
    share = np.minimum((tie / 2.0 ** 63 * (high - low)).astype(np.int64), np.maximum(high - low - 1, 0))
    return np.where(high > low, low + 1 + share, high)


def _frames(batches: Iterator[pa.RecordBatch], path: str, bounds: np.ndarray, end: int) -> Iterator[pa.RecordBatch]:
    coder, pack = tokenize.encoder(path), zstandard.ZstdCompressor(level=3, write_checksum=True)
    for batch in batches:
        lo = 0
        size = np.concatenate([[0], np.cumsum(batch.column("bytes").to_numpy())])
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(size, size[lo] + (8 << 20), "right")) - 1)
            ids, bound = coder.encode(batch.column("text").slice(lo, hi - lo), end)
            raw = memoryview(ids.astype("<u4", copy=False).tobytes())
            each = [raw[4 * a:4 * b] for a, b in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True)]
            digest = [xxhash.xxh64_intdigest(x) for x in each]
            doc = batch.column("id").slice(lo, hi - lo)
            tie = np.array([d >> 1 for d in digest], np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(_buckets(bounds, doc.to_numpy(), tie)), doc, pa.array(tie), pa.array(np.diff(bound)),
                pa.array([d & 0xFFFFFFFF for d in digest], pa.int64()), pa.array([pack.compress(x) for x in each], pa.binary())],
                ["bucket", "id", "tie", "n_tokens", "check", "frame"])
            lo = hi


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, id, tie) into files; a manifest row for each."""
    names = ["bucket", "part", "path", "n_docs", "n_tokens"]
    row = lambda bucket, part, made: pa.RecordBatch.from_pylist([{"bucket": bucket, "part": part} | made]).select(names)
    now, part, file = None, 0, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("bucket", "id", "n_tokens", "check", "frame")]
        for bucket, doc, n, check, frame in zip(*columns, strict=True):
            if file is not None and (bucket != now or file.bytes >= FILE_BYTES):
                yield row(now, part, file.close())
                file, part = None, part + 1
            if file is None:
                part = part if bucket == now else 0
                now, file = bucket, Writer(folder, f"ids-{bucket:05d}-{part:05d}-{uuid.uuid4().hex}.zst")
            file.add(doc, frame, n, check)
    if file is not None:
        yield row(now, part, file.close())


def write_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = END, store: Scratch | None = None) -> DataFrame:
    """Writes the files and returns their manifest in document order: bucket, part, path, n_docs, n_tokens, first (ids before)."""
    store = store or Scratch(docs.sparkSession, "tokenfile")
    narrow = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NULL_ID)).alias("id"), F.col(text).alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("bytes"))
    total = narrow.agg(F.sum("bytes")).first()[0] or 0
    ranges = max(1, -(-total // RANGE_BYTES))
    cuts = narrow.agg(F.percentile_approx("id", [i / ranges for i in range(1, ranges)], 4 * ranges)).first()[0] if ranges > 1 else []
    bounds = np.array(sorted(cuts), np.int64)
    frames = narrow.mapInArrow(lambda it: _frames(it, tokenizer, bounds, end), _FRAMES)
    dealt = frames.repartitionById(len(bounds) + 1, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "id", "tie")
    folder = f"{store.folder}/files"
    manifest = store.save(dealt.mapInArrow(lambda it: _write(it, folder), _MANIFEST), "manifest")
    before = Window.orderBy("bucket", "part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("bigint")))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist(), strict=True):
            rows, at = [], first
            for doc, ids in Reader(path).all():
                rows.append((doc, at, len(ids), zlib.crc32(ids)))
                at += len(ids)
            table = np.array(rows, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(table[:, i], mask=(table[:, 0] == NULL_ID) if i == 0 else None) for i in range(4)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone, a task for each (a stated number of
    partitions is not merged at runtime)."""
    files = manifest.select("path", "first")
    return files.repartition(max(1, manifest.count())).mapInArrow(_read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")

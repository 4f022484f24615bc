"""Line de-duplication over a sharded minimal perfect hash (operator 2).

A line's key is the line with ASCII white space stripped at both ends and A-Z lower-cased. Keys of at least
``min_chars`` code points found in at least ``min_docs`` documents lose all their lines except in the largest doc_id
that holds them.

1. Each document's distinct keys become 128-bit hashes, shuffled as (hash, doc_id) only, and are counted.
2. The distinct hashes are dealt into shards of a bounded number of keys. A shard is one row of flat arrays: a minimal
   perfect hash (levels of bits, about three bits a key), and by its slots a fingerprint, a document count and the
   largest doc_id.
3. The documents' hashes go by shard past those arrays, streamed: a task holds one shard's arrays and no probe but the
   batch at hand. A shard whose keys occur often (one line in a third of all documents) is repeated for as many tasks as
   its number of probes asks for, known from the counts.
4. What a document loses comes back as a list of hashes, bounded by its lines, and its text is cut once.

Every key is in the index, so a probe never hits a foreign slot; the fingerprint only guards against a broken shard.

Defined cases: null or empty text is one empty line; rows that share a doc_id count as one document and are treated
alike; a null doc_id counts as one document, smaller than all others; an empty table gives an empty result; other
columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .sieve import sift
from .storage import Scratch

MIN_CHARS = 20
MIN_DOCS = 3
#: Tasks that build shards at most (or the session's shuffle partitions, if more); a task takes one shard after another.
MAX_TASKS = 4096
SHARD_KEYS = 1 << 18
SHARD_PROBES = 1 << 20
NULL_ID = -(1 << 63)


def line_key(line: bytes) -> bytes:
    return line.strip(b"\x20\x09\x0a\x0b\x0c\x0d").lower()


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8")) >= min_chars)


# --- minimal perfect hash: levels of bits, keys that collide on one level go to the next -------------------------------

_GAMMA = 2.0
_LEVELS = 48


def _slots(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    return (T.mix(lo + T.mix(hi + np.uint64(level + 1))) % np.uint64(size)).astype(np.int64)


def build_mph(hi: np.ndarray, lo: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays by level for distinct keys, and the keys (indices) that no level could place, which take the last slots."""
    levels, left = [], np.arange(len(hi))
    while len(left) and len(levels) < _LEVELS:
        size = max(64, -(-int(_GAMMA * len(left)) // 64) * 64)
        at = _slots(hi[left], lo[left], len(levels), size)
        single = np.bincount(at, minlength=size) == 1
        levels.append(single)
        left = left[~single[at]]
    return levels, left


class Mph:
    """Finds the slot of each key; ``rest`` holds the (rare) keys that no level placed."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray) -> None:
        self.levels = levels
        self.base = np.cumsum([0, *[int(b.sum()) for b in levels]])
        self.rank = [np.cumsum(b) - b for b in levels]
        self.rest = {tuple(x): i for i, x in enumerate(rest.tolist())}

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        out, left = np.full(len(hi), -1, np.int64), np.arange(len(hi))
        for k, bits in enumerate(self.levels):
            at = _slots(hi[left], lo[left], k, len(bits))
            hit = bits[at]
            out[left[hit]] = self.base[k] + self.rank[k][at[hit]]
            left = left[~hit]
        for i in left:
            out[i] = self.base[-1] + self.rest.get((int(hi[i]), int(lo[i])), -self.base[-1] - 1)
        return out


def pack_shard(hi: np.ndarray, lo: np.ndarray, docs: np.ndarray, keeper: np.ndarray) -> dict[str, bytes]:
    levels, left = build_mph(hi, lo)
    rest = np.stack([hi[left], lo[left]], axis=1) if len(left) else np.zeros((0, 2), np.uint64)
    at = Mph(levels, rest).slots(hi, lo)
    prints, counts, keep = np.empty(len(hi), np.uint32), np.empty(len(hi), np.int64), np.empty(len(hi), np.int64)
    prints[at], counts[at], keep[at] = T.mix(hi ^ lo).astype(np.uint32), docs, keeper
    return {"sizes": np.array([len(b) for b in levels], np.int64).tobytes(), "bits": b"".join(np.packbits(b).tobytes() for b in levels),
            "rest": rest.tobytes(), "prints": prints.tobytes(), "counts": counts.tobytes(), "keepers": keep.tobytes()}


class Shard:
    def __init__(self, row: dict[str, bytes]) -> None:
        sizes, bits, levels, at = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["bits"], np.uint8), [], 0
        for n in sizes:
            levels.append(np.unpackbits(bits[at:at + n // 8]).astype(bool))
            at += n // 8
        self.mph = Mph(levels, np.frombuffer(row["rest"], np.uint64).reshape(-1, 2))
        self.prints, self.counts, self.keepers = np.frombuffer(row["prints"], np.uint32), np.frombuffer(row["counts"], np.int64), np.frombuffer(row["keepers"], np.int64)

    def probe(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.mph.slots(hi, lo)
        if (at < 0).any() or (self.prints[at] != T.mix(hi ^ lo).astype(np.uint32)).any():
            raise ValueError("a shard lacks a key that its documents hold")
        return self.counts[at], self.keepers[at]


# --- Spark jobs -----------------------------------------------------------------------------------------------------

def _line_hashes(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, found, digests = batch.column("id").to_numpy(zero_copy_only=False), [], []
        for i, text in enumerate(batch.column("text")):
            raw = text.as_buffer()
            keys = {line_key(x) for x in raw.to_pybytes().split(b"\n")} if raw is not None else ()
            mine = [xxhash.xxh3_128_digest(k) for k in keys if long_enough(k, min_chars)]
            digests += mine
            found.append(len(mine))
        pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(np.repeat(ids, found))], ["hi", "lo", "id"])


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard to one row of arrays per shard."""
    def packed(shard: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        col = lambda c: t.column(c).to_numpy()
        arrays = pack_shard(col("hi").view(np.uint64), col("lo").view(np.uint64), col("n_docs"), col("keeper"))
        probes = int(col("n_docs").sum())
        return pa.RecordBatch.from_pylist([{"shard": shard, "splits": -(-probes // SHARD_PROBES), **arrays}], schema=_SHARD_ARROW)

    now, parts = None, []
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        for lo, hi in _groups(shard):
            if shard[lo] != now and parts:
                yield packed(now, parts)
                parts = []
            now = int(shard[lo])
            parts.append(batch.slice(lo, hi - lo))
    if parts:
        yield packed(now, parts)


_ARRAYS = ("sizes", "bits", "rest", "prints", "counts", "keepers")
_SHARD_ARROW = pa.schema([("shard", pa.int64()), ("splits", pa.int64()), *[(c, pa.binary()) for c in _ARRAYS]])
_SHARD_SCHEMA = "shard bigint, splits bigint, " + ", ".join(f"{c} binary" for c in _ARRAYS)


def _groups(*keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of rows that are equal in all keys."""
    n = len(keys[0])
    cut = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1
    edges = [0, *cut.tolist(), n] if n else [0]
    yield from zip(edges[:-1], edges[1:], strict=True)


def _probe(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, split, kind): a shard's arrays, then its probes; yields (id, hi, lo) of lines to drop."""
    shard: Shard | None = None
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        for lo, hi in _groups(batch.column("shard").to_numpy(), batch.column("split").to_numpy(), kind):
            if kind[lo] == 0:
                shard = Shard({c: batch.column(c)[lo].as_py() for c in _ARRAYS})
                continue
            part = batch.slice(lo, hi - lo)
            h, l, ids = (part.column(c).to_numpy() for c in ("hi", "lo", "id"))
            counts, keepers = shard.probe(h.view(np.uint64), l.view(np.uint64))
            lose = (counts >= min_docs) & (keepers != ids)
            if lose.any():
                yield pa.RecordBatch.from_arrays([pa.array(ids[lose]), pa.array(h[lose]), pa.array(l[lose])], ["id", "hi", "lo"])


def find_drops(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, store: Scratch | None = None) -> DataFrame:
    """(id, drops): the hashes of the lines that each document loses. ``docs`` has id (not null) and text."""
    spark = docs.sparkSession
    store = store or Scratch(spark, "lines")
    found = docs.mapInArrow(lambda it: _line_hashes(it, min_chars), "hi bigint, lo bigint, id bigint")
    held = store.save(found.distinct(), "held")
    keys = store.save(held.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper")), "keys")
    n = keys.count()
    shards = max(1, -(-n // SHARD_KEYS))
    by_shard = F.pmod(F.col("hi"), F.lit(shards))
    tasks = min(shards, max(MAX_TASKS, int(spark.conf.get("spark.sql.shuffle.partitions"))))  # several shards a task beyond
    index = store.save(keys.withColumn("shard", by_shard).repartition(tasks, "shard").sortWithinPartitions("shard").mapInArrow(_build, _SHARD_SCHEMA), "index")
    hot = index.where("splits > 1").select("shard", "splits")
    arrays = index.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("splits") - 1)).alias("split")).select(
        "shard", "split", F.lit(0).alias("kind"), *[F.lit(None).cast("bigint").alias(c) for c in ("hi", "lo", "id")], *_ARRAYS)
    probes = held.withColumn("shard", by_shard).join(hot, "shard", "left").select(
        "shard", F.coalesce(F.pmod(F.xxhash64("id"), F.col("splits")), F.lit(0).cast("bigint")).alias("split"), F.lit(1).alias("kind"),
        "hi", "lo", "id", *[F.lit(None).cast("binary").alias(c) for c in _ARRAYS])
    dealt = arrays.unionByName(probes).repartition("shard", "split").sortWithinPartitions("shard", "split", "kind")
    lost = dealt.mapInArrow(lambda it: _probe(it, min_docs), "id bigint, hi bigint, lo bigint")
    return store.save(lost.groupBy("id").agg(F.collect_list(F.struct("hi", "lo")).alias("drops")), "drops")


def _cut(batches: Iterator[pa.RecordBatch], text: str, names: list[str], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        drops = batch.column("__drops").to_pylist()
        kept, n_lines, n_dropped = [], [], []
        for value, gone in zip(batch.column(text), drops, strict=True):
            raw = value.as_buffer()
            raw = raw.to_pybytes() if raw is not None else b""
            if not gone:
                kept.append(raw)
                n_lines.append(raw.count(b"\n") + 1)
                n_dropped.append(0)
                continue
            lose = {np.array([d["hi"], d["lo"]], np.int64).tobytes() for d in gone}
            lines = raw.split(b"\n")
            stay = [x for x in lines if not (long_enough(k := line_key(x), min_chars) and xxhash.xxh3_128_digest(k) in lose)]
            kept.append(b"\n".join(stay))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        new = {text: pa.array(kept, pa.binary()).cast(pa.string()), "__n_lines": pa.array(n_lines, pa.int64()), "__n_dropped": pa.array(n_dropped, pa.int64())}
        out = [*names, "__n_lines", "__n_dropped"]
        yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in out], out)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the text cut, and __n_lines and __n_dropped; null texts become empty."""
    ident = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NULL_ID))
    drops = find_drops(docs.select(ident.alias("id"), F.col(text).alias("text")), min_chars, min_docs)
    # texts that lose nothing stay where they are; those that may are moved to their drops
    marked = sift(docs.withColumn("__id", ident), "__id", drops, "id")
    drops = drops.select(F.col("id").alias("__drop_id"), F.col("drops").alias("__drops"))
    moved = marked.where("__may").join(drops, F.col("__id") == F.col("__drop_id"), "left").drop("__drop_id")
    still = marked.where("not __may").withColumn("__drops", F.lit(None).cast(drops.schema["__drops"].dataType))
    joined = still.unionByName(moved).drop("__id", "__may")
    names = docs.columns
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ["__n_lines bigint", "__n_dropped bigint"])
    return joined.mapInArrow(lambda it: _cut(it, text, names, min_chars), schema)

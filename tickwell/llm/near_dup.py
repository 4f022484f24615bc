"""MinHash near-duplicate classes (operator 4).

A document's set is its distinct ``k``-word shingles (A-Z lower-cased, words end at ASCII white space); with fewer words
the whole sequence is one shingle; without words the set is empty and linked with nothing. Two documents are linked if
the Jaccard similarity of their sets is at least ``percent`` per cent.

1. One pass over the texts: set size, a 128-bit fingerprint of the set, and a key for each band of ROWS slots of a
   one-permutation MinHash (the smallest hash in each of SLOTS bins, empty bins filled from bins that a per-bin random
   sequence names: optimal densification).
2. Documents with equal sets form a class; only the class's smallest doc_id goes on. Copies are never paired.
3. Every bucket links its members to its smallest one: as many candidates as members, not their square.
4. Candidates whose set sizes and sketches (a bit for each of SKETCH slots) allow the similarity are confirmed on the
   full sets, built anew from both texts; only these texts move. The links give components.
5. The exact rest: a star misses a link between two members whose star edges failed. Documents that candidates connect
   form a cluster; where a cluster holds more than one component, all its members stream past those outside its largest
   component (blocks of about BLOCK of these against chunks of FEW to CHUNK of those, so a cluster of some thousands is several tasks), as
   signatures of LONG slots. Pairs of
   different components whose signatures agree on about the similarity are confirmed too, and the components updated.

At similarity 0.8 a pair shares no bucket with probability (1 - 0.8^4)^32 = 5e-8; the filters of steps 4 and 5 lie
more than five standard errors below the limit.

Defined cases: null or empty texts have the empty set; rows that share a doc_id are one node, linked as any of them is;
a null doc_id is linked with nothing and kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .components import components
from .sieve import sift
from .storage import Scratch, columns_of

SHINGLE = 5
PERCENT = 80
SLOTS, ROWS = 128, 4
BANDS = SLOTS // ROWS
LONG = 1024
SKETCH = 512
BLOCK, CHUNK, FEW = 1 << 13, 1 << 14, 1 << 10
TRIES = 1024
_ROUNDS = (16, 128, TRIES)


def _agree(slots: int, percent: int, chance: float = 0.0) -> int:
    """Slots of a pair at the similarity that agree, less 5.5 standard errors; others agree by ``chance``."""
    p = percent / 100 + (1 - percent / 100) * chance
    return int(slots * p - 5.5 * (slots * p * (1 - p)) ** 0.5)


@lru_cache(maxsize=4)
def _probes(slots: int) -> np.ndarray:
    """Each slot's sequence of slots to borrow from."""
    at = T.mix(np.arange(slots * TRIES, dtype=np.uint64) + np.uint64(77)) % np.uint64(slots)
    return at.astype(np.int16).reshape(slots, TRIES)


def signature(hashes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """One-permutation MinHash of sorted distinct hashes: the smallest in each bin; empty bins borrow."""
    edge = np.searchsorted(hashes >> np.uint64(65 - slots.bit_length()), np.arange(slots + 1))
    filled = edge[:-1] < edge[1:]
    source = np.where(filled, np.arange(slots), -1)
    for rounds in _ROUNDS:
        empty = np.flatnonzero(source < 0)
        if not len(empty):
            break
        tried = _probes(slots)[empty, :rounds]
        hit = filled[tried]
        found = hit.any(axis=1)
        source[empty[found]] = tried[found, hit[found].argmax(axis=1)]
    for j in np.flatnonzero(source < 0):  # next filled bin in a circle: no sequence of TRIES met one
        source[j] = next(x % slots for x in range(j, j + slots) if filled[x % slots])
    return hashes[edge[:-1][source]]


def row_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Each row's shingle hashes, sorted and distinct."""
    for piece in T.pieces(column):
        piece = piece._replace(data=T.LOWER[piece.data])
        spans = T.words(piece, T.SPACED)
        grams, bound = T.shingles(T.hash_spans(piece.data, spans.start, spans.end), spans.bound, k)
        for lo, hi in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
            one = np.sort(grams[lo:hi])
            yield one[np.concatenate([[True], one[1:] != one[:-1]])] if hi - lo > 1 else one


_BAND_SALT = T.mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_BIT_SALT = T.mix(np.arange(1, SKETCH + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """A bit for each slot of a signature of SKETCH slots, as bigints. Each slot hashes by itself, so that slots that differ
    agree by chance independently also where a set has few shingles."""
    bits = (T.mix(signature(hashes, SKETCH) ^ _BIT_SALT) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, fp, bands, sketches = [], [], [], []
        for one in row_sets(batch.column("text"), k):
            n.append(len(one))
            if not len(one):
                fp.append((0, 0))
                bands.append(None)
                sketches.append(None)
                continue
            fp.append((int(T.mix(one).sum().view(np.int64)), int(T.mix(one ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum().view(np.int64))))
            sig = signature(one)
            key = _BAND_SALT.copy()
            for r in range(ROWS):
                key = T.mix(key + sig[r::ROWS])
            bands.append(key.view(np.int64))
            sketches.append(sketch(one))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array([x for x, _ in fp], pa.int64()), pa.array([x for _, x in fp], pa.int64()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "fp1", "fp2", "bands", "sketch"])


_SIGNED = "doc_id bigint, n_shingles bigint, fp1 bigint, fp2 bigint, bands array<bigint>, sketch array<bigint>"
SALTS = 32


def _confirm(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (hub, salt, member first): the hub's text, then its candidates; yields confirmed links."""
    hub, hub_sets, open_hub = None, [], False
    for batch in batches:
        hubs, members = batch.column("hub").to_numpy(), batch.column("member")
        is_hub = members.is_null().to_numpy(zero_copy_only=False)
        members = members.fill_null(0).to_numpy()
        links = []
        for i, one in enumerate(row_sets(batch.column("text"), k)):
            if is_hub[i]:  # rows that share the hub's doc_id follow one another
                if not open_hub or hubs[i] != hub:
                    hub, hub_sets = hubs[i], []
                if not any(np.array_equal(one, x) for x in hub_sets):
                    hub_sets.append(one)
                open_hub = True
                continue
            open_hub = False
            for other in hub_sets if hubs[i] == hub else ():
                if 100 * min(len(one), len(other)) < percent * max(len(one), len(other)):
                    continue
                both = np.concatenate([one, other])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(both) - common):
                    links.append((hubs[i], members[i]))
                    break
        if links:
            pair = np.array(links, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["a", "b"])


def _texts_of(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """The texts of the wanted doc_ids and few others."""
    return sift(texts, "doc_id", wanted, "doc_id").where("__may").drop("__may")


def _likely(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` whose set sizes and sketches allow the similarity. A hub with many members is dealt to SALTS tasks."""
    side = lambda name: reps.select(F.col("doc_id").alias(name), F.col("n_shingles").alias(f"{name}_n"), F.col("sketch").alias(f"{name}_sketch"))
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("member"), F.lit(SALTS)))
    hubs = salted.select("hub", "salt").distinct().join(side("hub"), "hub")
    met = salted.join(side("member"), "member").join(hubs, ["hub", "salt"])
    differ = sum((F.bit_count(F.get("hub_sketch", F.lit(i)).bitwiseXOR(F.get("member_sketch", F.lit(i)))) for i in range(SKETCH // 64)), F.lit(0))
    near = (SKETCH - differ >= _agree(SKETCH, percent, 0.5)) & (100 * F.least("hub_n", "member_n") >= percent * F.greatest("hub_n", "member_n"))
    return met.where(near).select("hub", "member")  # confirm takes distinct ones


def confirm(pairs: DataFrame, texts: DataFrame, k: int, percent: int, store: Scratch, name: str) -> DataFrame:
    """The links among ``pairs`` (hub, member). A hub with many members is dealt to SALTS tasks, its text with it.

    A member's text travels once for each of its pairs, a hub's once for each salt in use.
    """
    salted = store.save(pairs.distinct().withColumn("salt", F.pmod(F.xxhash64("member"), F.lit(SALTS))), f"{name}-pairs")
    hubs = salted.select("hub", "salt").distinct().select(F.col("hub").alias("doc_id"), "hub", "salt", F.lit(None).cast("bigint").alias("member"))
    wanted = hubs.unionByName(salted.select(F.col("member").alias("doc_id"), "hub", "salt", "member"))
    dealt = wanted.join(_texts_of(wanted, texts), "doc_id").select("hub", "salt", "member", "text").repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.col("member").asc_nulls_first())
    return store.save(dealt.mapInArrow(lambda it: _confirm(it, k, percent), "a bigint, b bigint"), f"{name}-links")


def _long(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(row_sets(batch.column("text"), k))
        sigs = [T.mix(signature(one, LONG)).astype(np.uint8).tobytes() if len(one) else None for one in sets]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(one) for one in sets], pa.int64()), pa.array(sigs, pa.binary())], ["doc_id", "n", "sig"])


class _Block:
    """Members as arrays: ids, components, set sizes, signatures, and which lie outside the cluster's largest component."""

    def __init__(self, batch: pa.RecordBatch | pa.Table) -> None:
        self.ids, self.comp, self.n = (batch.column(c).to_numpy() for c in ("doc_id", "component", "n"))
        self.stray = batch.column("stray").to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column("stray").to_numpy()
        self.sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(-1, LONG)


def _promising(strays: _Block, members: _Block, percent: int) -> Iterator[np.ndarray]:
    """Pairs (smaller id, larger id) of different components whose sizes and signatures allow the similarity."""
    size = 256
    for lo in range(0, len(strays.ids), size):
        for at in range(0, len(members.ids), size):
            a, b = np.s_[lo:lo + size], np.s_[at:at + size]
            n, m = strays.n[a][:, None], members.n[b]
            open_ = (strays.comp[a][:, None] != members.comp[b]) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
            open_ &= ~members.stray[b] | (strays.ids[a][:, None] < members.ids[b])  # two strays meet twice
            x, y = np.nonzero(open_)
            for cut in (SLOTS, LONG):
                near = (strays.sigs[a][x, :cut] == members.sigs[b][y, :cut]).sum(axis=1) >= _agree(cut, percent)
                x, y = x[near], y[near]
            if len(x):
                pair = np.stack([strays.ids[a][x], members.ids[b][y]], axis=1)
                pair.sort(axis=1)
                yield pair


def _rest(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cluster, block, chunk, member): a block of strays, then a chunk of its cluster's members, which stream past."""
    now, parts, strays = None, [], None
    for batch in batches:
        place = np.stack([batch.column(c).to_numpy() for c in ("cluster", "block", "chunk", "member")], axis=1)
        edges = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1).tolist(), len(place)] if len(place) else [0]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            part = batch.slice(lo, hi - lo)
            if not place[lo, 3]:
                parts, now = ([*parts, part] if parts and now == tuple(place[lo, :3]) else [part]), tuple(place[lo, :3])
                strays = None
                continue
            if now != tuple(place[lo, :3]):
                continue  # no stray fell to this block
            if strays is None:
                strays, parts = _Block(pa.Table.from_batches(parts).combine_chunks()), []
            for pair in _promising(strays, _Block(part), percent):
                yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["hub", "member"])


def _unmet(pairs: DataFrame, comp: DataFrame, texts: DataFrame, k: int, percent: int, store: Scratch) -> DataFrame:
    """(hub, member): promising pairs of different components within the clusters that ``pairs`` connect."""
    clusters = components(pairs.select(F.col("hub").alias("a"), F.col("member").alias("b")), store, "cluster")
    whole = clusters.unionByName(clusters.select(F.col("component").alias("node"), "component")).distinct().select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))
    placed = store.save(whole.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("cluster", "doc_id", F.coalesce("component", "doc_id").alias("component")), "placed")
    parts = placed.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("size"))
    shape = parts.groupBy("cluster").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.sum("size").alias("all"), (F.sum("size") - F.max("size")).alias("strays"))
    chunk = F.least(F.lit(CHUNK), F.greatest(F.lit(FEW), F.ceil(F.col("all") / 8)))
    shape = shape.where("strays > 0").withColumns({"blocks": F.ceil(F.col("strays") / BLOCK).cast("bigint"), "chunks": F.ceil(F.col("all") / chunk).cast("bigint")})
    open_ = store.save(placed.join(shape, "cluster").select("cluster", "doc_id", "component", "blocks", "chunks", (F.col("component") != F.col("main")).alias("stray")), "open")
    sigs = store.save(open_.select("doc_id").join(_texts_of(open_, texts), "doc_id").mapInArrow(lambda it: _long(it, k), "doc_id bigint, n bigint, sig binary"), "long")
    rows = open_.join(sigs.where("n > 0"), "doc_id")
    columns = ["cluster", "block", "chunk", "member", "doc_id", "component", "n", "sig", "stray"]
    part = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    strays = rows.where("stray").withColumns({"block": part("blocks"), "member": F.lit(0)}).withColumn("chunk", each("chunks")).select(columns)
    members = rows.withColumns({"chunk": part("chunks"), "member": F.lit(1)}).withColumn("block", each("blocks")).select(columns)
    dealt = strays.unionByName(members).repartition("cluster", "block", "chunk").sortWithinPartitions("cluster", "block", "chunk", "member")
    found = dealt.mapInArrow(lambda it: _rest(it, percent), "hub bigint, member bigint")
    return found.join(pairs, ["hub", "member"], "left_anti")  # those have been looked at


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of ``docs``."""
    store = Scratch(docs.sparkSession, "neardup")
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    signed = store.save(narrow.mapInArrow(lambda it: _signed(it, k), _SIGNED), "signed")
    sets = signed.where("n_shingles > 0 and doc_id is not null")
    same_set = ["n_shingles", "fp1", "fp2"]
    classes = sets.groupBy(*same_set).agg(F.min("doc_id").alias("rep"))
    member = store.save(sets.select("doc_id", *same_set).join(classes, same_set).select("doc_id", "rep").distinct(), "member")
    reps = store.save(sets.join(member.where("doc_id = rep").select("doc_id"), "doc_id", "left_semi"), "reps")
    rows = reps.select("doc_id", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub <> last").select("key", "hub")
    held = rows.join(buckets, "key")
    texts = narrow.where("doc_id is not null")
    pairs = store.save(held.where("doc_id <> hub").select("hub", F.col("doc_id").alias("member")).distinct(), "pairs")
    links = confirm(_likely(pairs, reps, percent), texts, k, percent, store, "star")
    alike = member.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    linked = links.unionByName(alike)
    comp = components(links.unionByName(alike.join(member.where("doc_id = rep").select(F.col("doc_id").alias("a")), "a", "left_semi")), store, "first")
    extra = confirm(_unmet(pairs, comp, texts, k, percent, store), texts, k, percent, store, "rest")
    final = components(linked.unionByName(extra), store, "final")
    out = signed.select("doc_id", "n_shingles").join(final, F.col("doc_id") == F.col("node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that are near copies of one with a smaller doc_id; rows that share a doc_id stay or go together."""
    store = Scratch(docs.sparkSession, "neardup")
    gone = store.save(near_duplicates(docs, doc_id, text).where("not kept").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    marked = sift(docs.withColumn("__id", F.col(doc_id).cast("bigint")), "__id", gone, "__gone")
    # only rows that may be gone move; the rest stay where they are read
    rest = marked.where("__may").join(gone, F.col("__id") == F.col("__gone"), "left_anti")
    return marked.where("not __may").unionByName(rest).select(columns_of(docs))

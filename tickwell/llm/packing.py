"""Hierarchical multi-length packing (operator 9).

Documents become token ids with an end id. Each task packs its documents in groups of about ``GROUP_TOKENS`` tokens, so
no ids are shuffled and memory is bounded by a group (one document longer than that is a group's worth by itself, cut
as it comes).

1. Whole windows of the largest tier are cut off long documents; what is left of each document is routed to the
   smallest context-size tier that holds it.
2. From the largest tier down, a window opens with its longest remaining piece, and its gap is filled from shorter
   pieces, best fit first; when none fits, the shortest piece is cut to fill it exactly.
3. What the last window lacks is cut into windows of smaller powers of two, so no sequence is padded.
4. The sequences of one length, of all groups, are dealt to steps of ``STEP_TOKENS`` tokens, heaviest first and back and
   forth by the sum of squared piece lengths (attention work), so steps are full and balanced over the whole corpus.
   Their places come from a range sort of one narrow row a sequence, counts a partition, and no single task.

Defined cases: null or empty text is the end id alone; rows that share a doc_id are packed one by one; a null doc_id
stays null; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokenize
from .storage import Scratch

TIERS = (4096, 2048, 1024, 512, 256)
GROUP_TOKENS = 1 << 20
STEP_TOKENS = 1 << 16
END = 2

Part = tuple[int, int, int]  # document, start, length


def _powers(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[Part]]:
    """Sequences of parts. Every token lies in one part; each sequence's length is a power of two, at most tiers[0]."""
    done: list[list[Part]] = []
    left: list[tuple[int, int, int]] = []  # length, document, start; sorted
    for d, n in enumerate(lengths):
        whole = n // tiers[0] * tiers[0]
        done += [[(d, s, tiers[0])] for s in range(0, whole, tiers[0])]
        if n > whole:
            left.append((n - whole, d, whole))
    left.sort()
    while left:
        n, d, s = left.pop()
        size = next(t for t in reversed(tiers) if t >= n)
        row, gap = [(d, s, n)], size - n
        while gap and left:
            i = bisect.bisect_right(left, (gap, 1 << 62, 0)) - 1
            if i >= 0:
                n, d, s = left.pop(i)
                row.append((d, s, n))
                gap -= n
            else:
                n, d, s = left.pop(0)
                row.append((d, s, gap))
                bisect.insort(left, (n - gap, d, s + gap))
                gap = 0
        if not gap:
            done.append(row)
            continue
        for want in _powers(size - gap):  # the last row: nothing is left to fill it
            piece: list[Part] = []
            while want:
                d, s, n = row.pop(0)
                take = min(n, want)
                piece.append((d, s, take))
                want -= take
                if n > take:
                    row.insert(0, (d, s + take, n - take))
            done.append(piece)
    return done


_FIELDS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "work")
_SCHEMA = "doc_id bigint, " + ", ".join(f"`{c}` bigint" for c in _FIELDS)
#: Sequence numbers of a task start here times its partition.
_PARTITION = 1 << 36


def _emit(docs: list[tuple], first: int) -> tuple[pa.RecordBatch, int]:
    """Packs one group, its sequences numbered from ``first``; also the number after its last."""
    sequences = pack([len(ids) for _, ids in docs])
    ids_out, rows = [], []
    for q, parts in enumerate(sequences):
        offset, size, work = 0, sum(n for _, _, n in parts), sum(n * n for _, _, n in parts)
        for d, s, n in parts:
            ids = docs[d][1]
            ids_out.append(docs[d][0])
            rows.append((s, n, zlib.crc32(ids[s:s + n].tobytes()), len(ids), first + q, offset, size, work))
            offset += n
    table = np.array(rows, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ids_out, pa.int64()), *[pa.array(table[:, i]) for i in range(len(_FIELDS))]], ["doc_id", *_FIELDS]), first + len(sequences)


def _packed(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    coder = tokenize.encoder(path)
    first = TaskContext.get().partitionId() * _PARTITION
    group, tokens = [], 0
    for batch in batches:
        lo = 0
        size = np.concatenate([[0], np.cumsum(batch.column("bytes").to_numpy())])
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(size, size[lo] + 4 * GROUP_TOKENS, "right")) - 1)
            ids, bound = coder.encode(batch.column("text").slice(lo, hi - lo), END)
            ids = ids.astype("<u4", copy=False)
            for name, a, b in zip(batch.column("doc_id").slice(lo, hi - lo).to_pylist(), bound[:-1].tolist(), bound[1:].tolist(), strict=True):
                group.append((name, ids[a:b]))
                tokens += b - a
                if tokens >= GROUP_TOKENS:
                    packed, first = _emit(group, first)
                    yield packed
                    group, tokens = [], 0
            lo = hi
    if group:
        yield _emit(group, first)[0]


def with_steps(pieces: DataFrame, store: Scratch, step_tokens: int) -> DataFrame:
    """``pieces`` with the step of their sequence instead of its work."""
    order = [F.desc("window"), F.desc("work"), "sequence_id"]
    heads = pieces.where("offset = 0").select("sequence_id", "window", "work").repartitionByRange(*order).sortWithinPartitions(*order)
    # one row a sequence; the number's upper bits are its partition of the sorted rows, the lower ones its row there
    ranked = store.save(heads.select("sequence_id", "window", F.monotonically_increasing_id().alias("at")), "sequences").withColumn("part", F.shiftright("at", 33))
    cells = ranked.groupBy("window", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"))
    before = Window.partitionBy("window").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = store.save(cells.withColumns({"before": F.coalesce(F.sum("n").over(before), F.lit(0)), "total": F.sum("n").over(Window.partitionBy("window"))}), "cells")
    sizes = cells.groupBy("window").agg(F.max("total").alias("total")).withColumn("count", F.ceil(F.col("total") * F.col("window") / step_tokens))
    larger = Window.orderBy(F.desc("window")).rowsBetween(Window.unboundedPreceding, -1)  # a row for each of at most 13 lengths
    sizes = store.save(sizes.select("window", "count", F.coalesce(F.sum("count").over(larger), F.lit(0)).alias("first")), "sizes")
    rank = F.col("before") + F.col("at") - F.col("low")
    placed = ranked.join(cells, ["window", "part"]).join(sizes, "window").select("sequence_id", "first", "count", rank.alias("rank"))
    turn, at = F.floor(F.col("rank") / F.col("count")), F.col("rank") % F.col("count")
    step = (F.col("first") + F.when(turn % 2 == 1, F.col("count") - 1 - at).otherwise(at)).cast("bigint")
    return pieces.join(placed.select("sequence_id", step.alias("step_id")), "sequence_id").select("doc_id", *_FIELDS[:-1], "step_id")


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", step_tokens: int = STEP_TOKENS) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window, step_id."""
    store = Scratch(docs.sparkSession, "packing")
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("bytes"))
    return with_steps(store.save(narrow.mapInArrow(lambda it: _packed(it, tokenizer), _SCHEMA), "pieces"), store, step_tokens)

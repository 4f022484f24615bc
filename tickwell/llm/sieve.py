"""A bitmap of ids, so that rows which surely have no partner are told apart before a join moves them.

The ids' hashes set bits, about PER_ID for each id, BITS at least and MOST at most: that is the bound of what is broadcast,
as pages of PAGE words of 64 bits (4 to 128 MB in all). One false partner in 32 passes up to MOST / 32 = 33 million ids, one in
eight up to 134 million; with still more ids more rows pass, and the exact join that follows does what it would have done without it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25
MOST = 1 << 30
PER_ID = 32
PAGE = 1 << 10


def size_for(n: int) -> int:
    """Bits for ``n`` ids: a power of two."""
    return min(MOST, max(BITS, 1 << max(0, PER_ID * n - 1).bit_length()))


def sift(rows: DataFrame, key: str, ids: DataFrame, id_column: str, out: str = "__may") -> DataFrame:
    """``rows`` with a boolean: false where no value of ``ids`` equals the row's ``key`` (a bigint)."""
    ids = ids.where(F.col(id_column).isNotNull())
    bits = size_for(ids.count())
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    mine, wanted = slot(F.col(key)), slot(F.col(id_column))
    word: Column = F.floor(wanted / 64)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (wanted % 64).cast("int"))
    words = ids.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    # pages that hold a bit are filled up with zeros, so that a word is found by its place
    held = words.groupBy(F.floor(F.col("__word") / PAGE).alias("__page")).agg(F.collect_list(F.struct("__word", "__bits")).alias("__held"))
    zeros = F.transform(F.sequence(F.lit(0), F.lit(PAGE - 1)), lambda i: F.struct((F.col("__page") * PAGE + i).alias("__word"), F.lit(0).cast("bigint").alias("__bits")))
    filled = held.select("__page", F.explode(F.concat("__held", zeros)).alias("w")).select("__page", "w.*").groupBy("__page", "__word").agg(F.bit_or("__bits").alias("__bits"))
    pages = filled.groupBy("__page").agg(F.transform(F.array_sort(F.collect_list(F.struct("__word", "__bits"))), lambda w: w["__bits"]).alias("__words"))
    hit = F.getbit(F.get("__words", (F.floor(mine / 64) % PAGE).cast("int")), (mine % 64).cast("int")) == 1
    return (rows.withColumn("__page", F.floor(mine / 64 / PAGE)).join(F.broadcast(pages), "__page", "left")
            .withColumn(out, F.coalesce(hit, F.lit(False))).drop("__page", "__words"))

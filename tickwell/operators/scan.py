"""Linear recurrences ``y_r = a * y_(r-1) + b_r`` as native window sums.

Spark windows cannot read their own output, and a recursive query needs
one iteration per row. A first-order linear recurrence with a constant
coefficient is associative, so it is evaluated in two levels instead:

1. Rows are numbered densely per key (``rn`` = 1, 2, ...) and cut into
   blocks of ``B`` rows: ``blk = (rn - 1) div B``, ``j = (rn - 1) mod B``.
   Inside a block the closed form is a running sum:
   ``loc_r = a^j * sum_{i <= j} b_i * a^(-i)``
   (a window over (key, blk), ordered by the row number). At a block's last
   row that is its end value with zero carry-in, ``S_k``.
2. The value carried into block ``k`` is
   ``carry_k = S_(k-1) + A * S_(k-2) + A^2 * S_(k-3) + ...`` with
   ``A = a^B``. Every block before the current one is full, so the sum of
   block ``k - m`` is the last end value among the key's rows up to the
   ``(m - 1) * B + 1``-th before: a running frame with a fixed end, the same
   for all rows of block ``k``.
3. ``y_r = loc_r + a^(j+1) * carry_k``.

Only the ``M`` latest block sums are read, with ``A^M`` below the smallest
positive double (``M * B * -ln a > 745``): every omitted term underflows to
zero, so the truncation drops nothing a double can hold. ``B`` is as large
as keeps ``a^(-(B-1))`` far from overflow, which makes ``M`` 2 to 4.

Nulls: window sums skip nulls but a recursion does not; once ``b`` is null
every later ``y`` of the key is null (a running "seen a null" flag, inside
the block and, as a carry, over the blocks before).

Plan: all windows partition by the key (or by (key, blk), which the key's
hash partitioning satisfies) and order by (blk, rn), so a scan is one sort
and two window operators on one hash partitioning by key: no aggregate, no
join back, and the input is read once. A key's rows are one
window partition; for daily bars that is bounded by the trading days of
the key (one row per (key, day)), see README "Scale".
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_BLOCK = 8192
_UNDERFLOW_LN = 745.0     # -ln(smallest positive subnormal double) ~ 744.44
_SAFE_EXP_LN = 600.0      # keep a^(-j) below e^600


@dataclass(frozen=True)
class ScanSpec:
    """One recurrence: output column ``name``, coefficient ``a``, input ``b``."""
    name: str
    a: float
    b: Column


def safe_block(a: float, cap: int = MAX_BLOCK) -> int:
    if a <= 0.0 or a >= 1.0:
        return cap
    return max(1, min(cap, int(_SAFE_EXP_LN / -math.log(a))))


def carry_depth(a: float, block: int) -> int:
    """Number of earlier blocks whose contribution is representable."""
    if a <= 0.0:
        return 0
    if a >= 1.0:
        raise ValueError("linear_scan needs 0 <= a < 1")
    return int(math.ceil(_UNDERFLOW_LN / (-block * math.log(a)))) + 1


def _carry(end: str, a: float, B: int, by_key) -> Column:
    """The value carried into a row's block: the sum over the M previous
    (full) blocks of S_(k-m) * A^(m-1); ``end`` is S_k on a block's last row,
    else null."""
    A = a ** B
    terms = []
    for m in range(1, carry_depth(a, B) + 1):
        w = A ** (m - 1)
        if w == 0.0:
            break
        before = by_key.rowsBetween(Window.unboundedPreceding, -((m - 1) * B + 1))
        s = F.coalesce(F.last(end, ignorenulls=True).over(before), F.lit(0.0)) * F.lit(a ** (B - 1))
        terms.append(s * F.lit(w) if m > 1 else s)
    return reduce(lambda x, y: x + y, terms)


def linear_scan(df: DataFrame, specs: list[ScanSpec], key: str = "symbol", rn: str = "row_num",
                block: int | None = None, keep_blocks: bool = False) -> DataFrame:
    """Add one column per spec with ``y_r = a * y_(r-1) + b_r`` (y_0 = 0)
    over rows ordered by the dense 1-based ``rn`` within ``key``.

    With ``keep_blocks`` the block columns stay, and a later scan of the
    same ``block`` over the frame reuses them and their sort."""
    for s in specs:
        if not 0.0 <= s.a < 1.0:
            raise ValueError(f"{s.name}: coefficient must be in [0, 1)")
    B = block or min(safe_block(s.a) for s in specs)
    by_key = Window.partitionBy(key).orderBy("_blk", rn)
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    blk_run = Window.partitionBy(key, "_blk").orderBy(rn).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    base = df if "_blk" in df.columns else (df.withColumn("_blk", F.floor((F.col(rn) - 1) / B))
                                              .withColumn("_j", (F.col(rn) - 1) % B))
    scaled = [s.b if s.a == 0.0 else s.b * F.pow(F.lit(s.a), -F.col("_j")) for s in specs]
    base = base.select("*", *[c.alias(f"_c{i}") for i, c in enumerate(scaled)])
    live = [i for i, s in enumerate(specs) if s.a > 0.0]
    # First inside the blocks, then over the key's blocks before: each one
    # window operator on the same exchange (if any) and the same sort.
    base = base.select("*", *[F.max(F.col(f"_c{i}").isNull()).over(blk_run).alias(f"_b{i}") for i in range(len(specs))],
                       *[F.sum(f"_c{i}").over(blk_run).alias(f"_r{i}") for i in live])
    base = base.select("*", *[F.when(F.col("_j") == B - 1, F.col(f"_r{i}")).alias(f"_e{i}") for i in live])
    base = base.select("*", *[(F.col(f"_b{i}") | F.coalesce(F.max(f"_b{i}").over(before), F.lit(False))).alias(f"_bad{i}")
                              for i in range(len(specs))],
                       *[_carry(f"_e{i}", specs[i].a, B, by_key).alias(f"_k{i}") for i in live])

    out = base
    for i, s in enumerate(specs):
        if s.a == 0.0:
            y = F.col(f"_c{i}")
        else:
            y = F.pow(F.lit(s.a), F.col("_j")) * (F.col(f"_r{i}") + F.lit(s.a) * F.col(f"_k{i}"))
        out = out.withColumn(s.name, F.when(~F.col(f"_bad{i}"), y))
    temp = (set() if keep_blocks else {"_blk", "_j"}) | {f"{p}{i}" for i in range(len(specs)) for p in ("_c", "_b", "_bad", "_r", "_e", "_k")}
    return out.drop(*[c for c in out.columns if c in temp])

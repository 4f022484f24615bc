"""Quality gates: not_null, unique, unique combination, expression_is_true.

Each gate is a count of failing rows (or failing key groups for uniqueness).
Row-level gates over the same frame are evaluated together in one aggregate;
a layer's gates are unioned into one small report frame. ``enforce`` raises ``QualityError`` when any gate fails, which stops
the build between layers.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(RuntimeError):
    def __init__(self, failures: dict):
        super().__init__(f"quality gates failed: {failures}")
        self.failures = failures


@dataclass(frozen=True)
class Gate:
    """A row-level gate carries ``count`` (failing rows of ``source``); the
    report evaluates all row-level gates of one source in a single
    aggregate. A key-level gate carries ``frame`` (one row, ``failures``)."""
    layer: str
    model: str
    test: str
    source: DataFrame
    count: Column | None = None
    frame: DataFrame | None = None


def not_null(df: DataFrame, col: str, layer: str, model: str) -> Gate:
    """Q1: rows where the column is null."""
    return Gate(layer, model, f"not_null({col})", df, count=F.count_if(F.col(col).isNull()))


def unique(df: DataFrame, cols, layer: str, model: str) -> Gate:
    """Q2 / Q3: key groups that occur more than once (rows with a null in a
    single-column key are ignored, as a unique test does). Aggregated with a
    map-side combine, so a hot key never gathers its rows in one task."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    src = df.filter(F.col(cols[0]).isNotNull()) if len(cols) == 1 else df
    dup = src.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    name = f"unique({cols[0]})" if len(cols) == 1 else f"unique_combination({', '.join(cols)})"
    return Gate(layer, model, name, df, frame=dup.agg(F.count(F.lit(1)).alias("failures")))


def expression_is_true(df: DataFrame, expr: str, layer: str, model: str, where: str | None = None) -> Gate:
    """Q4: rows (after the optional ``where``) where the expression is false;
    a null result passes, and so does a row whose ``where`` is not true."""
    failing = ~F.expr(expr) if where is None else (F.expr(where) & ~F.expr(expr))
    return Gate(layer, model, f"expression_is_true({expr})", df, count=F.count_if(failing))


def bronze_gates(prices: DataFrame, index: DataFrame) -> list[Gate]:
    """Null keys, looked for before any window: all of them would land in
    one window group."""
    return [not_null(df, c, "bronze", model) for df, model in ((prices, "bronze_prices"), (index, "bronze_index"))
            for c in ("code", "date")]


def silver_gates(silver_prices: DataFrame, silver_index: DataFrame) -> list[Gate]:
    return [
        unique(silver_prices, ["symbol", "trade_date"], "silver", "silver_prices"),
        not_null(silver_prices, "symbol", "silver", "silver_prices"),
        not_null(silver_prices, "trade_date", "silver", "silver_prices"),
        unique(silver_index, ["index_code", "trade_date"], "silver", "silver_index"),
        not_null(silver_index, "index_code", "silver", "silver_index"),
        not_null(silver_index, "trade_date", "silver", "silver_index"),
    ]


def gold_gates(indicators: DataFrame, summary: DataFrame, dim: DataFrame) -> list[Gate]:
    return [
        expression_is_true(indicators, "rsi_14 >= 0 AND rsi_14 <= 100", "gold", "fact_stock_indicators",
                           "rsi_14 IS NOT NULL"),
        expression_is_true(indicators, "ma200 > 0", "gold", "fact_stock_indicators", "ma200 IS NOT NULL"),
        expression_is_true(indicators, "bb_upper >= bb_lower", "gold", "fact_stock_indicators",
                           "bb_upper IS NOT NULL AND bb_lower IS NOT NULL"),
        expression_is_true(summary, "gainers + losers + unchanged = total_symbols", "gold",
                           "fact_market_summary"),
        unique(dim, "symbol", "gold", "dim_stock"),
        not_null(dim, "symbol", "gold", "dim_stock"),
    ]


def report(gates: list[Gate]) -> DataFrame:
    """One row per gate: layer, model, test, failures. Row-level gates on the
    same source frame share one aggregate (one pass over that frame)."""
    def labelled(i, g, failures):
        return F.struct(F.lit(i).alias("ordinal"), F.lit(g.layer).alias("layer"), F.lit(g.model).alias("model"),
                        F.lit(g.test).alias("test"), failures.cast("bigint").alias("failures"))

    parts, by_source = [], {}
    for i, g in enumerate(gates):
        if g.count is not None:
            by_source.setdefault(id(g.source), (g.source, []))[1].append((i, g))
        else:
            parts.append(g.frame.select(F.inline(F.array(labelled(i, g, F.col("failures"))))))
    for source, gs in by_source.values():
        row = source.agg(*[g.count.alias(f"_g{i}") for i, g in gs])
        parts.append(row.select(F.inline(F.array(*[labelled(i, g, F.col(f"_g{i}")) for i, g in gs]))))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.orderBy("ordinal").drop("ordinal")


def enforce(gates: list[Gate]) -> list[dict]:
    """Q5: evaluate a layer's gates once (one small job, one row per gate to
    the driver), raise on any failure, and return the rows."""
    rows = [r.asDict() for r in report(gates).collect()]
    failed = {f"{r['model']}.{r['test']}": r["failures"] for r in rows if r["failures"]}
    if failed:
        raise QualityError(failed)
    return rows

"""DuckDB oracle SQL for every registered query.

Each oracle starts from the driver's raw views (``lineitem`` ...), derives
the bronze tables exactly as the Spark fixture does, and then states the
model directly in SQL. The recursive indicators are literal recursive
queries (one step per row), so the oracle is independent of the block scan.

Comparison rules: doubles are rounded to 6 places on both sides (RSI is
already rounded to 4); counts and sums are BIGINT; audit timestamps are
left out.
"""

from __future__ import annotations

from .. import config as C
from .sqltext import CteSet

S = CteSet()

# --- fixture: bars derived from lineitem (same definition as sources/fixtures.py)
S.add("ticks", """
  SELECT CONCAT('S', CAST(l_suppkey AS VARCHAR)) AS code, l_suppkey,
    CAST(l_shipdate AS DATE) + 9131 AS date,
    l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity,
    (20 + l_suppkey % 80) * CAST(ROUND(100 + 100 * l_discount - 100 * l_tax) AS BIGINT) AS cents
  FROM lineitem""")
S.add("seq", """
  SELECT *,
    ROW_NUMBER() OVER (PARTITION BY code, date ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS r_first,
    ROW_NUMBER() OVER (PARTITION BY code, date ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) AS r_last
  FROM ticks""", ["ticks"])
S.add("bars", """
  SELECT code, l_suppkey, date,
    MAX(CASE WHEN r_first = 1 THEN cents END) AS o, MAX(cents) AS h, MIN(cents) AS l,
    MAX(CASE WHEN r_last = 1 THEN cents END) AS c,
    CAST(SUM(l_quantity) AS BIGINT) AS v, MAX(l_orderkey) AS k
  FROM seq GROUP BY code, l_suppkey, date""", ["seq"], materialized=True)
S.add("bronze_prices", """
  SELECT code, date,
    CAST(CASE WHEN k % 211 = 0 THEN -o ELSE o END / 100.0 AS DECIMAL(18,4)) AS open,
    CAST(CASE WHEN k % 223 = 0 THEN l - 100 ELSE h END / 100.0 AS DECIMAL(18,4)) AS high,
    CAST(l / 100.0 AS DECIMAL(18,4)) AS low,
    CAST(CASE WHEN k % 199 = 0 THEN 0 WHEN k % 97 = 0 THEN c * 140
              WHEN k % 1009 = 0 THEN NULL ELSE c * 100 END / 10000.0 AS DECIMAL(18,4)) AS close,
    CASE WHEN k % 227 = 0 THEN -v ELSE v END AS volume,
    CASE WHEN k % 5 = 0 THEN 'feed_b' ELSE 'feed_a' END AS source
  FROM bars""", ["bars"], materialized=True)
S.add("bronze_index", """
  SELECT 'VNINDEX' AS code, date,
    CAST(FLOOR(AVG(o)) / 10.0 AS DECIMAL(18,4)) AS open, CAST(MAX(h) / 10.0 AS DECIMAL(18,4)) AS high,
    CAST(MIN(l) / 10.0 AS DECIMAL(18,4)) AS low, CAST(FLOOR(AVG(c)) / 10.0 AS DECIMAL(18,4)) AS close,
    CAST(SUM(v) AS BIGINT) AS volume, 'feed_a' AS source FROM bars GROUP BY date
  UNION ALL
  SELECT 'VN30', date,
    CAST(FLOOR(AVG(o)) / 5.0 AS DECIMAL(18,4)), CAST(MAX(h) / 5.0 AS DECIMAL(18,4)),
    CAST(MIN(l) / 5.0 AS DECIMAL(18,4)), CAST(FLOOR(AVG(c)) / 5.0 AS DECIMAL(18,4)),
    CAST(SUM(v) AS BIGINT), 'feed_a' FROM bars WHERE l_suppkey % 10 < 3 GROUP BY date""",
      ["bars"], materialized=True)
S.add("bronze_components", "SELECT DISTINCT code FROM bars WHERE l_suppkey % 10 < 3", ["bars"])

# --- silver
S.add("px_raw", """
  SELECT code AS symbol, date AS trade_date,
    CAST(open AS DOUBLE) AS open_price, CAST(high AS DOUBLE) AS high_price,
    CAST(low AS DOUBLE) AS low_price, CAST(close AS DOUBLE) AS close_price,
    CAST(volume AS BIGINT) AS volume, source,
    LAG(CAST(close AS DOUBLE)) OVER (PARTITION BY code ORDER BY date) AS prev_close_price
  FROM bronze_prices""", ["bronze_prices"])
S.add("ix_move", """
  SELECT trade_date,
    CASE WHEN prev_ix > 0 THEN ABS(ix - prev_ix) / prev_ix ELSE 0 END AS index_change_rate
  FROM (SELECT date AS trade_date, CAST(close AS DOUBLE) AS ix,
               LAG(CAST(close AS DOUBLE)) OVER (ORDER BY date) AS prev_ix
        FROM bronze_index WHERE code = 'VNINDEX') t""", ["bronze_index"])
S.add("px_flagged", """
  SELECT p.*,
    CASE
      WHEN p.close_price <= 0 THEN 'invalid_close_price'
      WHEN p.high_price < p.low_price THEN 'high_less_than_low'
      WHEN p.open_price <= 0 OR p.high_price <= 0 OR p.low_price <= 0 THEN 'invalid_ohlc'
      WHEN p.volume < 0 THEN 'negative_volume'
      WHEN p.prev_close_price > 0
           AND ABS(p.close_price - p.prev_close_price) / p.prev_close_price > CAST(0.15 AS DOUBLE)
           AND COALESCE(m.index_change_rate, 0) < CAST(0.03 AS DOUBLE) THEN 'abnormal_price_gap'
      ELSE 'ok'
    END AS dq_flag
  FROM px_raw p LEFT JOIN ix_move m ON p.trade_date = m.trade_date""", ["px_raw", "ix_move"])
S.add("silver_prices", """
  SELECT symbol, trade_date,
    CASE WHEN dq_flag = 'abnormal_price_gap' THEN prev_close_price ELSE open_price END AS open_price,
    CASE WHEN dq_flag = 'abnormal_price_gap' THEN prev_close_price ELSE high_price END AS high_price,
    CASE WHEN dq_flag = 'abnormal_price_gap' THEN prev_close_price ELSE low_price END AS low_price,
    CASE WHEN dq_flag = 'abnormal_price_gap' THEN prev_close_price ELSE close_price END AS close_price,
    CASE WHEN dq_flag = 'abnormal_price_gap' THEN CAST(0 AS BIGINT) ELSE volume END AS volume,
    source, dq_flag, dq_flag IN ('ok', 'abnormal_price_gap') AS is_valid
  FROM px_flagged""", ["px_flagged"], materialized=True)
S.add("silver_index", """
  SELECT *, dq_flag = 'ok' AS is_valid FROM (
    SELECT code AS index_code, date AS trade_date,
      CAST(open AS DOUBLE) AS open_price, CAST(high AS DOUBLE) AS high_price,
      CAST(low AS DOUBLE) AS low_price, CAST(close AS DOUBLE) AS close_price,
      CAST(volume AS BIGINT) AS volume, source,
      CASE
        WHEN CAST(close AS DOUBLE) <= 0 THEN 'invalid_close_price'
        WHEN CAST(high AS DOUBLE) < CAST(low AS DOUBLE) THEN 'high_less_than_low'
        WHEN CAST(open AS DOUBLE) <= 0 OR CAST(high AS DOUBLE) <= 0 OR CAST(low AS DOUBLE) <= 0 THEN 'invalid_ohlc'
        WHEN volume < 0 THEN 'negative_volume'
        ELSE 'ok'
      END AS dq_flag
    FROM bronze_index) t""", ["bronze_index"])

# --- gold
S.add("fact_stock_price", """
  SELECT symbol, trade_date, row_num, open_price, high_price, low_price, close_price, volume, source,
    GREATEST(COALESCE(chg, 0), 0) AS gain, ABS(LEAST(COALESCE(chg, 0), 0)) AS loss
  FROM (SELECT *,
          ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY trade_date) AS row_num,
          close_price - LAG(close_price) OVER (PARTITION BY symbol ORDER BY trade_date) AS chg
        FROM silver_prices WHERE is_valid) t""", ["silver_prices"], materialized=True)
S.add("breadth", """
  SELECT trade_date,
    CAST(SUM(CASE WHEN gain > 0 THEN 1 ELSE 0 END) AS BIGINT) AS gainers,
    CAST(SUM(CASE WHEN loss > 0 THEN 1 ELSE 0 END) AS BIGINT) AS losers,
    CAST(SUM(CASE WHEN gain = 0 AND loss = 0 THEN 1 ELSE 0 END) AS BIGINT) AS unchanged,
    CAST(COUNT(symbol) AS BIGINT) AS total_symbols,
    CAST(SUM(volume) AS BIGINT) AS total_volume
  FROM fact_stock_price WHERE row_num > 1 GROUP BY trade_date""", ["fact_stock_price"])
S.add("fact_market_summary", """
  SELECT b.trade_date, b.gainers, b.losers, b.unchanged, b.total_symbols, b.total_volume,
    m.close_price AS vnindex_close, t.close_price AS vn30_close
  FROM breadth b
  JOIN silver_index m ON m.trade_date = b.trade_date AND m.index_code = 'VNINDEX' AND m.is_valid
  JOIN silver_index t ON t.trade_date = b.trade_date AND t.index_code = 'VN30' AND t.is_valid""",
      ["breadth", "silver_index"], materialized=True)
S.add("dim_stock", """
  SELECT g.symbol, g.exchange, 'HOSE' AS default_exchange, (c.code IS NOT NULL) AS is_vn30
  FROM (SELECT symbol, MAX(source) AS exchange
        FROM (SELECT DISTINCT symbol, source FROM silver_prices WHERE is_valid) d
        GROUP BY symbol) g
  LEFT JOIN (SELECT DISTINCT code FROM bronze_components) c ON c.code = g.symbol""",
      ["silver_prices", "bronze_components"], materialized=True)

# --- rolling windows and literal recursions over a price fact
def _ema_ctes(name: str, column: str, period: int, src: str, value: str, deps) -> None:
    alpha = f"(CAST(2 AS DOUBLE) / {period + 1})"
    S.add(f"{name}_seed", f"""
  SELECT symbol, AVG({value}) AS v FROM {src} WHERE row_num <= {period}
  GROUP BY symbol HAVING COUNT(*) = {period}""", deps)
    S.add(f"{name}_rec", f"""
  SELECT b.symbol, b.row_num, b.trade_date, s.v
  FROM {src} b JOIN {name}_seed s ON b.symbol = s.symbol AND b.row_num = {period}
  UNION ALL
  SELECT b.symbol, b.row_num, b.trade_date, b.{value} * {alpha} + r.v * (1 - {alpha})
  FROM {name}_rec r JOIN {src} b ON b.symbol = r.symbol AND b.row_num = r.rn + 1""",
          [*deps, f"{name}_seed"], columns="symbol, rn, trade_date, v")
    S.add(name, f"SELECT symbol, trade_date, v AS {column} FROM {name}_rec", [f"{name}_rec"], materialized=True)


def _indicator_ctes(src: str, x: str = "") -> None:
    """The indicator tables of the price fact ``src``; ``x`` ends their names."""
    S.add(f"ma_bb{x}", f"""
  SELECT symbol, trade_date, close_price, row_num,
    CASE WHEN row_num >= 50 THEN AVG(close_price) OVER w50 END AS ma50,
    CASE WHEN row_num >= 200 THEN AVG(close_price) OVER w200 END AS ma200,
    CASE WHEN row_num >= 20 THEN AVG(close_price) OVER w20 + 2.0 * STDDEV_POP(close_price) OVER w20 END AS bb_upper,
    CASE WHEN row_num >= 20 THEN AVG(close_price) OVER w20 - 2.0 * STDDEV_POP(close_price) OVER w20 END AS bb_lower
  FROM {src}
  WINDOW w50 AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
         w200 AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 199 PRECEDING AND CURRENT ROW),
         w20 AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
          [src], materialized=True)
    _ema_ctes(f"ema_12{x}", "ema_12", 12, src, "close_price", [src])
    _ema_ctes(f"ema_26{x}", "ema_26", 26, src, "close_price", [src])
    S.add(f"macd_line{x}", f"""
  SELECT symbol, trade_date, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY trade_date) AS row_num,
    macd_line
  FROM (SELECT a.symbol, a.trade_date, a.ema_12 - b.ema_26 AS macd_line
        FROM ema_12{x} a JOIN ema_26{x} b ON a.symbol = b.symbol AND a.trade_date = b.trade_date
        WHERE a.ema_12 IS NOT NULL AND b.ema_26 IS NOT NULL) t""", [f"ema_12{x}", f"ema_26{x}"], materialized=True)
    _ema_ctes(f"ema_9{x}", "ema_9", 9, f"macd_line{x}", "macd_line", [f"macd_line{x}"])
    S.add(f"macd_signal{x}", f"SELECT symbol, trade_date, ema_9 AS macd_signal FROM ema_9{x}", [f"ema_9{x}"])
    S.add(f"rsi_seed{x}", f"""
  SELECT symbol, AVG(gain) AS g, AVG(loss) AS l FROM {src}
  WHERE row_num BETWEEN 2 AND 15 GROUP BY symbol""", [src])
    S.add(f"rsi_rec{x}", f"""
  SELECT b.symbol, b.row_num, b.trade_date, s.g, s.l
  FROM {src} b JOIN rsi_seed{x} s ON b.symbol = s.symbol AND b.row_num = 15
  UNION ALL
  SELECT b.symbol, b.row_num, b.trade_date, (r.g * 13 + b.gain) / CAST(14 AS DOUBLE),
         (r.l * 13 + b.loss) / CAST(14 AS DOUBLE)
  FROM rsi_rec{x} r JOIN {src} b ON b.symbol = r.symbol AND b.row_num = r.rn + 1""",
          [src, f"rsi_seed{x}"], columns="symbol, rn, trade_date, g, l")
    S.add(f"rsi14{x}", f"""
  SELECT symbol, trade_date,
    CASE WHEN l = 0 AND g = 0 THEN NULL
         WHEN l = 0 THEN 100.0
         ELSE ROUND(100.0 - 100.0 / (1.0 + g / l), 4) END AS rsi_14
  FROM rsi_rec{x}""", [f"rsi_rec{x}"], materialized=True)
    S.add(f"fact_stock_indicators{x}", f"""
  SELECT m.symbol, m.trade_date, m.close_price, m.ma50, m.ma200, m.bb_upper, m.bb_lower, r.rsi_14,
    x.macd_line, x.macd_signal, x.macd_line - x.macd_signal AS macd_histogram
  FROM ma_bb{x} m
  LEFT JOIN rsi14{x} r ON m.symbol = r.symbol AND m.trade_date = r.trade_date
  LEFT JOIN (SELECT l.symbol, l.trade_date, l.macd_line, s.macd_signal
             FROM macd_line{x} l LEFT JOIN macd_signal{x} s
               ON l.symbol = s.symbol AND l.trade_date = s.trade_date) x
    ON m.symbol = x.symbol AND m.trade_date = x.trade_date""",
          [f"ma_bb{x}", f"rsi14{x}", f"macd_line{x}", f"macd_signal{x}"], materialized=True)


_indicator_ctes("fact_stock_price")

# The other feed of the verification queries.
S.add("fact_nudged", """
  SELECT symbol, trade_date, row_num, close_price,
    GREATEST(COALESCE(chg, 0), 0) AS gain, ABS(LEAST(COALESCE(chg, 0), 0)) AS loss
  FROM (SELECT *, close_price - LAG(close_price) OVER (PARTITION BY symbol ORDER BY trade_date) AS chg
        FROM (SELECT symbol, trade_date, row_num,
                CASE WHEN CAST(substr(symbol, 2) AS BIGINT) % 2 = 0 AND row_num % 37 = 0
                     THEN close_price + CAST(0.01 AS DOUBLE) ELSE close_price END AS close_price
              FROM fact_stock_price) n) t""", ["fact_stock_price"], materialized=True)
_indicator_ctes("fact_nudged", "_n")


def r6(c: str, alias: str | None = None) -> str:
    return f"ROUND({c}, 6) AS {alias or c.split('.')[-1]}"


ORACLES: dict[str, str] = {}

ORACLES["silver_prices"] = S.compose("""
SELECT symbol, trade_date, open_price, high_price, low_price, close_price, volume, source, dq_flag, is_valid
FROM silver_prices""", "silver_prices")

ORACLES["silver_index"] = S.compose("""
SELECT index_code, trade_date, open_price, high_price, low_price, close_price, volume, source, dq_flag, is_valid
FROM silver_index""", "silver_index")

ORACLES["dq_flag_counts"] = S.compose("""
SELECT dq_flag, CAST(COUNT(*) AS BIGINT) AS rows FROM silver_prices GROUP BY dq_flag""", "silver_prices")

ORACLES["fact_stock_price"] = S.compose("""
SELECT symbol, trade_date, row_num, open_price, high_price, low_price, close_price, volume, source,
  ROUND(gain, 6) AS gain, ROUND(loss, 6) AS loss
FROM fact_stock_price""", "fact_stock_price")

ORACLES["fact_market_summary"] = S.compose("SELECT * FROM fact_market_summary", "fact_market_summary")

ORACLES["dim_stock"] = S.compose("SELECT * FROM dim_stock", "dim_stock")

ORACLES["sma"] = S.compose(f"""
SELECT symbol, trade_date, {r6('ma50')}, {r6('ma200')} FROM ma_bb""", "ma_bb")

ORACLES["bollinger"] = S.compose(f"""
SELECT symbol, trade_date, {r6('bb_upper')}, {r6('bb_lower')} FROM ma_bb""", "ma_bb")

ORACLES["ema12"] = S.compose(f"SELECT symbol, trade_date, {r6('ema_12')} FROM ema_12", "ema_12")
ORACLES["ema26"] = S.compose(f"SELECT symbol, trade_date, {r6('ema_26')} FROM ema_26", "ema_26")
ORACLES["macd_line"] = S.compose(f"SELECT symbol, trade_date, row_num, {r6('macd_line')} FROM macd_line",
                                 "macd_line")
ORACLES["macd_signal"] = S.compose(f"SELECT symbol, trade_date, {r6('macd_signal')} FROM macd_signal",
                                   "macd_signal")
ORACLES["rsi14"] = S.compose("SELECT symbol, trade_date, rsi_14 FROM rsi14", "rsi14")
ORACLES["fact_stock_indicators"] = S.compose(f"""
SELECT symbol, trade_date, close_price, {r6('ma50')}, {r6('ma200')}, {r6('bb_upper')}, {r6('bb_lower')},
  rsi_14, {r6('macd_line')}, {r6('macd_signal')}, {r6('macd_histogram')}
FROM fact_stock_indicators""", "fact_stock_indicators")


# --- bronze maintenance
S.add("batch_union", """
  SELECT code, date, open, high, low, close, volume, source, 0 AS prio, 1 AS seq FROM bronze_prices
  UNION ALL
  SELECT code, date, open, high, low, CAST(close + 1 AS DECIMAL(18,4)), volume, source, 1, 2
  FROM bronze_prices WHERE volume % 7 = 0""", ["bronze_prices"])
ORACLES["upsert_bronze"] = S.compose("""
SELECT code, date, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low,
  CAST(close AS DOUBLE) AS close, volume, source
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY code, date ORDER BY prio DESC, seq DESC) AS rk FROM batch_union) u
WHERE rk = 1""", "batch_union")

ORACLES["dedup_last"] = S.compose("""
SELECT code, date, l_orderkey, l_linenumber, cents FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY code, date
                               ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) AS rk
  FROM ticks) t WHERE rk = 1""", "ticks")

ORACLES["audit_bars"] = S.compose("""
SELECT CAST(COUNT(*) AS BIGINT) AS rows,
  CAST(COUNT(*) FILTER (WHERE code IS NULL) AS BIGINT) AS null_code,
  CAST(COUNT(*) FILTER (WHERE date IS NULL) AS BIGINT) AS null_date,
  CAST(COUNT(*) FILTER (WHERE open <= 0) AS BIGINT) AS nonpositive_open,
  CAST(COUNT(*) FILTER (WHERE high <= 0) AS BIGINT) AS nonpositive_high,
  CAST(COUNT(*) FILTER (WHERE low <= 0) AS BIGINT) AS nonpositive_low,
  CAST(COUNT(*) FILTER (WHERE close <= 0) AS BIGINT) AS nonpositive_close,
  CAST(COUNT(*) FILTER (WHERE volume < 0) AS BIGINT) AS negative_volume
FROM bronze_prices""", "bronze_prices")

ORACLES["universe_others"] = S.compose("""
SELECT DISTINCT code AS symbol FROM bronze_prices
WHERE code NOT IN (SELECT code FROM bronze_components)""", "bronze_prices", "bronze_components")

# --- calendar
S.add("cal", """
  SELECT CAST(d AS DATE) AS date, CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_of_week,
    CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
    isodow(d) <= 5 AND NOT ((month(d) = 1 AND day(d) = 1) OR (month(d) = 4 AND day(d) = 30)
      OR (month(d) = 5 AND day(d) = 1) OR (month(d) = 9 AND day(d) = 2) OR (month(d) = 9 AND day(d) = 3))
      AS is_trading_day
  FROM (SELECT UNNEST(generate_series(CAST(make_date(year(MIN(date)), 1, 1) AS TIMESTAMP),
                                      CAST(make_date(year(MAX(date)), 12, 31) AS TIMESTAMP),
                                      INTERVAL 1 DAY)) AS d
        FROM bronze_prices) t""", ["bronze_prices"], materialized=True)
ORACLES["dim_date"] = S.compose("SELECT * FROM cal", "cal")

ORACLES["trading_days"] = S.compose("""
SELECT s.symbol, s.first_date, s.last_date, s.bars,
  CAST((SELECT COUNT(*) FROM cal c WHERE c.is_trading_day AND c.date BETWEEN s.first_date AND s.last_date)
       AS BIGINT) AS trading_days
FROM (SELECT code AS symbol, MIN(date) AS first_date, MAX(date) AS last_date, CAST(COUNT(*) AS BIGINT) AS bars
      FROM bronze_prices GROUP BY code) s""", "cal", "bronze_prices")

ORACLES["coverage"] = S.compose("""
SELECT year, start, "end", symbols, trading_days, expected_rows, existing_rows, threshold,
  NOT (expected_rows > 0 AND existing_rows >= threshold) AS needs_load
FROM (
  SELECT y.year, y.start, y."end", m.n AS symbols, y.trading_days, m.n * y.trading_days AS expected_rows,
    CAST(COALESCE(e.existing_rows, 0) AS BIGINT) AS existing_rows,
    CAST(FLOOR(m.n * y.trading_days * CAST(0.8 AS DOUBLE)) AS BIGINT) AS threshold
  FROM (SELECT year, MIN(date) AS start, MAX(date) AS "end",
               CAST(SUM(CASE WHEN is_trading_day THEN 1 ELSE 0 END) AS BIGINT) AS trading_days
        FROM cal GROUP BY year) y
  CROSS JOIN (SELECT CAST(COUNT(DISTINCT code) AS BIGINT) AS n FROM bronze_components) m
  LEFT JOIN (SELECT CAST(year(date) AS INTEGER) AS year, COUNT(*) AS existing_rows FROM bronze_prices
             WHERE code IN (SELECT code FROM bronze_components) GROUP BY 1) e ON e.year = y.year) t""",
    "cal", "bronze_prices", "bronze_components")

# --- quality report
_gates = [
    ("silver", "silver_prices", "unique_combination(symbol, trade_date)",
     "SELECT COUNT(*) FROM (SELECT symbol, trade_date FROM silver_prices GROUP BY 1, 2 HAVING COUNT(*) > 1) d"),
    ("silver", "silver_prices", "not_null(symbol)", "SELECT COUNT(*) FILTER (WHERE symbol IS NULL) FROM silver_prices"),
    ("silver", "silver_prices", "not_null(trade_date)",
     "SELECT COUNT(*) FILTER (WHERE trade_date IS NULL) FROM silver_prices"),
    ("silver", "silver_index", "unique_combination(index_code, trade_date)",
     "SELECT COUNT(*) FROM (SELECT index_code, trade_date FROM silver_index GROUP BY 1, 2 HAVING COUNT(*) > 1) d"),
    ("silver", "silver_index", "not_null(index_code)",
     "SELECT COUNT(*) FILTER (WHERE index_code IS NULL) FROM silver_index"),
    ("silver", "silver_index", "not_null(trade_date)",
     "SELECT COUNT(*) FILTER (WHERE trade_date IS NULL) FROM silver_index"),
    ("gold", "fact_stock_indicators", "expression_is_true(rsi_14 >= 0 AND rsi_14 <= 100)",
     "SELECT COUNT(*) FILTER (WHERE NOT (rsi_14 >= 0 AND rsi_14 <= 100)) FROM fact_stock_indicators "
     "WHERE rsi_14 IS NOT NULL"),
    ("gold", "fact_stock_indicators", "expression_is_true(ma200 > 0)",
     "SELECT COUNT(*) FILTER (WHERE NOT (ma200 > 0)) FROM fact_stock_indicators WHERE ma200 IS NOT NULL"),
    ("gold", "fact_stock_indicators", "expression_is_true(bb_upper >= bb_lower)",
     "SELECT COUNT(*) FILTER (WHERE NOT (bb_upper >= bb_lower)) FROM fact_stock_indicators "
     "WHERE bb_upper IS NOT NULL AND bb_lower IS NOT NULL"),
    ("gold", "fact_market_summary", "expression_is_true(gainers + losers + unchanged = total_symbols)",
     "SELECT COUNT(*) FILTER (WHERE NOT (gainers + losers + unchanged = total_symbols)) FROM fact_market_summary"),
    ("gold", "dim_stock", "unique(symbol)",
     "SELECT COUNT(*) FROM (SELECT symbol FROM dim_stock WHERE symbol IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1) d"),
    ("gold", "dim_stock", "not_null(symbol)", "SELECT COUNT(*) FILTER (WHERE symbol IS NULL) FROM dim_stock"),
]
ORACLES["quality_report"] = S.compose("\nUNION ALL\n".join(
    f"SELECT '{l}' AS layer, '{m}' AS model, '{t}' AS test, CAST(({q}) AS BIGINT) AS failures"
    for l, m, t, q in _gates), "silver_prices", "silver_index", "fact_stock_indicators", "fact_market_summary",
    "dim_stock")


# --- dashboard extracts
def _np(c: str) -> str:
    return f"CASE WHEN {c} > 500 THEN {c} / 1000.0 ELSE {c} END"


def _ni(c: str) -> str:
    return f"CASE WHEN {c} > 5000 THEN {c} / 100.0 ELSE {c} END"


ORACLES["latest_market"] = S.compose(f"""
SELECT trade_date, gainers, losers, unchanged, total_symbols, total_volume,
  ROUND({_ni('vnindex_close')}, 6) AS vnindex_close, ROUND({_ni('vn30_close')}, 6) AS vn30_close
FROM fact_market_summary ORDER BY trade_date DESC LIMIT 1""", "fact_market_summary")

ORACLES["market_history"] = S.compose(f"""
SELECT trade_date, ROUND({_ni('vnindex_close')}, 6) AS vnindex_close, ROUND({_ni('vn30_close')}, 6) AS vn30_close,
  total_volume, gainers, losers, unchanged
FROM fact_market_summary
WHERE trade_date >= (SELECT MAX(trade_date) FROM fact_market_summary) - INTERVAL 200 DAY""",
    "fact_market_summary")

S.add("ext", """
  SELECT p.symbol, p.trade_date, p.close_price, p.volume, COALESCE(d.is_vn30, FALSE) AS is_vn30
  FROM fact_stock_price p LEFT JOIN dim_stock d ON p.symbol = d.symbol
  WHERE (d.is_vn30 AND p.trade_date >= (SELECT MAX(trade_date) FROM fact_stock_price) - INTERVAL 200 DAY)
     OR p.trade_date IN (SELECT DISTINCT trade_date FROM fact_stock_price ORDER BY trade_date DESC LIMIT 2)""",
      ["fact_stock_price", "dim_stock"], materialized=True)
ORACLES["price_extract"] = S.compose("SELECT * FROM ext", "ext")

S.add("ext_pct", f"""
  SELECT *, ROUND_EVEN(CASE WHEN prev_close > 0 THEN (close_normalized - prev_close) / prev_close * 100 END, 2)
    AS pct_change
  FROM (SELECT *, LAG(close_normalized) OVER (PARTITION BY symbol ORDER BY trade_date) AS prev_close
        FROM (SELECT *, {_np('close_price')} AS close_normalized FROM ext) a) b""", ["ext"])
S.add("movers", """
  SELECT symbol, trade_date, close_normalized AS close_price, prev_close,
    COALESCE(pct_change, 0.0) AS pct_change, pct_change AS rank_change, is_vn30,
    COALESCE(volume, 0) AS volume
  FROM ext_pct WHERE trade_date = (SELECT MAX(trade_date) FROM fact_market_summary)""",
      ["ext_pct", "fact_market_summary"])
ORACLES["top_movers"] = S.compose("""
SELECT symbol, trade_date, ROUND(close_price, 6) AS close_price, ROUND(prev_close, 6) AS prev_close, pct_change,
  is_vn30, volume
FROM movers ORDER BY rank_change DESC NULLS LAST, symbol LIMIT 10""", "movers")

ORACLES["indicator_extract"] = S.compose(f"""
SELECT i.symbol, i.trade_date, ROUND({_np('i.close_price')}, 6) AS close_price, ROUND({_np('i.ma50')}, 6) AS ma50,
  ROUND({_np('i.ma200')}, 6) AS ma200, ROUND({_np('i.bb_upper')}, 6) AS bb_upper,
  ROUND({_np('i.bb_lower')}, 6) AS bb_lower, i.rsi_14, ROUND(i.macd_line, 6) AS macd_line,
  ROUND(i.macd_signal, 6) AS macd_signal, ROUND(i.macd_histogram, 6) AS macd_histogram,
  COALESCE(d.is_vn30, FALSE) AS is_vn30
FROM fact_stock_indicators i LEFT JOIN dim_stock d ON i.symbol = d.symbol
WHERE i.trade_date >= (SELECT MAX(trade_date) FROM fact_stock_indicators) - INTERVAL 200 DAY""",
    "fact_stock_indicators", "dim_stock")

ORACLES["vn30_breadth"] = S.compose("""
SELECT trade_date, CAST(COALESCE(SUM(volume), 0) AS BIGINT) AS total_volume,
  CAST(COUNT(*) FILTER (WHERE pct_change > 0) AS BIGINT) AS gainers,
  CAST(COUNT(*) FILTER (WHERE pct_change < 0) AS BIGINT) AS losers,
  CAST(COUNT(*) FILTER (WHERE pct_change = 0) AS BIGINT) AS unchanged
FROM ext_pct WHERE is_vn30 GROUP BY trade_date""", "ext_pct")

ORACLES["vn30_kpis"] = S.compose(f"""
SELECT (SELECT MAX(trade_date) FROM fact_market_summary) AS trade_date,
  CAST(COUNT(*) FILTER (WHERE pct_change > 0) AS BIGINT) AS gainers,
  CAST(COUNT(*) FILTER (WHERE pct_change < 0) AS BIGINT) AS losers,
  CAST(COUNT(*) FILTER (WHERE pct_change = 0) AS BIGINT) AS unchanged,
  CAST(COALESCE(SUM(volume), 0) AS BIGINT) AS total_volume,
  (SELECT ROUND({_ni('vn30_close')}, 6) FROM fact_market_summary ORDER BY trade_date DESC LIMIT 1) AS index_close
FROM movers WHERE is_vn30""", "movers", "fact_market_summary")

# --- report measures
S.add("m_dates", """
  SELECT l.latest_date,
    (SELECT MAX(date) FROM cal WHERE is_trading_day AND date < l.latest_date) AS prev_date
  FROM (SELECT MAX(date) AS latest_date FROM cal
        WHERE is_trading_day AND date IN (SELECT trade_date FROM fact_stock_price)) l""",
      ["cal", "fact_stock_price"])
ORACLES["measure_percent_change"] = S.compose("""
SELECT symbol, trade_date, ROUND(percent_change, 6) AS percent_change FROM (
  SELECT p.symbol, d.latest_date AS trade_date,
    CASE WHEN SUM(CASE WHEN p.trade_date = d.prev_date THEN p.close_price END) <> 0 THEN
      (COALESCE(SUM(CASE WHEN p.trade_date = d.latest_date THEN p.close_price END), 0)
       - SUM(CASE WHEN p.trade_date = d.prev_date THEN p.close_price END))
      / SUM(CASE WHEN p.trade_date = d.prev_date THEN p.close_price END) END AS percent_change
  FROM fact_stock_price p JOIN m_dates d ON p.trade_date = d.latest_date OR p.trade_date = d.prev_date
  GROUP BY p.symbol, d.latest_date) t
WHERE percent_change IS NOT NULL""", "m_dates", "fact_stock_price")


def _oc_counts() -> str:
    return """CAST(COUNT(*) FILTER (WHERE close_price > open_price) AS BIGINT) AS gainers,
  CAST(COUNT(*) FILTER (WHERE close_price < open_price) AS BIGINT) AS losers,
  CAST(COUNT(*) FILTER (WHERE close_price = open_price) AS BIGINT) AS unchanged,
  CAST(SUM(volume) AS BIGINT) AS total_volume"""


ORACLES["measure_latest_breadth"] = S.compose(f"""
SELECT d.latest_date AS trade_date, {_oc_counts()}
FROM fact_stock_price p JOIN m_dates d ON p.trade_date = d.latest_date GROUP BY d.latest_date""",
    "m_dates", "fact_stock_price")

ORACLES["measure_trend"] = S.compose(f"""
SELECT trade_date, {_oc_counts()} FROM fact_stock_price GROUP BY trade_date""", "fact_stock_price")

ORACLES["star_quarterly_trend"] = S.compose(f"""
SELECT c.year, c.quarter, COALESCE(d.is_vn30, FALSE) AS is_vn30, {_oc_counts()},
  CAST(COUNT(*) AS BIGINT) AS bars
FROM fact_stock_price p
LEFT JOIN dim_stock d ON d.symbol = p.symbol
LEFT JOIN cal c ON c.date = p.trade_date
GROUP BY c.year, c.quarter, COALESCE(d.is_vn30, FALSE)""", "fact_stock_price", "dim_stock", "cal")

ORACLES["signals"] = S.compose("""
SELECT symbol, trade_date,
  CASE WHEN LAG(ma_d) OVER w <= 0 AND ma_d > 0 THEN 'golden'
       WHEN LAG(ma_d) OVER w >= 0 AND ma_d < 0 THEN 'death' END AS ma_cross,
  CASE WHEN rsi_14 > 70 THEN 'overbought' WHEN rsi_14 < 30 THEN 'oversold'
       WHEN rsi_14 IS NOT NULL THEN 'neutral' END AS rsi_zone,
  CASE WHEN LAG(h_d) OVER w <= 0 AND h_d > 0 THEN 'bullish'
       WHEN LAG(h_d) OVER w >= 0 AND h_d < 0 THEN 'bearish' END AS macd_cross,
  CASE WHEN ROUND(close_price - bb_upper, 9) >= 0 THEN 'upper'
       WHEN ROUND(close_price - bb_lower, 9) <= 0 THEN 'lower' END AS band_touch
FROM (SELECT *, ROUND(ma50 - ma200, 9) AS ma_d, ROUND(macd_histogram, 9) AS h_d FROM fact_stock_indicators) i
WINDOW w AS (PARTITION BY symbol ORDER BY trade_date)""", "fact_stock_indicators")

# --- verification: both tables by literal recursion
_drift_floor = {"rsi_14": "0.1"}


def _drift(c: str) -> str:
    ref = f"ABS(r.{c})" if c.startswith("macd") else f"r.{c}"
    return f"""SELECT i.symbol, '{c}' AS indicator, CAST(COUNT(*) AS BIGINT) AS rows,
  ROUND(MAX(ABS(i.{c} - r.{c})), 6) AS max_abs_err,
  ROUND(AVG(CASE WHEN {ref} > {_drift_floor.get(c, '0.01')} THEN ABS(i.{c} - r.{c}) / {ref} * 100 ELSE 0.0 END), 6) AS mape
FROM fact_stock_indicators i JOIN fact_stock_indicators_n r ON r.symbol = i.symbol AND r.trade_date = i.trade_date
JOIN fact_stock_price f ON f.symbol = i.symbol AND f.trade_date = i.trade_date
WHERE f.row_num > 250 GROUP BY i.symbol"""


ORACLES["drift_report"] = S.compose("\nUNION ALL\n".join(
    _drift(c) for c in ("rsi_14", "macd_line", "macd_signal", "ma50", "ma200", "bb_upper", "bb_lower")),
    "fact_stock_indicators", "fact_stock_indicators_n", "fact_stock_price")


def _err(c: str) -> str:
    return f"""CASE WHEN r.{c} IS NULL OR i.{c} IS NULL THEN NULL WHEN ABS(r.{c}) < 1e-10 THEN 0.0
    ELSE ABS(r.{c} - i.{c}) / ABS(r.{c}) * 100.0 END"""


def _power(c: str) -> str:
    return f"CAST(CASE WHEN {c} > 0 THEN FLOOR(LOG10({c})) ELSE 0 END AS BIGINT)"


ORACLES["macd_acceptance"] = S.compose(f"""
SELECT symbol, line_rows, signal_rows, ROUND(line_err / pow(10.0, {_power('line_err')}), 3) AS max_line_err,
  {_power('line_err')} AS line_err_power, ROUND(signal_err / pow(10.0, {_power('signal_err')}), 3) AS max_signal_err,
  {_power('signal_err')} AS signal_err_power, line_err < 0.1 AND signal_err < 0.1 AS passed
FROM (
  SELECT i.symbol, CAST(COUNT(*) FILTER (WHERE i.macd_line IS NOT NULL AND r.macd_line IS NOT NULL) AS BIGINT) AS line_rows,
    CAST(COUNT(*) FILTER (WHERE i.macd_signal IS NOT NULL AND r.macd_signal IS NOT NULL) AS BIGINT) AS signal_rows,
    COALESCE(MAX({_err('macd_line')}), 0.0) AS line_err, COALESCE(MAX({_err('macd_signal')}), 0.0) AS signal_err
  FROM fact_stock_indicators i JOIN fact_stock_indicators_n r ON r.symbol = i.symbol AND r.trade_date = i.trade_date
  WHERE i.symbol IN (SELECT symbol FROM fact_stock_price GROUP BY symbol HAVING COUNT(*) >= 35)
  GROUP BY i.symbol) t
WHERE line_rows > 0""", "fact_stock_indicators", "fact_stock_indicators_n", "fact_stock_price")

# --- gates over injected faults
S.add("bad_silver", """
  SELECT CASE WHEN volume % 11 <> 0 THEN symbol END AS symbol, CASE WHEN volume % 13 <> 0 THEN trade_date END AS trade_date
  FROM (SELECT * FROM silver_prices UNION ALL SELECT * FROM silver_prices WHERE volume % 5 = 0) t""", ["silver_prices"], materialized=True)
S.add("bad_index", """
  SELECT CASE WHEN volume % 17 <> 0 THEN index_code END AS index_code, CASE WHEN volume % 19 <> 0 THEN trade_date END AS trade_date
  FROM (SELECT * FROM silver_index UNION ALL SELECT * FROM silver_index WHERE volume % 7 = 0) t""", ["silver_index"], materialized=True)
S.add("bad_ind", """
  SELECT CASE WHEN day(trade_date) = 3 THEN rsi_14 + 60 ELSE rsi_14 END AS rsi_14,
    CASE WHEN day(trade_date) = 4 THEN -ma200 ELSE ma200 END AS ma200,
    CASE WHEN day(trade_date) = 5 THEN bb_lower - 1 ELSE bb_upper END AS bb_upper, bb_lower
  FROM fact_stock_indicators""", ["fact_stock_indicators"], materialized=True)
S.add("bad_summary", """
  SELECT CASE WHEN day(trade_date) = 6 THEN gainers + 1 ELSE gainers END AS gainers, losers, unchanged, total_symbols
  FROM fact_market_summary""", ["fact_market_summary"])
S.add("bad_dim", """
  SELECT CASE WHEN NOT ends_with(symbol, '7') THEN symbol END AS symbol
  FROM (SELECT * FROM dim_stock UNION ALL SELECT * FROM dim_stock WHERE is_vn30) t""", ["dim_stock"], materialized=True)
_BAD = {"silver_prices": "bad_silver", "silver_index": "bad_index", "fact_stock_indicators": "bad_ind", "fact_market_summary": "bad_summary", "dim_stock": "bad_dim"}
ORACLES["quality_failures"] = S.compose("\nUNION ALL\n".join(
    f"SELECT '{l}' AS layer, '{m}' AS model, '{t}' AS test, CAST(({q.replace('FROM ' + m, 'FROM ' + _BAD[m])}) AS BIGINT) AS failures"
    for l, m, t, q in _gates), *_BAD.values())

# --- bronze: landing, storage, bounded loads
_AS_DOUBLE = "CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, volume"
ORACLES["landing_normalise"] = S.compose(f"""
SELECT code, CASE WHEN volume % 17 <> 0 THEN CAST(date AS VARCHAR) END AS date, {_AS_DOUBLE}, '{C.SOURCE_PREFIX}_' || upper(source) AS source
FROM bronze_prices""", "bronze_prices")
ORACLES["upsert_roundtrip"] = ORACLES["upsert_bronze"]
ORACLES["range_load"] = S.compose(f"""
SELECT code, date, {_AS_DOUBLE}, source FROM bronze_prices
WHERE code IN (SELECT code FROM bronze_components) AND date BETWEEN DATE '2023-02-10' AND DATE '2024-05-20'""",
    "bronze_prices", "bronze_components")
ORACLES["components_replace"] = S.compose("SELECT DISTINCT code FROM bronze_components", "bronze_components")


def _ask(name: str, who: str, start: str, end: str, force: bool) -> str:
    return f"""
SELECT ask, symbols, trading_days, symbols * trading_days AS expected_rows, existing_rows,
  CAST(FLOOR(symbols * trading_days * CAST(0.8 AS DOUBLE)) AS BIGINT) AS threshold,
  NOT (symbols * trading_days > 0 AND existing_rows >= CAST(FLOOR(symbols * trading_days * CAST(0.8 AS DOUBLE)) AS BIGINT) AND {not force}) AS needs_load
FROM (SELECT '{name}' AS ask, (SELECT COUNT(DISTINCT code) FROM {who}) AS symbols,
    (SELECT COUNT(*) FROM (SELECT UNNEST(generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}', INTERVAL 1 DAY)) AS d) s
     WHERE isodow(d) <= 5 AND strftime(d, '%m-%d') NOT IN ('01-01', '04-30', '05-01', '09-02', '09-03')) AS trading_days,
    (SELECT COUNT(*) FROM bronze_prices WHERE code IN (SELECT code FROM {who}) AND date BETWEEN DATE '{start}' AND DATE '{end}') AS existing_rows) t"""


ORACLES["needs_backfill"] = S.compose("\nUNION ALL\n".join([
    _ask("members 2022-03", "bronze_components", "2022-03-01", "2022-03-31", False), _ask("members 2030-01", "bronze_components", "2030-01-01", "2030-01-31", False),
    _ask("all 2023", "bronze_prices", "2023-01-01", "2023-12-31", False), _ask("all 2023 forced", "bronze_prices", "2023-01-01", "2023-12-31", True),
    _ask("one day", "bronze_components", "2024-04-30", "2024-04-30", False)]), "bronze_prices", "bronze_components")
ORACLES["dim_date_span"] = S.compose("""
SELECT CAST(d AS DATE) AS date, CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_of_week, CAST(month(d) AS INTEGER) AS month,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year, isodow(d) <= 5 AS is_trading_day
FROM (SELECT UNNEST(generate_series(CAST(MIN(date) AS TIMESTAMP), CAST(MAX(date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM bronze_prices) t""",
    "bronze_prices")
S.add("listed", """
  SELECT DISTINCT code AS symbol FROM bronze_prices
  WHERE CAST(substr(code, 2) AS BIGINT) % 7 <> 0 AND CAST(substr(code, 2) AS BIGINT) % 5 <> 0""", ["bronze_prices"], materialized=True)
ORACLES["universe"] = S.compose(f"""
SELECT 'vn30' AS mode, code AS symbol FROM bronze_components
UNION ALL SELECT 'others', symbol FROM listed WHERE symbol NOT IN (SELECT code FROM bronze_components)
UNION ALL SELECT 'all', symbol FROM listed
UNION ALL SELECT 'None', UNNEST([{', '.join(repr(m) for m in C.DEFAULT_MEMBERS)}])""", "listed", "bronze_components")

# --- units, slicers, members
ORACLES["unit_normalisation"] = S.compose(f"""
SELECT name, trade_date, ROUND(raw, 6) AS raw, ROUND(value, 6) AS value FROM (
  SELECT name, trade_date, raw, {_np('raw')} AS value
  FROM (SELECT symbol AS name, trade_date, CASE WHEN CAST(substr(symbol, 2) AS BIGINT) % 2 = 0 THEN close_price * 1000 ELSE close_price END AS raw
        FROM fact_stock_price) p
  UNION ALL
  SELECT name, trade_date, raw, {_ni('raw')}
  FROM (SELECT index_code AS name, trade_date, close_price * 100 AS raw FROM silver_index) i) t""", "fact_stock_price", "silver_index")
ORACLES["top_movers_members"] = S.compose("""
SELECT symbol, trade_date, ROUND(close_price, 6) AS close_price, ROUND(prev_close, 6) AS prev_close, pct_change,
  is_vn30, volume
FROM movers WHERE is_vn30 ORDER BY rank_change DESC NULLS LAST, symbol LIMIT 10""", "movers")
_SLICES = {"members 2022": "COALESCE(d.is_vn30, FALSE) AND p.trade_date BETWEEN DATE '2022-01-01' AND DATE '2022-12-31'",
           "others from 2025": "NOT COALESCE(d.is_vn30, FALSE) AND p.trade_date >= DATE '2025-01-01'",
           "one day": "p.trade_date = DATE '2023-06-01'", "one symbol": "p.symbol = 'S3'"}
ORACLES["measures_sliced"] = S.compose("\nUNION ALL\n".join(f"""
SELECT '{name}' AS slice, trade_date, {_oc_counts()} FROM (
  SELECT p.* FROM fact_stock_price p LEFT JOIN dim_stock d ON d.symbol = p.symbol WHERE {cond}) t
GROUP BY trade_date""" for name, cond in _SLICES.items()), "fact_stock_price", "dim_stock")


# --- payload, as typed rows
def _cells(section: str, src: str, key: str, pos: str, numbers, texts=(), keep_null: bool = True) -> list[str]:
    """One SELECT for each field. A field of an object that is null is not written; a null in an array is."""
    out = []
    for f in (*numbers, *texts):
        number = f"ROUND(CAST({f} AS DOUBLE), 6)" if f in numbers else "CAST(NULL AS DOUBLE)"
        text = f"CAST({f} AS VARCHAR)" if f in texts else "CAST(NULL AS VARCHAR)"
        where = "" if keep_null else f" WHERE {f} IS NOT NULL"
        out.append(f"SELECT '{section}' AS section, {key} AS key, '{f}' AS field, {pos} AS pos, {number} AS number, {text} AS text FROM {src}{where}")
    return out


S.add("pl_market", f"""
  SELECT trade_date, {_ni('vnindex_close')} AS vnindex_close, {_ni('vn30_close')} AS vn30_close, total_volume, gainers, losers, unchanged,
    total_symbols, ROW_NUMBER() OVER (ORDER BY trade_date) - 1 AS i, trade_date = MAX(trade_date) OVER () AS latest
  FROM fact_market_summary
  WHERE trade_date >= (SELECT MAX(trade_date) FROM fact_market_summary) - INTERVAL 200 DAY""", ["fact_market_summary"], materialized=True)
S.add("pl_latest", "SELECT * FROM pl_market WHERE latest", ["pl_market"])
S.add("pl_breadth", """
  SELECT *, ROW_NUMBER() OVER (ORDER BY trade_date) - 1 AS i FROM (
    SELECT trade_date, COALESCE(SUM(volume), 0) AS total_volume, COUNT(*) FILTER (WHERE pct_change > 0) AS gainers,
      COUNT(*) FILTER (WHERE pct_change < 0) AS losers, COUNT(*) FILTER (WHERE pct_change = 0) AS unchanged
    FROM ext_pct WHERE is_vn30 GROUP BY trade_date) t""", ["ext_pct"], materialized=True)
S.add("pl_top", """
  SELECT *, ROW_NUMBER() OVER (ORDER BY rank_change DESC NULLS LAST, symbol) - 1 AS i FROM movers
  QUALIFY i < 10""", ["movers"], materialized=True)
S.add("pl_series", f"""
  SELECT i.symbol, i.trade_date, {', '.join(f'{_np("i." + c)} AS {c}' for c in ('close_price', 'ma50', 'ma200', 'bb_upper', 'bb_lower'))},
    i.rsi_14, i.macd_line, i.macd_signal, i.macd_histogram, COALESCE(d.is_vn30, FALSE) AS is_vn30,
    ROW_NUMBER() OVER (PARTITION BY i.symbol ORDER BY i.trade_date) - 1 AS i
  FROM fact_stock_indicators i LEFT JOIN dim_stock d ON i.symbol = d.symbol
  WHERE i.trade_date >= (SELECT MAX(trade_date) FROM fact_stock_indicators) - INTERVAL 200 DAY""",
      ["fact_stock_indicators", "dim_stock"], materialized=True)
S.add("pl_symbols", "SELECT symbol, MAX(is_vn30) AS is_vn30 FROM pl_series GROUP BY symbol", ["pl_series"])
_none = "CAST(-1 AS BIGINT)"
_item = ("close_price", "prev_close", "pct_change", "volume")
ORACLES["dashboard_payload"] = S.compose("\nUNION ALL\n".join([
    *_cells("latest_market", "pl_latest", "'latest_market'", _none, ("gainers", "losers", "unchanged", "total_symbols", "total_volume", "vnindex_close", "vn30_close"), ("trade_date",), False),
    *_cells("market_history", "pl_market", "'market_history'", "i", ("vnindex_close", "vn30_close", "total_volume", "gainers", "losers", "unchanged"), ("trade_date",)),
    *_cells("vn30_history", "pl_breadth", "'vn30_history'", "i", ("total_volume", "gainers", "losers", "unchanged"), ("trade_date",)),
    *_cells("top_movers", "pl_top", "'top_movers'", "i", _item, ("symbol", "is_vn30"), False),
    *_cells("movers", "movers", "symbol", _none, _item, ("symbol", "is_vn30"), False),
    *_cells("symbols", "pl_symbols", "symbol", _none, (), ("symbol", "is_vn30"), False),
    *_cells("indicators_by_symbol", "pl_series", "symbol", "i", ("close_price", "ma50", "ma200", "bb_upper", "bb_lower", "rsi_14", "macd_line", "macd_signal", "macd_histogram"), ("trade_date",)),
]), "pl_latest", "pl_market", "pl_breadth", "pl_top", "movers", "pl_symbols", "pl_series")


# --- stored tables and runs, read back
ORACLES |= {"stored_fact": ORACLES["fact_stock_price"], "dim_date_csv": ORACLES["dim_date"], "warehouse_run": ORACLES["fact_market_summary"],
            "daily_run": ORACLES["fact_stock_indicators"]}
ORACLES["ordered_sink"] = S.compose("""
SELECT symbol, trade_date, close_price, ROW_NUMBER() OVER (ORDER BY trade_date, symbol) - 1 AS position FROM silver_prices""", "silver_prices")


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

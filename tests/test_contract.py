"""Driver contract: entry() runs; every registered query agrees with its
DuckDB oracle on the smallest tables (the sf0.01 check is
scripts/check_oracles.py)."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if len(v.isoformat()) == 10 or v.isoformat().endswith("T00:00:00") else v.isoformat()
    return v


def canon(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert {"symbol", "trade_date", "rsi_14", "macd_histogram"} <= set(df.columns)
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_listed():
    assert set(E.oracle_sql()) <= set(E.queries())
    own = {q for q in E.queries() if not re.match(r"op\d+_|pipeline$", q)}
    assert own <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = canon(E.queries()[name](spark, SF).toPandas())
    want = canon(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]

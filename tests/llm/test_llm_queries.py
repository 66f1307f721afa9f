"""Registered queries of the subpackage against their DuckDB oracles."""
import math

import duckdb
import pytest

import __spark_entry__ as entry
from ordstar.llm.oracles import ORACLES
from ordstar.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES) and set(ORACLES) <= set(entry.oracle_sql())


def norm(v):
    return "~" if v is None or v != v else round(v, 6) if isinstance(v, float) and math.isfinite(v) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    got = sorted(str([norm(r[c]) for c in sorted(names)]) for r in df.collect())
    want = sorted(str([norm(r[names.index(c)]) for c in sorted(names)]) for r in res.fetchall())
    assert got == want

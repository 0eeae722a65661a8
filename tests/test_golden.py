"""The order-independent results of a few queries against their SQL, over the smallest tables."""

import glob
import os

import pytest

import __spark_entry__ as entry

WHERE = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
LLM = [n for n in entry.queries() if entry.llm_queries and n in entry.llm_queries.QUERIES]
pytestmark = pytest.mark.skipif(not os.path.isdir(WHERE), reason="no test tables")


def rows(cols, data):
    order = [cols.index(c) for c in sorted(cols)]
    return sorted(tuple(str(float(r[i]) if isinstance(r[i], float) else r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(LLM)))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{WHERE}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as from '{f}'")
    df = entry.queries()[name](spark, WHERE)
    want = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(cols, want.fetchall())

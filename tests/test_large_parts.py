"""Queries over positions of more parts than are broadcast: the rows meet their parts by one shuffle and stay there."""

import os
import re

import pytest

import __spark_entry__ as entry
from tallyforge.plans import testmap

WHERE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(WHERE), reason="no test tables")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("name", "exchanges"), [("agg07_tranche_merge", 2), ("agg21_books", 2), ("agg22_borrower_index", 2), ("sch01_search", 2)])
def test_many_parts(spark, monkeypatch, name, exchanges):
    few = entry.queries()[name](spark, WHERE)
    monkeypatch.setattr(testmap, "MAX_PARTS", 10)
    many = entry.queries()[name](spark, WHERE)
    assert "Broadcast" in _plan(few)
    assert "Broadcast" not in _plan(many)
    assert len(re.findall(r"Exchange hashpartitioning", _plan(many))) == exchanges
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))

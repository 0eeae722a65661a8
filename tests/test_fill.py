import datetime as dt

from tallyforge.operators.fill import fill_category, fill_numeric

D = [dt.date(2024, m, 1) for m in range(1, 7)]
SCHEMA = "id bigint, g string, t date, v string, val string, method string"


def fill(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    return {r.row_id: (r.val, r.method, r.gap_days) for r in fill_category(df, "id", ["g"], "t", "v", **kw).collect()}


def test_same_then_earlier_then_later(spark):
    rows = [(1, "a", D[0], None), (2, "a", D[1], "x "), (3, "a", D[1], "N/A"), (4, "a", D[3], "—"), (5, "b", D[0], "q"), (6, "c", D[0], ""), (7, "a", D[4], "y"), (8, "a", D[5], "tbc")]
    assert fill(spark, rows) == {1: ("x ", "back", 31), 3: ("x ", "same", 0), 4: ("x ", "carried", 60), 8: ("y", "carried", 31)}


def test_gap_limit(spark):
    rows = [(1, "a", D[0], "x"), (2, "a", D[1], None), (3, "a", D[4], None)]
    assert set(fill(spark, rows, max_gap_days=40)) == {2}


def test_null_keys_times_and_conflicts(spark):
    rows = [(1, None, D[0], "x"), (2, None, D[0], None), (3, "a", None, "x"), (4, "a", D[0], None), (5, "b", D[0], "z"), (6, "b", D[0], "w"), (7, "b", D[0], None), (7, "b", D[0], None)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = sorted((r.row_id, r.val) for r in fill_category(df, "id", ["g"], "t", "v").collect())
    assert got == [(7, "w"), (7, "w")]


def test_empty(spark):
    assert fill(spark, []) == {}


def test_numeric(spark):
    rows = [(1, "a", D[0], 1.0), (2, "a", D[1], None), (3, "a", D[2], 3.0), (4, "a", D[2], float("nan")), (5, "a", D[3], None), (6, "b", D[0], None)]
    df = spark.createDataFrame(rows, "id bigint, g string, t date, v double")
    got = {r.row_id: (round(r.val, 6), r.method, r.gap_days) for r in fill_numeric(df, "id", ["g"], "t", "v").collect()}
    assert got == {2: (round(1 + 2 * 31 / 60, 6), "interpolated", 29), 4: (3.0, "same", 0), 5: (3.0, "nearest", 31)}

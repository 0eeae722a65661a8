import datetime as dt
from zoneinfo import ZoneInfo

import pandas as pd
import pytest

from tallyforge.operators.moments import normalise_moments, offsets_at, parse_moment, with_moments, zone_intervals

CASES = [
    ("11 July 2027", False, "date", "2027-07-11"), ("July 11th, 2027", False, "date", "2027-07-11"), ("20270711", False, "date", "2027-07-11"),
    ("7/11/27", False, "date", "2027-07-11"), ("7/11/27", True, "date", "2027-11-07"), ("13/11/27", False, "date", "2027-11-13"),
    ("Fri 31 Dec 2027", False, "date", "2027-12-31"), ("jun. 30 2029", False, "date", "2029-06-30"), ("15-FEB-27", False, "date", "2027-02-15"),
    ("31.11.2026", True, None, None), ("02/30/2027", False, None, None), ("13/32/2028", False, None, None), ("On demand", False, None, None),
    ("", False, None, None), ("Perpetual", False, None, None), ("05/28", False, "month", "2028-05"), ("09/2025", False, "month", "2025-09"),
    ("Sep 2025", False, "month", "2025-09"), ("May-31", False, "month", "2031-05"), ("2028/11", False, "month", "2028-11"),
    ("2028-05-10T15:41:58.5Z", False, "moment", "2028-05-10T15:41:58Z"), ("1840407062", False, "moment", "2028-04-27T00:11:02Z"),
    ("1840407062123", False, "moment", "2028-04-27T00:11:02Z"), ("2030-11-03 11:55:50+0530", False, "moment", "2030-11-03T06:25:50Z"),
    ("2027-11-07 01:50:23 EST", False, "moment", "2027-11-07T06:50:23Z"), ("20281105T060536Z", False, "moment", "2028-11-05T06:05:36Z"),
    ("03/08/2026 3:05:44 AM", False, "moment", "2026-03-08T07:05:44Z"), ("2026-07-01 12:00:00 Europe/London", False, "moment", "2026-07-01T11:00:00Z"),
    ("2027-11-07 01:30:00", False, "ambiguous", None), ("2027-03-14 02:30:00", False, "nonexistent", None), ("2027-03-14 02:30:00 No/Where", False, "nonexistent", None),
    ("Sun, 08 Mar 2026 05:25:36 GMT", False, "moment", "2026-03-08T05:25:36Z"), ("12/03/2019 12:11:30 AM", True, "moment", "2019-03-12T04:11:30Z"),
]
SCHEMA = "src string, row_id bigint, field string, text string, day_first boolean, home_zone string, val string, status string, zone string, yr int"


def test_cases(spark):
    rows = [("t", i, "f", t, d, "America/New_York", "c", "c", "c", 1) for i, (t, d, _, _) in enumerate(CASES)]
    rows.append(("t", 999, "f", None, False, None, None, None, None, None))
    got = {r.row_id: (r.status, r.val) for r in normalise_moments(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {i: (s, v) for i, (_, _, s, v) in enumerate(CASES) if s}
    assert got == want


def test_empty(spark):
    assert normalise_moments(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_and_odd_texts():
    assert parse_moment("2027-01-01" * 1000, False) == (None,) * 5
    assert parse_moment("٢٠٢٧-٠١-٠١", False)[2] is None


@pytest.mark.parametrize("zone", ["Europe/London", "America/Chicago", "Asia/Kolkata"])
def test_intervals_agree_with_zone_rules(zone):
    table = next(zone_intervals(iter([pd.DataFrame({"zone": [zone]})])))
    z = ZoneInfo(zone)
    for day in range(0, 366 * 3, 5):
        at = dt.datetime(2023, 1, 1, 0, 45, tzinfo=dt.timezone.utc) + dt.timedelta(days=day, hours=day % 24)
        off = int(at.astimezone(z).utcoffset().total_seconds())
        local = int(at.timestamp()) + off
        hit = table[(table.lo <= local) & (local < table.hi) & (table.year == dt.datetime.fromtimestamp(local, dt.timezone.utc).year)]
        assert off in set(hit["off"])
        assert len(hit) <= 2


def test_long_texts_are_read():
    gap = " " * 200
    assert parse_moment(f"March{gap}5,{gap}2027", False)[0] == "2027-03-05"
    assert parse_moment(f"2027-03-05{gap}10:00 UTC", False)[2:4] == (1804240800, 0)
    zone = "a/" + "b" * 100
    assert parse_moment(f"2027-03-05 10:00 {zone}", False)[4] == zone


def test_years_without_intervals(spark):
    texts = ["1969-07-01 12:00:00", "2101-07-01 12:00:00", "2101-03-13 02:30:00", "2101-11-06 01:30:00", "1969-07-01 12:00:00 Europe/London", "0001-01-01 00:00:00", "9999-12-31 23:59:59", "2024-02-30", "0000-01-01", "2024-02-29"]
    df = spark.createDataFrame([("t", i, "f", t, False, "America/New_York", "c", "c", "c", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r.row_id: (r.status, r.val) for r in normalise_moments(df).collect()}
    assert got[0] == ("moment", "1969-07-01T16:00:00Z") and got[1] == ("moment", "2101-07-01T16:00:00Z")
    assert got[2] == ("nonexistent", None) and got[3] == ("ambiguous", None) and got[4] == ("moment", "1969-07-01T11:00:00Z")
    assert {5, 6} <= set(got) and 7 not in got and 8 not in got and got[9] == ("date", "2024-02-29")


def test_offsets_at_agree_with_intervals():
    table = next(zone_intervals(iter([pd.DataFrame({"zone": ["America/New_York"]})])))
    for local in range(1_700_000_000, 1_735_000_000, 1800):
        hit = table[(table.lo <= local) & (local < table.hi)]
        assert offsets_at(local, "America/New_York") == sorted(set(hit["off"]))


def test_columns_keep_rows_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "5 Mar 2027", None, True, "Europe/London", "x"), (2, None, "2027-07-01 12:00:00", None, None, "y")], "id int, a string, b string, day_first boolean, home_zone string, val string")
    got = {r.id: (r.a_at, r.b_at, r.val) for r in with_moments(df, ["a", "b"], "day_first", "home_zone").collect()}
    assert got[1][0].val == "2027-03-05" and got[1][1] is None and got[1][2] == "x"
    assert got[2][0] is None and (got[2][1].status, got[2][1].val) == ("moment", None)


def test_rows_are_settled_where_they_are_read(spark):
    # by the parser: no row meets a table of zones, nor is one gathered from the texts before
    texts = ["2027-11-07 01:30:00", "2027-03-14 02:30:00", "2027-07-01 12:00:00", "2027-07-01 12:00:00 No/Where", "2027-07-01 12:00:00 Europe/London", "2027-07-01 12:00:00 EST"]
    df = spark.createDataFrame([(i, t, False, "America/New_York") for i, t in enumerate(texts)], "id int, a string, day_first boolean, home_zone string")
    m = with_moments(df, ["a"], "day_first", "home_zone")
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "MapInPandas" not in plan and plan.count("ArrowEvalPython") == 1
    got = [(r.a_at.status, r.a_at.val) for r in m.orderBy("id").collect()]
    assert got == [("ambiguous", None), ("nonexistent", None), ("moment", "2027-07-01T16:00:00Z"), ("nonexistent", None), ("moment", "2027-07-01T11:00:00Z"), ("moment", "2027-07-01T17:00:00Z")]

import os

import pytest

import __spark_entry__ as entry
from tallyforge.functions import finance as fn
from pyspark.sql import functions as F

WHERE = "/root/testdata/sf0.001"
NAMES = ["fn04_unit_currency", "fn09_clean_sector", "fn19_primary_legal", "fn21_stated_rates", "fn22_stated_base_rate", "fn23_stated_date", "fn25_shown_maturity", "fn28_number_or_null", "fn41_short_money", "agg17_audit_pick"]
CASES = {
    "unit_currency": {None: "USD", "": "USD", "u_usd": "USD", "shares": "USD", "Unit_gbp": "GBP", "u1": "U1"},
    "clean_sector": {"Software (3)": "Software", "Media - 2.5%": "Media", "Media — United States": "Media", "Debt Investments - Media": "Media", "and Media": "Media", "Media Maturity 2027": "Media", "Canada": "", "Table of Contents": "", "EnCap Energy Fund Investments": "", "Bain Senior Funds": "", "Investment Funds": "Investment Funds", "Hedge Funds": "Hedge Funds", None: None},
    "primary_legal": {"Acme Holdings, LLC and Beta Corp": "Acme Holdings, LLC", "Berner Food & Beverage, LLC": "Berner Food & Beverage, LLC", "A AG, B": "A AG, B", None: None},
    "stated_rate": {"S + 4.75 % cash": 4.75, "5 %": None, None: None},
    "stated_pik_rate": {"9.0% (2.50 % PIK)": 2.5, "2.5 % PIK": None},
    "stated_base_rate": {"3M euribor + 5": "EURIBOR", "Prime": "PRIME", "P + 4.0": "Prime", "s+": "SOFR", "fixed": None},
    "stated_date": {"6/7/2026": "2026-06-07", "4/2022": "2022-04", "06/17/51": "1951-06-17", "04/50": "2050-04", "2026-01-01": None},
    "shown_maturity": {"2026-1-5": "01/05/2026", " 2026-11": "11/15/2026", "1/5/2026": "01/05/2026", "4/2027": "04/15/2027", "soon ": "soon", " ": None},
    "number_or_null": {"0": 0.0, "0.0": 0.0, "0.00": None, "x": None, "1.5": 1.5},
}


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, name):
    df = spark.createDataFrame([(k,) for k in CASES[name]], "t string")
    got = {r.t: r.v for r in df.select("t", getattr(fn, name)(F.col("t")).alias("v")).collect()}
    assert got == CASES[name]


@pytest.mark.skipif(not os.path.isdir(WHERE), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_registered(spark, name):
    assert entry.queries()[name](spark, WHERE).collect()

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import finance as fn
from tallyforge.operators import portfolio as op

POS = "bdc string, entity string, key string, type string, sector string, fv bigint, cost bigint, par bigint, spread double, rate double, base string, mat_year bigint, ccy string, pik boolean, ord string, mark double"


def pos(bdc="A", entity="X LLC", key="x", type="First Lien", sector="Software", fv=5000, cost=5000, par=5000, spread=5.0, rate=9.0, base="SOFR", mat_year=2030, ccy="USD", pik=False, ord="1", mark=99.0):
    return (bdc, entity, key, type, sector, fv, cost, par, spread, rate, base, mat_year, ccy, pik, ord, mark)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), POS)


@pytest.mark.parametrize(
    ("fv", "cost", "par", "kind", "want"),
    [
        (99, 100, 100, "First Lien", 99.0),
        (99, 100, 118, "First Lien", 99.0),  # par states an undrawn commitment too
        (60, 100, 118, "First Lien", 50.85),
        (-1, 100, 100, "First Lien", None),
        (131, None, 100, "First Lien", None),
        (131, 100, None, "First Lien", None),
        (131, 100, None, "Common Equity", 131.0),
        (50, None, None, "First Lien", None),
    ],
)
def test_price_mark(spark, fv, cost, par, kind, want):
    df = spark.createDataFrame([(fv, cost, par, kind)], "fv bigint, cost bigint, par bigint, kind string")
    assert df.select(fn.price_mark(F.col("fv"), F.col("cost"), F.col("par"), F.col("kind"))).first()[0] == want


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    ("f", "text", "want"),
    [
        (fn.borrower_key, "Abc & Def Holdings, LLC (dba Abco)", "abc and def"),
        (fn.borrower_key, "Abc Parent, Inc.", "abc parent"),
        (lambda c: fn.borrower_key(c, parent=True), "Abc Parent, Inc.", "abc"),
        (fn.issuer_key, "Abc Holdings Déf, Inc. (US)", "abc déf"),
        (fn.trade_name, "Abc, Inc. (d/b/a Big Co)", "Big Co"),
        (fn.legal_name, "Abc, Inc. (f/k/a Old", "Abc, Inc."),
        (fn.legal_name, "Abc, Inc. (dba Big) | Revolver", "Abc, Inc."),
        (fn.legal_name, "Abc Ltd. - Class A", "Abc Ltd."),
        (fn.security_type, "Senior Subordinated Note", "Subordinated"),
        (fn.security_type, "one-stop loan", "First Lien"),
        (fn.security_type, "LP units", "Common Equity"),
        (fn.security_type, "Preferred units", "Preferred Equity"),
        (fn.security_type, None, "Other"),
        (fn.money, "$(1,234.5)", -1234.5),
        (fn.money, "—", None),
        (fn.number_or_null, "0.00", None),
        (fn.number_or_null, "0", 0.0),
        (fn.camel_words, "UnsecuredDebtUSMember", "Unsecured Debt US Member"),
        (fn.unit_currency, "iso4217_EUR", "EUR"),
        (fn.unit_currency, "usdPerShare", "USD"),
        (fn.maturity_year, "05/2031", 2031),
        (fn.fx_rate, " eur ", 1.04),
        (fn.fx_rate, "xxx", 1.0),
    ],
)
def test_text_functions(spark, f, text, want):
    assert one(spark, text, f) == want


def test_spread_step_halves_to_even(spark):
    df = spark.createDataFrame([(5.125,), (5.375,), (5.3,)], "s double")
    assert [r[0] for r in df.select(fn.spread_step(F.col("s"))).collect()] == [5.0, 5.5, 5.25]


def test_rollup_outcomes(spark):
    rows = [("f", "A", 300_000.0, 5.0), ("f", "A, T1", 100_000.0, 1.0), ("f", "A , T2", 200_000.0, 1.0), ("f", "B", 900_000.0, 0.0), ("f", "B, T1", 100_000.0, 1.0), ("f", "C", 900_000.0, 7.0), ("f", "C, T1", 100_000.0, 1.0), ("f", "AB", 1.0, 1.0), ("g", "A", 1.0, None)]
    df = spark.createDataFrame(rows, "filing string, ident string, fv double, cost double")
    got = {r.ident: (r.status, r.leaves, r.excess) for r in op.rollup_status(df).collect()}
    assert got == {"A": ("rollup", 2, 0.0), "B": ("partial", 1, 800_000.0), "C": ("own", 1, 0.0)}
    assert op.rollup_status(df.limit(0)).count() == 0


def test_aliases(spark):
    rows = [("e", 100.0, 0.0, 1), ("e", 100.2, 5.0, 2), ("e", 100.0, 6.0, 3), ("z", 7.0, 0.0, 4), ("z", None, 0.0, 5), ("z", None, 3.0, 6)]
    df = spark.createDataFrame(rows, "k string, fv double, cost double, id int")
    assert sorted(r.id for r in op.drop_aliases(df, ["k"]).collect()) == [2, 3, 4, 5, 6]


def test_mark_delta(spark):
    rows = [pos("A", mark=99.0, ord="1"), pos("B", mark=95.5, ord="2"), pos("C", fv=1000, mark=60.0, ord="3"), pos("A", key="y", mark=90.0), pos("B", key="y", mat_year=2031, mark=80.0), pos("A", key="q", mark=90.0), pos("B", key="q", fv=1999, mark=80.0)]
    got = op.mark_delta(table(spark, *rows)).collect()
    assert [(r.key, r.holders, r.total_fv, r.min_bdc, r.max_bdc, r.mark_spread) for r in got] == [("x", 3, 11000, "B", "A", 3.5)]


def test_merge_keeps_unfunded_apart_and_ignores_rate_with_spread(spark):
    rows = [pos(ord="1", rate=9.0), pos(ord="2", rate=9.5, sector="Media"), pos(ord="3", fv=-10), pos(ord="4", spread=None, rate=9.0), pos(ord="5", spread=None, rate=8.0)]
    got = sorted((r.ord, r.n, r.fv, r.sector) for r in op.merge_tranches(table(spark, *rows)).collect())
    assert got == [("1", 2, 10000, "Software"), ("3", 1, -10, "Software"), ("4", 1, 5000, "Software"), ("5", 1, 5000, "Software")]


def test_consensus_ties_to_first_seen(spark):
    rows = [pos(ord="2", sector="Media"), pos(ord="1", sector="Software"), pos(ord="3", sector="Other", bdc="B"), pos(ord="4", key="n", sector="Other")]
    got = {r.ord: (r.sector, r.changed) for r in op.sector_consensus(table(spark, *rows)).collect()}
    assert got == {"1": ("Software", False), "2": ("Software", True), "3": ("Software", True), "4": ("Other", False)}


def test_reference_rate_threshold_and_fill(spark):
    rows = [pos(ord=f"{i:03d}") for i in range(20)] + [pos(ord=f"e{i}", base="EURIBOR") for i in range(19)] + [pos(ord="s", rate=5.0), pos(ord="b", base="", rate=None), pos(ord="e", base="EURIBOR", rate=5.0), pos(ord="n", spread=None, rate=3.0)]
    p = table(spark, *rows)
    assert [(r.base, r.reference, r.n) for r in op.reference_rates(p).collect()] == [("SOFR", 4.0, 20)]
    got = {r.ord: (r.rate, r.rate_est) for r in op.fill_rates(p).collect()}
    assert got["s"] == (9.0, True) and got["b"] == (9.0, True) and got["e"] == (None, True) and got["n"] == (3.0, False)


def test_overlap_and_books(spark):
    rows = [pos("A", fv=10), pos("A", fv=5, ord="2"), pos("B", fv=7, ord="3"), pos("B", key="y", fv=9, ord="4"), pos("C", key="y", fv=0, ord="5")]
    o = {(r.fund_a, r.fund_b): (r.shared_fv, r.shared_names) for r in op.overlap(op.books(table(spark, *rows))).collect()}
    assert o == {("A", "B"): (15, 1), ("B", "A"): (7, 1)}


def test_rank_ties_and_missing(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", 1.0), ("c", 2.0), ("d", None)], "k string, m double")
    got = {r.k: r.r for r in df.select("k", op.stable_rank(df, "m", "k").alias("r")).collect()}
    assert got == {"a": 2.0, "b": 1.0, "c": 3.0, "d": 2.0}
    down = {r.k: r.r for r in df.select("k", op.stable_rank(df, "m", "k", ascending=False).alias("r")).collect()}
    assert down == {"a": 1.0, "c": 2.0, "b": 3.0, "d": 2.0}


def test_gap_split(spark):
    df = spark.createDataFrame([("g", p) for p in (1, 2, 9, 10, 17)], "g string, p bigint")
    assert [(r.cut_after, r.gap) for r in op.largest_gap(df, "g", "p").collect()] == [(2, 7)]


def test_band_join_equals_brute_force(spark):
    import random

    rnd = random.Random(7)
    left = [(i, rnd.choice([rnd.randint(-600, 600), rnd.randint(490, 510), rnd.randint(-10**6, 10**6)])) for i in range(400)]
    right = [(i, rnd.choice([v + rnd.randint(-12, 12), rnd.randint(-600, 600), int(v * rnd.uniform(0.985, 1.015))])) for i, (_, v) in enumerate(left * 2)]
    tol = lambda v: max(5, int(abs(v) * 0.01))
    want = {(a, b) for a, v in left for b, w in right if abs(w - v) <= tol(v)}
    ldf, rdf = spark.createDataFrame(left, "id bigint, fv bigint"), spark.createDataFrame(right, "row bigint, value bigint")
    assert {(r.id, r.row) for r in op.band_join(ldf, rdf).collect()} == want


def test_returns(spark):
    rows = [("T", "2023-12-29", 10.0), ("T", "2024-01-31", 20.0), ("T", "2024-02-01", 25.0), ("T", "2024-02-02", 30.0)]
    df = spark.createDataFrame(rows, "ticker string, d string, close double").withColumn("date", F.to_date("d"))
    r = op.period_returns(df).first()
    assert (r["last"], r.prev, r.day_pct, r.mtd_pct, r.ytd_pct, r.window_pct) == (30.0, 25.0, 20.0, 50.0, 200.0, 200.0)


def test_search_needs_every_word(spark):
    ix = spark.createDataFrame([("k1", "Red Widget LLC", 5), ("k2", "Red Bolt", 9)], "key string, name string, fv bigint")
    assert [r.key for r in op.search(ix, "red LLC").collect()] == ["k1"]
    assert [r.key for r in op.search(ix, "red").collect()] == ["k2", "k1"]


def test_overlap_of_a_borrower_that_very_many_funds_hold(spark):
    book = spark.range(1002).select(F.col("id").cast("string").alias("bdc"), F.lit("k").alias("key"), F.lit(2).alias("fv"))
    assert op.overlap(book).agg(F.count("*"), F.sum("shared_fv")).first()[:] == (1002 * 1001, 2 * 1002 * 1001)

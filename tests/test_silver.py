import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import rules as rl
from tallyforge.operators import silver as sv


def one(spark, text, make):
    return spark.createDataFrame([(text,)], "x string").select(make(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Alder, Inc., First lien senior secured loan", ("Alder, Inc.", "First Lien")), ("Alder, LLC, Class A-1 units, 3", ("Alder, LLC", "Common Equity")), ("Alder Warrants", ("Alder", "Warrant")),
        ("Alder Preferred Stock, Inc.", ("Alder", "Preferred Equity")), ("Alder, Inc.", ("Alder, Inc.", "")), ("Warrants", ("Warrants", "")), ("", ("", "")), ("x, interest rate 5%", ("x, interest rate 5%", "")),
    ],
)
def test_split_identifier(spark, text, want):
    r = one(spark, text, rl.split_identifier)
    assert (r.entity, r.kind) == want
    assert one(spark, None, rl.split_identifier) is None


def test_readers(spark):
    assert tuple(one(spark, "A b | Software | TL | 2", sv.piped)) == ("A b", "Software", "TL | 2")
    assert tuple(one(spark, "A b", sv.piped)) == ("A b", "", "")
    assert tuple(one(spark, "A, Inc., Second lien loan, 2030", lambda c: sv.commas(c, rl.KIND_RULES))) == ("A, Inc.", "", "Second lien loan, 2030")
    assert tuple(one(spark, "A, Inc.", lambda c: sv.commas(c, rl.KIND_RULES))) == ("A, Inc.", "", "")
    assert tuple(one(spark, "health care services: A b", lambda c: sv.peeled(c, ["Health", "Health Care Services"])))[:2] == ("A b", "health care services")
    assert tuple(one(spark, "Healthy Foods", lambda c: sv.peeled(c, ["Health"])))[:2] == ("Healthy Foods", "")
    assert tuple(one(spark, "Non-controlled/non-affiliated - x, A b 12", sv.unmarked)) == ("A b", "", "12")


def test_money_keys_and_ages(spark):
    assert [one(spark, t, rl.looks_like_money) for t in ("$ 1,234", "(5.0)", "—", "12/31", "abc", "", None)] == [True, True, True, False, False, False, None]
    assert one(spark, "Alder (dba X), L.P.", rl.override_key) == "alder" and one(spark, "Inc", rl.override_key) == "inc"
    assert one(spark, "a" * 61, rl.shortened) == "a" * 57 + "…" and one(spark, "a" * 60, rl.shortened) == "a" * 60
    t = dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(t, t + dt.timedelta(minutes=m)) for m in (0, 5, 61, 3000)], "a timestamp, b timestamp")
    assert [r.y for r in df.select(rl.ago(F.col("a"), F.col("b")).alias("y")).collect()] == ["just now", "5 min ago", "1 hr ago", "2 d ago"]


def test_last_fact_counts(spark):
    f = spark.createDataFrame([("f", "c", "fv", 1.0, 5), ("f", "c", "fv", 2.0, 9), ("f", "c", "cost", 7.0, 1), ("f", "gone", "fv", 3.0, 1)], "filing string, context string, concept string, value double, doc_order int")
    c = spark.createDataFrame([("f", "c", "x"), ("f", "none", "y")], "filing string, context string, identifier string")
    assert [(r.context, r.fv, r.cost, r.identifier) for r in sv.facts_in_contexts(f, c).collect()] == [("c", 2.0, 7.0, "x")]
    assert sv.facts_in_contexts(f.limit(0), c).count() == 0


def test_handlers(spark):
    rows = spark.createDataFrame([("a", "X | S", {"id": "1"}), ("a", "bare", {"id": "1"}), ("a", "Y | T", {"id": "1", "sub": "2"}), ("b", "Total", {}), ("b", "kept", {}), ("c", None, {}), (None, "unsourced", {})], "fund string, identifier string, dims map<string,string>")
    h = {"a": sv.Handler(dimensions=["id"], patterns=[r"^[^|]+$"], read=sv.piped), "b": sv.Handler(exact=["Total"])}
    got = {(r.fund, r.identifier, r.entity) for r in sv.handle(rows, "fund", h).collect()}
    assert {("a", "X | S", "X"), ("b", "kept", None)} <= got and not {x for x in got if x[1] in ("bare", "Y | T", "Total", None)}


def test_copies_without_cost(spark):
    rows = spark.createDataFrame([(1, 5.2, 1.0), (2, 5.0, 0.0), (3, 9.0, 0.0), (4, 9.1, None), (5, 0.0, 0.0), (6, None, 0.0)], "id int, fv double, cost double").withColumn("k", F.lit(1))
    assert {r.id for r in sv.drop_zero_cost_copies(rows, ["k"]).collect()} == {1, 5, 6}
    assert {r.id for r in sv.drop_zero_cost_copies(rows, ["k"], peers="cost").collect()} == {1, 3, 4, 5, 6}


def test_netting(spark):
    rows = spark.createDataFrame([("a", 110), ("b", 100)], "k string, fv int")
    off = spark.createDataFrame([("a", -5), ("a", 3), ("b", -7)], "k string, fv int")
    target = spark.createDataFrame([("a", 100), ("b", 100)], "k string, target int")
    assert sorted((r.k, r.fv) for r in sv.net_unfunded(rows, off, target, ["k"]).collect()) == [("a", -5), ("a", 110), ("b", 100)]


def test_pick_in_band(spark):
    left = spark.createDataFrame([(1, "p", 1000, ["alder", "mills"]), (2, "p", 5000, ["birch"]), (3, "p", 9000, None), (4, "q", 1000, ["alder"])], "id int, block string, fv bigint, words array<string>")
    right = spark.createDataFrame([(10, "p", 1001, ["oak"], 1), (11, "p", 1002, ["alder"], 2), (12, "p", 5001, ["oak"], 3), (13, "p", 5002, ["elm"], 4), (14, "p", 9000, ["x"], 5), (15, "p", 9001, ["y"], 6), (16, "q", 1001, None, 7)], "row int, block string, value bigint, words array<string>, ord int")
    assert {r.id: r.row for r in sv.best_in_band(left, right).collect()} == {1: 11, 2: 12, 4: 16}


def test_numbered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    assert [r.place for r in sv.numbered(df, F.asc("v")).orderBy("v").collect()] == list(range(1, 1001))
    assert sv.numbered(df.limit(0), F.asc("v")).count() == 0


@pytest.mark.parametrize(("few", "share", "longest"), [(64, 0.001, 8), (0, 0.001, 8), (0, 0.5, 8), (0, 0.0, 2), (3, 0.02, 3)])
def test_pick_among_many(spark, monkeypatch, few, share, longest):
    for c, v in (("FEW_MET", few), ("COMMON_SHARE", share), ("MAX_SET", longest)):
        monkeypatch.setattr(sv, c, v)
    rnd = random.Random(5)
    vocabulary = [f"word{i}" for i in range(30)]
    name = lambda: None if rnd.random() < 0.05 else [rnd.choice(vocabulary[: rnd.choice([3, 30])]) for _ in range(rnd.randrange(5))]
    value = lambda: rnd.choice([0, 0, 1, 3, -4, 7, 480, 505, 1000, 1009, -2000])
    left = [(i, rnd.choice("ab"), value(), name()) for i in range(150)]
    right = [(1000 + i, rnd.choice("ab"), value(), name(), 1000 + (i * 37) % 150) for i in range(150)]
    want = {}
    for i, block, fv, words in left:
        met = [(-len(set(words or ()) & set(b or ())), o, row) for row, k, v, b, o in right if k == block and abs(v - fv) <= max(5, abs(fv) // 100)]
        if len(met) == 1 or met and words:
            want[i] = (min(met)[2], len(met))
    x = spark.createDataFrame(left, "id int, block string, fv bigint, words array<string>")
    y = spark.createDataFrame(right, "row int, block string, value bigint, words array<string>, ord int")
    got = sv.best_in_band(x, y)
    assert {r.id: (r.row, r.met) for r in got.collect()} == want


@pytest.fixture
def crowd(spark, monkeypatch):
    """4,000 x 4,000 rows of one value and no common name, and the pairs that are listed for them."""
    x = spark.range(4000).select("id", F.lit("a").alias("block"), F.lit(0).cast("bigint").alias("fv"), F.array(F.concat(F.lit("left"), F.col("id"))).alias("words"))
    y = spark.range(4000).select(F.col("id").alias("row"), F.lit("a").alias("block"), (F.col("id") % 5).alias("value"), F.array(F.concat(F.lit("right"), F.col("id"))).alias("words"), F.col("id").alias("ord"))
    listed, join = [], sv.band_join
    monkeypatch.setattr(sv, "band_join", lambda *a, **k: listed.append(join(*a, **k)) or listed[-1])
    return x, y, listed


def test_many_meetings_are_not_listed(crowd):
    x, y, listed = crowd
    assert {tuple(r) for r in sv.best_in_band(x, y).select("row", "met").distinct().collect()} == {(0, 4000)}
    assert sum(d.count() for d in listed) < 10_000


def test_overlay_of_many_meetings(crowd):
    x, y, listed = crowd
    own, extra = x.select("id", F.lit("own").alias("sector")), y.select("row", F.col("row").cast("string").alias("sector"))
    assert sv.overlay(own, sv.best_in_band(x, y), extra, ["sector"]).where("sector = '0'").count() == 4000
    assert sum(d.count() for d in listed) < 10_000


def test_rows_that_meet_none_are_not_moved(crowd, monkeypatch):
    x, y, _ = crowd
    kept, store = [], sv.stored
    monkeypatch.setattr(sv, "stored", lambda d: kept.append(store(d)) or kept[-1])
    far = y.withColumns({"row": F.col("row") + 4000, "ord": F.col("ord") + 4000, "value": F.col("value") + 1_000_000})
    own, extra = x.select("id", F.lit("own").alias("sector")), y.select("row", F.col("row").cast("string").alias("sector"))
    assert sv.overlay(own, sv.best_in_band(x, y.unionByName(far)), extra, ["sector"]).where("sector = '0'").count() == 4000
    assert [d.where("row >= 4000").count() for d in kept if "row" in d.columns] == [0]


def test_picks_beyond_the_bound_of_broadcasts(spark, monkeypatch):
    rnd = random.Random(7)
    name = lambda: [f"word{rnd.randrange(9)}" for _ in range(rnd.randrange(4))]
    value = lambda: rnd.choice([0, 2, 6, -6, 499, 500, 505, 990, 1000, 10**9, -(10**9), 10**9 + 10**7, rnd.randrange(-600, 600)])
    x = spark.createDataFrame([(i, "a", value(), name()) for i in range(300)], "id int, block string, fv bigint, words array<string>")
    y = spark.createDataFrame([(i, "a", value(), name(), i) for i in range(300)], "row int, block string, value bigint, words array<string>, ord int")
    want = sorted(map(tuple, sv.best_in_band(x, y).collect()))
    monkeypatch.setattr(sv, "MAX_VALUES", 0)
    assert want and sorted(map(tuple, sv.best_in_band(x, y).collect())) == want


def test_wide_join_meets_each_pair_once(spark):
    values = [s * v for s in (1, -1) for v in (*range(0, 60), *range(430, 620, 3), *range(4_000, 5_000, 7), 10**9, 10**9 - 10**7, 10**9 + 10**7, 10**12)]
    x = spark.createDataFrame([("a", v) for v in values], "block string, fv bigint")
    y = spark.createDataFrame([("a", v) for v in values], "block string, value bigint")
    got = [(r.fv, r.value) for r in sv._wide_join(x, y, ["block"]).collect()]
    assert sorted(got) == sorted((a, b) for a in values for b in values if abs(b - a) <= max(5, abs(a) // 100))

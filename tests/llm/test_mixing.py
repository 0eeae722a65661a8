import os

import pytest
from pyspark.sql import functions as F

from tallyforge.llm.mixing import largest_total, mix_sources, rake, with_topics

TOKENIZER = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_50k.json")


def test_rake_meets_marginals():
    cells = {("a", "en", "t"): 60.0, ("a", "de", "t"): 40.0, ("b", "en", "u"): 50.0, ("b", "de", "u"): 50.0}
    w = rake(cells, {"a": 0.5, "b": 0.5}, {"a": 2, "b": 2}, 100.0)
    assert sum(v for k, v in w.items() if k[0] == "a") == pytest.approx(50, abs=0.1)
    assert sum(v for k, v in w.items() if k[1] == "en") == pytest.approx(55, abs=0.1)
    assert all(v <= cells[k] * 2 for k, v in w.items())


def test_caps_hold():
    cells = {("a", "en", "t"): 10.0, ("b", "en", "t"): 1000.0}
    w = rake(cells, {"a": 0.5, "b": 0.5}, {"a": 3, "b": 1}, 200.0)
    assert w["a", "en", "t"] <= 30 + 1e-6 and w["b", "en", "t"] == pytest.approx(100, abs=0.5)
    assert largest_total({"a": 10.0, "b": 1000.0}, {"a": 0.5, "b": 0.5, "none": 0.2}, {"a": 3, "b": 1, "none": 1}) == pytest.approx(60)
    assert rake({}, {}, {}, 5.0) == {}


def test_topics_part_texts(spark):
    kinds = ["the loan bears interest and the lender waives a covenant", "films and broadcast content from the studio publisher", "clinics and physicians treat patients with medicine"]
    docs = [(i, f"{kinds[i % 3]} number {i} {kinds[i % 3].split()[i % 5]}", i % 3) for i in range(90)] + [(900, None, None), (901, "", None), (902, "12 34", None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, kind int")
    rows = with_topics(df, topics=3).collect()
    assert len(rows) == len(docs) and {r.topic for r in rows if r.kind is None} == {"none"}
    by = {k: {r.topic for r in rows if r.kind == k} for k in range(3)}
    assert all(len(t) == 1 for t in by.values()) and len(set.union(*by.values())) == 3
    assert {r.doc_id: r.topic for r in with_topics(df.orderBy(F.desc("doc_id")), topics=3).collect()} == {r.doc_id: r.topic for r in rows}
    assert {r.topic for r in with_topics(df.where("doc_id > 899")).collect()} == {"none"}


def test_topics_are_of_all_documents(spark):
    # the texts about gardens have none of the 5,000 least hashes
    df = spark.range(5_400).select("id", F.concat(F.lit("the loan bears interest and the lender waives covenant number "), F.col("id") % 7).alias("text"))
    late = spark.range(10_000, 30_000).select("id", F.concat(F.lit("roses and tulips flower beside the garden hedge row "), F.col("id") % 7).alias("text"))
    h = F.xxhash64("id", "text")
    last = df.select(h.alias("h")).orderBy("h").limit(5_000).agg(F.max("h")).first()[0]
    df = df.unionByName(late.where(h > last).limit(300)).withColumnRenamed("id", "doc_id")
    rows = with_topics(df, topics=2).collect()
    loans, gardens = ({r.topic for r in rows if ("loan" in r.text) == k} for k in (True, False))
    assert len(rows) == 5_700 and len(loans) == len(gardens) == 1 and loans != gardens


@pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer file")
def test_shares_and_repeats(spark):
    docs = [(i, f"the loan number {i} pays interest " * (1 + i % 3), ["en", "de", None, "en-XX"][i % 4], "big") for i in range(3000)]
    docs += [(10_000 + i, f"small text {i} of a lender", "en", "small") for i in range(60)]
    docs += [(20_000, None, "en", "big"), (20_001, "", "en", "small"), (20_002, "no target", "en", "web"), (20_003, "no source", "en", None)]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id bigint, text string, lang string, source string, tokens int")
    t = spark.createDataFrame([("big", 0.8, 1), ("small", 0.15, 4), ("none", 0.05, 2)], "source string, target_share double, max_repeat int")
    chosen, report = mix_sources(d, t, TOKENIZER)
    r = {x.source: x for x in report.collect()}
    assert r["none"].docs == 0 and r["none"].actual_share == 0
    assert r["small"].most_repeats == 4 and r["small"].docs == 60
    assert r["big"].actual_share == pytest.approx(0.8 / 0.95, abs=0.02)
    c = chosen.collect()
    assert len({x.doc_id for x in c}) == len(c) and all(x.doc_id < 20_000 for x in c)
    assert {x.repeats for x in c if x.source == "big"} == {1}


@pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer file")
def test_empty(spark):
    d = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")
    t = spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeat int")
    chosen, report = mix_sources(d, t, TOKENIZER)
    assert chosen.count() == 0 and report.first().actual_share == 0

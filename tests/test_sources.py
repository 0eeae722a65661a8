import json

import pytest
from pyspark.sql import functions as F

from tallyforge.sources import readers as rd
from tallyforge.sources.html_tables import read_html_positions, walk

XBRL = """<xbrl>
<context id="c1"><entity><segment><explicitMember dimension="us-gaap:InvestmentTypeAxis">x:Debt</explicitMember>
<typedMember dimension="us-gaap:InvestmentIdentifierAxis"><InvestmentIdentifierAxis.domain>Abc, Inc., Loan</InvestmentIdentifierAxis.domain></typedMember></segment></entity><period><instant>2024-03-31</instant></period></context>
<context id="c2"><entity/><period><startDate>2024-01-01</startDate><endDate>2024-03-31</endDate></period></context>
<us-gaap:InvestmentOwnedAtFairValue contextRef="c1" unitRef="USD">100.5</us-gaap:InvestmentOwnedAtFairValue>
<us-gaap:InvestmentOwnedAtFairValue contextRef="c1" unitRef="USD">n/a</us-gaap:InvestmentOwnedAtFairValue>
<us-gaap:InvestmentOwnedAtCost contextRef="c1" unitRef="USD">99</us-gaap:InvestmentOwnedAtCost>
</xbrl>"""


@pytest.fixture
def file(tmp_path):
    def make(name, text):
        p = tmp_path / name
        p.write_text(text, encoding="utf-8")
        return str(p)

    return make


def test_registry(spark, file):
    p = file("r.json", json.dumps({"AAA": {"cik": "123", "name": "A Fund"}}))
    assert [tuple(r) for r in rd.read_registry(spark, p).collect()] == [("AAA", "0000000123", "A Fund")]


def test_contexts_and_facts(spark, file):
    p = file("x.xml", XBRL)
    c = {r.context_id: r for r in rd.read_contexts(spark, p).collect()}
    assert c["c1"].dims == {"us-gaap:InvestmentTypeAxis": "x:Debt", "us-gaap:InvestmentIdentifierAxis": "Abc, Inc., Loan"}
    assert (c["c1"].period_kind, str(c["c1"].period_end)) == ("instant", "2024-03-31")
    assert (c["c2"].period_kind, c["c2"].dims) == ("duration", {})
    f = rd.read_facts(spark, p, {k: v for k, v in rd.CONCEPTS.items() if v in ("fv", "cost")})
    assert sorted((r.concept, r.value) for r in f.collect()) == [("cost", 99.0), ("fv", 100.5)]
    w = rd.pivot_facts(f, "doc_order").first()
    assert (w.fv, w.cost, w.par) == (100.5, 99.0, None)
    ok = rd.read_contexts(spark, p).where(rd.allowed_dims(F.col("dims"), ["us-gaap:InvestmentTypeAxis"]))
    assert [r.context_id for r in ok.collect()] == ["c2"]


def test_company_facts(spark, file):
    e = lambda end, filed, val: {"end": end, "filed": filed, "form": "10-Q", "val": val}
    doc = {"cik": 7, "facts": {"us-gaap": {"Debt": {"units": {"USD": [e("2024-03-31", "2024-05-01", 5.0), e("2024-03-31", "2024-08-01", 6.0)]}}, "Loans": {"units": {"USD": [e("2024-03-31", "2024-05-01", 9.0)]}}}}}
    f = rd.read_company_facts(spark, file("f.json", json.dumps(doc)))
    assert f.count() == 3
    assert [(r.val, r.concept) for r in rd.pick_fact(f, ["Missing", "Debt", "Loans"], "2024-03-31").collect()] == [(6.0, "Debt")]


def test_csv_and_newest(spark, file):
    p = file("p.csv", 'ticker,acc,name\nA,1,"x ""y"", z"\nA,2,\n')
    df = rd.read_position_csv(spark, p)
    assert [(r.acc, r.name) for r in rd.newest_by(df, "ticker", "acc").collect()] == [("2", None)]
    assert df.where("acc = 1").first().name == 'x "y", z'


def test_news(spark, file):
    p = file("n.xml", "<rss><channel><item><title>T</title><link>http://a</link><pubDate>Tue, 05 Mar 2024 10:00:00 GMT</pubDate><source>S</source></item></channel></rss>")
    r = rd.read_news(spark, p).first()
    assert (r.title, r.url, str(r.published_at)) == ("T", "http://a", "2024-03-05 10:00:00")


def test_latest_form_and_accession(spark):
    df = spark.createDataFrame([("1", ["8-K", "10-Q", "10-Q"], ["a", "b", "c"], ["d3", "d2", "d1"])], "cik string, forms array<string>, accessions array<string>, dates array<string>")
    assert [tuple(r) for r in rd.latest_of_form(df, "10-Q").collect()] == [("1", "b", "d2")]
    t = spark.createDataFrame([("http://x/000123456724000012/y",), ("0001234567-24-000012",), ("none",)], "t string")
    assert [r[0] for r in t.select(rd.accession_of(F.col("t"))).collect()] == ["0001234567-24-000012"] * 2 + [None]


HTML = """<p>text</p><table><tr><td>Company</td><td>Investment type</td><td colspan=2>Cost</td><td colspan=2>Fair Value</td></tr>
<tr><td colspan=6>Software</td></tr>
<tr><td>Abc, Inc.</td><td>Term loan</td><td>$</td><td>10.5</td><td>$</td><td>(9.0)</td></tr>
<tr><td></td><td>Warrant</td><td></td><td>—</td><td></td><td>1,200.0</td></tr>
<tr><td>Total</td><td></td><td></td><td>10.5</td><td></td><td>9</td></tr></table>"""


def test_html_walk(spark):
    got = list(walk(HTML, 0.5))
    assert [(r["issuer"], r["sector"], r["investment_type"], r["cost"], r["fair_value"]) for r in got] == [("Abc, Inc.", "Software", "Term loan", 5.25, -4.5), ("Abc, Inc.", "Software", "Warrant", None, 600.0)]
    assert list(walk("")) == [] and list(walk("<table><tr><td>x")) == []
    df = spark.createDataFrame([("a", HTML), ("b", None), ("c", "<html>")], "source string, html string")
    assert sorted((r.source, r.ord) for r in read_html_positions(df).collect()) == [("a", 0), ("a", 1)]


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("A", 1), ("B", 2)], "ticker string, v int")
    rd.write_partitioned(df, str(tmp_path / "p"), "ticker")
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "p")).select("ticker", "v").collect()) == [("A", 1), ("B", 2)]
    rd.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_last_fact_in_the_document_counts(spark, file):
    one = lambda v: f'<us-gaap:InvestmentOwnedAtFairValue contextRef="c1" unitRef="usd">{v}</us-gaap:InvestmentOwnedAtFairValue>'
    p = file("twice.xml", "<xbrl>" + one(900) + one(5) + "</xbrl>")
    f = rd.read_facts(spark, p, {"us-gaap:InvestmentOwnedAtFairValue": "fv"})
    assert rd.pivot_facts(f, "doc_order").first().fv == 5.0 and rd.pivot_facts(f, "value").first().fv == 900.0


def test_document_order_and_dimensions(spark, file):
    p = file("inline.htm", '<p><ix contextRef="b">1</ix><ix contextRef = \'a\'>2</ix><ix contextRef="b">3</ix></p>')
    got = {r.context_id: r.doc_order for r in rd.document_order(spark, p).collect()}
    assert set(got) == {"a", "b"} and got["b"] < got["a"]
    assert rd.read_dimension(spark, p + ".none", "name string").count() == 0
    assert [r.name for r in rd.read_dimension(spark, file("d.json", '[{"name": "x"}]'), "name string").collect()] == ["x"]


def _table(*rows):
    return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"


def test_region_header_and_sections_of_a_schedule():
    from tallyforge.sources.html_tables import merged_header, walk

    head = [("Portfolio", "Principal", "", ""), ("Company", "", "Amortized Cost", "Fair Value")]
    html = (
        "<p>Contents</p>" + _table(("Issuer", "Cost"), ("Decoy", "1"))
        + "<h2>Schedule of Investments</h2><p>Health Care</p>"
        + _table(*head, ("Controlled affiliates", "", "", ""), ("First lien debt", "", "", ""), ("Alder LLC", "0", "5", "6"), ("", "2", "0", "7"), ("Total", "2", "5", "13"))
        + "<p>Notes to the statements</p>" + _table(("Company", "Cost"), ("Later", "9"))
    )
    got = list(walk(html, 10.0, anchor="Schedule of Investments", end="Notes to", sectors=("Health", "Health Care")))
    assert [(r["issuer"], r["sector"], r["affiliation"], r["investment_type"], r["principal"], r["cost"], r["fair_value"]) for r in got] == [
        ("Alder LLC", "Health Care", "Controlled affiliates", "First lien debt", None, 50.0, 60.0), ("Alder LLC", "Health Care", "Controlled affiliates", "First lien debt", 20.0, None, 70.0)
    ]
    assert list(walk(html, anchor="No such heading")) == []
    cells = lambda *t: [(k, 1, x) for k, x in enumerate(t)]
    assert merged_header([cells("Company", "Cost", "Cost")]) == ({(0, 1): "company", (1, 2): "cost", (2, 3): "fair_value"}, 1)

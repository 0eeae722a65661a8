"""Readers with fixed schemas. Formats are read by Spark's own sources; nothing is fetched here.

Downloading is a landing-zone job outside Spark; ``fresh`` tells which landed files are young
enough to be used again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fact concepts of a schedule of investments, and which of them are percentages.
CONCEPTS = {
    "us-gaap:InvestmentOwnedAtFairValue": "fv",
    "us-gaap:InvestmentOwnedAtCost": "cost",
    "us-gaap:InvestmentOwnedBalancePrincipalAmount": "par",
    "us-gaap:InvestmentOwnedBalanceShares": "shares",
    "us-gaap:InvestmentBasisSpreadVariableRate": "spread",
    "us-gaap:InvestmentInterestRate": "rate",
    "us-gaap:InvestmentInterestRatePaidInKind": "pik_rate",
}
_TEXT = T.StringType()
_MEMBER = T.ArrayType(T.StructType([T.StructField("_dimension", _TEXT), T.StructField("_VALUE", _TEXT)]))
_TYPED = T.ArrayType(T.StructType([T.StructField("_dimension", _TEXT), T.StructField("InvestmentIdentifierAxis.domain", _TEXT)]))
CONTEXT_SCHEMA = T.StructType(
    [
        T.StructField("_id", _TEXT),
        T.StructField("entity", T.StructType([T.StructField("segment", T.StructType([T.StructField("explicitMember", _MEMBER), T.StructField("typedMember", _TYPED)]))])),
        T.StructField("period", T.StructType([T.StructField("instant", _TEXT), T.StructField("startDate", _TEXT), T.StructField("endDate", _TEXT)])),
    ]
)
FACT_SCHEMA = T.StructType([T.StructField("_contextRef", _TEXT), T.StructField("_unitRef", _TEXT), T.StructField("_VALUE", _TEXT)])


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """(ticker, cik, name) from a JSON map of ticker to cik and name."""
    text = spark.read.text(path, wholetext=True)
    entry = T.MapType(_TEXT, T.StructType([T.StructField("cik", _TEXT), T.StructField("name", _TEXT)]))
    return text.select(F.explode(F.from_json("value", entry)).alias("ticker", "v")).select("ticker", F.lpad("v.cik", 10, "0").alias("cik"), "v.name")


def read_contexts(spark: SparkSession, path: str) -> DataFrame:
    """(source, context_id, period_kind, period_start, period_end, dims) of every context element."""
    x = spark.read.format("xml").option("rowTag", "context").schema(CONTEXT_SCHEMA).load(path).withColumn("source", F.input_file_name())
    seg = "entity.segment"
    members = F.coalesce(F.col(f"{seg}.explicitMember"), F.array().cast(_MEMBER))
    typed = F.coalesce(F.col(f"{seg}.typedMember"), F.array().cast(_TYPED))
    pairs = F.concat(
        F.transform(members, lambda m: F.struct(m["_dimension"].alias("k"), m["_VALUE"].alias("v"))),
        F.transform(typed, lambda m: F.struct(m["_dimension"].alias("k"), m["InvestmentIdentifierAxis.domain"].alias("v"))),
    )
    instant = F.col("period.instant").isNotNull()
    return x.select(
        "source", F.col("_id").alias("context_id"), F.when(instant, "instant").otherwise("duration").alias("period_kind"),
        F.to_date("period.startDate").alias("period_start"), F.to_date(F.coalesce("period.instant", "period.endDate")).alias("period_end"),
        F.map_from_entries(F.array_distinct(pairs)).alias("dims"),
    )


def read_facts(spark: SparkSession, path: str, concepts: dict[str, str] = CONCEPTS) -> DataFrame:
    """(source, context_id, concept, value, unit, doc_order): the numeric facts of the given concepts.

    ``doc_order`` orders the facts of one concept as the document has them.
    """
    out = None
    for tag, name in concepts.items():
        x = spark.read.format("xml").option("rowTag", tag).schema(FACT_SCHEMA).load(path).withColumn("source", F.input_file_name())
        x = x.select("source", F.col("_contextRef").alias("context_id"), F.lit(name).alias("concept"), F.expr("try_cast(_VALUE as double)").alias("value"), F.col("_unitRef").alias("unit"), F.struct(F.input_file_block_start().alias("start"), F.monotonically_increasing_id().alias("n")).alias("doc_order"))
        out = x if out is None else out.unionByName(x)
    return out.where("value is not null")


def document_order(spark: SparkSession, path: str) -> DataFrame:
    """(source, context_id, doc_order): where inline documents first name each context, in bytes."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for source, content in zip(pdf["path"], pdf["content"]):
                first: dict[bytes, int] = {}
                for m in re.finditer(rb"""contextRef\s*=\s*["']([^"']+)["']""", content):
                    first.setdefault(m[1], m.start())
                rows += [(source, c.decode("utf-8", "replace"), at) for c, at in first.items()]
            yield pd.DataFrame(rows, columns=["source", "context_id", "doc_order"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(scan, "source string, context_id string, doc_order bigint")


def pivot_facts(facts: DataFrame, order: str) -> DataFrame:
    """One row a context with a column a concept; of several facts the last by ``order``, of equals there the larger."""
    last = facts.groupBy("source", "context_id", "concept").agg(F.max(F.struct(F.col(order).alias("at"), "value"))["value"].alias("value"))
    return last.groupBy("source", "context_id").pivot("concept", sorted(set(CONCEPTS.values()))).agg(F.first("value"))


def read_dimension(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small JSON table of a known schema; empty where there is none."""
    try:
        return spark.read.schema(schema).json(path, multiLine=True)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def allowed_dims(dims: Column, allowed: list[str]) -> Column:
    """Whether every dimension of a context is among the allowed ones."""
    return F.size(F.array_except(F.map_keys(dims), F.array(*[F.lit(a) for a in allowed]))) == 0


def read_position_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, empty ones null, with the file's name."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"').withColumn("source", F.input_file_name())


def newest_by(df: DataFrame, key: str, order: str) -> DataFrame:
    """The rows of each key's newest file, by the largest ``order`` as text."""
    top = df.groupBy(key).agg(F.max(order).alias(order))
    return df.join(top, [key, order], "left_semi")


def latest_of_form(submissions: DataFrame, form: str) -> DataFrame:
    """(cik, accession, filed) of the first entry of a form in arrays ordered newest first."""
    z = submissions.select("cik", F.posexplode(F.arrays_zip("forms", "accessions", "dates")).alias("pos", "z")).where(F.col("z.forms") == form)
    return z.groupBy("cik").agg(F.min_by("z", "pos").alias("z")).select("cik", F.col("z.accessions").alias("accession"), F.col("z.dates").alias("filed"))


def accession_of(text: Column) -> Column:
    """0000000000-00-000000 from a URL or 18 digits."""
    raw = F.regexp_extract(text, r"(\d{18})", 1)
    own = F.regexp_extract(text, r"(\d{10}-\d{2}-\d{6})", 1)
    return F.when(own != "", own).when(raw != "", F.concat_ws("-", F.substring(raw, 1, 10), F.substring(raw, 11, 2), F.substring(raw, 13, 6)))


def read_company_facts(spark: SparkSession, path: str) -> DataFrame:
    """(cik, taxonomy, concept, unit, end, filed, form, val) of company-facts JSON files."""
    entry = "STRUCT<end: STRING, filed: STRING, form: STRING, val: DOUBLE>"
    schema = f"cik BIGINT, facts MAP<STRING, MAP<STRING, STRUCT<units: MAP<STRING, ARRAY<{entry}>>>>>"
    x = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("j")).select("j.*")
    x = x.select("cik", F.explode("facts").alias("taxonomy", "c"))
    x = x.select("cik", "taxonomy", F.explode("c").alias("concept", "u")).select("cik", "taxonomy", "concept", F.explode("u.units").alias("unit", "e"))
    x = x.select("cik", "taxonomy", "concept", "unit", F.explode("e").alias("e"))
    return x.select(F.lpad(F.col("cik").cast("string"), 10, "0").alias("cik"), "taxonomy", "concept", "unit", F.to_date("e.end").alias("end"), F.to_date("e.filed").alias("filed"), "e.form", "e.val")


def pick_fact(facts: DataFrame, concepts: list[str], end: str) -> DataFrame:
    """(cik, val, concept): of the first concept with a value at ``end``, the latest filed."""
    order = F.array_position(F.array(*[F.lit(c) for c in concepts]), F.col("concept"))
    x = facts.where(F.col("concept").isin(*concepts) & (F.col("end") == F.to_date(F.lit(end))) & (F.coalesce("val", F.lit(0.0)) != 0))
    return x.groupBy("cik").agg(F.max_by(F.struct("val", "concept"), F.struct(-order, F.col("filed"), F.col("val"))).alias("p")).select("cik", "p.val", "p.concept")


def read_news(spark: SparkSession, path: str) -> DataFrame:
    """(title, url, source, published, published_at) of RSS items."""
    schema = "title STRING, link STRING, pubDate STRING, source STRING"
    x = spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)
    when = F.coalesce(*[F.try_to_timestamp(F.regexp_replace("pubDate", r"^[A-Za-z]{3}, ", ""), F.lit(f)) for f in ("d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss Z")])
    return x.select("title", F.col("link").alias("url"), "source", F.col("pubDate").alias("published"), when.alias("published_at"))


def fresh(landed: DataFrame, ttl_seconds: int) -> DataFrame:
    """Landed files (path, modified) that are younger than ``ttl_seconds``."""
    return landed.where(F.unix_timestamp() - F.unix_timestamp("modified") < ttl_seconds)


def write_partitioned(df: DataFrame, path: str, by: str) -> None:
    """Parquet, a folder a value of ``by``; to a new path, never one that is being read."""
    df.write.mode("errorifexists").partitionBy(by).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a line."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("errorifexists").text(path)

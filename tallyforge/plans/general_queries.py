"""The queries of the general data problems over the project's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.text import MISSING_WORDS, is_missing
from tallyforge.operators.fill import fill_category, fill_numeric
from tallyforge.operators.moments import normalise_moments
from tallyforge.operators.multivalue import split_packed
from tallyforge.operators.units import MAX_EDGES, ccy_field, convert_units, described_currency, noted_scale
from tallyforge.session import table


def packed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, row_id, kind, field) of the two packed columns."""
    soi = table(spark, sf_dir, "soi_position").select(
        F.lit("soi_position").alias("src"), F.col("pos_id").alias("row_id"), F.lit("list").alias("kind"), F.col("identifier").alias("field")
    )
    html = table(spark, sf_dir, "html_row").select(
        F.lit("html_row").alias("src"), "row_id", F.lit("marks").alias("kind"), F.col("footnotes").alias("field")
    )
    return soi.unionByName(html)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per value of every identifier or footnotes field holding two or more."""
    return split_packed(packed_fields(spark, sf_dir), min_values=2)


def _missing_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    soi = fill_category(table(spark, sf_dir, "soi_position"), "pos_id", ["bdc", "entity"], "period_end", "sector")
    html = fill_category(table(spark, sf_dir, "html_row"), "row_id", ["bdc", "issuer"], "period_end", "business_description")
    return soi.select(F.lit("soi_position").alias("src"), "*").unionByName(html.select(F.lit("html_row").alias("src"), "*"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing sectors and descriptions that another row of the same fund and borrower states."""
    return _missing_filled(spark, sf_dir).select("src", "row_id", "val")


def p2_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every filled value, marked with its method and distance in days."""
    return _missing_filled(spark, sf_dir)


def p2_interpolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing all-in rates interpolated in time per fund, borrower and instrument wording."""
    soi = table(spark, sf_dir, "soi_position")
    return fill_numeric(soi, "pos_id", ["bdc", "entity", "type"], "period_end", "rate")


def stated_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, row_id, field, text, day_first, home_zone) of the four date columns."""
    out = None
    for src, key, cols in (("soi_position", "pos_id", ("maturity", "acq")), ("html_row", "row_id", ("maturity_date", "acquisition_date"))):
        t = table(spark, sf_dir, src).select("bdc", F.col(key).alias("row_id"), F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in cols])).alias("x"))
        t = t.select(F.lit(src).alias("src"), "bdc", "row_id", "x.field", "x.text")
        out = t if out is None else out.unionByName(t)
    return out.join(F.broadcast(locales(spark, sf_dir)), "bdc", "left").withColumn("day_first", F.coalesce("day_first", F.lit(False)))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates, months and moments not yet in normal form, in normal form."""
    n = normalise_moments(stated_times(spark, sf_dir))
    return n.where(F.col("val").isNotNull() & (F.col("val") != F.col("text"))).select("src", "row_id", "field", "val")


def p3_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values of each field are dates, months, moments, ambiguous or nonexistent."""
    n = normalise_moments(stated_times(spark, sf_dir))
    return n.groupBy("src", "field", "status").agg(F.count("*").alias("n"))


def unit_edges(spark: SparkSession, sf_dir: str) -> list[tuple]:
    """The conversion graph: scales of each currency, and each currency's dollar rate by date."""
    scales = (0.01, 1.0, 1e3, 1e6, 1e9)
    # fx_rate is a fixed table (64 rows); what is beyond the bound raises, it is not cut off
    rates = table(spark, sf_dir, "fx_rate").limit(MAX_EDGES + 1).collect()
    if len(rates) > MAX_EDGES:
        raise ValueError(f"fx_rate has more than {MAX_EDGES} rows")
    edges = [(f"{c}*{s:g}", f"{c}*1", s, 0.0, None) for c in {r.ccy for r in rates} for s in scales if s != 1]
    return edges + [(f"{r.ccy}*1", "USD*1", r.usd_per_unit, 0.0, str(r.rate_date)) for r in rates if r.ccy != "USD"]


def _unit(cur: Column, scale: Column) -> Column:
    short = F.when(scale == 0.01, "0.01").when(scale == 1, "1").when(scale == 1e3, "1000").when(scale == 1e6, "1e+06").otherwise("1e+09")
    return F.concat_ws("*", cur, short)


def position_units(spark: SparkSession, sf_dir: str, soi: DataFrame) -> DataFrame:
    """``soi`` (accession, ccy, descr and any others) with ``unit``, ``CCY*scale``, of its amounts."""
    # filing is a fixed table of 320 rows
    note = table(spark, sf_dir, "filing").select("accession", noted_scale("amounts_note")["scale"].alias("_note")).dropDuplicates(["accession"])
    s = soi.join(F.broadcast(note), "accession", "left")
    # a description counts only where the currency is missing
    own = F.when(~is_missing(F.col("ccy")), F.col("ccy"))
    s = s.withColumn("_own", own).withColumn("_told", F.when(F.col("_own").isNull(), F.col("descr")))
    s = s.withColumn("_a", ccy_field("_own")).withColumn("_b", described_currency("_told"))
    unit = _unit(F.coalesce("_a.cur", "_b.cur", F.lit("USD")), F.coalesce("_a.scale", "_b.scale", "_note", F.lit(1.0)))
    return s.withColumn("unit", unit).drop("_note", "_own", "_told", "_a", "_b")


def html_units(html: DataFrame) -> DataFrame:
    """``html`` (caption, investment_type and any others) with ``unit`` of its amounts."""
    h = html.withColumn("_a", described_currency("investment_type")).withColumn("_n", noted_scale("caption"))
    scale = F.when(F.col("_a.cur").isNotNull(), F.coalesce("_a.scale", F.lit(1.0))).otherwise(F.coalesce("_n.scale", F.lit(1.0)))
    return h.withColumn("unit", _unit(F.coalesce("_a.cur", F.lit("USD")), scale)).drop("_a", "_n")


def stated_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, row_id, field, amount, unit, at) of fv, par and fair_value; unit is ``CCY*scale``."""
    soi = table(spark, sf_dir, "soi_position").select("pos_id", "accession", "period_end", "ccy", "descr", "fv", "par")
    s = position_units(spark, sf_dir, soi.where(F.col("fv").isNotNull() | F.col("par").isNotNull()))
    s = s.select(
        F.lit("soi_position").alias("src"), F.col("pos_id").alias("row_id"), F.col("period_end").alias("at"), "unit",
        F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("amount")) for c in ("fv", "par")])).alias("x"),
    )
    h = table(spark, sf_dir, "html_row").select("row_id", "period_end", "caption", "investment_type", "fair_value").where(F.col("fair_value").isNotNull())
    h = html_units(h).select(
        F.lit("html_row").alias("src"), "row_id", F.col("period_end").alias("at"), "unit",
        F.struct(F.lit("fair_value").alias("field"), F.col("fair_value").alias("amount")).alias("x"),
    )
    return s.unionByName(h).select("src", "row_id", "x.field", "x.amount", "unit", "at")


def locales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(bdc, day_first, home_zone) of each fund: a fixed table of 20 rows."""
    return table(spark, sf_dir, "fund").select(F.col("ticker").alias("bdc"), (F.col("locale") != "en_US").alias("day_first"), "home_zone")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts not yet in single US dollars, in whole US dollars."""
    a = stated_amounts(spark, sf_dir).where((F.col("unit") != "USD*1") & F.col("amount").isNotNull() & ~F.isnan("amount"))
    c = convert_units(a, unit_edges(spark, sf_dir), "USD*1").where(F.col("status") == "converted")
    return c.select("src", "row_id", "field", F.round("val").cast("bigint").alias("usd"))


QUERIES = {
    "p1_found": p1_found, "p2_found": p2_found, "p2_marked": p2_marked, "p2_interpolated": p2_interpolated,
    "p3_found": p3_found, "p3_status": p3_status, "p5_found": p5_found,
}

_MISSING = "(x IS NULL OR regexp_matches(lower(trim(regexp_replace(x, '[\\s\\x{00a0}]+', ' ', 'g'))), '^[-–—―‒?._*/]*$') OR list_contains([" + ", ".join(f"'{w}'" for w in MISSING_WORDS) + "], lower(trim(regexp_replace(x, '[\\s\\x{00a0}]+', ' ', 'g')))))"

_FILLED = f"""WITH r AS (
  SELECT 'soi_position' AS src, pos_id AS row_id, bdc, entity AS who, period_end AS t, sector AS x FROM soi_position
  UNION ALL SELECT 'html_row', row_id, bdc, issuer, period_end, business_description FROM html_row
), k AS (SELECT *, {_MISSING} AS gone FROM r WHERE bdc IS NOT NULL AND who IS NOT NULL AND t IS NOT NULL),
o AS (SELECT src, bdc, who, t, min(x) AS x FROM k WHERE NOT gone GROUP BY ALL),
c AS (
  SELECT k.src, k.row_id, o.x AS val, CASE WHEN o.t = k.t THEN 'same' WHEN o.t < k.t THEN 'carried' ELSE 'back' END AS method, abs(date_diff('day', k.t, o.t)) AS gap
  FROM k JOIN o USING (src, bdc, who) WHERE gone
  QUALIFY row_number() OVER (PARTITION BY k.src, k.row_id ORDER BY CASE WHEN o.t = k.t THEN 0 WHEN o.t < k.t THEN 1 ELSE 2 END, abs(date_diff('day', k.t, o.t))) = 1
)
"""

#: The other problems' grammars outgrow SQL; their queries are tested against brute force and fixtures.
SQL: dict[str, str] = {
    "p2_found": _FILLED + "SELECT src, row_id, val FROM c",
    "p2_marked": _FILLED + "SELECT src, row_id, val, method, CAST(gap AS INT) AS gap_days FROM c",
}

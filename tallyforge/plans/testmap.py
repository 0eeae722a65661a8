"""The driver's order tables read as positions, in Spark and in SQL.

Amounts are whole thousands (BIGINT), so that sums do not depend on their order; ``ord`` is
the input order that every first-seen rule goes by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.finance import borrower_key, half_up, price_mark, security_type
from tallyforge.session import broadcast_within, table

_TYPES = {
    "PROMO": "Second lien loan", "STANDARD": "First lien senior secured loan", "ECONOMY": "Unitranche loan",
    "SMALL": "Common stock", "MEDIUM": "Subordinated note", "LARGE": "Preferred units",
}
_ENDINGS = {0: ", Inc.", 1: " LLC", 2: " Holdings, LLC", 3: " (dba Ring Works)", 4: ""}
_SECTORS = {0: "Software", 1: "Health Care", 2: "Other", 3: "Insurance", 4: "Media"}

#: The same projection for DuckDB; queries put it in front as ``WITH``.
POSITION_CTE = """
WITH pos0 AS (
  SELECT 'F' || lpad(CAST(l_suppkey % 19 AS VARCHAR), 2, '0') AS bdc,
    p_name || ' ' || CAST(p_partkey AS VARCHAR) || CASE l_suppkey % 5 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' LLC' WHEN 2 THEN ' Holdings, LLC' WHEN 3 THEN ' (dba Ring Works)' ELSE '' END AS entity,
    p_name || ' ' || CAST(p_partkey AS VARCHAR) AS key,
    CASE p_type WHEN 'PROMO' THEN 'Second Lien' WHEN 'STANDARD' THEN 'First Lien' WHEN 'ECONOMY' THEN 'First Lien' WHEN 'SMALL' THEN 'Common Equity' WHEN 'MEDIUM' THEN 'Subordinated' ELSE 'Preferred Equity' END AS type,
    CASE WHEN (l_suppkey + l_partkey) % 7 = 0 THEN 'Other' ELSE CASE p_partkey % 5 WHEN 0 THEN 'Software' WHEN 1 THEN 'Health Care' WHEN 2 THEN 'Other' WHEN 3 THEN 'Insurance' ELSE 'Media' END END AS sector,
    CAST(floor(l_extendedprice + 0.5) AS BIGINT) AS fv,
    CAST(floor(l_extendedprice * (1 - l_discount) + 0.5) AS BIGINT) AS cost,
    CAST(floor(l_extendedprice * (1 + l_tax) + 0.5) AS BIGINT) AS par,
    nullif(floor(l_discount * 100 + 0.5), 0) AS spread,
    CASE WHEN l_tax > 0 THEN floor(l_tax * 100 + 0.5) + 3.75 END AS rate,
    CASE l_returnflag WHEN 'A' THEN 'SOFR' WHEN 'N' THEN 'EURIBOR' ELSE '' END AS base,
    CAST(year(l_shipdate) + 30 AS BIGINT) AS mat_year,
    CASE l_suppkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' ELSE 'USD' END AS ccy,
    l_linestatus = 'O' AS pik,
    lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || lpad(CAST(l_partkey AS VARCHAR), 10, '0') || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') || lpad(CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS VARCHAR), 14, '0') || lpad(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), 5, '0') AS ord
  FROM lineitem JOIN part ON l_partkey = p_partkey
), pos1 AS (
  SELECT *, CASE WHEN par > 0 THEN fv / par * 100 END AS op, CASE WHEN cost > 0 THEN fv / cost * 100 END AS oc FROM pos0
), pos2 AS (
  SELECT *, floor((CASE WHEN cost > 0 AND par > cost * 1.08 AND oc BETWEEN 90 AND 103 THEN oc WHEN op > 0 AND op <= 130 THEN op ELSE oc END) * 100 + 0.5) / 100 AS m FROM pos1
), pos AS (
  SELECT * EXCLUDE (op, oc, m), CASE WHEN fv < 0 OR (type IN ('First Lien', 'Second Lien', 'Subordinated', 'Unsecured', 'Mezzanine') AND (m > 130 OR m < 0)) THEN NULL ELSE m END AS mark FROM pos2
)
"""


def _cases(col, cases: dict):
    out = None
    for k, v in cases.items():
        out = F.when(col == k, v) if out is None else out.when(col == k, v)
    return out


#: Parts of which the names are broadcast; more meet their lines by a shuffle.
MAX_PARTS = 50_000


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")


def told_by_name(spark: SparkSession, sf_dir: str) -> list[str]:
    """The columns of ``positions(..., part=True)`` that each entity and key has one value of.

    A plain name is followed by its part's number, which is then the last word of the key, too.
    """
    return ["part"] if _parts(spark, sf_dir).where(r"p_name is null or p_name rlike '[^A-Za-z0-9 -]'").isEmpty() else []


def positions(spark: SparkSession, sf_dir: str, part: bool = False) -> DataFrame:
    """(bdc, entity, key, type, sector, fv, cost, par, spread, rate, base, mat_year, ccy, pik, ord, mark); with ``part``, its number too."""
    # names, keys and types are worked out on the parts, not on the lines; one of the endings holds for a line
    known = broadcast_within(_parts(spark, sf_dir), MAX_PARTS)
    names = [F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string"), F.lit(_ENDINGS[e])) for e in sorted(_ENDINGS)]
    known = known.select("p_partkey", F.array(*names).alias("_names"), F.array(*[borrower_key(n) for n in names]).alias("_keys"), security_type(_cases(F.col("p_type"), _TYPES)).alias("type"))
    ending = F.col("l_suppkey") % 5
    ending = F.when(ending.between(0, 3), ending).otherwise(4).cast("int")
    j = table(spark, sf_dir, "lineitem").join(known, F.col("l_partkey") == F.col("p_partkey"))
    j = j.withColumns({"entity": F.get("_names", ending), "key": F.get("_keys", ending)})
    whole = lambda c: F.floor(c + 0.5).cast("bigint")
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    price = F.col("l_extendedprice")
    p = j.select(
        *([F.col("l_partkey").alias("part")] if part else []),
        F.concat(F.lit("F"), pad(F.col("l_suppkey") % 19, 2)).alias("bdc"),
        "entity", "key", "type",
        F.when((F.col("l_suppkey") + F.col("l_partkey")) % 7 == 0, "Other").otherwise(_cases(F.col("p_partkey") % 5, _SECTORS)).alias("sector"),
        whole(price).alias("fv"),
        whole(price * (1 - F.col("l_discount"))).alias("cost"),
        whole(price * (1 + F.col("l_tax"))).alias("par"),
        F.nullif(F.floor(F.col("l_discount") * 100 + 0.5).cast("double"), F.lit(0.0)).alias("spread"),
        F.when(F.col("l_tax") > 0, F.floor(F.col("l_tax") * 100 + 0.5) + F.lit(3.75)).cast("double").alias("rate"),
        F.when(F.col("l_returnflag") == "A", "SOFR").when(F.col("l_returnflag") == "N", "EURIBOR").otherwise("").alias("base"),
        (F.year("l_shipdate") + 30).cast("bigint").alias("mat_year"),
        F.when(F.col("l_suppkey") % 4 == 0, "EUR").when(F.col("l_suppkey") % 4 == 1, "GBP").otherwise("USD").alias("ccy"),
        (F.col("l_linestatus") == "O").alias("pik"),
        F.concat(pad(F.col("l_orderkey"), 12), pad(F.col("l_linenumber"), 3), pad(F.col("l_partkey"), 10), pad(F.col("l_suppkey"), 8), pad(whole(price * 100), 14), pad(F.col("l_quantity").cast("bigint"), 5)).alias("ord"),
    )
    return p.withColumn("mark", price_mark(F.col("fv"), F.col("cost"), F.col("par"), F.col("type")))


__all__ = ["POSITION_CTE", "half_up", "positions", "told_by_name"]

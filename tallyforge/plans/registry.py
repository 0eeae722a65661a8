"""All queries over the reference operators and their SQL for DuckDB.

Names start with the operator's id of the survey. Every computed column has one name and
type on both sides; sums are of whole numbers, and quotients are rounded by floor, so that
both engines give the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions import finance as fn
from tallyforge.functions.text import one_space
from tallyforge.operators import portfolio as op
from tallyforge.plans.testmap import POSITION_CTE, positions, told_by_name
from tallyforge.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def _typed(df: DataFrame, **types: str) -> DataFrame:
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def _ending_sql(words: str) -> str:
    """The number of last words of the list ``words`` that are an ending."""
    several = {}
    for e in fn.KEY_ENDINGS:
        several.setdefault(e.count(" ") + 1, []).append(e)
    cases = [f"WHEN len({words}) > {k} AND array_to_string({words}[-{k}:], ' ') IN ({', '.join(repr(e) for e in several[k])}) THEN {k}" for k in sorted(several, reverse=True)]
    return "CASE " + " ".join(cases) + " ELSE 0 END"


_KEYS = (
    r"""WITH t AS (SELECT pos_id, regexp_replace(regexp_replace(lower(entity), '\s*\((?:dba|d/b/a|a/k/a|aka|fka|f/k/a)\b[^)]*\)', '', 'g'), '\s*\([^()]*\)\s*$', '') AS x FROM soi_position),
w0 AS (SELECT pos_id, list_transform(list_filter(regexp_split_to_array(translate(x, '.,''`', ''), '\s+'), lambda w: w <> ''), lambda w: CASE WHEN w = '&' THEN 'and' ELSE w END) AS w FROM t),
"""
    + ", ".join(f"w{k + 1} AS (SELECT pos_id, w[1:len(w) - ({_ending_sql('w')})] AS w FROM w{k})" for k in range(fn.MOST_ENDINGS))
    + " "
)


# --- marks, loans and books -----------------------------------------------------------------

_DEBT = "('First Lien', 'Second Lien', 'Subordinated', 'Unsecured', 'Mezzanine')"


@_query(
    POSITION_CTE
    + f"""
, funds AS (
  SELECT key, type, mat_year, round_even(spread * 4, 0) / 4 AS spread_q, bdc, sum(fv) AS fv,
    sum(CASE WHEN mark BETWEEN 40 AND 108 AND fv >= 250 AND par > 0 THEN CAST(floor(mark * 100 + 0.5) AS BIGINT) * fv END) AS num,
    sum(CASE WHEN mark BETWEEN 40 AND 108 AND fv >= 250 AND par > 0 THEN fv END) AS den
  FROM pos WHERE type IN {_DEBT} AND fv > 0 AND spread IS NOT NULL GROUP BY ALL
), f2 AS (
  SELECT *, floor(CAST(num AS DOUBLE) / CAST(den AS DOUBLE) / 100 * 100 + 0.5) / 100 AS mark FROM funds
), f3 AS (
  SELECT *, mark IS NOT NULL AND fv >= 2000 AS ok FROM f2
), g AS (
  SELECT key, type, mat_year, spread_q, CAST(count(*) AS BIGINT) AS holders, CAST(sum(fv) AS BIGINT) AS total_fv, count(*) FILTER (WHERE ok) AS marks,
    min({{'m': mark, 'b': bdc}}) FILTER (WHERE ok) AS lo, max({{'m': mark, 'b': bdc}}) FILTER (WHERE ok) AS hi
  FROM f3 GROUP BY ALL
)
SELECT key, type, mat_year, spread_q, holders, total_fv, lo.m AS min_mark, lo.b AS min_bdc, hi.m AS max_mark, hi.b AS max_bdc,
  floor((hi.m - lo.m) * 100 + 0.5) / 100 AS mark_spread
FROM g WHERE holders >= 2 AND total_fv >= 500 AND marks >= 2
"""
)
def agg19_mark_delta(spark, sf):
    return _typed(op.mark_delta(positions(spark, sf)), spread_q="double")


@_query(POSITION_CTE + "SELECT bdc, key, CAST(sum(fv) AS BIGINT) AS fv, CAST(sum(cost) AS BIGINT) AS cost, CAST(sum(par) AS BIGINT) AS par, arg_min(entity, ord) AS name, arg_min(sector, ord) AS sector, arg_min(type, ord) AS type FROM pos WHERE fv <> 0 GROUP BY bdc, key")
def agg21_books(spark, sf):
    return op.books(positions(spark, sf, part=True), told_by_name(spark, sf))


@_query(
    POSITION_CTE
    + """, b AS (SELECT bdc, key, sum(fv) AS fv FROM pos WHERE fv <> 0 GROUP BY ALL)
SELECT a.bdc AS fund_a, c.bdc AS fund_b, CAST(sum(a.fv) AS BIGINT) AS shared_fv, CAST(count(*) AS BIGINT) AS shared_names FROM b a JOIN b c ON a.key = c.key AND a.bdc <> c.bdc GROUP BY ALL"""
)
def jn15_overlap(spark, sf):
    return op.overlap(op.books(positions(spark, sf)))


_FUNDS = [f"F{i:02d}" for i in range(19)]


@_query(
    POSITION_CTE
    + """, b AS (SELECT bdc, key, sum(fv) AS fv FROM pos WHERE fv <> 0 GROUP BY ALL),
o AS (SELECT a.bdc AS fund_a, c.bdc AS fund_b, sum(a.fv) AS v FROM b a JOIN b c ON a.key = c.key AND a.bdc <> c.bdc GROUP BY ALL)
SELECT fund_a, """
    + ", ".join(f"CAST(sum(v) FILTER (WHERE fund_b = '{f}') AS BIGINT) AS {f}" for f in _FUNDS)
    + ", CAST(max(v) AS BIGINT) AS row_max FROM o GROUP BY fund_a"
)
def win04_overlap_matrix(spark, sf):
    return op.overlap_matrix(op.books(positions(spark, sf)), _FUNDS)


_INDEX = (
    POSITION_CTE
    + """, nm AS (SELECT key, entity, count(*) AS n, min(ord) AS o FROM pos GROUP BY ALL),
nm2 AS (SELECT key, entity AS name FROM nm QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, length(entity) DESC, o) = 1),
sc AS (SELECT key, sector, count(*) AS n, min(ord) AS o FROM pos WHERE sector <> 'Other' GROUP BY ALL),
sc2 AS (SELECT key, sector FROM sc QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, o) = 1),
ix AS (SELECT key, name, coalesce(sector, 'Other') AS sector, CAST(fv AS BIGINT) AS fv, CAST(funds AS BIGINT) AS funds, CAST(positions AS BIGINT) AS positions
  FROM (SELECT key, sum(fv) AS fv, count(DISTINCT bdc) AS funds, count(*) AS positions FROM pos GROUP BY key) JOIN nm2 USING (key) LEFT JOIN sc2 USING (key))
"""
)


@_query(_INDEX + "SELECT * FROM ix")
def agg22_borrower_index(spark, sf):
    return op.borrower_index(positions(spark, sf, part=True), told_by_name(spark, sf))


@_query(_INDEX + "SELECT * FROM ix WHERE contains(lower(name || ' ' || key), 'red') AND contains(lower(name || ' ' || key), 'llc') ORDER BY fv DESC, key LIMIT 60")
def sch01_search(spark, sf):
    return op.search(op.borrower_index(positions(spark, sf, part=True), told_by_name(spark, sf)), "LLC red")


@_query(_INDEX + "SELECT * FROM ix WHERE key = 'red widget 1'")
def sch02_key_lookup(spark, sf):
    return op.borrower_index(positions(spark, sf).where("key = 'red widget 1'"))


@_query(
    POSITION_CTE
    + """, b AS (SELECT bdc, key, CAST(sum(fv) AS BIGINT) AS fv, CAST(sum(cost) AS BIGINT) AS cost FROM pos WHERE fv <> 0 GROUP BY ALL)
SELECT a.key, a.fv AS fv_a, c.fv AS fv_b, a.cost AS cost_a, c.cost AS cost_b FROM b a JOIN b c ON a.key = c.key WHERE a.bdc = 'F01' AND c.bdc = 'F02'"""
)
def sch03_pair_compare(spark, sf):
    b = op.books(positions(spark, sf))
    one = lambda f, x: b.where(F.col("bdc") == f).select("key", F.col("fv").alias(f"fv_{x}"), F.col("cost").alias(f"cost_{x}"))
    return one("F01", "a").join(one("F02", "b"), "key").select("key", "fv_a", "fv_b", "cost_a", "cost_b")


# --- merging, consensus, rates --------------------------------------------------------------


@_query(
    POSITION_CTE
    + """, k AS (SELECT *, lower(trim(entity)) AS nm, fv < 0 AS neg, CASE WHEN spread IS NOT NULL THEN '' ELSE coalesce(CAST(rate AS VARCHAR), '') END AS rk FROM pos),
g AS (SELECT bdc, nm, type, neg, mat_year, rk, spread, base, ccy, sum(fv) AS fv, sum(cost) AS cost, sum(par) AS par, count(*) AS n,
  arg_min(entity, ord) AS entity, arg_min(sector, ord) AS sector, arg_min({'m': mark}, ord) AS mk, min(ord) AS ord FROM k GROUP BY ALL)
SELECT bdc, entity, type, sector, CAST(fv AS BIGINT) AS fv, CAST(cost AS BIGINT) AS cost, CAST(par AS BIGINT) AS par, mat_year, spread, base, ccy, CAST(n AS BIGINT) AS n,
  CASE WHEN n > 1 THEN CASE WHEN fv / par * 100 > 0 AND fv / par * 100 <= 130 THEN floor(fv / par * 100 * 100 + 0.5) / 100 ELSE floor(fv / cost * 100 * 100 + 0.5) / 100 END ELSE mk.m END AS mark, ord
FROM g"""
)
def agg07_tranche_merge(spark, sf):
    return op.merge_tranches(positions(spark, sf, part=True), told_by_name(spark, sf))


_CONS = (
    POSITION_CTE
    + """, v AS (SELECT key, sector, sum(CASE WHEN fv = 0 THEN 1 ELSE abs(fv) END) AS w, min(ord) AS o FROM pos WHERE sector <> 'Other' GROUP BY ALL),
won AS (SELECT key, sector AS won FROM v QUALIFY row_number() OVER (PARTITION BY key ORDER BY w DESC, o) = 1)
"""
)


@_query(_CONS + "SELECT ord, bdc, key, coalesce(won, sector) AS sector, won IS NOT NULL AND won <> sector AS changed FROM pos LEFT JOIN won USING (key)")
def agg09_sector_consensus(spark, sf):
    return op.sector_consensus(positions(spark, sf)).select("ord", "bdc", "key", "sector", "changed")


@_query(_CONS + "SELECT coalesce(won, sector) AS sector, CAST(count(*) AS BIGINT) AS positions, CAST(sum(fv) AS BIGINT) AS fv FROM pos LEFT JOIN won USING (key) GROUP BY 1")
def jn11_sector_write_back(spark, sf):
    return op.sector_consensus(positions(spark, sf)).groupBy("sector").agg(F.count("*").alias("positions"), F.sum("fv").alias("fv"))


@_query(
    POSITION_CTE
    + """, s AS (SELECT lower(entity) AS e, sector, count(*) AS n, min(ord) AS o FROM pos WHERE sector <> 'Other' GROUP BY ALL)
SELECT e AS entity_key, sector, CAST(n AS BIGINT) AS weight FROM s QUALIFY row_number() OVER (PARTITION BY e ORDER BY n DESC, o) = 1"""
)
def agg08_entity_sector(spark, sf):
    p = positions(spark, sf).where("sector <> 'Other'").withColumn("entity_key", F.lower("entity"))
    return op.weighted_choice(p, "entity_key", "sector", F.lit(1), "ord")


_REF = (
    POSITION_CTE
    + """, ref AS (SELECT upper(base) AS base, floor(median(rate - spread) * 100 + 0.5) / 100 AS reference, CAST(count(*) AS BIGINT) AS n FROM pos
WHERE base <> '' AND rate - spread >= 1 AND rate < 30 GROUP BY 1 HAVING count(*) >= 20 AND median(rate - spread) >= 1)
"""
)


@_query(_REF + "SELECT * FROM ref")
def agg10_reference_rate(spark, sf):
    return op.reference_rates(positions(spark, sf))


@_query(
    _REF
    + """, x AS (SELECT pos.*, reference AS r, rate IS NULL OR rate <= spread AS short FROM pos LEFT JOIN ref ON ref.base = CASE WHEN pos.base = '' THEN 'SOFR' ELSE upper(pos.base) END),
y AS (SELECT *, coalesce(spread IS NOT NULL AND r IS NOT NULL AND short, false) AS known, coalesce(spread IS NOT NULL AND NOT (spread IS NOT NULL AND r IS NOT NULL AND short) AND rate IS NOT NULL AND rate <= spread, false) AS blank FROM x)
SELECT ord, base, spread, known OR blank AS rate_est, CASE WHEN known THEN floor((r + spread) * 100 + 0.5) / 100 WHEN blank THEN NULL ELSE rate END AS rate FROM y"""
)
def agg11_rate_fill(spark, sf):
    x = op.fill_rates(positions(spark, sf))
    return x.select("ord", "base", "spread", F.coalesce("rate_est", F.lit(False)).alias("rate_est"), "rate")


# --- totals ---------------------------------------------------------------------------------


@_query(
    POSITION_CTE
    + """SELECT bdc, sector, type, CAST(sum(fv) AS BIGINT) AS fv, CAST(count(*) AS BIGINT) AS positions, CAST(grouping(bdc, sector, type) AS BIGINT) AS level
FROM pos GROUP BY GROUPING SETS ((bdc), (bdc, sector), (bdc, type), (sector), (type))"""
)
def agg12_summary_grouping_sets(spark, sf):
    return op.summary(positions(spark, sf))


@_query(
    POSITION_CTE
    + """SELECT bdc, floor(sum(CASE WHEN sector <> 'Other' THEN fv ELSE 0 END) * 100.0 / sum(fv) * 100 + 0.5) / 100 AS known_pct,
  floor(sum(CASE WHEN sector = 'Other' THEN fv ELSE 0 END) * 100.0 / sum(fv) * 100 + 0.5) / 100 AS other_pct FROM pos GROUP BY bdc"""
)
def agg13_coverage(spark, sf):
    pct = lambda c: fn.half_up(F.sum(F.when(c, F.col("fv")).otherwise(F.lit(0))).cast("double") * 100.0 / F.sum("fv"), 2)
    return positions(spark, sf).groupBy("bdc").agg(pct(F.col("sector") != "Other").alias("known_pct"), pct(F.col("sector") == "Other").alias("other_pct"))


@_query("SELECT period_end, CAST(n AS BIGINT) AS n FROM (SELECT CAST(period_end AS VARCHAR) AS period_end, count(*) AS n FROM soi_position GROUP BY 1) QUALIFY row_number() OVER (ORDER BY n DESC, period_end) = 1")
def agg14_as_of_mode(spark, sf):
    g = table(spark, sf, "soi_position").groupBy(F.col("period_end").cast("string").alias("period_end")).agg(F.count("*").alias("n"))
    return g.orderBy(F.desc("n"), "period_end").limit(1)


_FX = "CASE ccy WHEN 'EUR' THEN 104 WHEN 'GBP' THEN 125 ELSE 100 END"


@_query(POSITION_CTE + f"SELECT bdc, CAST(sum(fv * {_FX}) AS DOUBLE) / 100 AS fv_usd, CAST(count(*) AS BIGINT) AS n FROM pos GROUP BY bdc")
def agg18_value_in_dollars(spark, sf):
    cents = (fn.fx_rate(F.col("ccy")) * 100).cast("bigint")
    return positions(spark, sf).groupBy("bdc").agg((F.sum(F.col("fv") * cents).cast("double") / 100).alias("fv_usd"), F.count("*").alias("n"))


@_query(POSITION_CTE + "SELECT ccy, CAST(sum(fv) AS BIGINT) AS fv, CAST(count(*) AS BIGINT) AS n FROM pos GROUP BY ccy")
def agg35_currency_mix(spark, sf):
    return positions(spark, sf).groupBy("ccy").agg(F.sum("fv").alias("fv"), F.count("*").alias("n"))


@_query(
    POSITION_CTE
    + """, t AS (SELECT bdc, floor(sum(CASE WHEN sector = 'Software' THEN fv ELSE 0 END) * 100.0 / sum(fv) * 10 + 0.5) / 10 AS sector_pct, floor(sum(CASE WHEN type = 'First Lien' THEN fv ELSE 0 END) * 100.0 / sum(fv) * 10 + 0.5) / 10 AS senior_pct,
  floor(sum(CASE WHEN pik THEN fv ELSE 0 END) * 100.0 / sum(fv) * 10 + 0.5) / 10 AS pik_pct, CAST(count(*) AS BIGINT) AS n FROM pos GROUP BY bdc)
SELECT *, floor((senior_pct - pik_pct) * 10 + 0.5) / 10 AS structure FROM t"""
)
def agg23_exposures(spark, sf):
    return op.exposures(positions(spark, sf))


_CONSERVE = (
    POSITION_CTE
    + f""", h AS (SELECT key, type, mat_year, bdc, sum(CAST(floor(mark * 100 + 0.5) AS BIGINT)) AS s, count(*) AS k FROM pos WHERE mark IS NOT NULL AND spread IS NOT NULL AND type IN {_DEBT} GROUP BY ALL),
h1 AS (SELECT *, CAST(floor(CAST(s AS DOUBLE) / k) AS BIGINT) AS bp FROM h),
h2 AS (SELECT *, count(*) OVER w AS holders, CAST(floor(CAST(sum(bp) OVER w AS DOUBLE) / count(*) OVER w) AS BIGINT) AS mean FROM h1 WINDOW w AS (PARTITION BY key, type, mat_year)),
cons AS (SELECT bdc, CAST(count(*) AS BIGINT) AS loans, floor(CAST(sum(bp - mean) AS DOUBLE) / count(*) * 100 + 0.5) / 100 AS deviation_bp FROM h2 WHERE holders >= 2 GROUP BY bdc)
"""
)


@_query(_CONSERVE + "SELECT * FROM cons")
def agg24_conservatism(spark, sf):
    return op.conservatism(positions(spark, sf))


@_query(
    _CONSERVE
    + """, e AS (SELECT bdc, floor(sum(CASE WHEN sector = 'Software' THEN fv ELSE 0 END) * 100.0 / sum(fv) * 10 + 0.5) / 10 AS sector_pct, CASE WHEN bdc IN ('F03', 'F07') THEN NULL ELSE floor(sum(CASE WHEN pik THEN fv ELSE 0 END) * 100.0 / sum(fv) * 10 + 0.5) / 10 END AS pik_pct FROM pos GROUP BY bdc),
j AS (SELECT bdc, sector_pct, pik_pct, deviation_bp FROM e LEFT JOIN cons USING (bdc)),
r AS (SELECT *, CASE WHEN sector_pct IS NOT NULL THEN CAST(row_number() OVER (ORDER BY sector_pct NULLS LAST, bdc) AS DOUBLE) ELSE (count(sector_pct) OVER () + 1) / 2 END AS sector_rank,
 CASE WHEN pik_pct IS NOT NULL THEN CAST(row_number() OVER (ORDER BY pik_pct NULLS LAST, bdc) AS DOUBLE) ELSE (count(pik_pct) OVER () + 1) / 2 END AS pik_rank,
 CASE WHEN deviation_bp IS NOT NULL THEN CAST(row_number() OVER (ORDER BY deviation_bp DESC NULLS LAST, bdc) AS DOUBLE) ELSE (count(deviation_bp) OVER () + 1) / 2 END AS mark_rank FROM j)
SELECT *, floor((sector_rank + pik_rank + mark_rank) / 3 * 100 + 0.5) / 100 AS composite FROM r"""
)
def win01_screener_rank(spark, sf):
    p = positions(spark, sf)
    e = op.exposures(p).select("bdc", "sector_pct", F.when(~F.col("bdc").isin("F03", "F07"), F.col("pik_pct")).alias("pik_pct"))
    j = e.join(op.conservatism(p).select("bdc", "deviation_bp"), "bdc", "left")
    r = j.select(
        "*", op.stable_rank(j, "sector_pct", "bdc").alias("sector_rank"), op.stable_rank(j, "pik_pct", "bdc").alias("pik_rank"),
        op.stable_rank(j, "deviation_bp", "bdc", ascending=False).alias("mark_rank"),
    )
    return r.withColumn("composite", fn.half_up((F.col("sector_rank") + F.col("pik_rank") + F.col("mark_rank")) / 3, 2))


# --- cleaning operators ---------------------------------------------------------------------

_ROLL = """WITH b AS (SELECT CAST(l_suppkey % 19 AS BIGINT) AS filing, p_name || ' ' || CAST(p_partkey % 400 AS VARCHAR) AS bare, l_linenumber AS ln, l_extendedprice AS v, l_returnflag AS rf FROM lineitem JOIN part ON l_partkey = p_partkey),
leaf AS (SELECT filing, bare || ', Tranche ' || CAST(ln AS VARCHAR) AS ident, CAST(sum(floor(v)) AS BIGINT) * 1000 AS fv, CAST(1000 AS BIGINT) AS cost FROM b GROUP BY filing, bare, ln),
bare AS (SELECT filing, bare AS ident, CAST(sum(floor(v)) AS BIGINT) * 1000 + CASE WHEN length(bare) % 3 = 0 THEN 0 ELSE 9000000 END AS fv, CAST(CASE WHEN length(bare) % 2 = 0 THEN 0 ELSE 500 END AS BIGINT) AS cost FROM b GROUP BY filing, bare),
r AS (SELECT * FROM leaf UNION ALL SELECT * FROM bare)
"""


def _rollup_rows(spark, sf) -> DataFrame:
    """Identifiers with tranches, and bare rows that sum them up, exceed them or stand alone."""
    b = table(spark, sf, "lineitem").join(table(spark, sf, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    b = b.select((F.col("l_suppkey") % 19).cast("bigint").alias("filing"), F.concat("p_name", F.lit(" "), (F.col("p_partkey") % 400).cast("string")).alias("bare"), F.col("l_linenumber").alias("ln"), F.floor("l_extendedprice").cast("bigint").alias("v"))
    g = b.groupBy("filing", "bare", "ln").agg((F.sum("v") * 1000).alias("fv"))
    leaf = g.select("filing", F.concat("bare", F.lit(", Tranche "), F.col("ln").cast("string")).alias("ident"), "fv", F.lit(1000).cast("bigint").alias("cost"))
    n = F.length("bare")
    bare = g.groupBy("filing", "bare").agg(F.sum("fv").alias("s")).select("filing", F.col("bare").alias("ident"), (F.col("s") + F.when(n % 3 == 0, 0).otherwise(9000000)).cast("bigint").alias("fv"), F.when(n % 2 == 0, 0).otherwise(500).cast("bigint").alias("cost"))
    return leaf.unionByName(bare)


@_query(
    _ROLL
    + """SELECT p.filing, p.ident, p.fv, CAST(sum(l.fv) AS BIGINT) AS leaf_fv, CAST(count(*) AS BIGINT) AS leaves,
  CASE WHEN abs(p.fv - sum(l.fv)) <= greatest(50000, 0.005 * abs(sum(l.fv))) THEN 'rollup' WHEN p.cost = 0 THEN 'partial' ELSE 'own' END AS status,
  CAST(CASE WHEN abs(p.fv - sum(l.fv)) > greatest(50000, 0.005 * abs(sum(l.fv))) AND p.cost = 0 AND p.fv > sum(l.fv) THEN p.fv - sum(l.fv) ELSE 0 END AS BIGINT) AS excess
FROM r p JOIN r l ON l.filing = p.filing AND l.ident <> p.ident AND (starts_with(l.ident, p.ident || ',') OR starts_with(l.ident, p.ident || ' ,')) GROUP BY p.filing, p.ident, p.fv, p.cost"""
)
def agg02_rollup(spark, sf):
    return op.rollup_status(_rollup_rows(spark, sf))


@_query(
    _ROLL
    + """, x AS (SELECT p.filing, p.ident, p.fv, p.cost, sum(l.fv) AS s FROM r p JOIN r l ON l.filing = p.filing AND l.ident <> p.ident AND starts_with(l.ident, p.ident || ',') GROUP BY ALL)
SELECT filing, ident || ' - Other (partial rollup excess)' AS ident, CAST(fv - s AS BIGINT) AS fv FROM x WHERE abs(fv - s) > greatest(50000, 0.005 * abs(s)) AND cost = 0 AND fv - s >= 50000"""
)
def agg03_excess_rows(spark, sf):
    x = op.rollup_status(_rollup_rows(spark, sf)).where("excess >= 50000")
    return x.select("filing", F.concat("ident", F.lit(" - Other (partial rollup excess)")).alias("ident"), F.col("excess").cast("bigint").alias("fv"))


@_query(
    _ROLL
    + """, k AS (SELECT *, lower(trim(split_part(ident, ',', 1))) AS seg FROM r), w AS (SELECT *, sum(CASE WHEN cost <> 0 THEN fv END) OVER (PARTITION BY filing, seg) AS sib FROM k)
SELECT filing, ident, fv FROM w WHERE NOT (cost = 0 AND sib IS NOT NULL AND abs(fv - sib) <= greatest(50000, 0.005 * abs(sib)))"""
)
def agg04_secondary_rollup(spark, sf):
    r = _rollup_rows(spark, sf).withColumn("seg", F.lower(F.trim(F.get(F.split("ident", ","), F.lit(0)))))
    sib = F.sum(F.when(F.col("cost") != 0, F.col("fv"))).over(Window.partitionBy("filing", "seg"))
    near = F.abs(F.col("fv") - F.col("sib")) <= F.greatest(F.lit(50000.0), 0.005 * F.abs("sib"))
    return r.withColumn("sib", sib).where(~((F.col("cost") == 0) & F.col("sib").isNotNull() & near)).select("filing", "ident", "fv")


@_query(
    POSITION_CTE
    + """, z AS (SELECT bdc, key, type, CAST(floor(fv / 1000) AS BIGINT) AS v, CASE WHEN pik THEN 0 ELSE cost END AS c, ord FROM pos),
w AS (SELECT *, max(CASE WHEN c <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY bdc, key, type, v) AS b FROM z) SELECT ord, bdc, key, type, v, c FROM w WHERE NOT (c = 0 AND b = 1)"""
)
def agg05_alias_dedupe(spark, sf):
    p = positions(spark, sf).select("ord", "bdc", "key", "type", F.floor(F.col("fv") / 1000).cast("bigint").alias("v"), F.when(F.col("pik"), F.lit(0)).otherwise(F.col("cost")).cast("bigint").alias("c"))
    return op.drop_aliases(p, ["bdc", "key", "type"], fv="v", cost="c")


@_query(
    """WITH g AS (SELECT l_suppkey AS grp, l_orderkey AS place FROM lineitem GROUP BY ALL),
d AS (SELECT grp, place, lead(place) OVER (PARTITION BY grp ORDER BY place) - place AS gap FROM g)
SELECT CAST(grp AS BIGINT) AS grp, CAST(place AS BIGINT) AS cut_after, CAST(gap AS BIGINT) AS gap FROM d WHERE gap IS NOT NULL QUALIFY row_number() OVER (PARTITION BY grp ORDER BY gap DESC, place) = 1"""
)
def win03_gap_split(spark, sf):
    g = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("grp"), F.col("l_orderkey").alias("place")).distinct()
    return op.largest_gap(g, "grp", "place")


# --- joins ----------------------------------------------------------------------------------

_TOL = """WITH a AS (SELECT CAST(l_partkey AS BIGINT) AS key, CAST(floor(l_extendedprice + 0.5) AS BIGINT) AS fv, lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') || lpad(CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS VARCHAR), 14, '0') AS ord, l_returnflag AS f FROM lineitem),
l AS (SELECT ord AS id, key, fv FROM a WHERE f = 'A'), r AS (SELECT ord AS row, ord, key, fv AS value FROM a WHERE f = 'R')
"""


def _sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    a = table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("bigint").alias("key"), F.floor(F.col("l_extendedprice") + 0.5).cast("bigint").alias("fv"), "l_returnflag",
        F.concat(pad(F.col("l_orderkey"), 12), pad(F.col("l_linenumber"), 3), pad(F.col("l_suppkey"), 8), pad(F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("bigint"), 14)).alias("ord"),
    )
    left = a.where("l_returnflag = 'A'").select(F.col("ord").alias("id"), "key", "fv")
    return left, a.where("l_returnflag = 'R'").select(F.col("ord").alias("row"), "ord", "key", F.col("fv").alias("value"))


@_query(
    _TOL
    + """SELECT id, row, value FROM l JOIN r ON l.key = r.key AND abs(value - fv) <= greatest(5, floor(abs(fv) * 0.01))
QUALIFY row_number() OVER (PARTITION BY id ORDER BY value, ord) = 1"""
)
def jn05_tolerance_join(spark, sf):
    return op.tolerance_join(*_sides(spark, sf))


@_query("""SELECT CAST(c_custkey AS BIGINT) AS id, CAST(s_suppkey AS BIGINT) AS row, CAST(floor(c_acctbal * 10) AS BIGINT) AS fv, CAST(floor(s_acctbal * 10) AS BIGINT) AS value FROM customer JOIN supplier
ON abs(floor(s_acctbal * 10) - floor(c_acctbal * 10)) <= greatest(5, floor(abs(floor(c_acctbal * 10)) * 0.01))""")
def jn06_band_join(spark, sf):
    left = table(spark, sf, "customer").select(F.col("c_custkey").cast("bigint").alias("id"), F.floor(F.col("c_acctbal") * 10).cast("bigint").alias("fv"))
    right = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("bigint").alias("row"), F.floor(F.col("s_acctbal") * 10).cast("bigint").alias("value"))
    return op.band_join(left, right)


@_query("""SELECT a.pos_id, CAST(count(h.row_id) AS BIGINT) AS rows FROM soi_position a LEFT JOIN html_row h ON h.bdc = a.bdc AND h.period_end = a.period_end AND h.issuer = a.entity GROUP BY a.pos_id""")
def jn08_left_enrichment(spark, sf):
    n = table(spark, sf, "html_row").where("issuer is not null").groupBy("bdc", "period_end", F.col("issuer").alias("entity")).agg(F.count("*").alias("rows"))
    return table(spark, sf, "soi_position").select("pos_id", "bdc", "period_end", "entity").join(n, ["bdc", "period_end", "entity"], "left").select("pos_id", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"))


@_query("""SELECT coalesce(f.ticker, b.ticker) AS ticker, f.name, CAST(b.periods AS BIGINT) AS periods FROM fund f FULL JOIN (SELECT ticker, count(*) AS periods FROM balance_sheet WHERE nav IS NOT NULL GROUP BY 1) b ON b.ticker = f.ticker""")
def jn12_full_outer(spark, sf):
    b = table(spark, sf, "balance_sheet").where("nav is not null").groupBy("ticker").agg(F.count("*").alias("periods"))
    return table(spark, sf, "fund").select("ticker", "name").join(b, "ticker", "full")


@_query("""SELECT DISTINCT entity FROM soi_position WHERE entity IS NOT NULL AND entity NOT IN (SELECT issuer FROM html_row WHERE issuer IS NOT NULL)""")
def jn17_names_not_listed(spark, sf):
    known = table(spark, sf, "html_row").select(F.col("issuer").alias("entity")).where("entity is not null")
    return table(spark, sf, "soi_position").where("entity is not null").select("entity").distinct().join(known, "entity", "left_anti")


@_query("""WITH s AS (SELECT bdc, CAST(period_end AS VARCHAR) AS period_end, CAST(count(*) AS BIGINT) AS positions FROM soi_position GROUP BY ALL)
SELECT s.bdc, s.period_end, positions, portfolio_fv, CASE WHEN portfolio_fv IS NULL THEN 'NONE' WHEN positions >= 30 THEN 'OK' WHEN positions >= 10 THEN 'WARN' ELSE 'LOW' END AS status FROM s LEFT JOIN balance_sheet b ON b.ticker = s.bdc AND CAST(b.period_end AS VARCHAR) = s.period_end""")
def jn16_status(spark, sf):
    s = table(spark, sf, "soi_position").groupBy("bdc", F.col("period_end").cast("string").alias("period_end")).agg(F.count("*").alias("positions"))
    b = table(spark, sf, "balance_sheet").select(F.col("ticker").alias("bdc"), F.col("period_end").cast("string").alias("period_end"), "portfolio_fv")
    n = F.col("positions")
    return s.join(F.broadcast(b), ["bdc", "period_end"], "left").select("bdc", "period_end", "positions", "portfolio_fv", F.when(F.col("portfolio_fv").isNull(), "NONE").when(n >= 30, "OK").when(n >= 10, "WARN").otherwise("LOW").alias("status"))


# --- text functions -------------------------------------------------------------------------


@_query(_KEYS + f"SELECT pos_id, array_to_string(w, ' ') AS key FROM w{fn.MOST_ENDINGS}")
def fn15_borrower_key(spark, sf):
    return table(spark, sf, "soi_position").select("pos_id", fn.borrower_key(F.col("entity")).alias("key"))


@_query(
    "SELECT pos_id, CASE "
    + " ".join(f"WHEN regexp_matches(type, '{p}', 'i') THEN '{b}'" for p, b in fn.TYPE_PATTERNS)
    + " ELSE 'Other' END AS bucket FROM soi_position"
)
def fn08_type(spark, sf):
    return table(spark, sf, "soi_position").select("pos_id", fn.security_type(F.col("type")).alias("bucket"))


@_query(f"""SELECT pos_id, array_to_string(list_filter(regexp_split_to_array(regexp_replace(lower(e), '\\([^)]*\\)', ' ', 'g'), '[^a-z0-9_]+'), lambda w: w <> '' AND w NOT IN {fn.ISSUER_WORDS}), ' ') AS key
FROM (SELECT pos_id, regexp_replace(entity, '[^ -~]', '?', 'g') AS e FROM soi_position)""")
def fn14_issuer_key(spark, sf):
    return table(spark, sf, "soi_position").select("pos_id", fn.issuer_key(F.regexp_replace("entity", r"[^ -~]", "?")).alias("key"))


@_query(r"""WITH n AS (SELECT pos_id, entity, regexp_replace(entity, '(?i)\s*\((?:dba|d/b/a|a/k/a|aka|fka|f/k/a|formerly)\b[^)]*\)', '', 'g') AS x FROM soi_position)
SELECT pos_id, trim(regexp_extract(entity, '(?i)\((?:dba|d/b/a|a/k/a|aka)\s+([^)]+)\)', 1)) AS common,
regexp_replace(array_to_string(list_filter(regexp_split_to_array(regexp_split_to_array(x, '(?i)\||\s[-–—]\s|\s*\((?:fka|f/k/a|formerly)\b')[1], ' +'), lambda w: w <> ''), ' '), '[ |,]+$', '') AS legal FROM n""")
def fn18_split_name(spark, sf):
    e = F.col("entity")
    return table(spark, sf, "soi_position").select("pos_id", fn.trade_name(e).alias("common"), fn.legal_name(e).alias("legal"))


@_query(r"SELECT pos_id, CAST(nullif(regexp_extract(maturity, '(20\d\d)', 1), '') AS BIGINT) AS year FROM soi_position")
def fn26_maturity_year(spark, sf):
    return table(spark, sf, "soi_position").select("pos_id", fn.maturity_year(F.col("maturity")).cast("bigint").alias("year"))


@_query(POSITION_CTE + "SELECT ord, fv, cost, par, type, mark FROM pos")
def fn07_mark(spark, sf):
    return positions(spark, sf).select("ord", "fv", "cost", "par", "type", "mark")


@_query("SELECT pos_id, round_even(spread * 4, 0) / 4 AS spread_q FROM soi_position WHERE spread IS NOT NULL")
def fn27_spread_step(spark, sf):
    return table(spark, sf, "soi_position").where("spread is not null").select("pos_id", fn.spread_step(F.col("spread")).cast("double").alias("spread_q"))


@_query("""SELECT accession, CASE WHEN starts_with(form, '10-K') THEN 'FY' || CAST(year(period_end) AS VARCHAR) ELSE 'Q' || CAST(quarter(period_end) AS VARCHAR) || ' ' || CAST(year(period_end) AS VARCHAR) END AS label FROM filing""")
def fn30_period_label(spark, sf):
    return table(spark, sf, "filing").select("accession", fn.period_label(F.col("period_end"), F.col("form")).alias("label"))


@_query()
def fn02_member_words(spark, sf):
    return table(spark, sf, "balance_sheet").select("ticker", F.col("period_end").cast("string").alias("period_end"), fn.camel_words(F.col("gross_debt_concept")).alias("words"))


@_query()
def fn45_one_space(spark, sf):
    return table(spark, sf, "html_row").select("row_id", one_space(F.col("issuer")).alias("issuer"))


# --- series, balance sheets, news, audits -----------------------------------------------------

_CLOSE = """WITH c AS (SELECT event_type AS ticker, CAST(ts AS DATE) AS d, arg_max(value, {'a': ts, 'b': event_id}) AS close FROM events GROUP BY ALL),
l AS (SELECT *, max(d) OVER (PARTITION BY ticker) AS ld FROM c)
"""


@_query(
    _CLOSE
    + """, g AS (SELECT ticker, max(ld) AS as_of, arg_max(close, d) AS last, arg_max(close, d) FILTER (WHERE d < ld) AS prev, arg_max(close, d) FILTER (WHERE d < date_trunc('month', ld)) AS mb, arg_max(close, d) FILTER (WHERE d < date_trunc('year', ld)) AS yb, arg_min(close, d) AS first FROM l GROUP BY ticker)
SELECT ticker, CAST(as_of AS VARCHAR) AS as_of, last, prev, floor((last - prev) / nullif(prev, 0) * 100 * 100 + 0.5) / 100 AS day_pct, floor((last - mb) / nullif(mb, 0) * 100 * 100 + 0.5) / 100 AS mtd_pct, floor((last - yb) / nullif(yb, 0) * 100 * 100 + 0.5) / 100 AS ytd_pct, floor((last - first) / nullif(first, 0) * 100 * 100 + 0.5) / 100 AS window_pct FROM g"""
)
def agg16_returns(spark, sf):
    e = table(spark, sf, "events")
    c = e.groupBy(F.col("event_type").alias("ticker"), F.col("ts").cast("date").alias("date")).agg(F.max_by("value", F.struct("ts", "event_id")).alias("close"))
    return op.period_returns(c)


@_query("""SELECT ticker, CAST(period_end AS VARCHAR) AS period_end, nav, gross_debt, nav + gross_debt AS gav, floor(CAST(gross_debt AS DOUBLE) / nullif(CAST(nav + gross_debt AS DOUBLE), 0) * 100 * 100 + 0.5) / 100 AS ltv_pct, floor(CAST(gross_debt AS DOUBLE) / CAST(nav AS DOUBLE) * 100 + 0.5) / 100 AS debt_to_equity,
floor(CAST(nav - lag(nav) OVER w AS DOUBLE) / CAST(lag(nav) OVER w AS DOUBLE) * 100 * 100 + 0.5) / 100 AS nav_change_pct FROM balance_sheet WHERE nav <> 0 WINDOW w AS (PARTITION BY ticker ORDER BY period_end)""")
def fn32_leverage(spark, sf):
    return op.fund_leverage(table(spark, sf, "balance_sheet"))


@_query("""SELECT ticker, arg_max(nav, period_end) FILTER (WHERE nav IS NOT NULL) AS nav, arg_max(gross_debt, period_end) FILTER (WHERE gross_debt IS NOT NULL) AS gross_debt FROM balance_sheet GROUP BY ticker""")
def agg15_latest_fact(spark, sf):
    pick = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("period_end"))).alias(c)
    return table(spark, sf, "balance_sheet").groupBy("ticker").agg(pick("nav"), pick("gross_debt"))


@_query("""SELECT bdc, arg_max(accession, {'d': file_date, 'a': accession}) AS accession, max(accession) AS max_accession, CAST(count(*) AS BIGINT) AS filings FROM filing GROUP BY bdc""")
def src17_latest_filing(spark, sf):
    return table(spark, sf, "filing").groupBy("bdc").agg(F.max_by("accession", F.struct("file_date", "accession")).alias("accession"), F.max("accession").alias("max_accession"), F.count("*").alias("filings"))


@_query(r"""WITH t AS (SELECT doc_id, trim(regexp_replace(lower(regexp_replace(split_part(text, chr(10), 1), '[^ -~]', '?', 'g')), '[^a-z0-9]+', ' ', 'g')) AS k, bdc, source FROM documents)
SELECT k AS title_key, CAST(min(doc_id) AS BIGINT) AS first_doc, array_to_string(list_sort(list_distinct(list(bdc) FILTER (WHERE bdc IS NOT NULL))), ',') AS tickers, arg_min({'s': source}, doc_id).s AS source, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY k""")
def agg32_news_merge(spark, sf):
    line = F.regexp_replace(F.get(F.split("text", "\n"), F.lit(0)), r"[^ -~]", "?")
    t = table(spark, sf, "documents").select("doc_id", F.trim(F.regexp_replace(F.lower(line), r"[^a-z0-9]+", " ")).alias("title_key"), "bdc", "source")
    g = t.groupBy("title_key").agg(F.min("doc_id").alias("first_doc"), F.array_join(F.array_sort(F.collect_set("bdc")), ",").alias("tickers"), F.min_by(F.struct("source"), "doc_id").alias("s"), F.count("*").alias("n"))
    return g.select("title_key", "first_doc", F.when(F.col("tickers") != "", F.col("tickers")).alias("tickers"), "s.source", "n")


SQL["agg32_news_merge"] = SQL["agg32_news_merge"].replace("array_to_string(list_sort", "nullif(array_to_string(list_sort").replace("IS NOT NULL))), ',')", "IS NOT NULL))), ','), '')")

_ISSUES = {
    "no_type": "type IS NULL OR trim(type) = ''",
    "no_entity": "entity IS NULL OR trim(entity) = ''",
    "no_fv": "fv IS NULL",
    "negative_fv": "fv < 0",
    "zero_cost": "cost = 0",
    "mark_off": "mark < 40 OR mark > 130",
    "rate_below_spread": "rate <= spread",
    "pik_without_rate": "pik AND pik_rate IS NULL",
}


def _issues(t: DataFrame) -> DataFrame:
    """(pos_id, bdc, issue): every quality rule that a position breaks."""
    codes = F.filter(F.array(*[F.when(F.expr(c), F.lit(k)) for k, c in _ISSUES.items()]), lambda x: x.isNotNull())
    return t.select("pos_id", "bdc", F.explode(codes).alias("issue"))


_ISSUE_SQL = "WITH i AS (" + " UNION ALL ".join(f"SELECT pos_id, bdc, '{k}' AS issue FROM soi_position WHERE {c}" for k, c in _ISSUES.items()) + ") "


@_query(_ISSUE_SQL + "SELECT bdc, " + ", ".join(f"CAST(count(*) FILTER (WHERE issue = '{k}') AS BIGINT) AS {k}" for k in _ISSUES) + " FROM i GROUP BY bdc")
def agg28_quality(spark, sf):
    g = _issues(table(spark, sf, "soi_position")).groupBy("bdc").pivot("issue", list(_ISSUES)).agg(F.count("pos_id"))
    return g.fillna(0, list(_ISSUES))


@_query(_ISSUE_SQL + "SELECT issue, pos_id FROM i QUALIFY row_number() OVER (PARTITION BY issue ORDER BY pos_id) <= 3")
def agg28_samples(spark, sf):
    """At most three sample rows an issue: a report."""
    w = Window.partitionBy("issue").orderBy("pos_id")
    return _issues(table(spark, sf, "soi_position")).withColumn("r", F.row_number().over(w)).where("r <= 3").select("issue", "pos_id")


@_query("""SELECT bdc, CAST(count(*) AS BIGINT) AS eligible, floor(CAST(count(*) FILTER (WHERE m) AS DOUBLE) / count(*) * 10000 + 0.5) / 10000 AS rate FROM (
SELECT s.bdc, EXISTS (SELECT 1 FROM html_row h WHERE h.bdc = s.bdc AND h.period_end = s.period_end AND h.issuer = s.entity) AS m FROM soi_position s WHERE fv <> 0 AND NOT (coalesce(cost, 0) = 0 AND coalesce(par, 0) = 0)) GROUP BY bdc""")
def agg25_match_rate(spark, sf):
    h = table(spark, sf, "html_row").select("bdc", "period_end", F.col("issuer").alias("entity"), F.lit(1).alias("hit")).where("entity is not null").distinct()
    s = table(spark, sf, "soi_position").where("fv <> 0 and not (coalesce(cost, 0) = 0 and coalesce(par, 0) = 0)").select("bdc", "period_end", "entity")
    return s.join(h, ["bdc", "period_end", "entity"], "left").groupBy("bdc").agg(F.count("*").alias("eligible"), fn.half_up(F.count("hit").cast("double") / F.count("*"), 4).alias("rate"))


@_query("""SELECT bdc, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE fv <> 0) AS BIGINT) AS valued FROM soi_position GROUP BY bdc""")
def agg26_universe(spark, sf):
    return table(spark, sf, "soi_position").groupBy("bdc").agg(F.count("*").alias("rows"), F.count(F.when(F.col("fv") != 0, 1)).alias("valued"))


@_query(
    POSITION_CTE
    + """, g AS (SELECT entity, CAST(sum(fv) AS BIGINT) AS fv, CAST(count(DISTINCT bdc) AS BIGINT) AS funds FROM pos GROUP BY entity) SELECT * FROM g ORDER BY fv DESC, entity LIMIT 1000"""
)
def agg29_work_list(spark, sf):
    """The thousand largest names: a top-k report."""
    g = positions(spark, sf).groupBy("entity").agg(F.sum("fv").alias("fv"), F.count_distinct("bdc").alias("funds"))
    return g.orderBy(F.desc("fv"), "entity").limit(1000)


@_query("""SELECT c_custkey AS custkey, c_name AS name, CAST(coalesce(n, 0) AS BIGINT) AS orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY 1) ON o_custkey = c_custkey""")
def jn13_left_join(spark, sf):
    n = table(spark, sf, "orders").where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return table(spark, sf, "customer").join(n, "c_custkey", "left").select(F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"), F.coalesce("n", F.lit(0)).cast("bigint").alias("orders"))


@_query("SELECT DISTINCT bdc FROM soi_position UNION SELECT DISTINCT ticker FROM balance_sheet")
def set03_key_union(spark, sf):
    return table(spark, sf, "soi_position").select("bdc").union(table(spark, sf, "balance_sheet").select("ticker")).distinct()


@_query("SELECT DISTINCT entity FROM soi_position WHERE entity IS NOT NULL INTERSECT SELECT DISTINCT issuer FROM html_row")
def set04_shared_names(spark, sf):
    return table(spark, sf, "soi_position").select("entity").where("entity is not null").intersect(table(spark, sf, "html_row").select("issuer"))


# --- further totals, lookups and functions ----------------------------------------------------


@_query(POSITION_CTE + "SELECT bdc, CAST(sum(fv) AS BIGINT) AS fv, CAST(sum(cost) AS BIGINT) AS cost, CAST(count(DISTINCT key) AS BIGINT) AS borrowers FROM pos GROUP BY bdc")
def agg20_fund_totals(spark, sf):
    return positions(spark, sf).groupBy("bdc").agg(F.sum("fv").alias("fv"), F.sum("cost").alias("cost"), F.count_distinct("key").alias("borrowers"))


@_query(r"""WITH x AS (SELECT pos_id, regexp_replace(entity, '(?i)\s*\((?:dba|d/b/a|a/k/a|aka)\s+[^)]*\)', '', 'g') AS legal, trim(regexp_extract(entity, '(?i)\((?:dba|d/b/a|a/k/a|aka)\s+([^)]+)\)', 1)) AS common FROM soi_position)
SELECT legal, arg_min(common, pos_id) AS common FROM x WHERE common <> '' GROUP BY legal""")
def agg30_common_names(spark, sf):
    e = F.col("entity")
    x = table(spark, sf, "soi_position").select("pos_id", F.regexp_replace(e, r"(?i)\s*\((?:dba|d/b/a|a/k/a|aka)\s+[^)]*\)", "").alias("legal"), fn.trade_name(e).alias("common"))
    return x.where("common <> ''").groupBy("legal").agg(F.min_by("common", "pos_id").alias("common"))


@_query("""SELECT form, affil IS NULL OR affil = '' AS unstated, CAST(count(*) AS BIGINT) AS n FROM (SELECT DISTINCT form, affil, identifier, floor(fv) AS v FROM soi_position) GROUP BY ALL""")
def agg31_canonical_values(spark, sf):
    d = table(spark, sf, "soi_position").select("form", "affil", "identifier", F.floor("fv").alias("v")).distinct()
    return d.groupBy("form", (F.col("affil").isNull() | (F.col("affil") == "")).alias("unstated")).agg(F.count("*").alias("n"))


_DELTA = """WITH t AS (SELECT ticker, portfolio_fv, total_assets, CAST(portfolio_fv - total_assets AS DOUBLE) / nullif(CAST(total_assets AS DOUBLE), 0) * 100 AS d FROM balance_sheet WHERE portfolio_fv IS NOT NULL AND total_assets IS NOT NULL)
"""


def _deltas(spark, sf) -> DataFrame:
    d = F.try_divide((F.col("portfolio_fv") - F.col("total_assets")).cast("double"), F.col("total_assets").cast("double")) * 100
    return table(spark, sf, "balance_sheet").where("portfolio_fv is not null and total_assets is not null").select("ticker", d.alias("d"))


@_query(_DELTA + "SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE abs(d) <= 5) AS BIGINT) AS within_5, CAST(count(*) FILTER (WHERE abs(d) <= 20) AS BIGINT) AS within_20 FROM t")
def agg33_status_kpis(spark, sf):
    near = lambda k: F.count(F.when(F.abs("d") <= k, 1)).alias(f"within_{k}")
    return _deltas(spark, sf).agg(F.count("*").alias("n"), near(5), near(20))


@_query(_DELTA + "SELECT CASE WHEN abs(d) <= 5 THEN 'OK' WHEN abs(d) <= 20 THEN 'WARN' ELSE 'BAD' END AS band, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY 1")
def agg34_bands(spark, sf):
    band = F.when(F.abs("d") <= 5, "OK").when(F.abs("d") <= 20, "WARN").otherwise("BAD")
    return _deltas(spark, sf).groupBy(band.alias("band")).agg(F.count("*").alias("n"))


@_query("""WITH r AS (SELECT DISTINCT s_suppkey AS e, s_name || CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE ' 1.' || CAST(s_suppkey % 10 AS VARCHAR) END AS ident, floor(s_acctbal) AS fv, CAST(floor(s_suppkey / 2) AS BIGINT) AS entity FROM supplier)
SELECT CAST(a.e AS BIGINT) AS id FROM r a WHERE regexp_matches(a.ident, ' \\d\\.\\d$') AND EXISTS (SELECT 1 FROM r b WHERE b.entity = a.entity AND NOT regexp_matches(b.ident, ' \\d\\.\\d$') AND abs(a.fv - b.fv) < 1000)""".replace("\\\\", "\\"))
def jn04_numbered_alias(spark, sf):
    k = F.col("s_suppkey")
    r = table(spark, sf, "supplier").select(k.cast("bigint").alias("id"), F.concat("s_name", F.when(k % 2 == 0, "").otherwise(F.concat(F.lit(" 1."), (k % 10).cast("string")))).alias("ident"), F.floor("s_acctbal").alias("fv"), F.floor(k / 2).cast("bigint").alias("entity"))
    numbered = F.col("ident").rlike(r" \d\.\d$")
    plain = r.where(~numbered).select("entity", F.col("fv").alias("other"))
    return r.where(numbered).join(plain, "entity").where(F.abs(F.col("fv") - F.col("other")) < 1000).select("id").distinct()


@_query("""SELECT s.pos_id, c.label_id FROM soi_position s JOIN canon_label c ON c.kind = 'sector' AND c.label = s.sector""")
def jn09_label_lookup(spark, sf):
    c = table(spark, sf, "canon_label").where("kind = 'sector'").select(F.col("label").alias("sector"), "label_id")
    return table(spark, sf, "soi_position").select("pos_id", "sector").join(F.broadcast(c), "sector").select("pos_id", "label_id")


@_query("""SELECT f.ticker, f.name, CAST(n AS BIGINT) AS positions, nav FROM fund f JOIN (SELECT bdc, count(*) AS n FROM soi_position GROUP BY 1) s ON s.bdc = f.ticker LEFT JOIN (SELECT ticker, arg_max(nav, period_end) FILTER (WHERE nav IS NOT NULL) AS nav FROM balance_sheet GROUP BY 1) b ON b.ticker = f.ticker""")
def jn14_universe(spark, sf):
    n = table(spark, sf, "soi_position").groupBy(F.col("bdc").alias("ticker")).agg(F.count("*").alias("positions"))
    b = table(spark, sf, "balance_sheet").groupBy("ticker").agg(F.max_by("nav", F.when(F.col("nav").isNotNull(), F.col("period_end"))).alias("nav"))
    return table(spark, sf, "fund").select("ticker", "name").join(n, "ticker").join(b, "ticker", "left")


@_query(POSITION_CTE + f"SELECT ord, ccy, CAST({_FX} AS DOUBLE) / 100 AS usd_per_unit FROM pos")
def jn18_fx_lookup(spark, sf):
    return positions(spark, sf).select("ord", "ccy", fn.fx_rate(F.col("ccy")).alias("usd_per_unit"))


@_query("SELECT DISTINCT entity FROM soi_position WHERE entity IS NOT NULL EXCEPT SELECT issuer FROM documents")
def set05_difference(spark, sf):
    return table(spark, sf, "soi_position").select("entity").where("entity is not null").distinct().subtract(table(spark, sf, "documents").select("issuer"))


@_query("""SELECT pos_id, CAST(len(list_intersect(string_split(lower(regexp_replace(entity, '[^ -~]', '?', 'g')), ' '), string_split(lower(regexp_replace(company, '[^ -~]', '?', 'g')), ' '))) AS BIGINT) AS shared FROM soi_position WHERE entity IS NOT NULL AND company IS NOT NULL""")
def set06_token_overlap(spark, sf):
    words = lambda c: F.split(F.lower(F.regexp_replace(c, r"[^ -~]", "?")), " ")
    return table(spark, sf, "soi_position").where("entity is not null and company is not null").select("pos_id", F.size(F.array_intersect(words("entity"), words("company"))).cast("bigint").alias("shared"))


@_query("SELECT DISTINCT bdc, caption FROM html_row")
def set07_distinct_captions(spark, sf):
    return table(spark, sf, "html_row").select("bdc", "caption").dropDuplicates()


@_query("SELECT pos_id, CASE WHEN abs(mark / 100) <= 1 AND mark <> 0 THEN floor(mark / 100 * 100 * 10000 + 0.5) / 10000 ELSE mark / 100 END AS pct FROM soi_position WHERE mark IS NOT NULL")
def fn03_as_percent(spark, sf):
    return table(spark, sf, "soi_position").where("mark is not null").select("pos_id", fn.as_percent(F.col("mark") / 100).alias("pct"))


@_query("SELECT row_id, CASE WHEN cost IS NULL THEN NULL ELSE CAST(CASE WHEN row_id % 2 = 0 THEN -floor(abs(cost)) ELSE floor(abs(cost)) END AS DOUBLE) END AS amount FROM html_row")
def fn20_money(spark, sf):
    whole = F.floor(F.abs("cost")).cast("bigint").cast("string")
    cell = F.when(F.col("row_id") % 2 == 0, F.concat(F.lit("$("), whole, F.lit(")"))).otherwise(F.concat(F.lit("$ "), whole))
    return table(spark, sf, "html_row").select("row_id", fn.money(F.coalesce(cell, F.lit("—"))).alias("amount"))


@_query("""SELECT ticker, CAST(period_end AS VARCHAR) AS period_end, floor((nav - lag(nav) OVER w) / nullif(lag(nav) OVER w, 0) * 100 * 100 + 0.5) / 100 AS pct FROM balance_sheet WINDOW w AS (PARTITION BY ticker ORDER BY period_end)""")
def fn31_percent_change(spark, sf):
    before = F.lag("nav").over(Window.partitionBy("ticker").orderBy("period_end"))
    return table(spark, sf, "balance_sheet").select("ticker", F.col("period_end").cast("string").alias("period_end"), fn.percent_change(F.col("nav").cast("double"), before.cast("double")).alias("pct"))


@_query(_CLOSE + "SELECT ticker, CAST(d AS VARCHAR) AS d, close, lag(close) OVER (PARTITION BY ticker ORDER BY d) AS prev FROM c")
def win06_previous_close(spark, sf):
    e = table(spark, sf, "events")
    c = e.groupBy(F.col("event_type").alias("ticker"), F.col("ts").cast("date").alias("d")).agg(F.max_by("value", F.struct("ts", "event_id")).alias("close"))
    return c.select("ticker", F.col("d").cast("string").alias("d"), "close", F.lag("close").over(Window.partitionBy("ticker").orderBy("d")).alias("prev"))


@_query(POSITION_CTE + "SELECT bdc, key, CAST(sum(fv) AS BIGINT) AS fv, CAST(row_number() OVER (PARTITION BY bdc ORDER BY sum(fv) DESC, key) AS BIGINT) AS place FROM pos GROUP BY bdc, key QUALIFY place <= 10")
def srt07_largest_by_fund(spark, sf):
    """The ten largest borrowers of each fund: a top-k report."""
    g = positions(spark, sf).groupBy("bdc", "key").agg(F.sum("fv").alias("fv"))
    place = F.row_number().over(Window.partitionBy("bdc").orderBy(F.desc("fv"), "key"))
    return g.withColumn("place", place.cast("bigint")).where("place <= 10")


# --- further functions and picks; without SQL, tested on their cases ----------------------------


def _of(name: str, source: str, key: str, **columns):
    """Register a projection of column functions over a table."""
    QUERIES[name] = lambda spark, sf: table(spark, sf, source).select(key, *[f(F.col(c)).alias(out) for out, (f, c) in columns.items()])


_of("fn04_unit_currency", "soi_position", "pos_id", currency=(fn.unit_currency, "ccy"))
_of("fn09_clean_sector", "soi_position", "pos_id", sector=(fn.clean_sector, "sector"))
_of("fn19_primary_legal", "soi_position", "pos_id", legal=(fn.primary_legal, "entity"))
_of("fn21_stated_rates", "soi_position", "pos_id", rate=(fn.stated_rate, "descr"), pik_rate=(fn.stated_pik_rate, "descr"))
_of("fn22_stated_base_rate", "soi_position", "pos_id", base=(fn.stated_base_rate, "descr"))
_of("fn23_stated_date", "html_row", "row_id", maturity=(fn.stated_date, "maturity_date"), acquired=(fn.stated_date, "acquisition_date"))
_of("fn25_shown_maturity", "soi_position", "pos_id", maturity=(fn.shown_maturity, "maturity"))
_of("fn28_number_or_null", "soi_position", "pos_id", fv=(lambda c: fn.number_or_null(c.cast("string")), "fv_raw"))
_of("fn41_short_money", "soi_position", "pos_id", fv=(fn.short_money, "fv"))


@_query()
def agg17_audit_pick(spark, sf):
    """Of the amounts that quarterly filings state for a fund and period, the largest in size; the first of equals."""
    quarterly = table(spark, sf, "filing").where(F.col("form").startswith("10-Q")).select("accession").distinct()
    x = table(spark, sf, "soi_position").where("fv is not null").join(quarterly, "accession", "left_semi")
    return x.groupBy("bdc", "period_end").agg(F.max_by("fv", F.struct(F.abs("fv"), -F.col("pos_id"))).alias("fv"))

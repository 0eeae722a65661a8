"""Queries of the cleaning, joining, classifying and ordering operators over positions, rows and filings, with their SQL.

Names start with the operator's id of the survey. Texts that both engines must cut alike are
matched by ASCII classes; numbers are whole or rounded by floor on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions import finance as fn
from tallyforge.functions import rules as rl
from tallyforge.operators import portfolio as op
from tallyforge.operators import silver as sv
from tallyforge.plans.testmap import POSITION_CTE, positions
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


def _soi(spark, sf) -> DataFrame:
    return table(spark, sf, "soi_position")


def _case(col: str, rules, otherwise: str = "NULL") -> str:
    """The CASE of ordered rules in SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    return "CASE " + " ".join(f"WHEN regexp_matches({col}, {quote('(?i)' + p)}) THEN {quote(v)}" for p, v in rules) + f" ELSE {otherwise} END"


# --- filters --------------------------------------------------------------------------------


@_query("SELECT s.pos_id FROM soi_position s JOIN filing f USING (accession) WHERE s.period_end = f.period_end")
def flt01_period(spark, sf):
    f = table(spark, sf, "filing").select("accession", F.col("period_end").alias("_end"))
    # filing is a fixed table of 320 rows
    return _soi(spark, sf).join(F.broadcast(f), "accession").where("period_end = _end").select("pos_id")


_LABELS = ", ".join(f"'{x}'" for x in sv.TOTAL_LABELS)


@_query(f"SELECT pos_id FROM soi_position WHERE coalesce(identifier, '') <> '' AND identifier NOT IN ({_LABELS})")
def flt02_total_labels(spark, sf):
    return sv.drop_identifiers(_soi(spark, sf), exact=sv.TOTAL_LABELS).select("pos_id")


@_query("SELECT doc_id FROM documents WHERE coalesce(text, '') <> '' AND NOT (" + " OR ".join(f"regexp_matches(text, '(?i){p}')" for p in (*sv.CASH_PATTERNS, "treasury")) + ")")
def flt03_cash_equivalents(spark, sf):
    d = table(spark, sf, "documents")
    return sv.drop_identifiers(d, "text", patterns=[f"(?i){p}" for p in (*sv.CASH_PATTERNS, "treasury")]).select("doc_id")


@_query("SELECT pos_id FROM soi_position WHERE fv IS NOT NULL OR cost IS NOT NULL")
def flt04_valued(spark, sf):
    return _soi(spark, sf).where("fv is not null or cost is not null").select("pos_id")


@_query("SELECT bdc, CAST(count(*) AS BIGINT) AS n FROM soi_position WHERE coalesce(entity, '') <> '' AND entity NOT IN ('Total Investments') AND NOT starts_with(entity, 'Al') AND NOT regexp_matches(entity, '(?i)loan pool|\\bfunds?$') GROUP BY bdc")
def flt06_identifier_rules(spark, sf):
    d = sv.drop_identifiers(_soi(spark, sf), "entity", exact=["Total Investments"], prefixes=["Al"], patterns=[r"(?i)loan pool|\bfunds?$"])
    return d.groupBy("bdc").agg(F.count("*").alias("n"))


@_query("SELECT pos_id FROM soi_position WHERE NOT (round_even(coalesce(fv, 0) / 1000, 0) = 0 AND round_even(coalesce(cost, 0) / 1000, 0) = 0)")
def flt07_dust(spark, sf):
    return sv.not_dust(_soi(spark, sf)).select("pos_id")


@_query("""SELECT doc_id FROM (SELECT doc_id, source, split_part(text, chr(10), 1) AS t FROM documents WHERE text IS NOT NULL)
WHERE source IN ('news_wire', 'press_release') AND NOT regexp_matches(t, '(?i)\\b(horoscope|lottery)\\b') AND regexp_matches(t, '(?i)\\b(loan|lender|lenders|credit|holdings|fund|amend)')""")
def flt13_text_gates(spark, sf):
    d = table(spark, sf, "documents").where("text is not null").withColumn("t", F.substring_index("text", "\n", 1))
    ok = F.col("source").isin("news_wire", "press_release") & ~F.col("t").rlike(r"(?i)\b(horoscope|lottery)\b") & F.col("t").rlike(r"(?i)\b(loan|lender|lenders|credit|holdings|fund|amend)")
    return d.where(ok).select("doc_id")


# --- projections ----------------------------------------------------------------------------

_K = "CASE WHEN {0} IS NULL OR isnan({0}) OR {0} = 0 THEN NULL ELSE floor({0} * fx / 1000 + 0.5) END"
_FXC = "CASE upper(trim(coalesce(ccy, 'USD'))) " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in fn.FX_TO_USD.items()) + " ELSE 1.0 END"
_VIEW = (
    f"WITH p AS (SELECT *, {_FXC} AS fx, CASE WHEN pik_rate > 0 AND pik_rate <= 40 THEN floor(pik_rate * 100 + 0.5) / 100 END AS pr, trim(coalesce(company, entity)) AS co FROM soi_position) "
    "SELECT pos_id, bdc, nullif(trim(entity), '') AS entity, CASE WHEN length(co) > 60 THEN substring(co, 1, 57) || '…' ELSE nullif(co, '') END AS company, nullif(trim(descr), '') AS descr, "
    + ", ".join(f"{_K.format(c)} AS {c}" for c in ("fv", "cost", "par"))
    + ", nullif(spread, 0) AS spread, nullif(rate, 0) AS rate, nullif(trim(base_rate), '') AS base_rate, trim(coalesce(ccy, 'USD')) AS ccy, coalesce(pik, false) OR pr IS NOT NULL AS pik, pr AS pik_rate, trim(coalesce(affil, '')) AS affil FROM p"
)


def _blank(c: str):
    return F.nullif(F.trim(c), F.lit(""))


@_query(_VIEW)
def prj01_position_view(spark, sf):
    p = _soi(spark, sf).withColumn("fx", fn.fx_rate(F.col("ccy"))).withColumn("pr", fn.half_up(rl.pik_rate(F.col("pik_rate")), 2))
    k = lambda c: F.when(F.col(c).isNotNull() & ~F.isnan(c) & (F.col(c) != 0), F.floor(F.col(c) * F.col("fx") / 1000 + 0.5).cast("double")).alias(c)
    co = F.trim(F.coalesce("company", "entity"))
    return p.select(
        "pos_id", "bdc", _blank("entity").alias("entity"), F.nullif(rl.shortened(co), F.lit("")).alias("company"), _blank("descr").alias("descr"), k("fv"), k("cost"), k("par"),
        F.nullif("spread", F.lit(0.0)).alias("spread"), F.nullif("rate", F.lit(0.0)).alias("rate"), _blank("base_rate").alias("base_rate"), F.trim(F.coalesce("ccy", F.lit("USD"))).alias("ccy"),
        (F.coalesce("pik", F.lit(False)) | F.col("pr").isNotNull()).alias("pik"), F.col("pr").alias("pik_rate"), F.trim(F.coalesce("affil", F.lit(""))).alias("affil"),
    )


@_query("SELECT pos_id, bdc, nullif(trim(coalesce(company, entity)), '') AS company, coalesce(pik, false) AS pik, coalesce(nullif(spread, 0), nullif(rate, 0)) AS first_rate FROM soi_position")
def prj02_cross_fund_view(spark, sf):
    zero = F.lit(0.0)
    return _soi(spark, sf).select("pos_id", "bdc", F.nullif(F.trim(F.coalesce("company", "entity")), F.lit("")).alias("company"), F.coalesce("pik", F.lit(False)).alias("pik"), F.coalesce(F.nullif("spread", zero), F.nullif("rate", zero)).alias("first_rate"))


@_query("SELECT pos_id, entity, floor(fv / 1000 * 10 + 0.5) / 10 AS fv, floor(cost / 1000 * 10 + 0.5) / 10 AS cost, floor(par / 1000 * 10 + 0.5) / 10 AS par FROM soi_position WHERE NOT coalesce(isnan(fv) OR isnan(cost) OR isnan(par), false)")
def prj03_json_record(spark, sf):
    k = lambda c: fn.half_up(F.col(c) / 1000, 1).alias(c)
    nan = F.coalesce(F.isnan("fv") | F.isnan("cost") | F.isnan("par"), F.lit(False))
    return _soi(spark, sf).where(~nan).select("pos_id", "entity", k("fv"), k("cost"), k("par"))


@_query("SELECT pos_id, CASE WHEN length(entity) > 30 THEN substring(entity, 1, 27) || '…' ELSE entity END AS entity FROM soi_position")
def prj04_shortened(spark, sf):
    return _soi(spark, sf).select("pos_id", rl.shortened(F.col("entity"), 30).alias("entity"))


# --- facts ----------------------------------------------------------------------------------

_AMOUNTS = ("fv", "cost", "par", "shares")


def _facts(spark, sf) -> DataFrame:
    """Positions as facts of contexts, each stated twice: first off by one, then as it is."""
    s = _soi(spark, sf)
    stated = F.array(*[F.struct(F.lit(c).alias("concept"), (F.col(c) + d).alias("value"), F.lit(2 * k + 1 + (d == 0)).alias("doc_order")) for k, c in enumerate(_AMOUNTS) for d in (1.0, 0.0)])
    f = s.select(F.col("accession").alias("filing"), F.col("pos_id").alias("context"), F.explode(stated).alias("x"))
    return f.select("filing", "context", "x.*").where("value is not null")


@_query("SELECT pos_id AS context, " + ", ".join(_AMOUNTS) + " FROM soi_position WHERE accession IS NOT NULL AND coalesce(" + ", ".join(_AMOUNTS) + ") IS NOT NULL")
def agg01_last_fact(spark, sf):
    contexts = _soi(spark, sf).select(F.col("accession").alias("filing"), F.col("pos_id").alias("context"))
    return sv.facts_in_contexts(_facts(spark, sf), contexts).select("context", *_AMOUNTS)


@_query("""WITH f AS (SELECT accession, count(fv) + count(cost) + count(par) + count(shares) AS n FROM soi_position GROUP BY 1)
SELECT form, CAST(sum(n) * 2 AS BIGINT) AS facts FROM f JOIN filing USING (accession) GROUP BY form""")
def jn01_facts_in_contexts(spark, sf):
    f = table(spark, sf, "filing").select(F.col("accession").alias("filing"), "form")
    # filing is a fixed table of 320 rows
    return _facts(spark, sf).groupBy("filing").agg(F.count("*").alias("n")).join(F.broadcast(f), "filing").groupBy("form").agg(F.sum("n").alias("facts"))


@_query("""WITH t AS (SELECT bdc, period_end, sum(floor(fv)) AS s FROM soi_position WHERE NOT coalesce(isnan(fv), false) GROUP BY ALL),
g AS (SELECT t.bdc, t.period_end FROM t JOIN balance_sheet b ON b.ticker = t.bdc AND b.period_end = t.period_end WHERE portfolio_fv > 0 AND s > portfolio_fv * 1.01),
r AS (SELECT bdc, period_end, floor(fv) AS fv FROM soi_position WHERE NOT coalesce(isnan(fv), false) UNION ALL SELECT bdc, period_end, -floor(abs(cost)) FROM soi_position SEMI JOIN g USING (bdc, period_end) WHERE cost <> 0 AND floor(abs(cost)) > 0 AND spread IS NULL AND NOT isnan(cost))
SELECT bdc, CAST(period_end AS VARCHAR) AS period_end, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(fv AS BIGINT)) AS BIGINT) AS fv FROM r GROUP BY ALL""")
def agg06_netting(spark, sf):
    s = _soi(spark, sf)
    rows = s.where(~F.coalesce(F.isnan("fv"), F.lit(False))).select("bdc", "period_end", F.floor("fv").cast("bigint").alias("fv"))
    offsets = s.where("spread is null and cost <> 0 and not isnan(cost)").select("bdc", "period_end", (-F.floor(F.abs("cost"))).cast("bigint").alias("fv"))
    target = table(spark, sf, "balance_sheet").select(F.col("ticker").alias("bdc"), "period_end", F.col("portfolio_fv").alias("target"))
    n = sv.net_unfunded(rows, offsets, target, ["bdc", "period_end"])
    return n.groupBy("bdc", F.col("period_end").cast("string").alias("period_end")).agg(F.count("*").alias("n"), F.sum("fv").alias("fv"))


# --- identifiers ----------------------------------------------------------------------------

_ID = "'Alder ' || p_name || ', ' || CASE p_partkey % 7 WHEN 0 THEN 'Inc., First lien senior secured loan' WHEN 1 THEN 'LLC, Class A-1 units' WHEN 2 THEN 'Inc.' WHEN 3 THEN 'LP, Preferred equity, 3' WHEN 4 THEN 'Warrants' WHEN 5 THEN 'Second-lien loan, Inc.' ELSE 'Ltd, LLC interest' END || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE ', ' || CAST(p_partkey AS VARCHAR) END"


@_query(
    f"""WITH i AS (SELECT p_partkey AS k, {_ID} AS x FROM part), p AS (SELECT k, x, string_split(x, ',') AS w FROM i),
c AS (SELECT k, x, n, trim(array_to_string(w[1:n], ',')) AS entity, trim(array_to_string(w[n + 1:], ',')) AS tail FROM (SELECT *, unnest(range(1, len(w))) AS n FROM p)),
t AS (SELECT k, n, entity, {_case("tail", rl.KIND_RULES)} AS kind FROM c),
b AS (SELECT k, entity, kind FROM t WHERE kind IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC) = 1)
SELECT CAST(i.k AS BIGINT) AS id, coalesce(b.entity, trim(i.x)) AS entity, coalesce(b.kind, '') AS kind FROM i LEFT JOIN b ON b.k = i.k"""
)
def fn01_split_identifier(spark, sf):
    # a kind that stands before every comma is told apart in the tests only
    x = F.expr(_ID.replace("VARCHAR", "STRING"))
    d = table(spark, sf, "part").select(F.col("p_partkey").cast("bigint").alias("id"), x.alias("x"))
    return rl.once_a_text(d, "x", "s", rl.split_identifier).select("id", "s.entity", "s.kind")


@_query(r"SELECT pos_id, trim(regexp_replace(trim(regexp_replace(regexp_replace(lower(entity), '\([^)]*\)', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')), '( (inc|llc|lp|l p|ltd|corp|co|plc))+$', '')) AS key FROM soi_position")
def fn17_override_key(spark, sf):
    return _soi(spark, sf).select("pos_id", rl.override_key(F.col("entity")).alias("key"))


@_query(r"SELECT pos_id, regexp_matches(regexp_replace(trim(x), '[$,% ]', '', 'g'), '^\(?-?[0-9]+(\.[0-9]+)?\)?$') OR regexp_replace(trim(x), '[$,% ]', '', 'g') IN ('-', '—', '–') AS money FROM (SELECT pos_id, split_part(identifier, ',', 2) AS x FROM soi_position WHERE identifier IS NOT NULL)")
def fn24_looks_like_money(spark, sf):
    x = F.split_part("identifier", F.lit(","), F.lit(2))
    return _soi(spark, sf).where("identifier is not null").select("pos_id", rl.looks_like_money(x).alias("money"))


@_query("SELECT pos_id, CASE WHEN pik_rate > 0 AND pik_rate <= 40 THEN CASE WHEN rate > 0 AND pik_rate > rate THEN rate ELSE pik_rate END END AS pik_rate, coalesce(pik, false) OR coalesce(pik_rate > 0 AND pik_rate <= 40, false) AS pik FROM soi_position")
def fn29_rate_in_kind(spark, sf):
    r = rl.pik_rate(F.col("pik_rate"))
    capped = F.when((F.col("rate") > 0) & (r > F.col("rate")), F.col("rate")).otherwise(r)
    return _soi(spark, sf).select("pos_id", capped.alias("pik_rate"), (F.coalesce("pik", F.lit(False)) | r.isNotNull()).alias("pik"))


_FLAGS = {"NAV_MISSING": "nav IS NULL", "DEBT_OVER_NAV": "gross_debt > nav", "SHARES_MISSING": "shares IS NULL OR shares = 0", "LIABILITIES_OVER_ASSETS": "total_liabilities > total_assets", "NAV_PER_SHARE_OFF": "abs(nav - nav_per_share * shares) > 0.005 * nav"}


@_query("WITH f AS (" + " UNION ALL ".join(f"SELECT ticker, period_end, '{k}' AS flag FROM balance_sheet WHERE {c}" for k, c in _FLAGS.items()) + ") SELECT ticker, CAST(period_end AS VARCHAR) AS period_end, flag FROM f")
def fn40_balance_flags(spark, sf):
    b = table(spark, sf, "balance_sheet")
    return b.select("ticker", F.col("period_end").cast("string").alias("period_end"), F.explode(rl.flags(**{k: F.expr(c) for k, c in _FLAGS.items()})).alias("flag"))


_MARKET = {"PRICE_BELOW_HALF_NAV": "close < 0.5 * base", "PRICE_OVER_TWICE": "close > 2.0 * base", "NO_PRICE": "close <= 0"}
_DAYS = "SELECT event_type AS ticker, CAST(CAST(ts AS DATE) AS VARCHAR) AS d, floor(max(value)) AS close FROM events GROUP BY ALL"


@_query(f"WITH c AS ({_DAYS}), b AS (SELECT ticker, min(close) AS base FROM c GROUP BY 1), x AS (SELECT * FROM c JOIN b USING (ticker)), f AS (" + " UNION ALL ".join(f"SELECT ticker, d, '{k}' AS flag FROM x WHERE {c}" for k, c in _MARKET.items()) + ") SELECT * FROM f")
def fn39_market_flags(spark, sf):
    c = table(spark, sf, "events").groupBy(F.col("event_type").alias("ticker"), F.col("ts").cast("date").cast("string").alias("d")).agg(F.floor(F.max("value")).cast("double").alias("close"))
    x = c.join(c.groupBy("ticker").agg(F.min("close").alias("base")), "ticker")
    return x.select("ticker", "d", F.explode(rl.flags(**{k: F.expr(v) for k, v in _MARKET.items()})).alias("flag"))


@_query("""WITH d AS (SELECT doc_id, CAST(floor((epoch(received) - epoch(published)) / 60) AS BIGINT) AS m FROM documents WHERE received IS NOT NULL AND published IS NOT NULL)
SELECT doc_id, CASE WHEN m < 1 THEN 'just now' WHEN m < 60 THEN CAST(m AS VARCHAR) || ' min ago' WHEN m < 1440 THEN CAST(CAST(floor(m / 60) AS BIGINT) AS VARCHAR) || ' hr ago' ELSE CAST(CAST(floor(m / 1440) AS BIGINT) AS VARCHAR) || ' d ago' END AS ago FROM d""")
def fn42_freshness(spark, sf):
    d = table(spark, sf, "documents").where("received is not null and published is not null")
    return d.select("doc_id", rl.ago(F.col("published").cast("timestamp"), F.col("received").cast("timestamp")).alias("ago"))


@_query("SELECT pos_id, TRY_CAST(descr AS DOUBLE) AS number, coalesce(TRY_CAST(split_part(maturity, '/', 1) AS DOUBLE), 0) AS or_zero FROM soi_position WHERE NOT regexp_matches(coalesce(descr, '') || coalesce(maturity, ''), '(?i)_|nan|inf')")
def fn44_numbers(spark, sf):
    s = _soi(spark, sf).where(~F.concat(F.coalesce("descr", F.lit("")), F.coalesce("maturity", F.lit(""))).rlike("(?i)_|nan|inf"))
    return s.select("pos_id", F.col("descr").try_cast("double").alias("number"), F.coalesce(F.split_part("maturity", F.lit("/"), F.lit(1)).try_cast("double"), F.lit(0.0)).alias("or_zero"))


# --- classes --------------------------------------------------------------------------------

_BOXES = ((r"\bloan pool\b", "Vehicle"), (r"\bclo\b", "Vehicle"))
_FALLBACK = ((r"software|saas", "Technology"), (r"health|medic|pharma", "Health"), (r"food|restaurant", "Consumer"), (r"insur|financ", "Financials"), (r"chemical|packag|material", "Materials"))
_DESCRIBED = ((r"loan|lien", "Debt"), (r"stock|unit|equity|warrant", "Equity"))
_CLASS_SQL = f"""WITH e AS (SELECT lower(trim(label)) AS k, arg_max('Label ' || CAST(label_id AS VARCHAR), label_id) AS c FROM canon_label WHERE kind = 'sector' GROUP BY 1),
x AS (SELECT pos_id, {_case("entity", _BOXES)} AS a, e.c AS b, {_case("sector", _FALLBACK)} AS c, {_case("type", _DESCRIBED)} AS d FROM soi_position LEFT JOIN e ON e.k = lower(trim(sector)))
"""


def _classes(spark, sf) -> DataFrame:
    label = table(spark, sf, "canon_label").where("kind = 'sector'").select(F.col("label").alias("key"), F.concat(F.lit("Label "), F.col("label_id").cast("string")).alias("class"), F.col("label_id").alias("ord"))
    return sv.classify(_soi(spark, sf).select("pos_id", "bdc", "entity", "sector", F.col("type").alias("description")), label, _FALLBACK, _BOXES, _DESCRIBED)


@_query(_CLASS_SQL + "SELECT pos_id, coalesce(a, b, c, d, 'Other') AS class, CASE WHEN a IS NOT NULL THEN 'box' WHEN b IS NOT NULL THEN 'exact' WHEN c IS NOT NULL THEN 'pattern' WHEN d IS NOT NULL THEN 'description' ELSE 'none' END AS how FROM x")
def fn13_classify(spark, sf):
    return _classes(spark, sf).select("pos_id", "class", "how")


@_query(f"SELECT pos_id, {_case('sector', _FALLBACK, chr(39) + 'Other' + chr(39))} AS class FROM soi_position")
def fn10_sector_patterns(spark, sf):
    return rl.once_a_text(_soi(spark, sf), "sector", "class", lambda c: rl.first_rule(c, _FALLBACK)).select("pos_id", F.coalesce("class", F.lit("Other")).alias("class"))


@_query(f"SELECT pos_id, {_case('entity', _BOXES)} IS NOT NULL AS box FROM soi_position")
def fn11_vehicle(spark, sf):
    return _soi(spark, sf).select("pos_id", rl.first_rule(F.col("entity"), _BOXES).isNotNull().alias("box"))


@_query(f"SELECT type, {_case('type', _DESCRIBED)} AS class, CAST(count(*) AS BIGINT) AS n FROM soi_position WHERE type IS NOT NULL GROUP BY ALL")
def fn12_description(spark, sf):
    return _soi(spark, sf).where("type is not null").groupBy("type", rl.first_rule(F.col("type"), _DESCRIBED).alias("class")).agg(F.count("*").alias("n"))


# --- handlers -------------------------------------------------------------------------------

_PIPE = "p_name || ' | ' || p_type || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ' | Tranche ' || CAST(p_partkey % 5 AS VARCHAR) END"


@_query(f"""WITH w AS (SELECT p_partkey AS k, list_transform(string_split({_PIPE}, '|'), lambda x: trim(x)) AS w FROM part)
SELECT CAST(k AS BIGINT) AS id, w[1] AS entity, coalesce(w[2], '') AS sector, array_to_string(w[3:], ' | ') AS rest FROM w""")
def hnd01_piped(spark, sf):
    d = table(spark, sf, "part").select(F.col("p_partkey").cast("bigint").alias("id"), F.expr(_PIPE.replace("VARCHAR", "STRING")).alias("identifier"))
    return sv.Handler(read=sv.piped).apply(d).select("id", "entity", "sector", "rest")


_SECTORS = ("PROMO", "STANDARD", "ECONOMY", "SMALL", "MEDIUM", "LARGE")
_PEEL = "p_type || ', ' || p_name || ' ' || CAST(p_partkey AS VARCHAR)"


@_query(f"SELECT CAST(p_partkey AS BIGINT) AS id, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS entity, p_type AS sector FROM part WHERE p_type <> 'SMALL'")
def hnd02_peeled_sector(spark, sf):
    d = table(spark, sf, "part").select(F.col("p_partkey").cast("bigint").alias("id"), F.expr(_PEEL.replace("VARCHAR", "STRING")).alias("identifier"))
    return sv.Handler(prefixes=["SMALL,"], read=lambda c: sv.peeled(c, _SECTORS)).apply(d).select("id", "entity", "sector")


_MARKED = "CASE p_partkey % 3 WHEN 0 THEN 'Non-Controlled/Non-Affiliated Investments, ' WHEN 1 THEN 'Controlled: ' ELSE '' END || p_name || CASE WHEN p_partkey % 2 = 0 THEN ' ' || CAST(1 + p_partkey % 9 AS VARCHAR) ELSE '' END"


@_query("SELECT CAST(p_partkey AS BIGINT) AS id, p_name AS entity, CASE WHEN p_partkey % 2 = 0 THEN CAST(1 + p_partkey % 9 AS VARCHAR) ELSE '' END AS rest FROM part")
def hnd03_unmarked(spark, sf):
    d = table(spark, sf, "part").select(F.col("p_partkey").cast("bigint").alias("id"), F.expr(_MARKED.replace("VARCHAR", "STRING")).alias("identifier"))
    return sv.Handler(read=sv.unmarked).apply(d).select("id", "entity", "rest")


@_query("SELECT CAST(p_partkey AS BIGINT) AS id, p_name || ', Inc.' AS entity, CASE WHEN p_partkey % 2 = 0 THEN 'Second-lien loan, 2030' ELSE 'Class A units' END AS rest FROM part")
def hnd04_commas(spark, sf):
    x = F.concat("p_name", F.lit(", Inc., "), F.when(F.col("p_partkey") % 2 == 0, "Second-lien loan, 2030").otherwise("Class A units"))
    d = table(spark, sf, "part").select(F.col("p_partkey").cast("bigint").alias("id"), x.alias("identifier"))
    return sv.Handler(read=lambda c: sv.commas(c, rl.KIND_RULES)).apply(d).select("id", "entity", "rest")


_COPY = "SELECT pos_id, bdc, period_end, floor(fv / 10000) AS v, CASE WHEN cost IS NULL OR pos_id % 3 = 0 THEN 0 ELSE 1 END AS c FROM soi_position WHERE NOT coalesce(isnan(fv), false)"


def _copies(spark, sf) -> DataFrame:
    s = _soi(spark, sf).where(~F.coalesce(F.isnan("fv"), F.lit(False)))
    return s.select("pos_id", "bdc", "period_end", F.floor(F.col("fv") / 10000).cast("double").alias("fv"), F.when(F.col("cost").isNull() | (F.col("pos_id") % 3 == 0), 0).otherwise(1).alias("cost"))


@_query(f"WITH z AS ({_COPY}), w AS (SELECT *, count(*) OVER (PARTITION BY bdc, period_end, v) AS n FROM z) SELECT pos_id FROM w WHERE NOT coalesce(c = 0 AND v <> 0 AND n > 1, false)")
def hnd05_zero_cost_repeats(spark, sf):
    return sv.drop_zero_cost_copies(_copies(spark, sf), ["bdc", "period_end"]).select("pos_id")


@_query(f"WITH z AS ({_COPY}), w AS (SELECT *, sum(c) OVER (PARTITION BY bdc, period_end, v) AS n FROM z) SELECT pos_id FROM w WHERE NOT coalesce(c = 0 AND v <> 0 AND n > 0, false)")
def hnd06_copies_of_costed(spark, sf):
    return sv.drop_zero_cost_copies(_copies(spark, sf), ["bdc", "period_end"], peers="cost").select("pos_id")


@_query("""SELECT bdc, CAST(count(*) AS BIGINT) AS n FROM soi_position
WHERE coalesce(identifier, '') <> '' AND CASE bdc WHEN 'NOXEL' THEN contains(identifier, '|') WHEN 'AQVEL' THEN NOT starts_with(identifier, 'A') ELSE true END GROUP BY bdc""")
def hnd07_by_source(spark, sf):
    handlers = {"NOXEL": sv.Handler(patterns=[r"^[^|]+$"]), "AQVEL": sv.Handler(prefixes=["A"])}
    s = _soi(spark, sf).select("bdc", "identifier")
    return sv.handle(s, "bdc", handlers).groupBy("bdc").agg(F.count("*").alias("n"))


# --- enrichment -----------------------------------------------------------------------------

_WORDS = "list_filter(string_split(lower(regexp_replace({0}, '[^ -~]', '?', 'g')), ' '), lambda w: length(w) > 3)"
_BANDS = f"""WITH a AS (SELECT pos_id AS id, bdc || '|' || CAST(period_end AS VARCHAR) AS block, CAST(floor(fv / 1000) AS BIGINT) AS fv, {_WORDS.format('entity')} AS w FROM soi_position WHERE fv IS NOT NULL AND NOT isnan(fv)),
b AS (SELECT row_id AS row, bdc || '|' || CAST(period_end AS VARCHAR) AS block, CAST(floor(fair_value) AS BIGINT) AS value, {_WORDS.format('issuer')} AS w, sector, affiliation FROM html_row WHERE fair_value IS NOT NULL AND NOT isnan(fair_value)),
j AS (SELECT a.id, b.row, len(list_intersect(a.w, b.w)) AS c, len(coalesce(a.w, [])) AS k FROM a JOIN b USING (block) WHERE abs(b.value - a.fv) <= greatest(5, floor(abs(a.fv) * 0.01))),
m AS (SELECT id, row, count(*) OVER (PARTITION BY id) AS met, k FROM j QUALIFY row_number() OVER (PARTITION BY id ORDER BY coalesce(c, 0) DESC, row) = 1)
"""


def _banded(spark, sf) -> tuple[DataFrame, DataFrame]:
    words = lambda c: F.filter(F.split(F.lower(F.regexp_replace(c, "[^ -~]", "?")), " "), lambda w: F.length(w) > 3)
    block = F.concat_ws("|", "bdc", F.col("period_end").cast("string"))
    a = _soi(spark, sf).where("fv is not null and not isnan(fv)").select(F.col("pos_id").alias("id"), block.alias("block"), F.floor(F.col("fv") / 1000).cast("bigint").alias("fv"), words("entity").alias("words"))
    b = table(spark, sf, "html_row").where("fair_value is not null and not isnan(fair_value)").select(F.col("row_id").alias("row"), block.alias("block"), F.floor("fair_value").cast("bigint").alias("value"), words("issuer").alias("words"), F.col("row_id").alias("ord"))
    return a, b


@_query(_BANDS + "SELECT id, row, CAST(met AS BIGINT) AS met FROM m WHERE met = 1 OR k > 0")
def jn06_best_in_band(spark, sf):
    return sv.best_in_band(*_banded(spark, sf))


@_query(_BANDS + ", e AS (SELECT m.id, b.sector AS s, b.affiliation AS f FROM m JOIN b ON b.row = m.row WHERE met = 1 OR k > 0) SELECT pos_id AS id, coalesce(e.s, sector) AS sector, coalesce(e.f, affil) AS affiliation FROM soi_position LEFT JOIN e ON e.id = pos_id")
def jn08_overlay(spark, sf):
    rows = _soi(spark, sf).select(F.col("pos_id").alias("id"), "sector", F.col("affil").alias("affiliation"))
    extra = table(spark, sf, "html_row").select(F.col("row_id").alias("row"), "sector", "affiliation")
    return sv.overlay(rows, sv.best_in_band(*_banded(spark, sf)), extra, ["sector", "affiliation"])


@_query(r"""WITH k AS (SELECT trim(regexp_replace(regexp_replace(lower(label), '[^a-z0-9]+', ' ', 'g'), '( (inc|llc|lp|l p|ltd|corp|co|plc))+$', '')) AS key, min(label_id) AS label_id FROM canon_label WHERE kind = 'sector' GROUP BY 1)
SELECT pos_id, label_id FROM soi_position JOIN k ON k.key = trim(regexp_replace(trim(regexp_replace(regexp_replace(lower(sector), '\([^)]*\)', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')), '( (inc|llc|lp|l p|ltd|corp|co|plc))+$', ''))""")
def jn09_normalised_lookup(spark, sf):
    # canon_label is a fixed table; of labels with one key the first counts
    k = table(spark, sf, "canon_label").where("kind = 'sector'").groupBy(rl.override_key(F.col("label")).alias("key")).agg(F.min("label_id").alias("label_id"))
    return _soi(spark, sf).withColumn("key", rl.override_key(F.col("sector"))).join(F.broadcast(k), "key").select("pos_id", "label_id")


@_query(r"""WITH c AS (SELECT legal, min(common) AS cached FROM (SELECT trim(entity) AS legal, trim(company) AS common FROM soi_position WHERE company IS NOT NULL AND entity IS NOT NULL) WHERE common <> '' GROUP BY 1)
SELECT pos_id, coalesce(nullif(trim(regexp_extract(entity, '(?i)\((?:dba|d/b/a|a/k/a|aka)\s+([^)]+)\)', 1)), ''), cached) AS common FROM soi_position LEFT JOIN c ON c.legal = trim(entity)""")
def jn10_common_name(spark, sf):
    s = _soi(spark, sf).withColumn("legal", F.trim("entity"))
    cache = s.where("company is not null and legal is not null and trim(company) <> ''").groupBy("legal").agg(F.min(F.trim("company")).alias("cached"))
    return s.join(cache, "legal", "left").select("pos_id", F.coalesce(F.nullif(fn.trade_name(F.col("entity")), F.lit("")), F.col("cached")).alias("common"))


# --- totals and order -----------------------------------------------------------------------


@_query("SELECT CAST(sum(CAST(floor(portfolio_fv / 1000000) AS BIGINT)) AS BIGINT) AS fv_m, (SELECT CAST(count(*) AS BIGINT) FROM soi_position) AS positions FROM balance_sheet")
def agg27_home_totals(spark, sf):
    n = _soi(spark, sf).agg(F.count("*").alias("positions"))
    v = table(spark, sf, "balance_sheet").agg(F.sum(F.floor(F.col("portfolio_fv") / 1000000).cast("bigint")).alias("fv_m"))
    # two tables of one row each
    return v.join(F.broadcast(n))


@_query("""WITH t AS (SELECT bdc, sum(CAST(floor(fv) AS BIGINT)) AS fv FROM soi_position WHERE NOT coalesce(isnan(fv), false) GROUP BY 1), b AS (SELECT ticker, sum(portfolio_fv) AS v FROM balance_sheet GROUP BY 1)
SELECT bdc, CAST(fv AS BIGINT) AS fv, CAST(v AS BIGINT) AS reported, printf('%+.2f', floor((CAST(fv AS DOUBLE) - v) / nullif(CAST(v AS DOUBLE), 0) * 100 * 100 + 0.5) / 100) AS delta_pct FROM t JOIN b ON b.ticker = bdc""")
def snk02_run_summary(spark, sf):
    t = _soi(spark, sf).where(~F.coalesce(F.isnan("fv"), F.lit(False))).groupBy("bdc").agg(F.sum(F.floor("fv").cast("bigint")).alias("fv"))
    b = table(spark, sf, "balance_sheet").groupBy(F.col("ticker").alias("bdc")).agg(F.sum("portfolio_fv").alias("reported"))
    r = t.join(b, "bdc")
    pct = fn.half_up(F.try_divide(F.col("fv").cast("double") - F.col("reported"), F.col("reported").cast("double")) * 100, 2)
    return r.select("bdc", "fv", F.col("reported").cast("bigint").alias("reported"), F.format_string("%+.2f", pct).alias("delta_pct"))


@_query("""WITH t AS (SELECT bdc, sum(CAST(floor(fv) AS BIGINT)) AS fv FROM soi_position WHERE NOT coalesce(isnan(fv), false) GROUP BY 1), b AS (SELECT ticker, sum(portfolio_fv) AS v FROM balance_sheet GROUP BY 1)
SELECT bdc, floor((CAST(fv AS DOUBLE) - coalesce(nullif(v, 0), fv)) / nullif(CAST(coalesce(nullif(v, 0), fv) AS DOUBLE), 0) * 100 * 100 + 0.5) / 100 AS delta_pct FROM t LEFT JOIN b ON b.ticker = bdc""")
def fn33_delta_to_reported(spark, sf):
    t = _soi(spark, sf).where(~F.coalesce(F.isnan("fv"), F.lit(False))).groupBy("bdc").agg(F.sum(F.floor("fv").cast("bigint")).alias("fv"))
    b = table(spark, sf, "balance_sheet").groupBy(F.col("ticker").alias("bdc")).agg(F.sum("portfolio_fv").alias("v"))
    r = t.join(b, "bdc", "left").withColumn("told", F.coalesce(F.nullif("v", F.lit(0)), "fv"))
    return r.select("bdc", fn.percent_change(F.col("fv").cast("double"), F.col("told").cast("double")).alias("delta_pct"))


_SORTED = {
    "srt03_borrowers": (POSITION_CTE + ", x AS (SELECT key, CAST(sum(fv) AS BIGINT) AS fv FROM pos GROUP BY key)", lambda s, d: positions(s, d).groupBy("key").agg(F.sum("fv").alias("fv")), "fv DESC, key"),
    "srt04_universe": ("WITH x AS (SELECT bdc, CAST(count(*) AS BIGINT) AS n FROM soi_position GROUP BY 1)", lambda s, d: _soi(s, d).groupBy("bdc").agg(F.count("*").alias("n")), "n DESC, bdc"),
    "srt05_categories": (POSITION_CTE + ", x AS (SELECT sector, CAST(sum(fv) AS BIGINT) AS fv FROM pos GROUP BY 1)", lambda s, d: positions(s, d).groupBy("sector").agg(F.sum("fv").alias("fv")), "fv DESC, sector"),
    "srt09_nulls_last": ("WITH x AS (SELECT pos_id, spread FROM soi_position WHERE NOT coalesce(isnan(spread), false))", lambda s, d: _soi(s, d).where("not coalesce(isnan(spread), false)").select("pos_id", "spread"), "spread DESC NULLS LAST, pos_id"),
    "srt10_reported": ("WITH x AS (SELECT ticker, CAST(sum(portfolio_fv) AS BIGINT) AS fv FROM balance_sheet GROUP BY 1)", lambda s, d: table(s, d, "balance_sheet").groupBy("ticker").agg(F.sum("portfolio_fv").cast("bigint").alias("fv")), "fv DESC NULLS LAST, ticker"),
    "win05_row_number": ("WITH x AS (SELECT row_id, bdc FROM html_row)", lambda s, d: table(s, d, "html_row").select("row_id", "bdc"), "bdc, row_id"),
}


def _place(rows, order: str):
    def run(spark, sf):
        return sv.numbered(rows(spark, sf), *[F.expr(o.replace(" NULLS LAST", "").replace(" DESC", "")).desc_nulls_last() if " DESC" in o else F.expr(o).asc() for o in order.split(", ")])

    return run


for _name, (_sql, _rows, _by) in _SORTED.items():
    QUERIES[_name] = _place(_rows, _by)
    SQL[_name] = _sql + f" SELECT *, CAST(row_number() OVER (ORDER BY {_by}) AS BIGINT) AS place FROM x"


@_query("SELECT doc_id, CAST(row_number() OVER (ORDER BY coalesce(epoch_us(published), 0) DESC, doc_id) AS BIGINT) AS place FROM documents")
def srt06_news(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.coalesce(F.unix_micros(F.col("published").cast("timestamp")), F.lit(0)).alias("at"))
    return sv.numbered(d, F.desc("at"), F.asc("doc_id")).select("doc_id", "place")


@_query("""WITH t AS (SELECT ticker, period_end, nav, gross_debt, portfolio_fv, CASE WHEN nav IS NULL OR nav = 0 OR gross_debt IS NULL OR gross_debt = 0 THEN NULL ELSE nav + gross_debt END AS gav FROM balance_sheet)
SELECT ticker, CAST(period_end AS VARCHAR) AS period_end, floor(CAST(portfolio_fv AS DOUBLE) / nav * 100 + 0.5) / 100 AS p_nav, floor((CAST(portfolio_fv AS DOUBLE) + gross_debt) / gav * 100 + 0.5) / 100 AS p_gav,
 floor(CAST(gross_debt AS DOUBLE) / gav * 100 * 100 + 0.5) / 100 AS ltv_pct, floor((nav / CAST(portfolio_fv AS DOUBLE) - 1) * 100 * 100 + 0.5) / 100 AS pull_pct FROM t WHERE gav IS NOT NULL AND portfolio_fv > 0""")
def fn32_valuation(spark, sf):
    b = table(spark, sf, "balance_sheet").where("coalesce(nav, 0) <> 0 and coalesce(gross_debt, 0) <> 0 and portfolio_fv > 0")
    price, nav, debt = F.col("portfolio_fv").cast("double"), F.col("nav"), F.col("gross_debt")
    return b.select(
        "ticker", F.col("period_end").cast("string").alias("period_end"), fn.half_up(price / nav, 2).alias("p_nav"), fn.half_up((price + debt) / (nav + debt), 2).alias("p_gav"),
        fn.half_up(debt.cast("double") / (nav + debt) * 100, 2).alias("ltv_pct"), fn.half_up((nav / price - 1) * 100, 2).alias("pull_pct"),
    )


# --- marts ----------------------------------------------------------------------------------


@_query(
    POSITION_CTE
    + """SELECT key, bdc, CAST(fv AS BIGINT) AS fv, CAST(place AS BIGINT) AS place FROM (SELECT key, bdc, fv, ord, row_number() OVER (PARTITION BY key ORDER BY fv DESC, ord) AS place FROM pos WHERE key <> '')"""
)
def agg22_positions_by_value(spark, sf):
    w = Window.partitionBy("key").orderBy(F.desc("fv"), "ord")
    return positions(spark, sf).where("key <> ''").select("key", "bdc", "fv", F.row_number().over(w).cast("bigint").alias("place"))


@_query(
    POSITION_CTE
    + """, h AS (SELECT key, type, mat_year, round_even(spread * 4, 0) / 4 AS q, bdc, CAST(sum(fv) AS BIGINT) AS fv, CAST(sum(CAST(floor(spread * 100 + 0.5) AS BIGINT)) AS BIGINT) AS s, count(*) AS n FROM pos
  WHERE type IN ('First Lien', 'Second Lien', 'Subordinated', 'Unsecured', 'Mezzanine') AND fv > 0 AND spread IS NOT NULL GROUP BY ALL)
SELECT key, type, mat_year, q AS spread_q, bdc, fv, floor(CAST(s AS DOUBLE) / n + 0.5) / 100 AS mean_spread, CAST(row_number() OVER (PARTITION BY key, type, mat_year, q ORDER BY fv DESC, bdc) AS BIGINT) AS place FROM h"""
)
def srt02_details_by_value(spark, sf):
    p = positions(spark, sf).where(F.col("type").isin(*fn.DEBT_TYPES) & (F.col("fv") > 0) & F.col("spread").isNotNull())
    loan = ["key", "type", "mat_year", "spread_q"]
    h = p.withColumn("spread_q", fn.spread_step(F.col("spread")).cast("double")).groupBy(*loan, "bdc").agg(F.sum("fv").alias("fv"), F.sum(F.floor(F.col("spread") * 100 + 0.5).cast("bigint")).alias("s"), F.count("*").alias("n"))
    w = Window.partitionBy(*loan).orderBy(F.desc("fv"), "bdc")
    return h.select(*loan, "bdc", "fv", (F.floor(F.col("s").cast("double") / F.col("n") + 0.5) / 100).alias("mean_spread"), F.row_number().over(w).cast("bigint").alias("place"))


@_query("""SELECT bdc, CAST(count(*) AS BIGINT) AS positions, CAST(count(*) FILTER (WHERE fv <> 0 AND NOT isnan(fv)) AS BIGINT) AS valued, CAST(sum(CASE WHEN isnan(fv) THEN 0 ELSE floor(fv) END) AS BIGINT) AS fv,
 CAST(coalesce(nullif(max(v), 0), sum(CASE WHEN isnan(fv) THEN 0 ELSE floor(fv) END)) AS BIGINT) AS shown_fv FROM soi_position LEFT JOIN (SELECT ticker, max(portfolio_fv) AS v FROM balance_sheet GROUP BY 1) ON ticker = bdc GROUP BY bdc""")
def agg26_universe_value(spark, sf):
    v = F.when(F.isnan("fv"), 0).otherwise(F.floor("fv")).cast("bigint")
    t = _soi(spark, sf).groupBy("bdc").agg(F.count("*").alias("positions"), F.count(F.when((F.col("fv") != 0) & ~F.isnan("fv"), 1)).alias("valued"), F.sum(v).alias("fv"))
    b = table(spark, sf, "balance_sheet").groupBy(F.col("ticker").alias("bdc")).agg(F.max("portfolio_fv").alias("v"))
    return t.join(b, "bdc", "left").select("bdc", "positions", "valued", "fv", F.coalesce(F.nullif("v", F.lit(0)), "fv").cast("bigint").alias("shown_fv"))


_ANY = ("sector", "affiliation", "business_description", "investment_type", "base_rate", "spread", "interest_rate", "pik_rate", "acquisition_date", "maturity_date", "principal", "cost", "footnotes")


@_query("SELECT bdc, CAST(count(*) AS BIGINT) AS eligible, floor(CAST(count(*) FILTER (WHERE " + " OR ".join(f"coalesce(trim(CAST({c} AS VARCHAR)), '') <> ''" for c in _ANY) + ") AS DOUBLE) / count(*) * 10000 + 0.5) / 10000 AS rate FROM html_row WHERE fair_value <> 0 AND NOT (coalesce(cost, 0) = 0 AND coalesce(principal, 0) = 0) GROUP BY bdc")
def agg25_stated_columns(spark, sf):
    any_ = F.lit(False)
    for c in _ANY:
        any_ |= F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != ""
    h = table(spark, sf, "html_row").where("fair_value <> 0 and not (coalesce(cost, 0) = 0 and coalesce(principal, 0) = 0)")
    return h.groupBy("bdc").agg(F.count("*").alias("eligible"), F.floor(F.count(F.when(any_, 1)).cast("double") / F.count("*") * 10000 + 0.5).cast("double").alias("r")).select("bdc", "eligible", (F.col("r") / 10000).alias("rate"))


# --- audits ---------------------------------------------------------------------------------

# What entities and sectors hold that are no such.
_ENTITY_BAD = (
    "Investment Debt Investments", "non-controlled/non-affiliated", "Non-Controlled/Non-Affiliated", "Debt Investments", "Equity Investments",
    "Warrant Investments", "United States", "Investments-", "Investments  -",
)
_SECTOR_BAD = ("(continued)", "(cont.)", "Holdings, LLC", "Investments-")
_SECTOR_LABELS = ("Investments", "Investment", "Interest", "Rate", "Coupon", "Maturity", "Cost", "Fair Value", "Notes", "Shares", "Units")


def _has(c: str, texts) -> str:
    return "(" + " OR ".join(f"contains({c}, '{t}')" for t in texts) + ")"


_E, _S = "trim(coalesce(entity, ''))", "trim(coalesce(sector, ''))"
_ENTITY_CODES = {
    "ENTITY_EMPTY": f"{_E} = ''", "ENTITY_POLLUTED": _has(_E, _ENTITY_BAD), "ENTITY_SUFFIX_ONLY": f"{_E} IN ('Inc', 'LLC', 'L.P.', 'Ltd', 'Corp')",
    "ENTITY_HAS_PERCENT": f"contains({_E}, '%') AND contains({_E}, '(')", "ENTITY_TOO_SHORT": f"length({_E}) < 3",
}
_SECTOR_CODES = {
    "SECTOR_HEADER_LABEL": f"{_S} IN ({', '.join(repr(x) for x in _SECTOR_LABELS)})", "SECTOR_POLLUTED": _has(_S, _SECTOR_BAD), "SECTOR_HAS_PERCENT": f"contains({_S}, '%')",
    "SECTOR_CONTINUED": f"contains(lower({_S}), '(continued)')",
}
_NUMBER_CODES = {"MARK_EXTREME": "fv <> 0 AND abs(cost) >= 50000 AND (mark > 5000 OR mark < -100)", "FV_LARGE_NEGATIVE": "fv < -1000000.0", "RATE_EXTREME": "rate > 50"}
_CODES = {**_ENTITY_CODES, **_SECTOR_CODES, **_NUMBER_CODES}


def _first_code(codes) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{k}'" for k, c in codes.items()) + " END"


@_query(
    f"WITH i AS (SELECT bdc, {_first_code(_ENTITY_CODES)} AS issue FROM soi_position UNION ALL SELECT bdc, {_first_code(_SECTOR_CODES)} FROM soi_position"
    + "".join(f" UNION ALL SELECT bdc, '{k}' FROM soi_position WHERE {c}" for k, c in _NUMBER_CODES.items())
    + ") SELECT bdc, issue, CAST(count(*) AS BIGINT) AS n FROM i WHERE issue IS NOT NULL GROUP BY ALL"
)
def agg28_issue_codes(spark, sf):
    # of entities and of sectors the first code counts, of numbers each
    found = F.array(F.expr(_first_code(_ENTITY_CODES)), F.expr(_first_code(_SECTOR_CODES)), *[F.when(F.expr(c), F.lit(k)) for k, c in _NUMBER_CODES.items()])
    i = _soi(spark, sf).select("bdc", F.explode(F.array_compact(found)).alias("issue"))
    return i.groupBy("bdc", "issue").agg(F.count("*").alias("n"))


_OFF = "WITH t AS (SELECT bdc, sum(CAST(floor(fv) AS BIGINT)) AS fv FROM soi_position WHERE NOT coalesce(isnan(fv), false) GROUP BY 1), b AS (SELECT ticker, sum(portfolio_fv) AS v FROM balance_sheet GROUP BY 1), d AS (SELECT abs(CAST(fv AS DOUBLE) / v - 1) * 100 AS o FROM t JOIN b ON b.ticker = bdc WHERE v > 0) "


@_query(_OFF + "SELECT CAST(count(*) AS BIGINT) AS funds, CAST(count(*) FILTER (WHERE o <= 1) AS BIGINT) AS within_1, CAST(count(*) FILTER (WHERE o <= 5) AS BIGINT) AS within_5, CAST(count(*) FILTER (WHERE o > 20) AS BIGINT) AS bad FROM d")
def agg33_within_reported(spark, sf):
    t = _soi(spark, sf).where(~F.coalesce(F.isnan("fv"), F.lit(False))).groupBy("bdc").agg(F.sum(F.floor("fv").cast("bigint")).alias("fv"))
    b = table(spark, sf, "balance_sheet").groupBy(F.col("ticker").alias("bdc")).agg(F.sum("portfolio_fv").alias("v")).where("v > 0")
    d = t.join(b, "bdc").select((F.abs(F.col("fv").cast("double") / F.col("v") - 1) * 100).alias("o"))
    n = lambda c: F.count(F.when(c, 1))
    return d.agg(F.count("*").alias("funds"), n(F.col("o") <= 1).alias("within_1"), n(F.col("o") <= 5).alias("within_5"), n(F.col("o") > 20).alias("bad"))


@_query("SELECT DISTINCT entity FROM soi_position WHERE entity IS NOT NULL AND entity NOT IN (SELECT issuer FROM html_row WHERE issuer IS NOT NULL) AND entity NOT IN (SELECT issuer FROM documents WHERE issuer IS NOT NULL)")
def jn17_neither_listed_nor_cached(spark, sf):
    names = _soi(spark, sf).where("entity is not null").select("entity").distinct()
    for t in ("html_row", "documents"):
        names = names.join(table(spark, sf, t).select(F.col("issuer").alias("entity")).distinct(), "entity", "left_anti")
    return names


@_query("WITH d AS (SELECT DISTINCT accession, identifier, affil, floor(fv / 1000 + 0.5) AS v FROM soi_position WHERE fv IS NOT NULL AND NOT isnan(fv)) SELECT coalesce(affil, '') AS affil, identifier IS NOT NULL AS named, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(v AS BIGINT)) AS BIGINT) AS fv_k FROM d GROUP BY ALL")
def agg31_values_by_dimension(spark, sf):
    d = _soi(spark, sf).where("fv is not null and not isnan(fv)").select("accession", "identifier", "affil", F.floor(F.col("fv") / 1000 + 0.5).cast("bigint").alias("v")).distinct()
    return d.groupBy(F.coalesce("affil", F.lit("")).alias("affil"), F.col("identifier").isNotNull().alias("named")).agg(F.count("*").alias("n"), F.sum("v").alias("fv_k"))


@_query("""WITH g AS (SELECT entity, sum(CASE WHEN isnan(fv) THEN 0 ELSE CAST(floor(fv) AS BIGINT) END) AS fv, CAST(count(DISTINCT bdc) AS BIGINT) AS funds, max(length(descr)) AS longest,
 arg_min(sector, pos_id) FILTER (WHERE trim(coalesce(sector, '')) <> '') AS sector, arg_max(company, pos_id) FILTER (WHERE trim(coalesce(company, '')) <> '') AS brand FROM soi_position WHERE entity IS NOT NULL GROUP BY 1)
SELECT entity, CAST(fv AS BIGINT) AS fv, funds, CAST(longest AS BIGINT) AS longest, sector, brand FROM g""")
def agg29_picks(spark, sf):
    v = F.when(F.isnan("fv"), 0).otherwise(F.floor("fv")).cast("bigint")
    told = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    g = _soi(spark, sf).where("entity is not null").groupBy("entity").agg(
        F.sum(v).alias("fv"), F.count_distinct("bdc").alias("funds"), F.max(F.length("descr")).cast("bigint").alias("longest"),
        F.min_by("sector", F.when(told("sector"), F.col("pos_id"))).alias("sector"), F.max_by("company", F.when(told("company"), F.col("pos_id"))).alias("brand"),
    )
    return g


@_query("""WITH s AS (SELECT bdc, row_id AS place, CAST(floor(fair_value) AS BIGINT) AS fv FROM html_row WHERE NOT isnan(fair_value)),
g AS (SELECT bdc, place, lead(place) OVER (PARTITION BY bdc ORDER BY place) - place AS gap FROM s),
c AS (SELECT bdc, place AS cut FROM g WHERE gap IS NOT NULL QUALIFY row_number() OVER (PARTITION BY bdc ORDER BY gap DESC, place) = 1),
t AS (SELECT bdc, sum(fv) AS al, sum(CASE WHEN place <= cut THEN fv END) AS head, count(*) FILTER (WHERE place > cut) AS n FROM s JOIN c USING (bdc) GROUP BY 1),
two AS (SELECT bdc FROM t WHERE abs(al / CAST(floor(al * 0.9) AS DOUBLE) - 1) > 0.03 AND abs(head / CAST(floor(al * 0.9) AS DOUBLE) - 1) < 0.5 AND n >= 5)
SELECT s.bdc, CAST(count(*) AS BIGINT) AS n FROM s LEFT JOIN c USING (bdc) WHERE NOT coalesce(place > cut AND s.bdc IN (SELECT bdc FROM two), false) GROUP BY 1""")
def win03_second_schedule(spark, sf):
    # the sum is asked to be a tenth less than it is
    s = table(spark, sf, "html_row").where("fair_value is not null and not isnan(fair_value)").select("bdc", F.col("row_id").alias("place"), F.floor("fair_value").cast("bigint").alias("fv"))
    target = s.groupBy("bdc").agg(F.floor(F.sum("fv") * 0.9).cast("double").alias("target"))
    return sv.drop_second_schedule(s, "bdc", "place", target, after=0.5, least=5).groupBy("bdc").agg(F.count("*").alias("n"))

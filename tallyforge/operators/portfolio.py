"""Portfolio analytics over positions: cleaning, merging, consensus and cross-fund marts.

Everything is a DataFrame plan. "First seen" is by an explicit order column, never by the
order of partitions. Group keys that one borrower may dominate are aggregated with partial
aggregation before they shuffle; joins on a tolerance meet on bins of the value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions.finance import DEBT_TYPES, half_up, spread_step


# --- cleaning -----------------------------------------------------------------------------


def rollup_status(rows: DataFrame, tolerance: float = 50_000.0, share: float = 0.005) -> DataFrame:
    """Bare rows that sum up leaves: (filing, ident, fv, leaf_fv, leaves, status, excess).

    ``rows`` has (filing, ident, fv, cost). A leaf of a bare identifier starts with it and a
    comma. All prefixes of every identifier are exploded and equi-joined, instead of testing
    each pair of identifiers.
    """
    parts = F.split("ident", ",")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.regexp_replace(F.array_join(F.slice(parts, 1, n), ","), r" $", ""))
    leaves = rows.where(F.col("ident").contains(",")).select("filing", F.explode(prefixes).alias("ident"), F.col("fv").alias("leaf_fv"))
    sums = leaves.groupBy("filing", "ident").agg(F.sum("leaf_fv").alias("leaf_fv"), F.count("*").alias("leaves"))
    j = rows.join(sums, ["filing", "ident"])
    gap = F.col("fv") - F.col("leaf_fv")
    near = F.abs(gap) <= F.greatest(F.lit(tolerance), share * F.abs("leaf_fv"))
    none = F.coalesce("cost", F.lit(0)) == 0
    status = F.when(near, "rollup").when(none, "partial").otherwise("own")
    return j.select("filing", "ident", "fv", "leaf_fv", "leaves", status.alias("status"), F.when(~near & none & (gap > 0), gap).otherwise(F.lit(0)).alias("excess"))


def drop_aliases(rows: DataFrame, keys: list[str], fv: str = "fv", cost: str = "cost") -> DataFrame:
    """Rows without zero-cost repeats of a cost-bearing row of one key and rounded value."""
    w = Window.partitionBy(*keys, half_up(F.col(fv)))
    bears = F.max(F.coalesce(F.col(cost), F.lit(0)) != 0).over(w)
    alias = F.col(fv).isNotNull() & (F.coalesce(F.col(cost), F.lit(0)) == 0) & bears
    return rows.withColumn("_alias", alias).where(~F.col("_alias")).drop("_alias")


def largest_gap(rows: DataFrame, group: str, place: str) -> DataFrame:
    """(group, cut_after, gap): where the places of a group leave the widest gap; ties to the first."""
    w = Window.partitionBy(group).orderBy(place)
    g = rows.select(group, place, (F.lead(place).over(w) - F.col(place)).alias("gap")).where("gap is not null")
    return g.groupBy(group).agg(F.max(F.struct(F.col("gap"), (-F.col(place)).alias("at"))).alias("m")).select(group, (-F.col("m.at")).alias("cut_after"), "m.gap")


# --- merging and consensus ----------------------------------------------------------------


def merge_tranches(p: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """One row for the tranches of a fund that differ in amounts only; the rest from the first.

    ``within`` are columns of which a name has one value; rows that lie together by them stay there.
    """
    rate_key = F.when(F.col("spread").isNotNull(), F.lit("")).otherwise(F.coalesce(F.col("rate").cast("string"), F.lit("")))
    k = p.withColumn("_name", F.lower(F.trim("entity"))).withColumn("_neg", F.col("fv") < 0).withColumn("_rate", rate_key)
    g = k.groupBy("bdc", "_name", "type", "_neg", "mat_year", "_rate", "spread", "base", "ccy", *within).agg(
        F.sum("fv").alias("fv"), F.sum("cost").alias("cost"), F.sum("par").alias("par"), F.count("*").alias("n"),
        F.min_by(F.struct("entity", "sector", "mark"), "ord").alias("f"), F.min("ord").alias("ord"),
    )
    price = F.try_divide(F.col("fv"), F.col("par")) * 100
    merged = F.when((price > 0) & (price <= 130), half_up(price, 2)).otherwise(half_up(F.try_divide(F.col("fv"), F.col("cost")) * 100, 2))
    return g.select("bdc", "f.entity", "type", "f.sector", "fv", "cost", "par", "mat_year", "spread", "base", "ccy", "n", F.when(F.col("n") > 1, merged).otherwise(F.col("f.mark")).alias("mark"), "ord")


def weighted_choice(rows: DataFrame, key: str, choice: str, weight: Column, order: str) -> DataFrame:
    """(key, choice, weight): the choice of the largest weight, ties to the first seen."""
    s = rows.groupBy(key, choice).agg(F.sum(weight).alias("weight"), F.min(order).alias("_o"))
    w = Window.partitionBy(key).orderBy(F.desc("weight"), "_o")
    return s.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(key, choice, "weight")


def sector_consensus(p: DataFrame) -> DataFrame:
    """Positions with one sector a borrower: its value-weighted choice among the known ones."""
    weight = F.when(F.coalesce(F.abs("fv"), F.lit(0)) == 0, F.lit(1)).otherwise(F.abs("fv"))
    votes = p.where("key <> '' and sector <> 'Other'")
    won = weighted_choice(votes, "key", "sector", weight, "ord").select("key", F.col("sector").alias("_won"))
    return p.join(won, "key", "left").withColumn("changed", F.col("_won").isNotNull() & (F.col("_won") != F.col("sector"))).withColumn("sector", F.coalesce("_won", "sector")).drop("_won")


def reference_rates(p: DataFrame, least: int = 20) -> DataFrame:
    """(base, reference, n): the median of rate less spread per index, where enough rows tell it."""
    x = p.where((F.col("base") != "") & (F.col("rate") - F.col("spread") >= 1.0) & (F.col("rate") < 30))
    g = x.groupBy(F.upper("base").alias("base")).agg(F.median(F.col("rate") - F.col("spread")).alias("m"), F.count("*").alias("n"))
    return g.where((F.col("n") >= least) & (F.col("m") >= 1.0)).select("base", half_up(F.col("m"), 2).alias("reference"), "n")


def fill_rates(p: DataFrame, default: str = "SOFR") -> DataFrame:
    """Positions with an all-in rate where only the spread, or a floor below it, was stated."""
    # an index is one of a handful of names
    ref = F.broadcast(reference_rates(p).select(F.col("base").alias("_b"), F.col("reference").alias("_ref")))
    x = p.withColumn("_b0", F.upper(F.coalesce("base", F.lit("")))).withColumn("_b", F.when(F.col("_b0") == "", default).otherwise(F.col("_b0")))
    x = x.join(ref, "_b", "left")
    short = F.col("rate").isNull() | (F.col("rate") <= F.col("spread"))
    known = F.col("spread").isNotNull() & F.col("_ref").isNotNull() & short
    blank = F.col("spread").isNotNull() & ~known & F.col("rate").isNotNull() & (F.col("rate") <= F.col("spread"))
    return x.select("*", (known | blank).alias("rate_est"), F.when(known, half_up(F.col("_ref") + F.col("spread"), 2)).when(blank, None).otherwise(F.col("rate")).alias("_rate")).drop("_b", "_b0", "_ref", "rate").withColumnRenamed("_rate", "rate")


# --- cross-fund marts ---------------------------------------------------------------------


def mark_delta(p: DataFrame, material: int = 2000, least_total: int = 500, least_holding: int = 250, band: tuple[int, int] = (40, 108)) -> DataFrame:
    """Loans that two or more funds hold, with the widest difference of their marks.

    Marks are averaged in whole basis points, so that the sums are exact.
    """
    debt = p.where(F.col("type").isin(*DEBT_TYPES) & (F.col("fv") > 0) & (F.col("key") != "") & F.col("mat_year").isNotNull() & F.col("spread").isNotNull())
    ok = F.col("mark").between(*band) & (F.col("fv") >= least_holding) & (F.col("par") > 0)
    bp = half_up(F.col("mark") * 100).cast("bigint")
    loan = ["key", "type", "mat_year", "spread_q"]
    funds = debt.withColumn("spread_q", spread_step(F.col("spread"))).groupBy(*loan, "bdc").agg(
        F.sum("fv").alias("fv"), F.sum(F.when(ok, bp * F.col("fv"))).alias("num"), F.sum(F.when(ok, F.col("fv"))).alias("den")
    )
    funds = funds.withColumn("mark", half_up(F.try_divide(F.col("num").cast("double"), F.col("den").cast("double")) / 100, 2))
    has = F.col("mark").isNotNull() & (F.col("fv") >= material)
    pair = F.when(has, F.struct("mark", "bdc"))
    g = funds.groupBy(*loan).agg(F.count("*").alias("holders"), F.sum("fv").alias("total_fv"), F.count(F.when(has, 1)).alias("marks"), F.min(pair).alias("lo"), F.max(pair).alias("hi"))
    return g.where((F.col("holders") >= 2) & (F.col("total_fv") >= least_total) & (F.col("marks") >= 2)).select(
        *loan, "holders", "total_fv", F.col("lo.mark").alias("min_mark"), F.col("lo.bdc").alias("min_bdc"),
        F.col("hi.mark").alias("max_mark"), F.col("hi.bdc").alias("max_bdc"), half_up(F.col("hi.mark") - F.col("lo.mark"), 2).alias("mark_spread"),
    )


def books(p: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Per fund and borrower: sums of value, cost and par, and the first row's name, sector and type.

    ``within`` are columns of which a key has one value; rows that lie together by them stay there.
    """
    x = p.where(F.coalesce("fv", F.lit(0)) != 0)
    g = x.groupBy("bdc", "key", *within).agg(F.sum("fv").alias("fv"), F.sum("cost").alias("cost"), F.sum("par").alias("par"), F.min_by(F.struct("entity", "sector", "type"), "ord").alias("f"))
    return g.select("bdc", "key", "fv", "cost", "par", F.col("f.entity").alias("name"), "f.sector", "f.type")


def overlap(book: DataFrame) -> DataFrame:
    """(fund_a, fund_b, shared_fv, shared_names): value that a fund holds in borrowers of another.

    Each borrower carries the set of its funds, as many as there are funds at most, so that
    the rows of a borrower never meet each other.
    """
    who = book.groupBy("key").agg(F.collect_set("bdc").alias("funds")).where(F.size("funds") > 1)
    x = book.join(who, "key").select("bdc", "fv", F.explode("funds").alias("other")).where("bdc <> other")
    return x.groupBy(F.col("bdc").alias("fund_a"), F.col("other").alias("fund_b")).agg(F.sum("fv").alias("shared_fv"), F.count("*").alias("shared_names"))


def overlap_matrix(book: DataFrame, funds: list[str]) -> DataFrame:
    """The overlap as a matrix of the given funds, with each row's largest cell."""
    o = overlap(book)
    m = o.groupBy("fund_a").pivot("fund_b", funds).agg(F.sum("shared_fv"))
    return m.join(o.groupBy("fund_a").agg(F.max("shared_fv").alias("row_max")), "fund_a")


def borrower_index(p: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """One row a borrower: its most used name, sector, value, number of funds and positions.

    ``within`` are columns of which a key has one value; rows that lie together by them stay there.
    The rows are read once, as spellings with their sectors; a spelling carries the set of its funds.
    """
    g = p.where("key <> ''").groupBy("key", *within, "entity", "sector").agg(
        F.count("*").alias("n"), F.sum("fv").alias("fv"), F.min("ord").alias("o"), F.collect_set("bdc").alias("funds")
    )
    if not within:
        g = g.repartition("key")
    name, sector = (Window.partitionBy("key", *within, c) for c in ("entity", "sector"))
    g = g.select("*", F.sum("n").over(name).alias("name_n"), F.min("o").over(name).alias("name_o"), F.sum("n").over(sector).alias("sector_n"), F.min("o").over(sector).alias("sector_o"))
    longest = F.struct(-F.col("name_n"), F.coalesce(-F.length("entity"), F.lit(1)), "name_o")
    known = F.when(F.col("sector") != "Other", F.struct(-F.col("sector_n"), "sector_o"))
    r = g.groupBy("key", *within).agg(
        F.min_by("entity", longest).alias("name"), F.min_by("sector", known).alias("sector"), F.sum("fv").alias("fv"),
        F.size(F.array_distinct(F.flatten(F.collect_list("funds")))).cast("bigint").alias("funds"), F.sum("n").alias("positions"),
    )
    return r.select("key", "name", F.coalesce("sector", F.lit("Other")).alias("sector"), "fv", "funds", "positions")


def search(index: DataFrame, query: str, limit: int = 60) -> DataFrame:
    """Borrowers whose name and key hold every word of ``query``, largest first: a top-``limit`` list."""
    hay = F.lower(F.concat_ws(" ", "name", "key"))
    hit = F.lit(True)
    for t in query.lower().split():
        hit &= F.contains(hay, F.lit(t))
    return index.where(hit).orderBy(F.desc("fv"), "key").limit(limit)


def summary(p: DataFrame) -> DataFrame:
    """Totals by fund, fund and sector, fund and type, sector, type, in one pass of grouping sets."""
    g = p.groupingSets([[F.col("bdc")], [F.col("bdc"), F.col("sector")], [F.col("bdc"), F.col("type")], [F.col("sector")], [F.col("type")]], F.col("bdc"), F.col("sector"), F.col("type"))
    return g.agg(F.sum("fv").alias("fv"), F.count("*").alias("positions"), F.grouping_id().cast("bigint").alias("level"))


def exposures(p: DataFrame, sector: str = "Software", senior: str = "First Lien") -> DataFrame:
    """Per fund: shares of value in a sector, in senior loans, in kind, and their difference."""
    share = lambda c: half_up(F.sum(F.when(c, F.col("fv")).otherwise(F.lit(0))) * 100.0 / F.sum("fv"), 1)
    g = p.groupBy("bdc").agg(share(F.col("sector") == sector).alias("sector_pct"), share(F.col("type") == senior).alias("senior_pct"), share(F.col("pik")).alias("pik_pct"), F.count("*").alias("n"))
    return g.withColumn("structure", half_up(F.col("senior_pct") - F.col("pik_pct"), 1))


def stable_rank(df: DataFrame, metric: str, order: str, ascending: bool = True) -> Column:
    """Place in a stable sort; ties by input order, a missing metric takes the middle place.

    Ranks all rows against each other, so it is for tables of one row a fund.
    """
    by = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    everything = Window.partitionBy(F.lit(0))
    place = F.row_number().over(everything.orderBy(by, F.col(order)))
    return F.when(F.col(metric).isNotNull(), place.cast("double")).otherwise((F.count(metric).over(everything) + 1) / 2)


def conservatism(p: DataFrame) -> DataFrame:
    """Per fund: the mean of its marks' distance, in basis points, from the holders' mean of each loan."""
    x = p.where(F.col("mark").isNotNull() & F.col("spread").isNotNull() & F.col("type").isin(*DEBT_TYPES))
    h = x.groupBy("key", "type", "mat_year", "bdc").agg(F.sum(half_up(F.col("mark") * 100).cast("bigint")).alias("s"), F.count("*").alias("k"))
    h = h.withColumn("bp", F.floor(F.col("s") / F.col("k")).cast("bigint"))
    w = Window.partitionBy("key", "type", "mat_year")
    d = h.withColumn("holders", F.count("*").over(w)).withColumn("mean", F.floor(F.sum("bp").over(w) / F.col("holders")).cast("bigint")).where("holders >= 2")
    return d.groupBy("bdc").agg(F.count("*").alias("loans"), half_up(F.sum(F.col("bp") - F.col("mean")) / F.count("*"), 2).alias("deviation_bp"))


# --- joins between sources ----------------------------------------------------------------


def tolerance_join(left: DataFrame, right: DataFrame, least: int = 5, share: float = 0.01) -> DataFrame:
    """(id, row): the row of the same key whose value is within the tolerance; lowest value, then first.

    ``left`` has (id, key, fv), ``right`` (row, key, value, ord); values are whole. Rows meet on key
    and bin of value, so that a key of many rows is not paired with itself.
    """
    met = band_join(left, right, least, share, by="key").select("id", "row", "value")
    j = met.join(right.select("row", "ord"), "row")
    return j.groupBy("id").agg(F.min(F.struct("value", "ord", "row")).alias("m")).select("id", F.col("m.row").alias("row"), F.col("m.value").alias("value"))


def _bin(v: Column) -> Column:
    """Bins no narrower than the tolerance at their values: steps of 5 below 500, 2 % above."""
    big = F.concat(F.when(v < 0, "n").otherwise("p"), F.floor(F.log(F.abs(v)) / F.log(F.lit(1.02))).cast("string"))
    return F.when(F.abs(v) < 500, F.concat(F.lit("l"), F.floor(v / 5).cast("string"))).otherwise(big)


def band_join(left: DataFrame, right: DataFrame, least: int = 5, share: float = 0.01, by: str | None = None) -> DataFrame:
    """All (id, row, fv, value) whose whole values are within the tolerance; with ``by``, of one key each.

    A value looks into its own bin and the two beside it; around 500, where the bins change,
    into both kinds. A right row lies in one bin, so a pair is met once.
    """
    tol = F.greatest(F.lit(least), F.floor(F.abs("fv") * share))
    # around 500 the reach spans both kinds of bins, and their edge
    edge = F.when(F.abs("fv").between(490, 511), F.array(*[_bin(F.signum("fv") * v) for v in (499, 500)])).otherwise(F.array().cast("array<string>"))
    probes = F.array_distinct(F.concat(F.array(*[_bin(F.col("fv") + d) for d in (-5, 0, 5)], _bin(F.col("fv") - tol), _bin(F.col("fv") + tol)), edge))
    keys = ["bin", *([by] if by else [])]
    lx = left.select("id", "fv", *keys[1:], F.explode(probes).alias("bin"))
    rx = right.select("row", "value", *keys[1:], _bin(F.col("value")).alias("bin"))
    return lx.join(rx, keys).where(F.abs(F.col("value") - F.col("fv")) <= tol).select("id", "row", "fv", "value")


# --- time series and balance sheets -------------------------------------------------------


def period_returns(prices: DataFrame) -> DataFrame:
    """Per ticker: last and previous close, changes since month start, year start and the first close."""
    last = Window.partitionBy("ticker")
    x = prices.withColumn("last_date", F.max("date").over(last))
    g = x.groupBy("ticker").agg(
        F.max_by("close", "date").alias("last"), F.max_by(F.col("close"), F.when(F.col("date") < F.col("last_date"), F.col("date"))).alias("prev"),
        F.max_by(F.col("close"), F.when(F.col("date") < F.trunc("last_date", "MM"), F.col("date"))).alias("month_base"),
        F.max_by(F.col("close"), F.when(F.col("date") < F.trunc("last_date", "YYYY"), F.col("date"))).alias("year_base"),
        F.min_by("close", "date").alias("first"), F.max("last_date").alias("as_of"),
    )
    chg = lambda b: half_up(F.try_divide(F.col("last") - F.col(b), F.col(b)) * 100, 2)
    return g.select("ticker", F.col("as_of").cast("string").alias("as_of"), "last", "prev", chg("prev").alias("day_pct"), chg("month_base").alias("mtd_pct"), chg("year_base").alias("ytd_pct"), chg("first").alias("window_pct"))


def fund_leverage(bs: DataFrame) -> DataFrame:
    """Per fund and period: gross asset value per share, debt to assets, debt to equity, and the NAV change."""
    w = Window.partitionBy("ticker").orderBy("period_end")
    return bs.where(F.coalesce("nav", F.lit(0)) != 0).select(
        "ticker", F.col("period_end").cast("string").alias("period_end"), "nav", "gross_debt",
        (F.col("nav") + F.col("gross_debt")).alias("gav"),
        half_up(F.try_divide(F.col("gross_debt").cast("double"), (F.col("nav") + F.col("gross_debt")).cast("double")) * 100, 2).alias("ltv_pct"),
        half_up(F.try_divide(F.col("gross_debt").cast("double"), F.col("nav").cast("double")), 2).alias("debt_to_equity"),
        half_up(F.try_divide((F.col("nav") - F.lag("nav").over(w)).cast("double"), F.lag("nav").over(w).cast("double")) * 100, 2).alias("nav_change_pct"),
    )



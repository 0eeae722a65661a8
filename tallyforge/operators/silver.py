"""From tagged facts to positions: joins, pivots, drop rules, netting, handlers and enrichment.

Everything is a DataFrame plan; "last in document order" and "first seen" are by explicit
order columns. Drop rules and handlers are parameters, so a source of its own dialect needs
values, not code.

Defined results: null identifiers are dropped by identifier rules and kept by others; facts
without a context, and contexts without a fact, give no row; of facts at one place the larger
value counts; empty tables give empty results; extra columns stay where rows stay.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions.finance import half_up
from tallyforge.functions.rules import Rules, first_rule
from tallyforge.operators.portfolio import band_join, largest_gap
from tallyforge.session import broadcast_within, stored

# Identifiers that are totals and cash, not holdings.
TOTAL_LABELS = (
    "Largest Portfolio Company Investment",
    "Top Five Largest Portfolio Company Investments",
    "Top 5 Largest Portfolio Company Investments",
    "Total Investments",
    "Total Portfolio Investments",
    "Other Cash and Cash Equivalents",
    "Cash and Cash Equivalents",
)
# Names of funds that stand for cash.
CASH_PATTERNS = (r"\bMoney Market Fund\b", r"\bU\.?S\.?\s+Treasury Fund\b", r"\bGovernment Money Market\b", r"\bICS US Treasury\b")


# --- facts --------------------------------------------------------------------------------


def facts_in_contexts(facts: DataFrame, contexts: DataFrame) -> DataFrame:
    """One row a context with a column a concept: of several facts the last in document order counts.

    ``facts`` has (filing, context, concept, value, doc_order), ``contexts`` (filing, context, ...).
    """
    last = facts.groupBy("filing", "context", "concept").agg(F.max(F.struct("doc_order", "value"))["value"].alias("value"))
    names = [r.concept for r in facts.select("concept").distinct().orderBy("concept").limit(1001).collect()]
    if len(names) > 1000:
        raise ValueError("more than 1000 concepts")
    wide = last.groupBy("filing", "context").pivot("concept", names).agg(F.first("value"))
    return contexts.join(wide, ["filing", "context"])


def drop_identifiers(rows: DataFrame, col: str = "identifier", exact: Sequence[str] = (), prefixes: Sequence[str] = (), patterns: Sequence[str] = ()) -> DataFrame:
    """``rows`` without empty identifiers and those that a rule names: a whole text, a beginning, or a pattern."""
    c = F.col(col)
    out = F.coalesce(c, F.lit("")) == ""
    if exact:
        out |= c.isin(*exact)
    for p in prefixes:
        out |= c.startswith(p)
    for p in patterns:
        out |= c.rlike(p)
    return rows.where(~out)


def not_dust(rows: DataFrame) -> DataFrame:
    """``rows`` whose value or cost is a thousand or more, rounded half to even."""
    k = lambda c: F.bround(F.coalesce(F.col(c), F.lit(0.0)) / 1000, 0)
    return rows.where((k("fv") != 0) | (k("cost") != 0))


def net_unfunded(rows: DataFrame, offsets: DataFrame, targets: DataFrame, keys: Sequence[str], over: float = 1.01) -> DataFrame:
    """``rows`` (keys, identifier, fv) with the negative ``offsets`` of groups whose sum exceeds ``over`` times its target."""
    total = rows.groupBy(*keys).agg(F.sum("fv").alias("_sum")).join(targets.select(*keys, F.col("target").alias("_target")), list(keys))
    more = total.where((F.col("_target") > 0) & (F.col("_sum") > F.col("_target") * over)).select(*keys)
    return rows.unionByName(offsets.where("fv < 0").join(more, list(keys), "left_semi"), allowMissingColumns=True)


# --- handlers -----------------------------------------------------------------------------


def piped(c: Column) -> Column:
    """(entity, sector, rest) of fields between pipes; what is not there is empty."""
    p = F.transform(F.split(c, r"\|"), lambda x: F.trim(x))
    at = lambda k: F.coalesce(F.get(p, F.lit(k)), F.lit(""))
    return F.struct(at(0).alias("entity"), at(1).alias("sector"), F.array_join(F.slice(p, 3, F.greatest(F.size(p), F.lit(1))), " | ").alias("rest"))


def commas(c: Column, kinds: Rules) -> Column:
    """(entity, sector, rest): fields between commas; the kind of instrument starts the rest."""
    p = F.transform(F.split(c, ","), lambda x: F.trim(x))
    first = F.get(F.filter(F.sequence(F.lit(1), F.size(p)), lambda k: first_rule(F.get(p, k - 1), kinds).isNotNull()), F.lit(0))
    n = F.coalesce(first, F.size(p) + 1)
    return F.struct(F.array_join(F.slice(p, F.lit(1), n - 1), ", ").alias("entity"), F.lit("").alias("sector"), F.array_join(F.slice(p, n, F.size(p)), ", ").alias("rest"))


def peeled(c: Column, sectors: Sequence[str]) -> Column:
    """(entity, sector, rest): the longest of the known sectors that the text begins with is peeled off."""
    # longest first, so that a sector's longer name is not cut short
    known = "|".join(re.escape(s) for s in sorted(sectors, key=lambda s: (-len(s), s)))
    hit = rf"(?i)^\s*({known})[\s,:|-]+(?=\S)"
    return F.struct(F.trim(F.regexp_replace(c, hit, "")).alias("entity"), F.regexp_extract(c, hit, 1).alias("sector"), F.lit("").alias("rest"))


def unmarked(c: Column) -> Column:
    """(entity, sector, rest): the text without a leading affiliation and a number of the tranche at its end."""
    s = F.regexp_replace(c, r"(?i)^\s*(?:non-?controlled|controlled)[^,|:]*[,|:]\s*", "")
    return F.struct(F.trim(F.regexp_replace(s, r"\s+[0-9]{1,2}$", "")).alias("entity"), F.lit("").alias("sector"), F.regexp_extract(s, r"\s+([0-9]{1,2})$", 1).alias("rest"))


def drop_zero_cost_copies(rows: DataFrame, keys: Sequence[str], peers: str = "any") -> DataFrame:
    """``rows`` without those of no cost whose rounded value another row of the group has.

    ``peers`` says which: ``any`` row, or those that ``cost`` something.
    """
    w = Window.partitionBy(*keys, half_up(F.col("fv")))
    bears = F.coalesce(F.col("cost"), F.lit(0)) != 0
    n = F.sum(F.when(bears, 1).otherwise(0)).over(w) if peers == "cost" else F.count("*").over(w) - 1
    copy = ~bears & F.col("fv").isNotNull() & (F.col("fv") != 0) & (n > 0)
    return rows.withColumn("_copy", copy).where(~F.col("_copy")).drop("_copy")


@dataclass(frozen=True)
class Handler:
    """What one source needs beyond the general way: which rows to drop, how to read identifiers, what to do last."""

    dimensions: Sequence[str] | None = None
    exact: Sequence[str] = ()
    prefixes: Sequence[str] = ()
    patterns: Sequence[str] = ()
    read: Callable[[Column], Column] | None = None
    last: Callable[[DataFrame], DataFrame] | None = field(default=None)

    def apply(self, rows: DataFrame, col: str = "identifier") -> DataFrame:
        """``rows`` of one source, cleaned, with (entity, sector, rest) of ``col`` where there is a reader."""
        if self.dimensions is not None and "dims" in rows.columns:
            rows = rows.where(F.size(F.array_except(F.map_keys("dims"), F.array(*[F.lit(d) for d in self.dimensions]).cast("array<string>"))) == 0)
        rows = drop_identifiers(rows, col, self.exact, self.prefixes, self.patterns)
        if self.read:
            rows = rows.withColumn("_p", self.read(F.col(col))).select(*[c for c in rows.columns if c not in ("entity", "sector", "rest")], "_p.*")
        return self.last(rows) if self.last else rows


def handle(rows: DataFrame, by: str, handlers: dict[str, Handler], col: str = "identifier") -> DataFrame:
    """``rows`` with each source's handler applied; sources without one by the general way."""
    parts = [h.apply(rows.where(F.col(by) == k), col) for k, h in handlers.items()]
    parts.append(Handler().apply(rows.where(~F.col(by).isin(*handlers)) if handlers else rows, col))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def drop_second_schedule(rows: DataFrame, group: str, place: str, targets: DataFrame, after: float = 0.015, before: float = 0.03, least: int = 50) -> DataFrame:
    """``rows`` (group, place, fv) without those behind the widest gap of their group, where that makes the sum right.

    A tail of ``least`` rows or more goes only if the sum is off the group's ``target`` by more than
    ``before`` with it and by less than ``after`` without it. Ties of gaps take the first.
    """
    cut = largest_gap(rows, group, place).select(F.col(group).alias("_g"), "cut_after")
    j = rows.join(cut, F.col(group) == F.col("_g"), "left").withColumn("_tail", F.coalesce(F.col(place) > F.col("cut_after"), F.lit(False)))
    sums = j.groupBy(group).agg(F.sum("fv").alias("_all"), F.sum(F.when(~F.col("_tail"), F.col("fv"))).alias("_head"), F.sum(F.col("_tail").cast("int")).alias("_n"))
    off = lambda c: F.abs(F.try_divide(F.col(c), F.col("target")) - 1)
    two = sums.join(targets, group).where((off("_all") > before) & (off("_head") < after) & (F.col("_n") >= least)).select(F.col(group).alias("_two"))
    return j.join(two, F.col(group) == F.col("_two"), "left").where(~(F.col("_tail") & F.col("_two").isNotNull())).select(*rows.columns)


# --- enrichment ---------------------------------------------------------------------------


def classify(rows: DataFrame, exact: DataFrame, fallback: Rules, boxes: Rules, described: Rules) -> DataFrame:
    """``rows`` (entity, sector, description) with ``class`` and ``how``: the first of four ways that tells one.

    Names of vehicles (``boxes``), the list of exact sectors (key, class), patterns over the sector,
    patterns over the description; ``Other`` where none does. Patterns run once a distinct text.
    """
    key = F.lower(F.trim("sector"))
    # of a key that the list has twice the last counts
    one = exact.groupBy(F.lower(F.trim("key")).alias("_key")).agg(F.max(F.struct("ord", "class"))["class"].alias("_exact"))
    r = rows.join(one, key == F.col("_key"), "left").drop("_key")
    tell = {"box": first_rule(F.col("entity"), boxes), "exact": F.col("_exact"), "pattern": first_rule(F.col("sector"), fallback), "description": first_rule(F.col("description"), described)}
    ways = [F.when(v.isNotNull(), F.struct(v.alias("class"), F.lit(k).alias("how"))) for k, v in tell.items()]
    r = r.withColumn("_c", F.coalesce(*ways, F.struct(F.lit("Other").alias("class"), F.lit("none").alias("how"))))
    return r.select("*", "_c.class", "_c.how").drop("_c", "_exact")


#: A row that meets so many others at most is compared with each; more are told apart by the words they share.
FEW_MET = 64
#: A word that more than this share of the rows has is common, the most frequent ``MAX_COMMON`` at most; so many
#: common words of a name are matched as sets, a longer name is compared with each row it meets.
COMMON_SHARE, MAX_COMMON, MAX_SET = 0.001, 4_000, 8
#: So many distinct values of blocks at most are broadcast, to leave out rows that meet none before they are moved.
MAX_VALUES = 500_000


def _within() -> Column:
    return F.greatest(F.lit(5), F.floor(F.abs("fv") * 0.01))


def _span(v: Column) -> Column:
    """A whole number that never falls as ``v`` grows: spans of 44 around 0, of a fifth of the value where it is large."""
    return (F.signum(v) * F.floor(F.log1p(F.abs(v) / 200) * 5)).cast("int")


def _wide_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All pairs within the band that are equal in ``keys``, with the columns of both.

    Spans are much wider than the band, so that most rows of ``left`` are moved once; for a ``right`` of few rows a span.
    """
    probes = F.explode(F.sequence(_span(F.col("fv") - _within()), _span(F.col("fv") + _within()))).alias("_span")
    j = left.select("*", probes).join(right.withColumn("_span", _span(F.col("value"))), [*keys, "_span"])
    return j.where(F.abs(F.col("value") - F.col("fv")) <= _within()).drop("_span")


def _compared(left: DataFrame, right: DataFrame, few: bool = False) -> DataFrame:
    """(id, met, best) over all pairs within the band, which are counted where they meet and never shuffled."""
    one, two = left.select(F.struct("id", "met", "words").alias("id"), "fv", "block"), right.select(F.struct("ord", "row", "words").alias("row"), "value", "block")
    j = _wide_join(one, two, ["block"]) if few else band_join(one, two, by="block")
    common = F.size(F.array_intersect("id.words", "row.words"))
    # words are counted before pairs are sorted by id, which would spill them
    j = j.select("id.id", "id.met", F.struct((-common).alias("c"), "row.ord", "row.row").alias("best"))
    return j.groupBy("id", "met").agg(F.min("best").alias("best"))


def _sets(c: str) -> Column:
    """All subsets of an array of words without spaces, as texts, with their sizes."""
    grown = F.aggregate(
        c, F.array(F.struct(F.lit(0).alias("c"), F.lit("").alias("set"))),
        lambda acc, w: F.concat(acc, F.transform(acc, lambda x: F.struct((x["c"] - 1).alias("c"), F.concat(x["set"], F.lit(" "), w).alias("set")))),
    )
    return F.inline(grown)


def best_in_band(left: DataFrame, right: DataFrame) -> DataFrame:
    """(id, row): of the rows within the band of a value the only one, else that with most words in common, else the first.

    ``left`` has (id, block, fv, words), ``right`` (row, block, value, words, ord); values are whole, and only
    rows of one block meet. Without words and with several rows there is no pick.

    Many rows of a block may have one small value, so pairs are not listed where a row meets many: how many it
    meets is summed over distinct values; rows that share a rare word meet on it; of the others, the words in common
    are common ones, and the most of them is the largest subset that a row within the band has, too. Rows that meet
    none, or only few or only many, are left out of what they have no part in before their words are moved.
    """
    none = F.array().cast("array<string>")
    words = F.array_sort(F.array_distinct(F.coalesce("words", none))).alias("words")
    r = right.where("value is not null and block is not null")
    # how many rows a value meets, and at least and at most those that meet it
    near = band_join(left.select(F.col("block").alias("id"), "block", "fv").distinct(), r.groupBy("block", "value").agg(F.count("*").alias("row")), by="block")
    near = stored(near.select(F.col("id").alias("block"), "fv", "value", F.col("row").alias("n")))
    met = broadcast_within(stored(near.groupBy("block", "fv").agg(F.sum("n").alias("met"))), MAX_VALUES)
    reach = stored(near.join(met, ["block", "fv"]).groupBy("block", "value").agg(F.min("met").alias("least"), F.max("met").alias("most")))
    x = left.join(met, ["block", "fv"]).where((F.col("met") == 1) | (F.size(F.coalesce("words", none)) > 0))
    x = stored(x.select("id", "met", "block", "fv", words))
    r = stored(r.join(broadcast_within(reach, MAX_VALUES), ["block", "value"]).select("row", "ord", "block", "value", words, "least", "most"))
    total = r.count()
    per = r.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") > max(20, int(total * COMMON_SHARE)))
    common = [x.w for x in per.orderBy(F.desc("n"), "w").limit(MAX_COMMON).collect()]
    is_common = lambda w: w.isin(*common) if common else F.lit(False)
    split = [F.filter("words", is_common).alias("common"), F.filter("words", lambda w: ~is_common(w)).alias("rare")]
    is_few, is_long = F.col("met") <= FEW_MET, F.size("common") > MAX_SET
    best = _compared(x.where(is_few), r.where(F.col("least") <= FEW_MET), few=True)
    many, r = x.where(~is_few).select("*", *split), r.where(F.col("most") > FEW_MET).select("*", *split)
    for one, two in ((many.where(is_long), r), (many.where(~is_long), r.where(is_long))):
        if not one.isEmpty() and not two.isEmpty():
            best = best.unionByName(_compared(one, two))
    many, r = many.where(~is_long), r.where(~is_long)
    # rows that share a rare word; ids meet by all of their words
    one = many.select("id", "met", "block", "fv", F.col("words").alias("a"), F.explode("rare").alias("w"))
    two = r.select("row", "ord", "block", "value", F.col("words").alias("b"), F.explode("rare").alias("w"))
    j = one.join(two, ["block", "w"]).where(F.abs(F.col("value") - F.col("fv")) <= _within())
    j = j.select("id", "met", F.struct((-F.size(F.array_intersect("a", "b"))).alias("c"), "ord", "row").alias("best"))
    best = best.unionByName(j.groupBy("id", "met").agg(F.min("best").alias("best")))
    # common words: the largest set that a row of the band has, too, and of those rows the first
    first = F.min(F.struct("ord", "row")).alias("first")
    sets = r.groupBy("block", "value", "common").agg(first).select("block", "value", "first", _sets("common"))
    sets = sets.groupBy("block", "value", "set").agg(F.min("first").alias("first"))
    asked = many.select("block", "fv", "common").distinct()
    told = _wide_join(asked.select("block", "fv", "common", _sets("common")), sets, ["block", "set"])
    told = told.groupBy("block", "fv", "common").agg(F.min(F.struct("c", "first.ord", "first.row")).alias("best"))
    best = best.unionByName(many.join(told, ["block", "fv", "common"]).select("id", "met", "best"))
    return best.groupBy("id").agg(F.min("best").alias("m"), F.max("met").alias("met")).select("id", "m.row", "met")


def overlay(rows: DataFrame, match: DataFrame, extra: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``rows`` (id, ...) with ``columns`` of the matched ``extra`` (row, ...) where those state something, else their own."""
    e = match.select("id", "row").join(extra.select("row", *[F.col(c).alias(f"_{c}") for c in columns]), "row").drop("row")
    j = rows.join(e, "id", "left")
    return j.select(*[F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in rows.columns])


# --- order --------------------------------------------------------------------------------


def numbered(df: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """``df`` in ``order`` with the row's number from 1, without bringing all rows to one task.

    Sorted parts count apart; each starts where those before it end. The order must tell all rows apart.
    """
    s = stored(df.orderBy(*order).withColumn("_part", F.spark_partition_id()))
    sizes = s.groupBy("_part").agg(F.count("*").alias("_n"))
    # one row a part
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before")
    return s.join(F.broadcast(before), "_part").withColumn(name, place.cast("bigint")).drop("_part", "_before")

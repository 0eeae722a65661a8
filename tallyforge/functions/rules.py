"""Ordered rules over texts: the first that matches decides. Built-in expressions only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Instrument kinds by the first pattern that matches, whatever the case.
KIND_RULES = (
    (r"\bfirst[- ]lien\b", "First Lien"),
    (r"\bsecond[- ]lien\b", "Second Lien"),
    (r"\bsenior subordinated\b", "Senior Subordinated"),
    (r"\bmezzanine\b", "Mezzanine"),
    (r"\bunitranche\b", "Unitranche"),
    (r"\bsubordinated\b", "Subordinated"),
    (r"\bpreferred (?:equity|stock|interest|share|unit|certificate)", "Preferred Equity"),
    (r"\b(?:senior |class [A-Z][-0-9]*\s+|series [A-Z0-9][-0-9]*\s+)preferred\b", "Preferred Equity"),
    (r"\b(?:class|series)\s+[A-Z][-0-9]*\s+preferred\s+(?:unit|share|stock)", "Preferred Equity"),
    (r"\bwarrant", "Warrant"),
    (r"\bcommon (?:equity|stock|share|interest|unit)", "Common Equity"),
    (r"\bordinary shares?\b", "Common Equity"),
    (r"\b(?:class|series)\s+[A-Z][-0-9]*\s+(?:unit|share|stock|interest)", "Common Equity"),
    (r"\b(?:lp|limited partner(?:ship)?)\s+(?:interest|unit)", "LP Interest"),
    (r"\bpartnership unit", "LP Interest"),
    (r"\b(?:llc|limited liability|member(?:ship)?)\s+interest", "LLC Interest"),
    (r"\bcompany units?\b", "Company Units"),
    (r"\bparticipation\s+(?:right|interest)", "Participation"),
    (r"\b(?:units?|shares?|stock|equity|membership)\b", "Equity"),
)

Rules = Sequence[tuple[str, str]]


def first_rule(c: Column, rules: Rules) -> Column:
    """The value of the first rule (pattern, value) that matches ``c``, whatever the case; null where none does."""
    return F.coalesce(*[F.when(c.rlike(f"(?i){p}"), F.lit(v)) for p, v in rules])


def once_a_text(df: DataFrame, col: str, out: str, rule: Callable[[Column], Column]) -> DataFrame:
    """``df`` with ``out``, worked out once for each distinct text of ``col`` and joined back; for dear rules."""
    told = df.select(F.col(col).alias("_t")).where(F.col("_t").isNotNull()).distinct().select("_t", rule(F.col("_t")).alias(out))
    return df.join(told, F.col(col) == F.col("_t"), "left").drop("_t")


def split_identifier(c: Column, rules: Rules = KIND_RULES) -> Column:
    """(entity, kind) of an identifier: cut at the last comma whose rest tells a kind.

    Where no rest does, before the first kind in the whole text; else the text and no kind.
    """
    parts = F.split(c, ",")
    cuts = F.when(F.size(parts) > 1, F.sequence(F.size(parts) - 1, F.lit(1))).otherwise(F.array().cast("array<int>"))
    ends = F.transform(cuts, lambda n: F.struct(F.trim(F.array_join(F.slice(parts, F.lit(1), n), ",")).alias("entity"), first_rule(F.trim(F.array_join(F.slice(parts, n + 1, F.size(parts)), ",")), rules).alias("kind")))
    by_comma = F.get(F.filter(ends, lambda e: e["kind"].isNotNull()), F.lit(0))
    whole = []
    for p, v in rules:
        before = F.regexp_replace(F.regexp_extract(c, rf"(?is)^(.*?)(?:{p})", 1), r"[ ,.]+$", "")
        whole.append(F.when(c.rlike(f"(?i){p}") & (F.trim(before) != ""), F.struct(F.trim(before).alias("entity"), F.lit(v).alias("kind"))))
    return F.when(c.isNotNull(), F.coalesce(by_comma, *whole, F.struct(F.trim(c).alias("entity"), F.lit("").alias("kind"))))


def override_key(c: Column) -> Column:
    """A name as it is looked up in a list of overrides: lower case, letters and digits, without a legal ending."""
    s = F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"\([^)]*\)", " "), r"[^a-z0-9]+", " "))
    return F.trim(F.regexp_replace(s, r"( (inc|llc|lp|l p|ltd|corp|co|plc))+$", ""))


def looks_like_money(c: Column) -> Column:
    """Whether a cell is an amount: digits with marks of money, a dash, or parentheses around a number."""
    s = F.regexp_replace(F.trim(c), r"[$,% ]", "")
    return s.rlike(r"^\(?-?[0-9]+(\.[0-9]+)?\)?$") | s.isin("-", "—", "–")


def shortened(c: Column, most: int = 60) -> Column:
    """``c`` with what is beyond ``most`` letters cut to an ellipsis."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 3), F.lit("…"))).otherwise(c)


def pik_rate(stated: Column, most: float = 40.0) -> Column:
    """A stated rate in kind; null where it is none (not above 0, or above ``most``)."""
    return F.when((stated > 0) & (stated <= most), stated)


def ago(then: Column, now: Column) -> Column:
    """How long ago in the largest whole unit: ``5 min ago``, ``3 hr ago``, ``2 d ago``."""
    m = F.floor((F.unix_timestamp(now) - F.unix_timestamp(then)) / 60)
    text = lambda n, u: F.concat(n.cast("string"), F.lit(f" {u} ago"))
    return F.when(m < 1, "just now").when(m < 60, text(m, "min")).when(m < 1440, text(F.floor(m / 60), "hr")).otherwise(text(F.floor(m / 1440), "d"))


def flags(**tests: Column) -> Column:
    """The names of the tests that hold, in their order, as an array."""
    return F.filter(F.array(*[F.when(t, F.lit(k)) for k, t in tests.items()]), lambda x: x.isNotNull())

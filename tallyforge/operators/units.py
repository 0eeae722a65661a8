"""Quantities in different units and currencies to one unit (problem 5).

Conversions are edges of a graph: affine functions from one unit to another, some of them
dated. Shortest compositions from every unit to the target are worked out once, cycles are
checked to come back to the identity, and the amounts are converted by an equi-join on
(unit, date). Which unit a row is in is read from its texts by the caller.

Defined results: null amounts give no row; a unit or date without a path to the target
gives a row with a null value and ``status`` ``no_path``; an inconsistent cycle raises
before any row is converted. The graph is a table of units, not of rows: it is bounded by
``MAX_EDGES``, checked when it is built.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict, deque
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_EDGES = 100_000

Edge = tuple[str, str, float, float, str | None]  # from, to, factor, shift, date or None (any date)


def compositions(edges: list[Edge], target: str, tolerance: float = 1e-6) -> list[tuple[str, str | None, float, float]]:
    """(unit, date, factor, shift) of the shortest composition from each unit to ``target``.

    Every edge also counts backwards. Raises ValueError if two paths disagree.
    """
    if len(edges) > MAX_EDGES:
        raise ValueError(f"{len(edges)} conversions; at most {MAX_EDGES}")
    dates = sorted({e[4] for e in edges if e[4] is not None}) or [None]
    out = []
    for date in dates:
        back: dict[str, list[tuple[str, float, float]]] = defaultdict(list)
        for a, b, k, c, when in edges:
            if when is None or when == date:
                if not k or not math.isfinite(k) or not math.isfinite(c):
                    raise ValueError(f"{a} to {b}: not invertible")
                back[b].append((a, k, c))
                back[a].append((b, 1 / k, -c / k))
        best: dict[str, tuple[float, float]] = {target: (1.0, 0.0)}
        queue = deque([target])
        while queue:
            u = queue.popleft()
            ku, cu = best[u]
            for a, k, c in back[u]:
                f = (ku * k, ku * c + cu)
                if a not in best:
                    best[a] = f
                    queue.append(a)
                elif not (math.isclose(best[a][0], f[0], rel_tol=tolerance) and math.isclose(best[a][1], f[1], rel_tol=tolerance, abs_tol=tolerance)):
                    raise ValueError(f"conversions of {a} to {target} disagree: {best[a]} and {f}")
        out += [(u, date, k, c) for u, (k, c) in best.items()]
    return out


def conversion_table(spark: SparkSession, edges: list[Edge], target: str) -> DataFrame:
    """(unit, on, factor, shift) of each unit's composition to ``target``; ``on`` is null for any date. At most MAX_EDGES x 2 rows."""
    return spark.createDataFrame(compositions(edges, target), "unit string, on string, factor double, shift double")


def convert_units(amounts: DataFrame, edges: list[Edge], target: str) -> DataFrame:
    """(src, row_id, field, unit, val, status) of ``amounts`` (src, row_id, field, amount, unit, at)."""
    conv = conversion_table(amounts.sparkSession, edges, target)
    dated = any(e[4] is not None for e in edges)
    a = amounts.select("src", "row_id", "field", F.col("amount").cast("double").alias("amount"), "unit", F.col("at").cast("string").alias("at")).where(F.col("amount").isNotNull())
    on = (a["unit"] == conv["unit"]) & (a["at"] == conv["on"]) if dated else a["unit"] == conv["unit"]
    # bounded as the table is
    j = a.join(F.broadcast(conv), on, "left")
    val = F.col("amount") * F.col("factor") + F.col("shift")
    return j.select("src", "row_id", "field", a["unit"], val.alias("val"), F.when(F.col("factor").isNull(), "no_path").otherwise("converted").alias("status"))


# The ways in which currencies and scales are written.
CURRENCY_WORDS = {
    "USD": r"usd|us\$|u\.?s\.? ?dollars?|us dollars?|\$",
    "EUR": r"eur|euros?|€",
    "GBP": r"gbp|british pounds?|pounds? sterling|pounds?|sterling|stg|£",
    "CAD": r"cad|canadian dollars?|cdn ?\$|c\$",
    "AUD": r"aud|australian dollars?|a\$",
    "SEK": r"sek|swedish kron[ao]r?",
    "NOK": r"nok|norwegian kroner?",
    "CHF": r"chf|swiss francs?|sfr",
}
SCALES = {
    1e3: r"['’]?000s?|thousands?|k",
    1e6: r"millions?|mn|mm|m",
    1e9: r"billions?|bn",
}
PENCE = ("pence", "GBp", "GBX", "GBx")

_CUR = "(" + "|".join(CURRENCY_WORDS.values()) + ")"
_SCALE = "(" + "|".join(SCALES.values()) + ")"
_FIELD = re.compile(rf"{_CUR} ?{_SCALE}?")
_LED = re.compile(rf"([tkm]) ?{_CUR}")
_STATED = [
    re.compile(p)
    for p in (
        rf"\bdrawn in {_CUR}$",
        rf"\({_CUR} denominated\)",
        rf"^{_CUR} tranche$",
        rf"[(\[]{_CUR},? (?:amounts )?(?:in )?{_SCALE}[)\]]",
        rf"^{_CUR} (?:in )?{_SCALE}; ",
        rf", {_CUR} in {_SCALE}$",
        rf"[(\[]{_CUR}[)\]]$",
    )
]
_NOTED = (
    (1e6, re.compile(r"million|\bmm\b|\bmn\b|\$ ?mm?\b")),
    (1e3, re.compile(r"thousand|\b0{3}s?\b|'000|\bk\b")),
    (1e9, re.compile(r"billion|\bbn\b")),
)


def _code(text: str | None) -> str | None:
    return next((k for k, w in CURRENCY_WORDS.items() if re.fullmatch(w, text)), None) if text else None


def _scale(text: str | None) -> float | None:
    return next((k for k, w in SCALES.items() if re.fullmatch(w, text)), None) if text else None


def read_currency_field(text: str) -> tuple[str | None, float | None]:
    """(currency, scale or None) of a field such as ``EUR``, ``€'000``, ``TSEK``, ``pence``."""
    s = " ".join(text.split())
    if s in PENCE or s.lower() == "pence":
        return "GBP", 0.01
    if m := _FIELD.fullmatch(s.lower()):
        return _code(m[1]), _scale(m[2])
    if m := _LED.fullmatch(s.lower()):
        return _code(m[2]), 1e6 if m[1] == "m" else 1e3
    return None, None


def read_description(text: str) -> tuple[str | None, float | None]:
    """(currency, scale) that a description states of its own amounts, else (None, None).

    A currency that is merely mentioned (a legacy note, a collateral) states nothing.
    """
    s = " ".join(text.lower().split())
    for p in _STATED:
        if m := p.search(s):
            return _code(m[1]), _scale(m[2]) if p.groups > 1 else None
    return None, None


def read_note(text: str) -> tuple[str | None, float | None]:
    """(None, scale) that a caption or note tells of a table's amounts; 1 where it tells no other."""
    s = " ".join(text.lower().split())
    return None, next((k for k, p in _NOTED if p.search(s)), 1.0)


def _reader(read: Callable) -> Callable:
    @F.pandas_udf(T.StructType([T.StructField("cur", T.StringType()), T.StructField("scale", T.DoubleType())]))
    def each(texts: pd.Series) -> pd.DataFrame:
        at, known = pd.factorize(texts)  # -1 where there is none: the last
        cur, scale = zip(*[read(t) for t in known], (None, None))
        return pd.DataFrame({"cur": np.array(cur, object)[at], "scale": np.array(scale, float)[at]})

    return each


#: Pandas UDFs: each distinct text of a batch is read once.
ccy_field, described_currency, noted_scale = map(_reader, (read_currency_field, read_description, read_note))

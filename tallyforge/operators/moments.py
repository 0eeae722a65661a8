"""Dates, months and moments in mixed formats and zones to one normal form (problem 3).

Texts are parsed, in Arrow batches and each distinct text of a batch once, into a date or
month, or into a local time with a zone (as built-in expressions the grammar outgrows the
JVM's method size, and with it whole-stage code generation). A zone is an offset, a fixed
abbreviation, or a zone name of the tz database, by whose rules the parser settles the local
time where it is read, so that no row meets a table of zones: two offsets under which the
zone's clocks show it mean an ambiguous time, none a nonexistent one, one gives the moment.

Defined results: null, blank and other texts, and impossible dates, give no row; an
ambiguous or nonexistent local time gives a row with that ``status`` and no value, a local
time without a zone or home zone one with status ``moment`` and no value, in any
year from 1 to 9999; texts of any length are read whole.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

YEARS = (1970, 2100)

# Hours from UTC of zone abbreviations.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "west": 1, "bst": 1, "cet": 1, "cest": 2, "eet": 2,
    "eest": 3, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7,
    "jst": 9, "aest": 10, "aedt": 11,
}
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")

_TIME = re.compile(
    r"(?:t|,?\s+|(?<=\d),)(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?\s*([ap]\.m\.|[ap]m\b)?"
    r"\s*(z|(?:utc|gmt)?[+-]\d{2}:?\d{2}|[a-z]{1,5}|[a-z]+(?:/[a-z_+\-0-9]+)+)?$",
    re.I,
)
_COMPACT = re.compile(r"(\d{4})(\d{2})(\d{2})[t ]?(\d{2})(\d{2})(\d{2})(z?)", re.I)
_WEEKDAY = re.compile(r"^(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?\.?,?\s+")
_ORDINAL = re.compile(r"(?<=\d)(?:st|nd|rd|th)\b")
_MONTH_AT = {m[:n]: i for i, m in enumerate(MONTHS, 1) for n in range(3, len(m) + 1)} | {"sept": 9}
_YMD = re.compile(r"(\d{4})([-/. ])(\d{1,2})\2(\d{1,2})")
_XXY = re.compile(r"(\d{1,2})([-/. ])(\d{1,2})\2(\d{4}|\d{2})")
_NAME_D_Y = re.compile(r"([a-z]+)[-. ,]+(\d{1,2})[-. ,]+(\d{4})")
_D_NAME_Y = re.compile(r"(\d{1,2})[-. ,]+([a-z]+)[-. ,]+(\d{4}|\d{2})")
_Y_NAME_D = re.compile(r"(\d{4})[-. ,]+([a-z]+)[-. ,]+(\d{1,2})")
_Y_M = re.compile(r"(\d{4})[-/. ](\d{1,2})")
_M_Y = re.compile(r"(\d{1,2})[-/. ](\d{4}|\d{2})")
_NAME_Y = re.compile(r"([a-z]+)[-. ,']+(\d{4}|\d{2})")
_Y_NAME = re.compile(r"(\d{4})[-. ,]+([a-z]+)\.?")

Parsed = tuple[str | None, str | None, int | None, int | None, str | None]  # date, month, local, offset, zone
_NOTHING: Parsed = (None, None, None, None, None)
_EPOCH = dt.datetime(1970, 1, 1)


def _year(text: str) -> int:
    return int(text) + 2000 * (len(text) == 2)


def _date(y: int, m: int | None, d: int) -> dt.date | None:
    try:
        return dt.date(y, m or 0, d)
    except ValueError:
        return None


def _as_date(s: str, day_first: bool) -> dt.date | None:
    if m := _YMD.fullmatch(s):
        return _date(int(m[1]), int(m[3]), int(m[4]))
    if len(s) == 8 and s.isdecimal():
        return _date(int(s[:4]), int(s[4:6]), int(s[6:]))
    if m := _XXY.fullmatch(s):
        y, a, b = _year(m[4]), int(m[1]), int(m[3])
        return (_date(y, b, a) or _date(y, a, b)) if day_first else (_date(y, a, b) or _date(y, b, a))
    if m := _NAME_D_Y.fullmatch(s):
        return _date(_year(m[3]), _MONTH_AT.get(m[1]), int(m[2]))
    if m := _D_NAME_Y.fullmatch(s):
        return _date(_year(m[3]), _MONTH_AT.get(m[2]), int(m[1]))
    if m := _Y_NAME_D.fullmatch(s):
        return _date(int(m[1]), _MONTH_AT.get(m[2]), int(m[3]))
    return None


def _as_month(s: str) -> str | None:
    y = m = None
    if x := _Y_M.fullmatch(s):
        y, m = int(x[1]), int(x[2])
    elif x := _M_Y.fullmatch(s):
        y, m = _year(x[2]), int(x[1])
        if m > 12 and len(x[1]) == 2 and len(x[2]) == 2:
            y, m = _year(x[1]), int(x[2])
    elif x := _NAME_Y.fullmatch(s):
        y, m = _year(x[2]), _MONTH_AT.get(x[1])
    elif x := _Y_NAME.fullmatch(s):
        y, m = int(x[1]), _MONTH_AT.get(x[2])
    return f"{y:04d}-{m:02d}" if y and m and 1 <= m <= 12 else None


def parse_moment(text: str, day_first: bool) -> Parsed:
    """What ``text`` states: a date, a month, or local seconds with an offset or a zone's name."""
    return _parse(re.sub(r"\s+", " ", text.strip().strip("\u200b\ufeff")).strip(), day_first)


def _parse(s: str, day_first: bool) -> Parsed:
    if not s:
        return _NOTHING
    if len(s) == 10 and s[4] == s[7] == "-" and s.isascii():
        # most texts; what is no date in this form is none in another
        try:
            return dt.date.fromisoformat(s).isoformat(), None, None, None, None
        except ValueError:
            return _NOTHING
    if s.isdecimal() and s.isascii() and len(s) in (10, 13):
        return None, None, int(s[:10]), 0, None
    if m := _COMPACT.fullmatch(s):
        s = f"{m[1]}-{m[2]}-{m[3]}T{m[4]}:{m[5]}:{m[6]}{m[7]}"
    t = _TIME.search(s) if ":" in s else None
    d = _ORDINAL.sub("", _WEEKDAY.sub("", (s[: t.start()] if t else s).lower()))
    date = _as_date(d, day_first)
    if not t:
        return (date.isoformat(), None, None, None, None) if date else (None, _as_month(d), None, None, None)
    if not date:
        return _NOTHING
    h, mi, sec = int(t[1]), int(t[2]), int(t[3] or 0)
    if t[4]:
        if not 1 <= h <= 12:
            return _NOTHING
        h = h % 12 + 12 * (t[4][0] in "pP")
    if h > 23 or mi > 59 or sec > 59:
        return _NOTHING
    local = (date - dt.date(1970, 1, 1)).days * 86400 + h * 3600 + mi * 60 + sec
    zone = t[5] or ""
    if m := re.search(r"([+-])(\d{2}):?(\d{2})$", zone):
        return None, None, local, (-1 if m[1] == "-" else 1) * (int(m[2]) * 3600 + int(m[3]) * 60), None
    if zone.lower() in ABBREVIATIONS:
        return None, None, local, ABBREVIATIONS[zone.lower()] * 3600, None
    return None, None, local, None, zone


def offsets_at(local: int, zone: str) -> list[int]:
    """The offsets under which a zone's clocks show ``local``: none, one, or two."""
    from zoneinfo import ZoneInfo

    try:
        z = ZoneInfo(zone)
        at = _EPOCH + dt.timedelta(seconds=local)
        late = at.replace(tzinfo=z, fold=1).utcoffset()
        if at.replace(tzinfo=z).utcoffset() == late and _FIRST <= local < _LAST:
            return [int(late.total_seconds())]  # most times: the clocks are not set about then
        out = set()
        for fold in (0, 1):
            off = at.replace(tzinfo=z, fold=fold).utcoffset()
            back = (at - off).replace(tzinfo=dt.timezone.utc).astimezone(z)
            if back.replace(tzinfo=None, fold=0) == at:
                out.add(int(off.total_seconds()))
        return sorted(out)
    except Exception:  # no such zone, or the edge of the calendar
        return []


_FIRST, _LAST = (int((dt.datetime(y, 1, 1) - _EPOCH).total_seconds()) for y in (YEARS[0], YEARS[1] + 1))


def _resolved(text: str, day_first: bool, home_zone: str | None) -> tuple:
    """(val, status, local, offset): what the text states; a moment's value is its local seconds less the offset."""
    date, month, local, offset, zone = parse_moment(text, day_first)
    if local is None:
        return date or month, "date" if date else "month" if month else None, None, None
    zone = zone or home_zone
    if offset is not None or not zone and _FIRST <= local < _LAST:
        return None, "moment", local, offset  # or no zone to tell it in
    hits = offsets_at(local, zone or "")
    return None, ("nonexistent", "moment", "ambiguous")[len(hits)], local, hits[0] if len(hits) == 1 else None


@lru_cache(200_000)
def _kept(text: str, day_first: bool, home_zone: str | None) -> tuple:
    return _resolved(text, day_first, home_zone)


@F.pandas_udf(T.StructType([T.StructField(c, T.StringType()) for c in ("val", "status")] + [T.StructField(c, T.LongType()) for c in ("local", "offset")]))
def _parsed(text: pd.Series, day_first: pd.Series, home_zone: pd.Series) -> pd.DataFrame:
    n = len(text)
    val, status = [None] * n, [None] * n
    # few texts are moments, so numbers are set where they occur
    number = np.full((2, n), np.nan)
    for k, (t, d, z) in enumerate(zip(text, day_first, home_zone)):
        if isinstance(t, str):
            val[k], status[k], local, offset = (_kept if len(t) <= 100 else _resolved)(t, bool(d), z)
            if local is not None:
                number[0, k] = local
                if offset is not None:
                    number[1, k] = offset
    return pd.DataFrame({"val": val, "status": status, "local": number[0], "offset": number[1]})


def zone_intervals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(zone, year, lo, hi, off): local seconds [lo, hi) of each constant offset, by local year; what ``offsets_at`` is held against."""
    from zoneinfo import ZoneInfo

    utc = dt.timezone.utc
    epoch = dt.datetime(1970, 1, 1, tzinfo=utc)
    for pdf in batches:
        rows = []
        for name in pdf["zone"]:
            try:
                z = ZoneInfo(name)
            except Exception:  # no such zone: its moments have no interval
                continue

            def off(s: int) -> int:
                return int((epoch + dt.timedelta(seconds=s)).astimezone(z).utcoffset().total_seconds())

            start = int((dt.datetime(YEARS[0], 1, 1, tzinfo=utc) - epoch).total_seconds()) - 86400
            end = int((dt.datetime(YEARS[1] + 1, 1, 1, tzinfo=utc) - epoch).total_seconds()) + 86400
            cuts, at, step = [start], start, 7 * 86400
            while at < end:
                a, b = at, min(end, at + step)
                if off(a) != off(b):
                    while b - a > 1:
                        m = (a + b) // 2
                        a, b = (m, b) if off(m) == off(a) else (a, m)
                    cuts.append(b)
                    at = b
                else:
                    at = b
            cuts.append(end)
            for a, b in zip(cuts, cuts[1:]):
                o = off(a)
                lo, hi = a + o, b + o
                for y in range((epoch + dt.timedelta(seconds=lo)).year, (epoch + dt.timedelta(seconds=hi - 1)).year + 1):
                    rows.append((name, y, lo, hi, o))
        yield pd.DataFrame(rows, columns=["zone", "year", "lo", "hi", "off"])


def with_moments(df: DataFrame, texts: list[str], day_first: str, home_zone: str) -> DataFrame:
    """``df`` with a struct (val, status) beside each column of ``texts``, named ``<column>_at``.

    It is null where the text states no date, month or moment.
    """
    out = df.withColumns({f"_p_{c}": _parsed(F.col(c), F.col(day_first), F.col(home_zone)) for c in texts})

    def told(c: str) -> Column:
        p = F.col(f"_p_{c}")
        moment = F.date_format(F.timestamp_seconds(p["local"] - p["offset"]), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        return F.when(p["status"].isNotNull(), F.struct(F.coalesce(p["val"], moment).alias("val"), p["status"].alias("status")))

    return out.withColumns({f"{c}_at": told(c) for c in texts}).drop(*[f"_p_{c}" for c in texts])


def normalise_moments(values: DataFrame) -> DataFrame:
    """(src, row_id, field, text, val, status) of ``values`` (src, row_id, field, text, day_first, home_zone).

    ``status`` is ``date``, ``month``, ``moment``, ``ambiguous`` or ``nonexistent``.
    """
    v = values.select("src", "row_id", "field", "text", "day_first", "home_zone").where(F.col("text").isNotNull())
    m = with_moments(v, ["text"], "day_first", "home_zone").where(F.col("text_at").isNotNull())
    return m.select("src", "row_id", "field", "text", "text_at.val", "text_at.status")

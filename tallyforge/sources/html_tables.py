"""Schedules of investments in HTML tables, walked row by row.

A document is sequential (sections, carried issuers, headers that change), so documents are
walked in parallel and each within one task, by a generator over Arrow batches. Cells are
matched to fields by the columns they span. A schedule may be told to begin after a heading
(``anchor``) and to stop at another (``end``); headers of several rows are put together; a table
without fair values takes its last column of costs for them; section rows set affiliation, type
or sector; text between tables that names a known sector sets it.

Defined results: a null or empty document, or one without a table that has an issuer and an
amount, gives no row; malformed markup is read as far as it closes; a document without the
anchor gives no row; par and cost of zero are null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

# Words of header labels and the fields they head.
LABELS = (
    ("company", r"portfolio company|company|issuer|investment name|borrower"),
    ("business_description", r"business description"),
    ("sector", r"industry|sector"),
    ("investment_type", r"investment type|type of investment|instrument|^investment"),
    ("spread", r"spread"),
    ("interest_rate", r"interest rate|coupon|^rate"),
    ("acquisition_date", r"acquisition date|initial date"),
    ("maturity_date", r"maturity"),
    ("shares_units", r"shares|units"),
    ("principal", r"principal|par"),
    ("cost", r"cost"),
    ("fair_value", r"fair value"),
    ("pct_net_assets", r"% of net assets|percentage of net assets"),
    ("footnotes", r"footnotes|notes"),
)
AMOUNTS = ("principal", "cost", "fair_value", "shares_units", "pct_net_assets", "spread", "interest_rate")
TEXTS = ("business_description", "investment_type", "acquisition_date", "maturity_date", "footnotes")
SCHEMA = "source string, ord int, issuer string, sector string, affiliation string, " + ", ".join(f"{c} string" for c in TEXTS) + ", " + ", ".join(f"{c} double" for c in AMOUNTS)

Cell = tuple[int, int, str]  # first column, columns spanned, text


class _Tables(HTMLParser):
    """Rows of cells of every table, in order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[Cell]]] = []
        self._row: list[Cell] | None = None
        self._text: list[str] | None = None
        self._span = 1
        self.prose: dict[int, str] = {}  # the text before each table

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self._end_row()
            self._row = []
        elif tag in ("td", "th") and self._row is not None:
            self._end_cell()
            span = dict(attrs).get("colspan") or "1"
            self._span = int(span) if span.isdecimal() and 0 < int(span) < 1000 else 1
            self._text = []

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th"):
            self._end_cell()
        elif tag in ("tr", "table"):
            self._end_row()

    def handle_data(self, data: str) -> None:
        if self._text is not None:
            self._text.append(data)
        else:
            self.prose[len(self.tables)] = self.prose.get(len(self.tables), "") + " " + data

    def _end_cell(self) -> None:
        if self._text is not None and self._row is not None:
            at = self._row[-1][0] + self._row[-1][1] if self._row else 0
            self._row.append((at, self._span, " ".join("".join(self._text).split())))
        self._text = None

    def _end_row(self) -> None:
        self._end_cell()
        if self._row and self.tables:
            self.tables[-1].append(self._row)
        self._row = None


def amount(text: str) -> float | None:
    """A number from a cell; parentheses are negative, dashes none."""
    s = re.sub(r"[$,%\s ]", "", text)
    negative = s.startswith("(") and s.endswith(")")
    try:
        v = float(s.strip("()"))
    except ValueError:
        return None
    return None if v != v else -v if negative else v


def _field(label: str) -> str | None:
    low = label.lower()
    return next((f for f, p in LABELS if re.search(p, low)), None)


def _header(row: list[Cell]) -> dict[tuple[int, int], str]:
    found = {(at, at + span): f for at, span, text in row if text and len(text) < 60 and (f := _field(text))}
    return found if len(set(found.values())) >= 2 else {}


#: Rows of one header, and rows that are none after which it ends.
MOST_HEADER_ROWS, HEADER_GAP = 6, 2
_AFFILIATION = re.compile(r"(?i)\b(?:non-?)?(?:controlled|affiliated?)\b|\baffiliates?\b")
_KIND = re.compile(r"(?i)^(?:(?:first|second|1st|2nd)[ -]lien|senior secured|subordinated|unsecured|preferred|common|equity|warrants?|debt)\b[^,]*$")


def _names_positions(fields: dict[tuple[int, int], str]) -> bool:
    return "company" in fields.values() and bool({"fair_value", "cost", "principal"} & set(fields.values()))


def merged_header(rows: list[list[Cell]]) -> tuple[dict[tuple[int, int], str], int]:
    """(fields, header rows): the fields of a table's first rows put together, a column's first label counting; costs stand in for fair values."""
    out: dict[tuple[int, int], str] = {}
    gap = used = 0
    for k, row in enumerate(rows[:MOST_HEADER_ROWS], 1):
        found = {(at, at + span): f for at, span, text in row if text and len(text) < 60 and amount(text) is None and (f := _field(text))}
        if not found or any(amount(t) is not None for _, _, t in row if t):
            gap += 1
            if gap >= HEADER_GAP:
                break
            continue
        used = k
        for (lo, hi), f in found.items():
            if not any(lo < b and hi > a for a, b in out):
                out[lo, hi] = f
    return _with_fair_value(out), used


def _with_fair_value(fields: dict[tuple[int, int], str]) -> dict[tuple[int, int], str]:
    costs = sorted(k for k, f in fields.items() if f == "cost")
    return fields | {costs[-1]: "fair_value"} if "fair_value" not in fields.values() and len(costs) > 1 else fields


def _region(parser: _Tables, anchor: str | None, end: str | None) -> range:
    """The tables of the schedule: from the first that names positions after a match of ``anchor`` to ``end``."""
    n = len(parser.tables)
    seen = anchor is None
    first = None
    for k in range(n):
        seen = seen or bool(re.search(anchor or "", parser.prose.get(k, "")))
        if seen and _names_positions(merged_header(parser.tables[k])[0]):
            first = k
            break
    if first is None:
        return range(0) if anchor else range(n)
    last = next((k for k in range(first + 1, n) if end and re.search(end, parser.prose.get(k, ""))), n)
    return range(first, last)


def walk(html: str, scale: float = 1.0, anchor: str | None = None, end: str | None = None, sectors: tuple[str, ...] = ()) -> Iterator[dict]:
    """The positions of one document: section rows set affiliation, type or sector, blank issuers carry on."""
    parser = _Tables()
    parser.feed(html)
    parser.close()
    fields: dict[tuple[int, int], str] = {}
    issuer = sector = affiliation = kind = None
    for k in _region(parser, anchor, end):
        rows = parser.tables[k]
        prose = parser.prose.get(k, "").lower()
        sector = next((s for s in sorted(sectors, key=len, reverse=True) if s.lower() in prose), sector)
        top, used = merged_header(rows)
        if _names_positions(top):
            fields, rows = top, rows[used:]
        for row in rows:
            texts = [t for _, _, t in row if t]
            if not texts:
                continue
            numbers = [t for t in texts if amount(t) is not None]
            if (head := _header(row)) and not numbers:
                if _names_positions(head):
                    fields = _with_fair_value(head)
                continue
            if not _names_positions(fields):
                continue
            if len(texts) <= 2 and not numbers and re.search(r"[A-Za-z]", texts[0]):
                if _AFFILIATION.search(texts[0]):
                    affiliation = texts[0]
                elif _KIND.match(texts[0]):
                    kind = texts[0]
                else:
                    sector = texts[0]
                issuer = None
                continue
            got: dict[str, list[str]] = {}
            for at, span, text in row:
                hit = next((f for (lo, hi), f in fields.items() if at < hi and at + span > lo), None)
                if hit and text and text not in ("$", "%", ")"):
                    got.setdefault(hit, []).append(text)
            name = " ".join(got.get("company", []))
            if re.match(r"(?i)(sub)?total", name):
                continue
            issuer = name or issuer
            values = {c: amount(" ".join(got[c])) if c in got else None for c in AMOUNTS}
            for c in ("principal", "cost", "fair_value"):
                values[c] = values[c] * scale if values[c] is not None else None
            for c in ("principal", "cost"):
                values[c] = values[c] or None
            if issuer and (values["fair_value"] is not None or values["cost"] is not None):
                told = {c: " ".join(got[c]) if c in got else None for c in TEXTS}
                told["investment_type"] = told["investment_type"] or kind
                yield {"issuer": issuer, "sector": " ".join(got.get("sector", [])) or sector, "affiliation": affiliation, **told, **values}


def read_html_positions(documents: DataFrame, scale: float = 1.0, anchor: str | None = None, end: str | None = None, sectors: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``documents`` (source, html)."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = [c.split()[0] for c in SCHEMA.split(", ")]
        for pdf in batches:
            out = [{"source": s, "ord": k, **r} for s, h in zip(pdf["source"], pdf["html"]) if isinstance(h, str) for k, r in enumerate(walk(h, scale, anchor, end, sectors))]
            yield pd.DataFrame(out, columns=cols)

    return documents.select("source", "html").mapInPandas(rows, SCHEMA)

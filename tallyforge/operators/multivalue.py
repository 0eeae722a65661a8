"""Several values packed in one field (problem 1).

Every field is cut into tokens (separators, quotes, brackets, ordinary runs); masking the
ordinary ones leaves the field's *delimiter skeleton*, one character a token. Far fewer
skeletons than fields exist, so the splitting rule, which token spans are values, is worked
out once for each distinct skeleton, and applied to the fields by position, in the JVM.

Defined results: a null, blank or separator-only field gives no row; a field of one value
gives one row (``min_values=1``) or none; empty pieces between separators are no values and
take no position; equal values and repeated rows count each; an unclosed quote is an
ordinary character; texts of any length are split whole; columns other than those named are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.text import outer_trim
from tallyforge.session import broadcast_within, checkpointed

# Legal forms before which a comma never separates.
LEGAL_FORM = (
    r"(?:incorporated|inc|l\. ?l\. ?c|llc|l\. ?p|lp|limited|ltd|corporation|corp|company|co"
    r"|l\. ?l\. ?p|llp|plc|holdings?|hldgs?|hldg|holdco)"
)
BLANK = r"[  ]"
#: Rules are broadcast up to so many skeletons, joined by a shuffle beyond.
MAX_BROADCAST_SKELETONS = 200_000

# A comma with the legal form behind it is one ordinary token.
_LEGAL_TOKEN = rf",{BLANK}*(?i:{LEGAL_FORM})(?![\p{{L}}\p{{N}}])(?!{BLANK}+(?i:interests?|units?|shares?|stakes?)\b)\.?"
_SPACED = rf"{BLANK}+[-–—/I](?={BLANK})"
_TOKENS = {
    "list": rf'""|"|{_LEGAL_TOKEN}|{_SPACED}|[|;\t•\n\r,()]|(?:(?!{_SPACED})[^|;\t•\n\r",()])+',
    "marks": r'""|"|\*+|†+|‡+|#+|§+|¶+|\^+|~+|[\p{L}\p{N}]+(?:[.\'’][\p{L}\p{N}]+)*|[^\p{L}\p{N}"*†‡#§¶^~]+',
}


def _mask(kind: str, token: Column) -> Column:
    """The skeleton's character for one token."""
    quote = F.when(token == '""', F.lit("Q")).when(token == '"', F.lit("q"))
    if kind == "list":
        return (
            quote.when(token.isin("|", ";", "\t", "•", "\n", "\r"), F.lit("s"))
            .when(token.rlike(rf"^{BLANK}+[-–—/I]$"), F.lit("s"))
            .when(token.isin(",", "(", ")"), token)
            .when(token.rlike(r"(?U)^\s+$"), F.lit("_"))
            .otherwise(F.lit("w"))
        )
    return (
        quote.when(F.lower(token).isin("and", "und", "et", "or", "y"), F.lit("_"))
        .when(token.rlike(r"^[\p{L}\p{N}*†‡#§¶^~]"), F.lit("w"))
        .otherwise(F.lit("_"))
    )


def _quoted_end(skeleton: str, at: int) -> int:
    """Index of the quote that closes the one at ``at``; -1 if none does."""
    return skeleton.find("q", at + 1)


def _list_spans(s: str) -> list[tuple[int, int]]:
    """Spans of values in a skeleton of separated values."""
    pieces: list[list[tuple[int, str]]] = []

    def cut(separator: str) -> None:
        pieces.clear()
        piece: list[tuple[int, str]] = []
        i, depth = 0, 0
        while i < len(s):
            ch = s[i]
            if ch == "q" and not [c for _, c in piece if c != "_"] and (end := _quoted_end(s, i)) > 0:
                piece += [(k, "x") for k in range(i, end + 1)]
                i = end + 1
                continue
            depth = max(0, depth + (ch == "(") - (ch == ")"))
            if ch == separator and (ch == "s" or not depth):
                pieces.append(piece)
                piece = []
            else:
                piece.append((i, ch))
            i += 1
        pieces.append(piece)

    cut("s")
    if len(pieces) < 2:
        cut(",")
    return [(p[0][0], p[-1][0]) for p in pieces if any(c != "_" for _, c in p)]


def _mark_spans(s: str) -> list[tuple[int, int]]:
    """Spans of values in a skeleton of note marks."""
    out, i = [], 0
    while i < len(s):
        if s[i] == "q" and (end := _quoted_end(s, i)) > 0:
            if end > i + 1:
                out.append((i, end))
            i = end + 1
        else:
            if s[i] == "w":
                out.append((i, i))
            i += 1
    return out


def resolve_rules(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The value spans of each skeleton: runs once a distinct skeleton."""
    for pdf in batches:
        spans = [(_list_spans if k == "list" else _mark_spans)(s) for k, s in zip(pdf["kind"], pdf["skeleton"])]
        yield pd.DataFrame(
            {
                "kind": pdf["kind"],
                "skeleton": pdf["skeleton"],
                "spans": [[{"a": a + 1, "n": b - a + 1} for a, b in x] for x in spans],
            }
        )


def split_packed(fields: DataFrame, min_values: int = 1) -> DataFrame:
    """Rows (src, row_id, pos, val) of ``fields`` (src, row_id, kind, field).

    ``kind`` is ``list`` (values between separators) or ``marks`` (note marks).
    """
    f = fields.select("src", "row_id", "kind", "field").where(F.col("field").isNotNull())
    tokens = F.when(F.col("kind") == "list", F.regexp_extract_all("field", F.lit(_TOKENS["list"]), F.lit(0))).otherwise(
        F.regexp_extract_all("field", F.lit(_TOKENS["marks"]), F.lit(0))
    )
    t = f.select("src", "row_id", "kind", tokens.alias("tokens"))
    skeleton = F.array_join(
        F.when(F.col("kind") == "list", F.transform("tokens", lambda x: _mask("list", x))).otherwise(
            F.transform("tokens", lambda x: _mask("marks", x))
        ),
        "",
    )
    t = t.withColumn("skeleton", skeleton)
    rules = checkpointed(
        t.select("kind", "skeleton")
        .distinct()
        .mapInPandas(resolve_rules, "kind string, skeleton string, spans array<struct<a:int,n:int>>")
    )
    cut = F.transform(
        "spans", lambda s: outer_trim(F.array_join(F.slice(F.col("tokens"), s["a"], s["n"]), ""))
    )
    plain = F.transform(
        cut,
        lambda v: F.when(
            v.rlike(r'(?s)^".*"$') & (F.length(v) > 1),
            outer_trim(F.regexp_replace(F.substring(v, F.lit(2), F.length(v) - 2), '""', '"')),
        ).otherwise(v),
    )
    values = F.filter(plain, lambda v: v != "")
    return (
        t.join(broadcast_within(rules, MAX_BROADCAST_SKELETONS), ["kind", "skeleton"])
        .where(F.size("spans") >= min_values)
        .select("src", "row_id", values.alias("vals"))
        .where(F.size("vals") >= min_values)
        .select("src", "row_id", F.posexplode("vals").alias("p", "val"))
        .select("src", "row_id", (F.col("p") + 1).cast("int").alias("pos"), "val")
    )

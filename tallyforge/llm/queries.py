"""The queries of the problems tagged llm over the project's tables."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.text import is_missing
from tallyforge.llm.canon import closest_entries
from tallyforge.llm.leaks import leaked_items, scored_items
from tallyforge.llm.linkage import Rules, link_records
from tallyforge.llm.mixing import mix_sources
from tallyforge.llm.names import entity_classes, variant_pairs
from tallyforge.llm.spans import shared_words
from tallyforge.operators.moments import with_moments
from tallyforge.operators.units import conversion_table
from tallyforge.plans.general_queries import html_units, locales, position_units, unit_edges
from tallyforge.session import broadcast_within, checkpointed, spread, stored, table

#: Entries of a reference list that the driver reads to build the trees.
MAX_ENTRIES = 100_000

LABELLED = (
    ("soi_position", "pos_id", "sector", "sector"),
    ("soi_position", "pos_id", "type", "type"),
    ("html_row", "row_id", "sector", "sector"),
    ("html_row", "row_id", "investment_type", "type"),
)


def label_entries(spark: SparkSession, sf_dir: str) -> list[tuple[int, str, str, str | None]]:
    """The entries (id, kind, label, note) of canon_label, a fixed table of 42 rows."""
    rows = table(spark, sf_dir, "canon_label").limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"canon_label has more than {MAX_ENTRIES} rows")
    return [(r.label_id, r.kind, r.label, r.note) for r in rows]


def _wordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for src, key, field, kind in LABELLED:
        t = table(spark, sf_dir, src).select(
            F.lit(src).alias("src"), F.col(key).alias("row_id"), F.lit(field).alias("field"), F.lit(kind).alias("kind"), F.col(field).alias("text")
        )
        t = t.where(~is_missing(F.col("text")))
        out = t if out is None else out.unionByName(t)
    return out


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canon_label entry that each free wording means; 0 where none fits."""
    label = table(spark, sf_dir, "canon_label").select("kind", F.col("label").alias("text"))
    w = _wordings(spark, sf_dir).join(F.broadcast(label), ["kind", "text"], "left_anti")
    m = closest_entries(w, label_entries(spark, sf_dir))
    return w.join(m, ["kind", "text"]).select("src", "row_id", "field", F.col("entry").alias("label_id"))


def p4_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wordings that mean no entry, with the rows that use them."""
    w = _wordings(spark, sf_dir)
    m = closest_entries(w, label_entries(spark, sf_dir)).where("entry = 0")
    n = w.groupBy("kind", "text").agg(F.count("*").alias("n"))
    return n.join(m, ["kind", "text"]).select("kind", "text", "n")


def borrower_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, own, line, numeral, how, rarity) of every borrower name in the two books."""
    # as many rows as spellings meet, read for the names and for what rows state
    soi = checkpointed(table(spark, sf_dir, "soi_position").groupBy("entity", "company").agg(F.count("*").alias("n")))
    html = table(spark, sf_dir, "html_row").groupBy("issuer").agg(F.count("*").alias("n"))
    names = soi.select(F.col("entity").alias("name"), "n").unionByName(soi.select(F.col("company").alias("name"), "n")).unionByName(html.select(F.col("issuer").alias("name"), "n"))
    names = names.where(F.col("name").isNotNull()).groupBy("name").agg(F.sum("n").alias("n"))
    both = soi.where(F.col("entity").isNotNull() & F.col("company").isNotNull() & (F.col("entity") != F.col("company")))
    uses = both.select(F.col("entity").alias("name"), F.col("company").alias("other")).unionByName(both.select(F.col("company").alias("name"), F.col("entity").alias("other")))
    return entity_classes(names, uses)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of different spellings that name one borrower."""
    return variant_pairs(borrower_classes(spark, sf_dir))


def p6_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling with its borrower, how it was linked, and the rarity of the rewriting."""
    c = borrower_classes(spark, sf_dir)
    return c.select("name", F.concat_ws("|", "own", "line", F.col("numeral").cast("string")).alias("borrower"), "how", "rarity")


HOLDING_RULES = Rules(
    exact={"label": (1.0, 5.0), "spread": (1.5, 5.0), "rate": (1.0, 5.0), "base": (0.5, 5.0), "pik": (0.5, 2.0), "shares": (3.0, 5.0)},
    prefix={"acq": (2.5, 5.0), "maturity": (2.0, 5.0)},
    overlap={"who": (0.0, 6.0)},
    same=("label", "acq_month"),
)
#: A record's tolerance: a share of its amount, and for positions a dollar.
AMOUNT_SHARE, AMOUNT_LEAST = 0.009, 1.0
#: Spelling classes are broadcast up to so many names, joined by a shuffle beyond.
MAX_BROADCAST_NAMES = 300_000


def size_bin(amount: Column) -> Column:
    """The bin of 4 % in which an amount lies; bins rise with amounts, 0 has those below a dollar."""
    size = F.floor(F.log(F.abs(amount)) / F.log(F.lit(1.04))) + 1
    return F.when(F.abs(amount) < 1, F.lit(0)).otherwise(F.signum(amount) * size).cast("bigint")


def size_reach(amount: Column, tol: Column) -> tuple[Column, Column]:
    """The first and last bin with an amount of a position that is within the tolerances of both records."""
    # the edges solve |x - amount| = tol + share * |x| + least for x; a little wider for rounding
    reach = (tol + AMOUNT_LEAST) * (1 + 1e-9) + 1e-9 * F.abs(amount)
    low, high = amount - reach, amount + reach
    low = F.when(low >= 0, low / (1 + AMOUNT_SHARE)).otherwise(low / (1 - AMOUNT_SHARE))
    high = F.when(high >= 0, high / (1 - AMOUNT_SHARE)).otherwise(high / (1 + AMOUNT_SHARE))
    return size_bin(low), size_bin(high)


def size_probes(amount: Column, tol: Column) -> Column:
    """Every bin from the first to the last of ``size_reach``."""
    return F.sequence(*size_reach(amount, tol))


def holdings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The positions and the HTML rows as records for linkage.

    What a row says in its own words (names, labels, dates, amounts) is worked out once a
    distinct name or wording, or in passing; each book is read once and not shuffled.
    """
    names = borrower_classes(spark, sf_dir).groupBy("name").agg(F.collect_set(F.xxhash64("own", "line", "numeral")).alias("who"))
    names = broadcast_within(stored(names), MAX_BROADCAST_NAMES)
    w = None
    for src, c in (("soi_position", "type"), ("html_row", "investment_type")):
        t = table(spark, sf_dir, src).select(F.lit("type").alias("kind"), F.col(c).alias("text")).distinct()
        w = t if w is None else w.unionByName(t)
    w = w.where(~is_missing(F.col("text")))  # looked at once a wording
    label = table(spark, sf_dir, "canon_label").where("kind = 'type'").select(F.col("label").alias("text"), F.col("label_id").alias("exact"))
    meant = closest_entries(w, label_entries(spark, sf_dir)).join(F.broadcast(label), "text", "left").select("text", F.coalesce("exact", "entry").alias("label"))
    meant = broadcast_within(stored(meant.where("label > 0")), MAX_BROADCAST_NAMES)
    conv = F.broadcast(conversion_table(spark, unit_edges(spark, sf_dir), "USD*1"))  # bounded by units.MAX_EDGES
    place = F.broadcast(locales(spark, sf_dir))  # 20 rows

    def book(rows: DataFrame, names_of: tuple[str, ...], acquired: str, matures: str) -> DataFrame:
        r = rows.join(place, "bdc", "left").withColumn("day_first", F.coalesce("day_first", F.lit(False)))
        r = with_moments(r, [acquired, matures], "day_first", "home_zone")
        at = F.col("period_end").cast("string")
        r = r.join(conv.withColumnsRenamed({"unit": "_unit"}), (F.col("unit") == F.col("_unit")) & (at == F.col("on")), "left")
        r = r.join(meant, "text", "left")
        none = F.array().cast("array<bigint>")
        who = none
        for k, c in enumerate(names_of):
            r = r.join(names.select(F.col("name").alias(f"_n{k}"), F.col("who").alias(f"_w{k}")), F.col(c) == F.col(f"_n{k}"), "left")
            who = F.array_union(who, F.coalesce(f"_w{k}", none))
        day = lambda c: F.substring(F.col(f"{c}_at.val"), 1, 10)
        return r.select(
            "src", "row_id", "bdc", "period_end", who.alias("who"), "label", "spread", "rate", F.when(F.col("base").isNotNull(), F.xxhash64("base")).alias("base"), "pik", "shares",
            (F.col("stated") * F.col("factor") + F.col("shift")).alias("amount"), F.when(F.col("src") == "html_row", F.col("stated")).alias("stated"),
            F.element_at(F.split("unit", r"\*"), 2).cast("double").alias("scale"), day(acquired).alias("acq"), day(matures).alias("maturity"),
        )

    soi = table(spark, sf_dir, "soi_position").select(
        F.lit("soi_position").alias("src"), F.col("pos_id").alias("row_id"), "bdc", "period_end", "entity", "company", F.col("type").alias("text"), "spread", "rate", F.col("base_rate").alias("base"),
        F.col("pik_rate").alias("pik"), "shares", F.when(~F.isnan("fv"), F.col("fv")).alias("stated"), "accession", "ccy", "descr", "acq", "maturity",
    )
    html = table(spark, sf_dir, "html_row").select(
        F.lit("html_row").alias("src"), "row_id", "bdc", "period_end", "issuer", F.col("investment_type").alias("text"), "investment_type", "caption", "spread", F.col("interest_rate").alias("rate"),
        F.col("base_rate").alias("base"), F.col("pik_rate").alias("pik"), F.col("shares_units").alias("shares"), F.when(~F.isnan("fair_value"), F.col("fair_value")).alias("stated"), "acquisition_date", "maturity_date",
    )
    r = book(position_units(spark, sf_dir, soi), ("entity", "company"), "acq", "maturity").unionByName(book(html_units(html), ("issuer",), "acquisition_date", "maturity_date"))
    # a stated amount is exact to half of its last digit, in its unit
    whole = lambda x: F.rint(x) == x
    step = F.when(whole(F.col("stated")), 0.5).when(whole(F.col("stated") * 10), 0.05).when(F.abs(F.col("stated") * 100 - F.rint(F.col("stated") * 100)) < 1e-6, 0.005).otherwise(0.0005)
    dollars = F.abs(F.col("amount") / F.when(F.col("stated") != 0, F.col("stated")))
    tol = AMOUNT_SHARE * F.abs("amount") + F.when(F.col("stated").isNotNull(), step * F.coalesce(dollars, "scale")).otherwise(F.lit(AMOUNT_LEAST))
    r = r.withColumns({"tol": tol, "acq_month": F.substring("acq", 1, 7), "mat_month": F.substring("maturity", 1, 7)})

    def key(tag: int, *cols: str) -> Column:
        ok = F.lit(True)
        for c in cols:
            ok &= F.col(c).isNotNull()
        return F.when(ok, F.xxhash64(F.lit(tag), *cols))

    # repeated records of one side state the same amount to three digits
    lead = F.pow(F.lit(10.0), F.floor(F.log10(F.abs("amount"))) - 2)
    # a position lies in one bin; an HTML row probes all that the tolerances reach
    placed, reach = size_bin(F.col("amount")), size_reach(F.col("amount"), F.col("tol"))
    first, last = (F.when(F.col("src") == "soi_position", placed).otherwise(x) for x in reach)
    # functions over arrays are interpreted, and each layer of them copies the row: all else is told before, in generated code
    r = r.withColumns({
        "own": F.array(key(1, "acq_month", "label"), key(2, "mat_month", "label"), key(3, "acq_month", "mat_month"), key(4, "shares"), key(5, "spread", "rate", "label")),
        "first": first, "last": last, "cell": F.xxhash64("bdc", "period_end"), "twin": F.when(F.abs("amount") > 0, F.xxhash64(F.rint(F.col("amount") / lead), lead)),
    })
    r = r.withColumn("terms", key(6, "cell", "acq_month", "mat_month"))
    none = F.array().cast("array<bigint>")
    r = r.withColumn("bins", F.coalesce(F.transform(F.sequence("first", "last"), lambda x: F.xxhash64(x)), none))
    # within a borrower one attribute or two; whatever the name, amount and both months. Hashes meet by exclusive or
    own = F.concat("bins", F.array_compact("own"))
    named = F.flatten(F.transform(F.transform("who", lambda c: F.xxhash64("cell", c)), lambda c: F.transform(own, lambda k: c.bitwiseXOR(k))))
    terms = F.when(F.col("terms").isNotNull(), F.transform("bins", lambda x: F.col("terms").bitwiseXOR(x))).otherwise(none)
    r = r.withColumn("keys", F.concat(named, terms))
    r = stored(
        r.select("src", F.col("row_id").alias("id"), "keys", "twin", "amount", "tol", "who", "label", "spread", "rate", "base", "pik", "shares", "acq", "maturity", "acq_month"),
        plain=("id", "keys.list.element", "twin", "amount", "tol"),
    )
    return r.where("src = 'soi_position'"), r.where("src = 'html_row'")


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = holdings(spark, sf_dir)
    return link_records(left, right, HOLDING_RULES).select(F.col("a").alias("pos_id"), F.col("b").alias("row_id"), "confidence")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a position and an HTML row that describe one holding."""
    return _linked(spark, sf_dir).select("pos_id", "row_id")


def p7_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched pairs with their confidence."""
    return _linked(spark, sf_dir)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the items of which they hold 13 or more consecutive words."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return leaked_items(docs, table(spark, sf_dir, "eval_item")).where("run >= 13").select("doc_id", "item_id")


def p8_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments of documents with items, edited copies included, of half the item's best score or more."""
    x = scored_items(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), table(spark, sf_dir, "eval_item"))
    return x.select("doc_id", "item_id", "score", "matched", "run", (F.col("matched") / F.col("words")).alias("share"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with spans of 60 or more words found in another document, and the words in them."""
    return shared_words(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))).select("doc_id", "shared_words")


def p10_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shared words, their share, number of shared spans, and its longest maximal repeat with a partner."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = docs.select("doc_id", F.size(F.filter(F.split("text", r"(?U)\s+"), lambda x: x != "")).alias("n_words"))
    s = shared_words(docs)
    return s.join(n, "doc_id").select("doc_id", "shared_words", "spans", (F.col("shared_words") / F.col("n_words")).alias("share"), "longest", "partner")


#: The tokenizer whose tokens measure the mix; a path, so that others can be used.
TOKENIZER = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_50k.json")


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return mix_sources(docs, table(spark, sf_dir, "mix_target"), TOKENIZER)


def p9_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mix with their repeats, tokens and the share their source really gets."""
    chosen, report = _mix(spark, sf_dir)
    return chosen.join(F.broadcast(report.select("source", "target_share", "actual_share")), "source")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of every source, with documents, tokens and the most repeats."""
    return _mix(spark, sf_dir)[1]


QUERIES = {
    "p4_found": p4_found, "p4_unmatched": p4_unmatched, "p6_found": p6_found, "p6_classes": p6_classes, "p7_found": p7_found, "p7_confidence": p7_confidence,
    "p8_found": p8_found, "p8_scored": p8_scored,
    "p9_chosen": p9_chosen, "p9_shares": p9_shares, "p10_found": p10_found, "p10_spans": p10_spans,
}

_WORDS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"

#: Problems 4, 6, 7 and 9 cannot be told in SQL; they are tested against brute force and fixtures.
SQL: dict[str, str] = {
    "p8_found": f"""WITH i AS (SELECT item_id, {_WORDS} AS w FROM eval_item), d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
ig AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS k FROM i)),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d))
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)""",
    "p10_found": """WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[\\s\\x{00a0}\\x{2000}-\\x{200a}\\x{3000}]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, k, hash(array_to_string(w[k:k + 59], chr(0))) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 58)) AS k FROM d)),
two AS (SELECT h FROM g GROUP BY h HAVING min(doc_id) <> max(doc_id)),
s AS (SELECT doc_id, k, k - lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS step FROM g WHERE h IN (SELECT h FROM two))
SELECT doc_id, CAST(sum(CASE WHEN step < 60 THEN step ELSE 60 END) AS BIGINT) AS shared_words FROM s GROUP BY doc_id""",
}

"""Evaluation texts leaking into training text (problem 8).

Words are maximal runs of letters and digits of the lower-cased text. The n-grams of all
items are counted over the whole corpus; in every window of ``run`` consecutive item words
the rarest n-gram that the corpus has becomes a seed, so that any run of that length holds a seed and none is
missed, while frequent n-grams seldom are one. Documents and items that share a seed are
aligned by Smith-Waterman over their words, which scores edited and paraphrased copies and
also gives the longest run of equal words.

Seeds find runs. Edited copies may hold none, whatever the seed's length, so ``scored_items``
asks of every document and item a bound that no score exceeds: each document word in an
alignment is matched (2) or costs 1 at least, and matched words are words of the item, so the
largest sum over a stretch of the document of 2 for words of the item and -1 for others is at
least the score. What reaches the asked score by this bound is aligned; nothing is missed.

Defined results: null and empty texts, and items shorter than an n-gram, match nothing;
repeated items and documents match each; ties of frequency take the first n-gram of the
window; whole texts are read, whatever their length (an alignment keeps one row of scores).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.session import broadcast_within, checkpointed, dealt, stored

#: Item n-grams and seeds are broadcast up to so many rows (16 bytes each), shuffled beyond.
MAX_BROADCAST_SEEDS = 2_000_000

#: A pass over the documents bounds so many items, of so many words in all, on average.
ITEMS_A_PASS, WORDS_A_PASS = 1000, 60_000
#: Document words that are bounded at a time.
WORDS_AT_ONCE = 4096

MATCH, MISMATCH, GAP = 2, -1, -1


def words_of(text: Column) -> Column:
    """The words of a text, as an array."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _grams(h: Column, n: int) -> Column:
    """(pos, gram) of every n-gram of the word hashes ``h``."""
    at = F.sequence(F.lit(0), F.size(h) - n)
    return F.transform(at, lambda i: F.struct(i.alias("pos"), F.xxhash64(*[F.get(h, i + k) for k in range(n)]).alias("gram")))


def _row(h: np.ndarray, same: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The scores at the next item word; insertions along the row are a running maximum, as a gap costs the same wherever it starts."""
    row = np.zeros_like(h)
    np.maximum(h[:-1] + np.where(same, h.dtype.type(MATCH), h.dtype.type(MISMATCH)), h[1:] + h.dtype.type(GAP), out=row[1:])
    np.maximum(row, 0, out=row)
    lifted = row - GAP * index
    return np.maximum.accumulate(lifted, out=lifted) + GAP * index


def align(doc: np.ndarray, item: np.ndarray) -> tuple[int, int, int, int, int]:
    """(score, matched words, item words spanned, first document word, longest equal run).

    Local alignment with linear gaps. The score and where it ends are found over the whole
    document, the rest by tracing the stretch before that end in which the alignment lies: of its
    document words no more than two are unmatched for each that is matched.
    """
    n = len(doc)
    index = np.arange(n + 1, dtype=np.int32)
    h, run = np.zeros(n + 1, np.int32), np.zeros(n + 1, np.int32)
    score, end_i, end_d, longest = 0, 0, 0, 0
    for i, w in enumerate(item):
        same = doc == w
        np.multiply(run[:-1] + 1, same, out=run[1:])
        longest = max(longest, int(run.max()))
        h = _row(h, same, index)
        k = int(h.argmax())
        if h[k] > score:
            score, end_i, end_d = int(h[k]), i, k
    if not score:
        return 0, 0, 0, 0, longest
    start = max(0, end_d - 3 * len(item) - 1)
    matched, first_i, first_d = _trace(doc[start:end_d], item[: end_i + 1])
    return score, matched, end_i - first_i + 1, start + first_d, longest


def _trace(doc: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """(matched words, first item word, first document word) of the best alignment that ends with both."""
    rows = [np.zeros(len(doc) + 1, np.int32)]
    index = np.arange(len(doc) + 1, dtype=np.int32)
    for w in item:
        rows.append(_row(rows[-1], doc == w, index))
    i, d, matched = len(item), len(doc), 0
    while rows[i][d] > 0:
        here = rows[i][d]
        if i and d and here == rows[i - 1][d - 1] + (MATCH if doc[d - 1] == item[i - 1] else MISMATCH):
            matched += int(doc[d - 1] == item[i - 1])
            i, d = i - 1, d - 1
        elif i and here == rows[i - 1][d] + GAP:
            i -= 1
        else:
            d -= 1
    return matched, i, d


def _aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for d, i, dw, iw in zip(pdf["doc_id"], pdf["item_id"], pdf["doc"], pdf["item"]):
            rows.append((d, i, *align(np.asarray(dw), np.asarray(iw)), len(iw)))
        yield pd.DataFrame(rows, columns=["doc_id", "item_id", "score", "matched", "spanned", "at", "run", "words"])


ALIGNED = "doc_id bigint, item_id bigint, score bigint, matched bigint, spanned bigint, at bigint, run bigint, words bigint"


def _hashed(t: DataFrame, key: str, least: int, *also: str) -> DataFrame:
    """(key, w): the hashed words of texts of ``least`` words or more."""
    w = F.transform(words_of(F.col("text")), lambda x: F.xxhash64(x))
    return t.select(key, *also, w.alias("w")).where(F.size("w") >= least)


def bounds(doc: np.ndarray, known: np.ndarray, worth: np.ndarray) -> np.ndarray:
    """For each item, the largest sum of ``worth`` over a stretch of ``doc``: no alignment scores more.

    ``worth`` has a row a word of ``known`` (sorted), and a last one for all other words.
    """
    at = np.minimum(np.searchsorted(known, doc), len(known) - 1)
    at = np.where(known[at] == doc, at, len(known))
    best = here = np.zeros(worth.shape[1], np.int64)
    for k in range(0, len(at), WORDS_AT_ONCE):
        sums = here + np.cumsum(worth[at[k : k + WORDS_AT_ONCE]], axis=0, dtype=np.int32)
        ending = sums - np.minimum(np.minimum.accumulate(sums, axis=0), 0)
        best, here = np.maximum(best, ending.max(axis=0)), ending[-1]
    return best


def _bounded(items: list[list[int]], least: float):
    """(doc_id, doc, item) of documents and items whose bound is ``least`` of the item's best score or more."""
    asked = np.array([MATCH * least * len(w) for w in items])
    words = [np.array(w, np.int64) for w in items]

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = np.unique(np.concatenate(words)) if words else np.zeros(0, np.int64)
        worth = np.full((len(known) + 1, len(words)), max(MISMATCH, GAP), np.int8)
        for k, w in enumerate(words):
            worth[np.searchsorted(known, w), k] = MATCH
        for pdf in batches:
            rows = []
            for d, w in zip(pdf["doc_id"], pdf["w"]):
                if words:
                    rows += [(d, w, words[k]) for k in np.nonzero(bounds(np.asarray(w), known, worth) >= asked)[0]]
            yield pd.DataFrame(rows, columns=["doc_id", "doc", "item"])

    return keep


def leaked_items(docs: DataFrame, items: DataFrame, run: int = 13, n: int = 5) -> DataFrame:
    """(doc_id, item_id, score, matched, spanned, at, run, words) of documents and items that share a seed.

    ``docs`` has (doc_id, text), ``items`` (item_id, text). ``run`` is the length of runs that
    are never missed; ``n`` the words of a seed.
    """
    i = stored(_hashed(items, "item_id", n))
    item_grams = stored(i.select("item_id", F.size("w").alias("len"), F.inline(_grams(F.col("w"), n))))
    wanted = broadcast_within(stored(item_grams.select("gram").distinct()), MAX_BROADCAST_SEEDS)
    # the only pass over the corpus: where documents have n-grams of items
    hits = stored(_hashed(docs, "doc_id", n).select("doc_id", F.explode(_grams(F.col("w"), n)["gram"]).alias("gram")).join(wanted, "gram", "left_semi"))
    counts = broadcast_within(stored(hits.groupBy("gram").agg(F.count("*").alias("n"))), MAX_BROADCAST_SEEDS)
    # the rarest n-gram that occurs, of every window; windows of short items are whole items
    g = item_grams.join(counts, "gram")
    windows = g.withColumn("start", F.explode(F.sequence(F.greatest(F.lit(0), F.col("pos") - (run - n)), F.least(F.col("pos"), F.greatest(F.lit(0), F.col("len") - run)))))
    rare = windows.groupBy("item_id", "start").agg(F.min(F.struct("n", "pos", "gram")).alias("s"))
    seeds = broadcast_within(stored(rare.select("item_id", "s.gram").distinct()), MAX_BROADCAST_SEEDS)
    # a document's words travel once, whatever the number of items that it has seeds of
    pairs = hits.join(seeds, "gram").groupBy("doc_id").agg(F.collect_set("item_id").alias("items"))
    both = dealt(docs.select("doc_id", "text").join(pairs, "doc_id")).select("text", F.col("doc_id"), F.explode("items").alias("item_id"))
    both = _hashed(both, "doc_id", n, "item_id").withColumnRenamed("w", "doc").join(broadcast_within(i.withColumnRenamed("w", "item"), ITEMS_A_PASS), "item_id")
    return both.mapInPandas(_aligned, ALIGNED)


def scored_items(docs: DataFrame, items: DataFrame, least: float = 0.5, n: int = 5) -> DataFrame:
    """The columns of ``leaked_items`` for every document and item whose score is ``least`` of the item's best or more.

    ``n`` is the length from which items count. Documents are read once a pass of items.
    """
    i = checkpointed(_hashed(items, "item_id", n))
    d = _hashed(docs, "doc_id", 1)
    total = i.agg(F.count("*").alias("items"), F.coalesce(F.sum(F.size("w")), F.lit(0)).alias("words")).first()
    passes = max(1, -(-total.items // ITEMS_A_PASS), -(-total.words // WORDS_A_PASS))
    d = checkpointed(d) if passes > 1 else d
    near = None
    for k in range(passes):
        # equal items are bounded once and meet again in the join
        part = i.select("w").distinct().where(F.pmod(F.xxhash64("w"), F.lit(passes)) == k)
        found = d.mapInPandas(_bounded([r.w for r in part.collect()], least), "doc_id bigint, doc array<bigint>, item array<bigint>")
        near = found if near is None else near.unionByName(found)
    both = near.join(i.withColumnRenamed("w", "item"), "item")
    return both.mapInPandas(_aligned, ALIGNED).where(F.col("score") >= MATCH * least * F.col("words"))

"""Mixing sources to target weights (problem 9).

Sizes are tokens of a public tokenizer. Tokens are summed per cell of (source, language,
topic), a small table whatever the corpus; languages are the base codes, topics are clusters of
words, fitted on all documents. Iterative proportional fitting rakes the cells'
weights in turn to the source, language and topic marginals, never above what a cell can
give at its source's repeat cap. A cell's weight over its size is the number of times that
its documents are used on average: each is used the whole part of it, and the rest by a
probability, the document's hash against a threshold that is calibrated on a histogram of
hashes, so that the sum meets the weight and not only its expectation.

Defined results: documents without text, source or target have no part; a source without
documents gets nothing and its share goes to the others in proportion; the total is the
largest at which every other source can meet its target under its cap, unless given;
repeated documents count each; an empty corpus gives no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyforge.session import checkpointed, stored

#: Cells of (source, language, topic) that the fitting may hold; more is an error.
MAX_CELLS = 100_000
BUCKETS = 4096

#: Topics, and the size of the table that words are hashed to.
TOPICS, FEATURES = 8, 4_096


def with_topics(docs: DataFrame, topics: int = TOPICS) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``topic``, the nearest of the clusters of their words.

    The clusters (bisecting k-means over words weighted by their rarity) are fitted on every document with a
    word; ``none`` are texts without one.
    """
    words = F.filter(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]{3,}"), F.lit(0)), lambda w: F.length(w) < 40)
    words = F.coalesce(words, F.array().cast("array<string>")).alias("_words")
    count = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=FEATURES)
    # the fit reads its input several times
    told = stored(count.transform(docs.select(words).where(F.size("_words") > 0)).select("_tf"))
    d = docs.select("*", words)
    if told.isEmpty():
        return d.withColumn("topic", F.lit("none")).drop("_words")
    model = Pipeline(
        stages=[
            IDF(inputCol="_tf", outputCol="_idf", minDocFreq=2),
            Normalizer(inputCol="_idf", outputCol="_unit"),
            BisectingKMeans(featuresCol="_unit", predictionCol="_topic", k=topics, seed=7, maxIter=15),
        ]
    ).fit(told)
    out = model.transform(count.transform(d))
    topic = F.when(F.size("_words") == 0, "none").otherwise(F.concat(F.lit("t"), F.col("_topic").cast("string")))
    return out.withColumn("topic", topic).drop("_words", "_tf", "_idf", "_unit", "_topic")


def language_of(lang: Column) -> Column:
    """The base language code, ``und`` where none is given."""
    t = F.lower(F.regexp_extract(F.trim(lang), r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    return F.when(t == "", "und").otherwise(F.coalesce(t, F.lit("und")))


def count_tokens(tokenizer_file: str, at_once: int = 64):
    """Pandas UDF: tokens of each text under the tokenizer of ``tokenizer_file``.

    Encodings are far larger than their texts, so only ``at_once`` exist at a time.
    """

    @F.pandas_udf(T.LongType())
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer_file)
        t.encode_special_tokens = True
        for s in texts:
            all_ = [x or "" for x in s]
            n: list[int] = []
            for k in range(0, len(all_), at_once):
                n += [len(e.ids) for e in t.encode_batch_fast(all_[k : k + at_once], add_special_tokens=False)]
            yield pd.Series(n, dtype="int64")

    return count


def largest_total(have: dict[str, float], shares: dict[str, float], cap: dict[str, int]) -> float:
    """The largest total at which every source with documents meets its share under its cap."""
    real = {s: w for s, w in shares.items() if have.get(s) and w > 0}
    whole = sum(real.values())
    return min((have[s] * cap[s] * whole / w for s, w in real.items()), default=0.0)


def rake(
    cells: dict[tuple[str, str, str], float], shares: dict[str, float], cap: dict[str, int], total: float, rounds: int = 200, tolerance: float = 1e-6
) -> dict[tuple[str, str, str], float]:
    """Weights of cells whose marginals are the source shares and the cells' own language and topic shares.

    The language and topic marginals are those of the whole pool. Where caps leave the three
    at odds, the source marginal, fitted last, is the one that is met.
    """
    if not cells or total <= 0:
        return {k: 0.0 for k in cells}
    pool = sum(cells.values())
    have: dict[str, float] = {}
    for (s, _, _), n in cells.items():
        have[s] = have.get(s, 0.0) + n
    real = {s: shares.get(s, 0.0) for s in have}
    whole = sum(real.values()) or 1.0
    target: list[dict[str, float]] = [{s: w / whole * total for s, w in real.items()}, {}, {}]
    for key, n in cells.items():
        for axis in (1, 2):
            target[axis][key[axis]] = target[axis].get(key[axis], 0.0) + n / pool * total
    most = {k: n * cap[k[0]] for k, n in cells.items()}
    w = {k: min(most[k], target[0][k[0]] * n / have[k[0]]) for k, n in cells.items()}
    for _ in range(rounds):
        before = dict(w)
        for axis in (1, 2, 0):
            for _ in range(20):
                got: dict[str, float] = {}
                free: dict[str, float] = {}
                for k, x in w.items():
                    got[k[axis]] = got.get(k[axis], 0.0) + x
                    if x < most[k] * (1 - 1e-12):
                        free[k[axis]] = free.get(k[axis], 0.0) + x
                off = 0.0
                for k in w:
                    gap = target[axis][k[axis]] - got[k[axis]]
                    if gap < 0:
                        w[k] *= target[axis][k[axis]] / got[k[axis]]
                    elif gap > tolerance * total and free.get(k[axis]) and w[k] < most[k]:
                        w[k] = min(most[k], w[k] * (1 + gap / free[k[axis]]))
                        off = max(off, gap)
                if axis or off <= tolerance * total:
                    break
        if max(abs(w[k] - before[k]) for k in w) <= tolerance * total:
            break
    return w


def mix_sources(docs: DataFrame, targets: DataFrame, tokenizer_file: str, total: float | None = None) -> tuple[DataFrame, DataFrame]:
    """The chosen documents (doc_id, source, lang, topic, tokens, repeats) and the shares by source.

    ``docs`` has (doc_id, text, lang, source), ``targets`` (source, target_share, max_repeat).
    """
    spark = docs.sparkSession
    t = targets.select(F.trim("source").alias("source"), "target_share", "max_repeat").where("source is not null and target_share > 0")
    rows = t.limit(MAX_CELLS + 1).collect()
    if len(rows) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} targets")
    shares = {r.source: float(r.target_share) for r in rows}
    cap = {r.source: int(r.max_repeat) for r in rows}
    d = docs.where(F.col("text").isNotNull()).select("doc_id", F.trim("source").alias("source"), language_of(F.col("lang")).alias("lang"), "text")
    # targets are checked above to be few
    d = d.join(F.broadcast(t.select("source")), "source", "left_semi")
    d = with_topics(d)
    d = d.select("doc_id", "source", "lang", "topic", count_tokens(tokenizer_file)("text").alias("tokens"))
    # filtered only once written: a filter on the count would be pushed below it and count twice
    d = checkpointed(d.withColumn("bucket", F.pmod(F.xxhash64(F.lit("mix"), "doc_id"), F.lit(BUCKETS)).cast("int"))).where("tokens > 0")
    cells_df = d.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("n"))
    found = cells_df.limit(MAX_CELLS + 1).collect()
    if len(found) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells of source, language and topic")
    cells = {(r.source, r.lang, r.topic): float(r.n) for r in found}
    have: dict[str, float] = {}
    for (s, _, _), n in cells.items():
        have[s] = have.get(s, 0.0) + n
    w = rake(cells, shares, cap, largest_total(have, shares, cap) if total is None else total)
    rates = spark.createDataFrame(
        [(*k, int(w[k] / n), w[k] - int(w[k] / n) * n) for k, n in cells.items()], "source string, lang string, topic string, whole int, part double"
    )
    rates = F.broadcast(rates)  # at most MAX_CELLS rows
    # the threshold of each cell: the last bucket of hashes that its part still holds
    bins = d.groupBy("source", "lang", "topic", "bucket").agg(F.sum("tokens").alias("n"))
    per = bins.groupBy("source", "lang", "topic").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("h")).join(rates, ["source", "lang", "topic"])
    # at most BUCKETS entries an array
    fits = lambda a, x: a["open"] & (a["sum"] + x["n"] / 2 <= F.col("part"))
    run = F.aggregate(
        "h",
        F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("last"), F.lit(True).alias("open")),
        lambda a, x: F.struct(
            (a["sum"] + x["n"]).cast("double").alias("sum"), F.when(fits(a, x), x["bucket"]).otherwise(a["last"]).alias("last"), fits(a, x).alias("open")
        ),
    )
    cut = F.broadcast(per.select("source", "lang", "topic", "whole", run["last"].alias("last")))  # at most MAX_CELLS rows
    used = d.join(cut, ["source", "lang", "topic"]).withColumn("repeats", F.col("whole") + F.when(F.col("bucket") <= F.col("last"), 1).otherwise(0))
    limit = F.broadcast(t.select("source", "max_repeat"))
    used = used.join(limit, "source").withColumn("repeats", F.least("repeats", "max_repeat"))
    chosen = used.where("repeats > 0").select("doc_id", "source", "lang", "topic", "tokens", "repeats")
    got = chosen.groupBy("source").agg(F.count("*").alias("docs"), F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.max("repeats").alias("most_repeats"))
    report = t.join(got, "source", "left").fillna(0, ["docs", "tokens", "most_repeats"])
    whole = F.sum("tokens").over(Window.partitionBy(F.lit(0)))  # one row a target
    report = report.select(
        "source", "target_share", "max_repeat", "docs", "tokens", "most_repeats", F.coalesce(F.try_divide(F.col("tokens"), whole), F.lit(0.0)).alias("actual_share")
    )
    return chosen, report

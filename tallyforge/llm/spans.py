"""Long exact spans shared between records (problem 10).

Words are the pieces between blanks. A span of at least ``length`` words that recurs in
another document is the union of windows of ``length`` words that do; those are the deep
nodes of the suffix tree of all documents. The tree is built in parts:

1. Anchors. In every document the words whose following block has the smallest hash of its
   surroundings are anchors. Equal windows have, in both documents, the same anchor, so only
   windows whose anchor is in two documents can be shared: the others, nearly all of a
   corpus, never leave their task.
2. Prefix partitions. Each suffix left is its next blocks' hashes. Suffixes are grouped by
   the first block; a group of one document is pruned, one larger than the memory bound is
   split by one more block, again and again, up to the full depth, where a group is a node.
3. Subtrees. A group within the bound is sorted and its subtree read off the common
   prefixes of neighbours: the nodes at full depth whose leaves lie in two documents. Each
   leaf is told a partner, a leaf of another document under its node.
4. Maximal repeats. Windows that follow each other with the same partner at the same distance
   go down one path of the tree; the repeat is as long as the path.

Defined results: null and short texts, and documents without an id, share nothing; repeats within one document count only
if another document has them too; copies of a whole document are shared wholly; texts of
any length are read whole. Blocks are 64-bit hashes, five of which must agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.session import broadcast_within, stored

#: Suffixes that one subtree may hold.
MAX_GROUP = 50_000
#: Large groups are told to all tasks up to so many, by a shuffle beyond.
MAX_BROADCAST_GROUPS = 100_000

BLOCK = 12
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def block_hashes(words: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The hash of the ``block`` words from each word on."""
    w = _mix(np.asarray(words, np.int64).view(np.uint64))
    n = len(w) - block + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(block):
            h = h * _BASE + w[k : k + n]
        return _mix(h).view(np.int64)


def anchor_of(hashes: np.ndarray, window: int) -> np.ndarray:
    """For every ``window`` of consecutive hashes the place of its smallest one, the first of equals.

    The smallest of a stretch is the smaller one of two that cover it; stretches double.
    """
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64)
    best, reach = np.arange(n), 1

    def join(step: int) -> np.ndarray:
        left, right = best[: len(best) - step], best[step:]
        return np.where(hashes[left] <= hashes[right], left, right)

    while 2 * reach <= window:
        best = join(reach)
        reach *= 2
    return join(window - reach) if reach < window else best


def anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """The anchors of all windows."""
    return np.unique(anchor_of(hashes, window))


class _Batch:
    """Documents of a batch end to end: hashes and anchors are worked out over all of them at once."""

    def __init__(self, pdf: pd.DataFrame, length: int, block: int) -> None:
        sizes = pdf["w"].str.len().to_numpy(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else np.zeros(0, np.int64)
        self.ids = pdf["doc_id"].to_numpy(np.int64)
        words = np.concatenate(list(pdf["w"])) if len(sizes) else np.zeros(0, np.int64)
        self.hashes = block_hashes(words, block)
        self.anchor = anchor_of(self.hashes, length - block + 1)
        # windows that run into the next document are none
        end = np.repeat(self.starts + sizes, sizes)[: len(self.anchor)]
        self.inside = np.arange(len(self.anchor)) + length <= end

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, place in it) of places in the batch."""
        doc = np.searchsorted(self.starts, at, side="right") - 1
        return self.ids[doc], at - self.starts[doc]


def _find_anchors(length: int, block: int):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            b = _Batch(pdf, length, block)
            at = np.unique(b.anchor[b.inside])
            doc, pos = b.place(at)
            yield pd.DataFrame({"doc_id": doc, "pos": pos, "anchor": b.hashes[at]})

    return find


def _suffixes(length: int, block: int):
    """Suffixes of ``length`` words whose anchor another document holds too: no other window can be shared."""
    depth = length // block

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            b = _Batch(pdf, length, block)
            shared = np.zeros(len(b.hashes) + 1, bool)
            for start, at in zip(b.starts, pdf["places"]):
                shared[start + np.asarray(at)] = True
            p = np.flatnonzero(b.inside & shared[b.anchor])
            doc, pos = b.place(p)
            yield pd.DataFrame({"doc_id": doc, "pos": pos} | {f"h{k}": b.hashes[p + k * block] for k in range(depth)})

    return cut


def deep_nodes(group: pd.DataFrame, depth: int) -> pd.DataFrame:
    """(doc_id, pos, partner, partner_pos) of the leaves under nodes at ``depth`` blocks that lie in two documents.

    Suffixes in order are the leaves of the group's tree from left to right; two neighbours'
    common prefix is the depth of the node that joins them. The partner is the least document
    under the node, or for that one the greatest, at its first leaf.
    """
    cols = [f"h{k}" for k in range(depth)]
    keys = group[cols].to_numpy(np.int64)
    doc, pos = group["doc_id"].to_numpy(np.int64), group["pos"].to_numpy(np.int64)
    order = np.lexsort((pos, doc, *(keys[:, k] for k in reversed(range(depth)))))
    keys, doc, pos = keys[order], doc[order], pos[order]
    common = np.cumprod(keys[1:] == keys[:-1], axis=1).sum(axis=1)
    new = np.concatenate(([True], common < depth)) if len(doc) else np.zeros(0, bool)
    node = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    # the first leaf of the node's last document
    fresh = np.flatnonzero(new | np.concatenate(([True], doc[1:] != doc[:-1]))) if len(doc) else first
    head = fresh[np.searchsorted(fresh, last, side="right") - 1] if len(doc) else first
    lo, hi = first[node], head[node]
    two = doc[lo] != doc[hi]
    at = np.where(doc == doc[lo], hi, lo)
    return pd.DataFrame({"doc_id": doc[two], "pos": pos[two], "partner": doc[at][two], "partner_pos": pos[at][two]})


_NODES = "doc_id bigint, pos bigint, partner bigint, partner_pos bigint"


def shared_windows(docs: DataFrame, length: int = 60, block: int = BLOCK, max_group: int = MAX_GROUP) -> DataFrame:
    """(doc_id, pos, partner, partner_pos): the windows of ``length`` words that occur in another document too, and where.

    ``docs`` has (doc_id, text); ``length`` is a multiple of ``block``.
    """
    if length % block:
        raise ValueError("length must be a multiple of block")
    depth = length // block
    words = F.filter(F.split("text", r"(?U)\s+"), lambda x: x != "")
    d = docs.select("doc_id", F.transform(words, lambda x: F.xxhash64(x)).alias("w")).where(F.col("doc_id").isNotNull() & (F.size("w") >= length))
    found = stored(d.mapInPandas(_find_anchors(length, block), "doc_id bigint, pos bigint, anchor bigint"))
    two = found.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("anchor")
    places = found.join(two, "anchor", "left_semi").groupBy("doc_id").agg(F.collect_set("pos").alias("places"))
    cols = [f"h{k}" for k in range(depth)]
    schema = "doc_id bigint, pos bigint, " + ", ".join(f"{c} bigint" for c in cols)
    left = stored(d.join(places, "doc_id").mapInPandas(_suffixes(length, block), schema))
    out = None
    for k in range(1, depth + 1):
        prefix = cols[:k]
        if k == depth:
            # a group at full depth is a node, whatever its size
            node = left.groupBy(*prefix).agg(F.min(F.struct("doc_id", "pos")).alias("lo"), F.max(F.struct("doc_id", (-F.col("pos")).alias("minus"))).alias("hi")).where("lo.doc_id <> hi.doc_id")
            mine = F.col("doc_id") == F.col("lo.doc_id")
            part = left.join(node, prefix).select(
                "doc_id", "pos", F.when(mine, F.col("hi.doc_id")).otherwise(F.col("lo.doc_id")).alias("partner"), F.when(mine, -F.col("hi.minus")).otherwise(F.col("lo.pos")).alias("partner_pos")
            )
            return part if out is None else out.unionByName(part)
        # few groups are large: those of an eighth of the bound or more have a task of their own, or are split
        size = left.groupBy(*prefix).agg(F.count("*").alias("n"), (F.min("doc_id") != F.max("doc_id")).alias("two")).where(F.col("n") > max_group // 8)
        size = stored(size)
        total = left.count()
        buckets = max(8, -(-4 * total // max_group))
        few = broadcast_within(size, MAX_BROADCAST_GROUPS)
        group = left.join(few, prefix, "left").where(F.col("n").isNull() | (F.col("two") & (F.col("n") <= max_group)))
        group = group.withColumn("bucket", F.when(F.col("n").isNull(), F.pmod(F.xxhash64(*prefix), F.lit(buckets))).otherwise(F.xxhash64(*prefix))).drop("n", "two")
        nodes = group.groupBy("bucket").applyInPandas(lambda g: deep_nodes(g, depth), _NODES)
        out = nodes if out is None else out.unionByName(nodes)
        rest = size.where(F.col("two") & (F.col("n") > max_group))
        if rest.isEmpty():
            return out
        left = stored(left.join(rest.select(*prefix), prefix, "left_semi"))


def maximal_repeats(docs: DataFrame, length: int = 60, block: int = BLOCK, max_group: int = MAX_GROUP) -> DataFrame:
    """(doc_id, start, words, partner, partner_start): spans of a document as far as they run along with one partner.

    Consecutive windows whose nodes have the partner at the same distance are one path down the
    tree: the repeat is as long as the path. Windows of one document may have several partners.
    """
    w = shared_windows(docs, length, block, max_group).withColumn("by", F.col("partner_pos") - F.col("pos"))
    run = F.col("pos") - F.row_number().over(Window.partitionBy("doc_id", "partner", "by").orderBy("pos"))
    g = w.withColumn("run", run).groupBy("doc_id", "partner", "by", "run").agg(F.min("pos").alias("start"), (F.count("*") + length - 1).alias("words"))
    return g.select("doc_id", "start", "words", "partner", (F.col("start") + F.col("by")).alias("partner_start"))


def shared_words(docs: DataFrame, length: int = 60, block: int = BLOCK, max_group: int = MAX_GROUP) -> DataFrame:
    """(doc_id, shared_words, spans, longest, partner): words of each document in shared spans, the spans, and the longest maximal repeat."""
    m = maximal_repeats(docs, length, block, max_group)
    # spans are the union of the repeats: a gap is where none reaches
    reach = F.max(F.col("start") + F.col("words")).over(Window.partitionBy("doc_id").orderBy("start", "words", "partner").rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("start") + F.col("words")
    fresh = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce("reach", "start")))
    return (
        m.withColumn("reach", reach)
        .groupBy("doc_id")
        .agg(
            F.sum(fresh).cast("bigint").alias("shared_words"),
            F.sum(F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)).cast("bigint").alias("spans"),
            F.max(F.struct("words", (-F.col("partner")).alias("minus"))).alias("m"),
        )
        .select("doc_id", "shared_words", "spans", F.col("m.words").cast("bigint").alias("longest"), (-F.col("m.minus")).alias("partner"))
    )

import random
import re

import numpy as np

from tallyforge.llm import leaks
from tallyforge.llm.leaks import align, leaked_items
from tallyforge.llm.queries import QUERIES

WORDS = [f"w{i}" for i in range(40)]


def test_align_equals_table():
    rnd = random.Random(5)
    for _ in range(30):
        d, i = [[rnd.randint(0, 5) for _ in range(rnd.randint(1, 30))] for _ in range(2)]
        h = np.zeros((len(i) + 1, len(d) + 1), int)
        run = np.zeros_like(h)
        for a in range(1, len(i) + 1):
            for b in range(1, len(d) + 1):
                h[a, b] = max(0, h[a - 1, b - 1] + (2 if i[a - 1] == d[b - 1] else -1), h[a - 1, b] - 1, h[a, b - 1] - 1)
                run[a, b] = run[a - 1, b - 1] + 1 if i[a - 1] == d[b - 1] else 0
        score, matched, spanned, _, longest = align(np.array(d), np.array(i))
        assert (score, longest) == (h.max(), run.max())
        assert 0 <= matched <= spanned <= len(i)


def test_runs_equal_brute_force(spark):
    rnd = random.Random(1)
    text = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    items = [(k, text(30)) for k in range(12)]
    docs = []
    for k in range(120):
        w = items[k % 12][1].split()
        a, n = rnd.randint(0, 15), rnd.choice([8, 12, 13, 14, 15])
        docs.append((k, f"{text(20)} {'; '.join(w[a : a + n]).upper()} {text(20)}"))
    docs += [(500, None), (501, ""), (502, "one two"), (503, items[0][1]), (503, items[0][1])]
    norm = lambda t: re.findall(r"[^\W_]+", (t or "").lower())

    def longest(d, i):
        grams = {tuple(i[k : k + 13]) for k in range(len(i) - 12)}
        return any(tuple(d[k : k + 13]) in grams for k in range(len(d) - 12))

    want = {(d, i) for d, t in docs for i, u in items if longest(norm(t), norm(u))}
    ddf = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id bigint, text string, gram string, pos int")
    got = leaked_items(ddf, spark.createDataFrame(items, "item_id bigint, text string")).where("run >= 13")
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_edited_copy_scores(spark):
    item = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa"
    edited = item.replace("golf", "GULF,").replace(" lima", "")
    docs = spark.createDataFrame([(1, "x y z " + edited + " q")], "doc_id bigint, text string")
    r = leaked_items(docs, spark.createDataFrame([(7, item)], "item_id bigint, text string")).first()
    assert (r.matched, r.at, r.run, r.words) == (14, 3, 6, 16)


def test_empty(spark):
    e = spark.createDataFrame([], "doc_id bigint, text string")
    i = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    assert leaked_items(e, i).count() == 0
    assert leaked_items(e.unionByName(spark.createDataFrame([(1, "a b c d e f")], e.schema)), i.limit(0)).count() == 0


def test_edited_copies_score_beside_a_whole_one(spark, tmp_path, monkeypatch):
    item = [f"i{k}" for k in range(48)]
    edited = lambda step: " ".join("x" if k % step == step - 1 else w for k, w in enumerate(item))
    # edits each 8 and each 4 words, each other word an insertion, and a text of other words
    docs = [(1, " ".join(item)), (2, "a b " + edited(8)), (3, edited(4) + " c"), (4, " ".join(f"{w} x" for w in item[:47]) + " " + item[47]), (5, "x " * 300), (6, None), (7, "")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(9, " ".join(item)), (10, " ".join(item)), (11, "five other words than these")], "item_id bigint, text string").write.parquet(f"{tmp_path}/eval_item.parquet")
    want = {(d, i, s) for d, s in ((1, 96), (2, 79), (3, 61), (4, 49)) for i in (9, 10)}
    for size in (1000, 1):
        monkeypatch.setattr(leaks, "ITEMS_A_PASS", size)
        got = QUERIES["p8_scored"](spark, str(tmp_path)).collect()
        assert {(r.doc_id, r.item_id, r.score) for r in got} == want


def test_bound_is_never_below_the_score(monkeypatch):
    rnd = random.Random(2)
    monkeypatch.setattr(leaks, "WORDS_AT_ONCE", 7)
    for _ in range(200):
        d, i = [np.array([rnd.randint(0, 6) for _ in range(rnd.randint(1, 40))]) for _ in range(2)]
        known = np.unique(i)
        worth = np.array([[2]] * len(known) + [[-1]], np.int8)
        sums = [sum(2 if w in known else -1 for w in d[a:b]) for a in range(len(d)) for b in range(a, len(d) + 1)]
        assert leaks.bounds(d, known, worth)[0] == max(sums) >= align(d, i)[0]

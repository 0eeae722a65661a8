import random

import numpy as np
import pytest

from tallyforge.llm.spans import anchors, block_hashes, maximal_repeats, shared_words


def brute(docs, length):
    win = {}
    toks = [(d, (t or "").split()) for d, t in docs if d is not None]
    for d, w in toks:
        for k in range(len(w) - length + 1):
            win.setdefault(tuple(w[k : k + length]), set()).add(d)
    out = {}
    for d, w in toks:
        c = set()
        for k in range(len(w) - length + 1):
            if len(win[tuple(w[k : k + length])]) > 1:
                c |= set(range(k, k + length))
        if c:
            out[d] = len(c)
    return out


def corpus(n, hot):
    rnd = random.Random(2)
    base = [str(rnd.randint(0, 30)) for _ in range(400)]
    out = []
    for d in range(n):
        w = [str(rnd.randint(0, 10**6)) for _ in range(rnd.randint(0, 80))]
        if d % 3 == 0:
            a = rnd.randint(0, 300)
            w[len(w) // 2 : len(w) // 2] = base[a : a + rnd.randint(5, 60)]
        if d % 5 == 0 and hot:
            w = base[:70] + w
        out.append((d, "  ".join(w) + "\n"))
    return [*out, (None, " ".join(base)), (9000, None), (9001, ""), (9002, " ".join(["same"] * 200))]


@pytest.mark.parametrize(("length", "block", "bound"), [(24, 6, 50_000), (24, 12, 40), (20, 5, 7)])
def test_equals_brute_force(spark, length, block, bound):
    docs = corpus(90, True)
    df = spark.createDataFrame([(*r, "x") for r in docs], "doc_id bigint, text string, pos string")
    got = {r.doc_id: r.shared_words for r in shared_words(df, length, block, max_group=bound).collect()}
    assert got == brute(docs, length)


@pytest.mark.parametrize("bound", [50_000, 40])
def test_repeats_are_equal_words_of_a_partner(spark, bound):
    docs = corpus(90, True)
    words = {d: (t or "").split() for d, t in docs}
    got = maximal_repeats(spark.createDataFrame(docs, "doc_id bigint, text string"), 24, 6, max_group=bound).collect()
    assert got
    for r in got:
        a, b = words[r.doc_id][r.start : r.start + r.words], words[r.partner][r.partner_start : r.partner_start + r.words]
        assert r.partner != r.doc_id and a == b and len(a) == r.words >= 24
    covered = {}
    for r in got:
        covered.setdefault(r.doc_id, set()).update(range(r.start, r.start + r.words))
    assert {d: len(c) for d, c in covered.items()} == brute(docs, 24)


def test_copies_share_everything(spark):
    t = " ".join(str(i) for i in range(5000))
    df = spark.createDataFrame([(1, t), (2, t), (3, t + " more")], "doc_id bigint, text string")
    assert {r.doc_id: (r.shared_words, r.spans, r.longest, r.partner) for r in shared_words(df).collect()} == {1: (5000, 1, 5000, 3), 2: (5000, 1, 5000, 1), 3: (5000, 1, 5000, 1)}


def test_empty(spark):
    assert shared_words(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_anchors_are_common():
    rnd = np.random.default_rng(1)
    a, b, common = (rnd.integers(0, 10**9, n) for n in (200, 150, 60))
    ha, hb = (block_hashes(np.concatenate([x, common, x[:30]]), 12) for x in (a, b))
    at_a, at_b = anchors(ha, 49), anchors(hb, 49)
    inside = {int(ha[i]) for i in at_a if 200 <= i <= 248}
    assert inside & {int(hb[i]) for i in at_b if 150 <= i <= 198}

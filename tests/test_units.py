import pytest

from tallyforge.operators.units import compositions, convert_units, read_currency_field, read_description, read_note


def test_shortest_compositions_and_inverse():
    rows = {(u, d): (k, c) for u, d, k, c in compositions([("k", "u", 1000, 0, None), ("C", "K", 1, 273.15, None), ("F", "C", 5 / 9, -160 / 9, None)], "K")}
    assert rows["C", None] == (1.0, 273.15)
    k, c = rows["F", None]
    assert abs(k * 212 + c - 373.15) < 1e-9
    assert ("k", None) not in rows


def test_inconsistent_cycle_raises():
    with pytest.raises(ValueError, match="disagree"):
        compositions([("a", "b", 2, 0, None), ("b", "c", 3, 0, None), ("a", "c", 5, 0, None)], "c")


def test_not_invertible_raises():
    with pytest.raises(ValueError, match="invertible"):
        compositions([("a", "b", 0, 0, None)], "b")


def test_convert(spark):
    edges = [("EUR*1000", "EUR*1", 1000, 0, None), ("EUR*1", "USD*1", 1.1, 0, "2024-03-31"), ("EUR*1", "USD*1", 1.2, 0, "2024-06-30")]
    rows = [("t", 1, "fv", 2.0, "EUR*1000", "2024-03-31", "x"), ("t", 2, "fv", 2.0, "EUR*1", "2024-06-30", "x"), ("t", 3, "fv", None, "EUR*1", "2024-06-30", "x"), ("t", 4, "fv", 1.0, "XXX", "2024-06-30", "x"), ("t", 5, "fv", 7.0, "USD*1", "2024-06-30", "x"), ("t", 6, "fv", 7.0, None, None, "x")]
    df = spark.createDataFrame(rows, "src string, row_id bigint, field string, amount double, unit string, at string, val string")
    got = {r.row_id: (r.val and round(r.val, 6), r.status) for r in convert_units(df, edges, "USD*1").collect()}
    assert got == {1: (2200.0, "converted"), 2: (2.4, "converted"), 4: (None, "no_path"), 5: (7.0, "converted"), 6: (None, "no_path")}
    assert convert_units(df.limit(0), edges, "USD*1").count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [("USD ", ("USD", None)), ("US$ thousands", ("USD", 1e3)), ("k$", ("USD", 1e3)), ("$M", ("USD", 1e6)), ("USDm", ("USD", 1e6)), ("TEUR", ("EUR", 1e3)), ("MSEK", ("SEK", 1e6)), ("€'000", ("EUR", 1e3)),
     ("GBp", ("GBP", 0.01)), ("gbp", ("GBP", None)), ("pence", ("GBP", 0.01)), ("C$'000", ("CAD", 1e3)), ("Sfr", ("CHF", None)), ("Swedish Krona", ("SEK", None)), ("GBP 000s", ("GBP", 1e3)), ("??", (None, None))],
)
def test_currency_fields(text, want):
    assert read_currency_field(text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("Term loan drawn in €", ("EUR", None)), ("Facility B (EUR, amounts in '000)", ("EUR", 1e3)), ("euro millions; term loan", ("EUR", 1e6)), ("Local line, sterling in thousands", ("GBP", 1e3)), ("Canadian dollar tranche", ("CAD", None)),
     ("First Lien Term Loan [€ '000]", ("EUR", 1e3)), ("Refinanced a legacy euro note", (None, None)), ("Sterling silver plant collateral", (None, None)), ("", (None, None))],
)
def test_descriptions(text, want):
    assert read_description(text) == want


@pytest.mark.parametrize(("text", "want"), [("$ mm", 1e6), ("US$m", 1e6), ("Figures in mn", 1e6), ("(000 omitted)", 1e3), ("Dollar amounts in 000s", 1e3), ("Amounts expressed in '000", 1e3), ("US$, unrounded", 1.0), ("Amounts in U.S. dollars", 1.0), ("(in thousands, except share data)", 1e3)])
def test_notes(text, want):
    assert read_note(text) == (None, want)

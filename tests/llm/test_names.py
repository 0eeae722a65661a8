import pytest

from pyspark.sql import functions as F

from tallyforge.llm.names import COMMON_LINES, Lines, abbreviates, brand_forms, components, core_forms, entity_classes, learn_lines, parse_name, rewriting, typed_as, variant_pairs

LINES = Lines(list(COMMON_LINES))


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Gralbell Thistvick Fitness Holdings, L.L.C. (4)", (["gralbell", "thistvick"], "fitness", 1, [])),
        ("Fitness Gralbéll-Thistvick II, LP*", (["gralbell", "thistvick"], "fitness", 2, [])),
        ("Gralbell Thistvick Ftness 2, Inc. (d/b/a Gralbellthist)", (["gralbell", "thistvick"], "fitness", 2, ["gralbellthist"])),
        ("Gralbellthist (Gralbell Thistvick Fitness, LLC)", (["gralbell", "thistvick"], "fitness", 1, ["gralbellthist"])),
        ("Gralbell Thistvick Co.", (["gralbell", "thistvick"], "", 1, [])),
        ("A B Env. Serv. Hldgs", (["a", "b"], "environmental services", 1, [])),
        ("???", ([], "", 1, [])),
    ],
)
def test_parse(text, want):
    assert parse_name(text, LINES) == want


def test_slips():
    assert typed_as("gralbell", "grabell") and typed_as("gralbell", "gralbbell") and typed_as("gralbell", "grablell")
    assert not typed_as("gralbell", "grilbell") and not typed_as("abc", "abd")


def test_abbreviations():
    assert all(abbreviates(a, b) for a, b in (("mgmt", "management"), ("prods", "products"), ("sec", "security"), ("lgstcs", "logistics"), ("pkg", "packaging")))
    assert not abbreviates("torwell", "technologies") and not abbreviates("ab", "abbey") and not abbreviates("media", "media")


@pytest.mark.parametrize(
    ("a", "b", "rule"),
    [
        ("ralhan flalclan", "flalclan ralhan", "same"), ("ralhanflalclan", "ralhan flalclan", "same"), ("r flalclan", "ralhan flalclan", "initial"), ("flalclan r", "ralhan flalclan", "initial"),
        ("bob flalclan", "robert flalclan", "nickname"), ("ralhan flallclan", "ralhan flalclan", "slip"), ("ralhan flaclan", "flalclan ralhan", "slip"), ("ralhen flalclan", "ralhan flalclan", "letter"),
        ("ralhan flalclan", "norwova sormova", None), ("ralhan", "sormova", None),
    ],
)
def test_rewritings(a, b, rule):
    got = rewriting(a.split(), b.split())
    assert (got and got[0]) == rule


def forms(spark, make, *cores):
    df = spark.createDataFrame([(c.split(),) for c in cores], "w array<string>")
    return [set(r[0]) for r in df.select(make(F.col("w"))).collect()]


def test_forms_meet(spark):
    alias = lambda w: core_forms(w, F.array_join(w, ""))
    a, b, i, sub, ab, ac = forms(spark, alias, "gralbell thistvick", "thistvick gralbel", "g thistvick", "gralball thistvick", "ab c", "ab")
    assert a & b and a & i and a & sub and ab & ac
    assert "gralbellthist" in forms(spark, brand_forms, "gralbell thistvick")[0]
    assert forms(spark, brand_forms, "alone")[0] == set()


def test_components_of_long_chains(spark):
    rows = [(k, k + 1) for k in range(40)] + [(100, 101), (103, 102), (101, 102), (7, 7)]
    got = {r.id: r.part for r in components(spark.createDataFrame(rows, "u bigint, v bigint")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 104)}


def test_lines_are_learnt(spark):
    rows = [(f"{chr(97 + k % 26)}al{chr(97 + k // 26)}or Ven{chr(97 + k % 7)}un {'Beekeeping' if k % 2 else 'Falconry'}, LLC",) for k in range(60)]
    got = learn_lines(spark.createDataFrame(rows, "name string"), ()).heads
    assert set(got) == {"beekeeping", "falconry"}


def pairs(spark, names, uses=()):
    df = spark.createDataFrame([(n, k) for n, k in names], "name string, n bigint")
    use = spark.createDataFrame(list(uses), "name string, other string")
    return {(r.name_a, r.name_b) for r in variant_pairs(entity_classes(df, use)).collect()}


def test_variants_and_traps(spark):
    full = "Gralbell Thistvick Fitness, LLC"
    names = [(full, 50), ("Gralbel Thistvick Fitness, LLC", 2), ("Thistvick Gralbell Fitness", 3), ("Gralbell Thistvick Fitness II, LLC", 9), ("Gralbell Thistvick Media, LLC", 9), ("Other Borrower Media, LLC", 5), ("Gralbellthist", 2), (" ", 1)]
    got = pairs(spark, names, [("Gralbellthist", full)])
    same = {full, "Gralbel Thistvick Fitness, LLC", "Thistvick Gralbell Fitness", "Gralbellthist"}
    assert got == {(a, b) for a in same for b in same if a < b}


def test_bare_name_without_rows_needs_a_single_entity(spark):
    names = [("Aaaaaa Bbbbbb Media, LLC", 5), ("Aaaaaa Bbbbbb", 1), ("Cccccc Dddddd Media, LLC", 5), ("Cccccc Dddddd Food, LLC", 5), ("Cccccc Dddddd", 1)]
    assert pairs(spark, names) == {("Aaaaaa Bbbbbb", "Aaaaaa Bbbbbb Media, LLC")}


def test_empty(spark):
    assert pairs(spark, []) == set()


def test_chain_of_spellings_and_rare_rewritings(spark):
    # six spellings, each a slip from the next; and two words of many borrowers that are a slip apart
    chain = ["Gralbell Thistvick", "Gralbel Thistvick", "Gralbel Thistvik", "Gralbl Thistvik", "Gralbl Thstvik", "Grlbl Thstvik"]
    names = [(f"{c} Media, LLC", 9 - k) for k, c in enumerate(chain)]
    others = ["Dorfan", "Mistgell", "Corwick", "Venplova", "Tralbick", "Nenskan"]
    names += [(f"{w} {o} Media, LLC", 5) for w in ("Palhan", "Plalhan") for o in others]
    got = pairs(spark, names)
    same = {n for n, _ in names[:6]}
    assert got == {(a, b) for a in same for b in same if a < b}


def test_initials_and_nicknames(spark):
    names = [("Robert Dorfan Media, LLC", 9), ("R. Dorfan Media, LLC", 2), ("Bob Dorfan Media, LLC", 2), ("Venplova Mistgell Food, LLC", 9), ("Vorplova Mistgell Food, LLC", 9), ("V Mistgell Food, LLC", 1)]
    same = {n for n, _ in names[:3]}
    assert {(a, b) for a, b in pairs(spark, names) if "Media" in a} == {(a, b) for a in same for b in same if a < b}

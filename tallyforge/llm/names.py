"""Variant spellings of organisation names (problem 6).

A name is parsed into its parts: core words, line of business, series numeral, brand (trade
name). Which words are lines of business is learnt from the names: they stand beside many
different words, a borrower's own words beside few. Rewriting rules then generate canonical
forms of each core: without legal form, with abbreviations, numerals and nicknames undone,
with the words in either order and written together, with a word as its initial, and with one
letter left out (which meets dropped, doubled, swapped and substituted letters half way). The
forms are exploded and equi-joined.

A pair of cores that meets is scored by the rarity of the rewriting: the weight of the rule,
over the number of other words that the rarer of the two differing words stands beside,
measured against the commoner one. A typing slip makes a word that stands nowhere else; a
word of many other borrowers is a word of its own, however near. Pairs above ``ACCEPT`` whose
names state a line in common, or none, are links; links and names that rows state of one
borrower make components, found by least labels until nothing changes. Names with one
component, line and numeral are one entity. A name that leaves out the line or is only a brand
takes the entity whose rows use it, or else the only one it fits.

Defined results: null and blank names give no row; names without a letter or digit stand
alone; a name that fits several entities with no row to tell which is linked to none of
them; a name used by rows of several entities belongs to each. Two slips in one name meet
only through a third spelling or through rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.llm.metric import levenshtein
from tallyforge.session import checkpointed, stored

# Legal forms and other words that tell no borrowers apart.
LEGAL = set(
    "inc incorporated llc lp llp ltd limited corp corporation co company plc holdings holding hldg hldgs hold group grp loan ln pool the and of".split()
)
# Long forms of legal words that are often mistyped.
LEGAL_LONG = ("holdings", "group", "incorporated", "limited", "corporation", "company")
# Given names and their short forms.
NICKNAMES = {
    "bill": "william", "will": "william", "bob": "robert", "rob": "robert", "dick": "richard", "rick": "richard", "jim": "james", "jack": "john",
    "joe": "joseph", "mike": "michael", "tom": "thomas", "dave": "david", "dan": "daniel", "ed": "edward", "ted": "edward", "tony": "anthony",
    "chuck": "charles", "charlie": "charles", "liz": "elizabeth", "beth": "elizabeth", "kate": "katherine", "peggy": "margaret", "meg": "margaret",
    "sue": "susan", "alex": "alexander", "sam": "samuel", "ben": "benjamin", "nick": "nicholas", "steve": "steven", "greg": "gregory",
}
# Lines of business that are taken as such even where names are too few to learn them.
COMMON_LINES = (
    "aerospace", "automotive", "building", "products", "chemicals", "dental", "management", "education", "energy", "systems", "environmental",
    "services", "fitness", "food", "distribution", "health", "industries", "insurance", "international", "logistics", "manufacturing", "media",
    "packaging", "pharma", "restaurants", "security", "software", "solutions", "staffing", "technologies", "partners", "capital", "financial",
)
ROMAN = {"ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10}

#: A line of business stands beside words as many as this share of the names, and so many at least.
LINE_SHARE, LINE_LEAST = 0.005, 20
#: Words of lines that the driver reads: names of k words have k * (k - 1) / LINE_SHARE at most.
MAX_LINES = 20_000
#: Weights of the rewriting rules, and the score from which a rewriting is a link.
RULES = {"same": 9.0, "nickname": 1.0, "slip": 1.0, "slips": 0.6, "letter": 0.5, "initial": 0.5}
ACCEPT = 0.3


def _plain(text: str) -> str:
    s = unicodedata.normalize("NFKD", text.replace("’", "'"))
    return "".join(c for c in s if not unicodedata.combining(c)).lower()


def typed_as(a: str, b: str, edits: int = 2) -> bool:
    """Whether one of two words becomes the other by typing slips.

    Slips are a letter dropped, doubled or swapped with its neighbour, and 0 or 1 for o or l;
    another letter in place of one is no slip. Words under 8 letters bear one slip.
    """
    return _slips(a, b, edits) is not None


def _slips(a: str, b: str, edits: int = 2) -> int | None:
    """The number of typing slips between two words, if few enough."""
    a, b = a.replace("0", "o").replace("1", "l"), b.replace("0", "o").replace("1", "l")
    if a == b:
        return 0
    if abs(len(a) - len(b)) > edits or min(len(a), len(b)) < 3 or len(set(a) - set(b)) > edits or len(set(b) - set(a)) > edits or levenshtein(a, b) > 2 * edits:
        return None

    def slip(x: str, y: str, left: int) -> int | None:
        i = 0
        while i < min(len(x), len(y)) and x[i] == y[i]:
            i += 1
        x, y = x[i:], y[i:]
        if x == y:
            return 0
        if not left:
            return None
        ways = []
        if len(x) > 1 and len(y) > 1 and x[0] == y[1] and x[1] == y[0]:
            ways.append(slip(x[2:], y[2:], left - 1))
        if x:
            ways.append(slip(x[1:], y, left - 1))
        if y:
            ways.append(slip(x, y[1:], left - 1))
        return min((w + 1 for w in ways if w is not None), default=None)

    n = slip(a, b, 1 if max(len(a), len(b)) < 8 else edits)
    return n if n is not None and (len(a) != len(b) or sorted(a) == sorted(b)) else None


def abbreviates(short: str, word: str) -> bool:
    """Whether ``short`` is a beginning of ``word``, or its letters without most vowels."""
    if not 2 < len(short) <= len(word) - 2 or short[0] != word[0]:
        return False
    if word.startswith(short):
        return True
    at = 0
    for c in short:
        at = word.find(c, at) + 1
        if not at:
            return False
    return sum(c in "aeiou" for c in short[1:]) <= 1


class Lines:
    """The words of lines of business, with their abbreviations and slips."""

    def __init__(self, words: list[str]) -> None:
        """``words`` come with the more frequent first."""
        self.heads: list[str] = []
        self.memo: dict[str, str | None] = {}
        for w in words:
            if w not in LEGAL and w not in self.heads and self.variant(w) is None:
                self.heads.append(w)

    def variant(self, w: str) -> str | None:
        """The line's word of which ``w`` is the beginning, the letters, or a mistyping."""
        found = next((x for x in self.heads if x.startswith(w) and abbreviates(w, x)), None) or next((x for x in self.heads if abbreviates(w, x)), None)
        if found is None and len(w) >= 4:
            found = next((x for x in (*self.heads, *LEGAL_LONG) if len(x) > 3 and abs(len(x) - len(w)) <= 2 and typed_as(w, x)), None)
        return found

    def word(self, w: str) -> str | None:
        """The line's word or legal word that ``w`` is, perhaps shortened or mistyped."""
        if w in LEGAL or w in self.heads:
            return w
        if w not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[w] = self.variant(w)
        return self.memo[w]


def parse_name(text: str, lines: Lines) -> tuple[list[str], str, int, list[str]]:
    """(core words, line, numeral, brands) of a name; a bare brand has one core word and no line."""
    s = _plain(" ".join(text.split()))
    brands = []
    if m := re.fullmatch(r"([^\s(]+) \(([^()]*\s[^()]*)\)\W*", s):
        if not re.match(r"d/?b/?a|doing business|a/?k/?a|f/?k/?a", m[2].strip("\"'")):
            # a brand with its full name behind it
            brands.append(re.sub(r"[^a-z0-9]", "", m[1]))
            s = m[2]

    def aside(m: re.Match) -> str:
        inner = m[1].strip().strip("\"'")
        inner = re.sub(r"^(?:d/?b/?a|dba|doing business as|a/?k/?a|f/?k/?a)\b\.?\s*", "", inner)
        if re.search(r"[a-z]", inner) and len(inner) > 2:
            brands.append(re.sub(r"[^a-z0-9]", "", inner))
        return " "

    s = re.sub(r"\(([^)]*)\)", aside, s)
    s = re.sub(r"\b(?:dba|d/b/a)\b.*$", lambda m: brands.append(re.sub(r"[^a-z0-9]", "", re.sub(r"^(?:dba|d/b/a)", "", m[0]))) or " ", s)
    s = s.replace("'", "")
    s = re.sub(r"\b(l)\.\s?(l)\.\s?(c)\b\.?", "llc", s)
    s = re.sub(r"\b(l)\.\s?(p)\b\.?", "lp", s)
    words = re.findall(r"[a-z0-9]+", s)
    core, line, numeral = [], [], 1
    for k, w in enumerate(words):
        if w in ROMAN and k:
            numeral = ROMAN[w]
        elif w.isdecimal() and len(w) == 1 and k:
            numeral = int(w)
        elif (known := lines.word(w)) is None:
            core.append(w)
        elif known not in LEGAL and known not in LEGAL_LONG:
            line.append(known)
    return core, " ".join(sorted(set(line))), numeral, [b for b in brands if b]


def learn_lines(names: DataFrame, seeds: tuple[str, ...] = COMMON_LINES) -> Lines:
    """The lines of business of ``names`` (name): words beside many different words, and ``seeds``."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.regexp_replace("name", r"\([^)]*\)|['’]", "")), F.lit("[a-z]{3,}"), F.lit(0)))
    words = F.array_except(words, F.array(*[F.lit(w) for w in sorted(LEGAL)]))
    # outer, as else a filter on the words is told of every row that the names are drawn from
    pairs = names.select(words.alias("w")).select("w", F.explode_outer("w").alias("word")).select("word", F.explode_outer("w").alias("beside")).where("word <> beside")
    beside = pairs.groupBy("word").agg(F.approx_count_distinct("beside").alias("k"))
    least = max(LINE_LEAST, LINE_SHARE * names.count())
    found = beside.where(F.col("k") >= least).orderBy(F.desc("k"), "word").limit(MAX_LINES + 1).collect()
    if len(found) > MAX_LINES:
        raise ValueError(f"more than {MAX_LINES} words of lines of business")
    return Lines([*[r.word for r in found], *seeds])


_PARSED = "name string, n bigint, core string, line string, numeral int, brands array<string>, words array<string>, alias string"


def _parsing(lines: Lines):
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, n in zip(pdf["name"], pdf["n"]):
                core, line, numeral, brands = parse_name(name, lines)
                rows.append((name, n, "".join(core), line, numeral, brands, core, "".join(NICKNAMES.get(w, w) for w in core)))
            yield pd.DataFrame(rows, columns=["name", "n", "core", "line", "numeral", "brands", "words", "alias"])

    return parse


def core_forms(words: Column, alias: Column) -> Column:
    """Hashes of the forms of a core: in either order, as its nicknames' names, with an initial, less one letter."""
    joined = F.array_join(words, "")
    turned = F.array_join(F.concat(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 1, 1)), "")
    whole = F.array_distinct(F.array(joined, turned, alias))
    less = F.transform(whole, lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w)))))
    first = F.transform(words, lambda w, i: F.concat(F.lit("^"), F.substring(w, F.lit(1), F.lit(1)), F.lit("|"), F.array_join(F.concat(F.slice(words, F.lit(1), i), F.slice(words, i + 2, F.size(words))), "")))
    forms = F.concat(whole, F.flatten(less), F.when(F.size(words) > 1, first).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.transform(F.filter(forms, lambda f: F.length(f) > 1), lambda f: F.xxhash64(f)))


def brand_forms(words: Column) -> Column:
    """The brands that core words make: one word with the beginning of another."""
    both = F.flatten(F.transform(words, lambda a, i: F.transform(F.filter(words, lambda b, j: i != j), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    cut = F.transform(both, lambda p: F.transform(F.sequence(F.lit(3), F.greatest(F.length(p["b"]), F.lit(3))), lambda n: F.concat(p["a"], F.substring(p["b"], F.lit(1), n))))
    return F.array_distinct(F.flatten(cut))


def rewriting(a: list[str], b: list[str]) -> tuple[str, str, str] | None:
    """(rule, word of a, word of b) by which core ``a`` is a rewriting of ``b``; the words are those that differ."""
    turned = lambda w: [*w[1:], w[0]] if w else w
    join = "".join
    if join(a) in (join(b), join(turned(b))) or join(turned(a)) == join(b):
        return "same", "", ""
    best = None
    for x in (a, turned(a)) if len(a) > 1 else (a,):
        if len(x) == len(b):
            off = [(p, q) for p, q in zip(x, b) if p != q]
            if all(NICKNAMES.get(p, p) == NICKNAMES.get(q, q) for p, q in off):
                return "nickname", "", ""
            if len(off) == 1 and 1 in (len(off[0][0]), len(off[0][1])) and off[0][0][0] == off[0][1][0]:
                return "initial", *off[0]
        else:
            off = []
        p, q = off[0] if len(off) == 1 else (join(x), join(b))
        n = _slips(join(x), join(b))
        if n is not None and len(join(x)) > 3:
            found = ("slip" if n < 2 else "slips", p, q)
        elif len(p) == len(q) > 3 and levenshtein(p, q) == 1:
            found = ("letter", p, q)
        else:
            continue
        if best is None or RULES[found[0]] > RULES[best[0]]:
            best = found
    return best


def _rewritings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for u, v, aw, bw in zip(pdf["u"], pdf["v"], pdf["aw"], pdf["bw"]):
            if found := rewriting(list(aw), list(bw)):
                rows.append((u, v, *found, RULES[found[0]]))
        yield pd.DataFrame(rows, columns=["u", "v", "rule", "p", "q", "weight"])


def components(links: DataFrame) -> DataFrame:
    """(id, part) of the ends of ``links`` (u, v): the least id that each reaches, until nothing changes."""
    e = stored(links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    part = checkpointed(e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("v")).select("id", F.least("id", "v").alias("part")))
    while True:
        near = e.join(part.withColumnRenamed("id", "v"), "v").groupBy(F.col("u").alias("id")).agg(F.min("part").alias("least"))
        new = part.join(near, "id").select("id", F.col("part").alias("was"), F.least("part", "least").alias("part"))
        jump = new.select(F.col("id").alias("part"), F.col("part").alias("next"))
        part = checkpointed(new.join(jump, "part").select("id", "was", F.least("part", "next").alias("part")))
        if part.where("part <> was").isEmpty():
            return part.select("id", "part")
        part = part.select("id", "part")


def entity_classes(names: DataFrame, uses: DataFrame, seeds: tuple[str, ...] = COMMON_LINES) -> DataFrame:
    """(name, own, line, numeral, how, rarity): the entities of each distinct name.

    ``names`` has (name, n): distinct names with their number of rows. ``uses`` has
    (name, other): names that rows state of one entity. ``own`` is the most used core of an
    entity's component, ``rarity`` the best score of the links that a name's core has.
    """
    names = names.where(F.trim("name") != "")
    parsed = stored(names.select("name", "n").mapInPandas(_parsing(learn_lines(names, seeds)), _PARSED))
    lined = F.col("line") != ""
    cores = parsed.where("core <> ''").groupBy("core").agg(
        F.sum("n").alias("n"), F.max_by(F.struct("words", "alias"), F.struct(F.size("words"), "n", "name")).alias("w"),
        F.collect_set(F.when(lined, F.xxhash64("line", "numeral"))).alias("lines"),
    )
    cores = stored(cores.select(F.xxhash64("core").alias("id"), "core", "n", "w.words", "w.alias", "lines"))
    # one form has few cores: as many as there are ways to put one letter into it
    forms = cores.select("id", F.explode(core_forms(F.col("words"), F.col("alias"))).alias("form"))
    met = forms.groupBy("form").agg(F.sort_array(F.collect_list("id")).alias("ids")).where(F.size("ids") > 1)
    pairs = F.flatten(F.transform("ids", lambda a, i: F.transform(F.slice("ids", i + 2, F.size("ids")), lambda b: F.struct(a.alias("u"), b.alias("v")))))
    met = met.select(F.inline(pairs)).distinct()
    side = lambda k, w, x: cores.select(F.col("id").alias(k), F.col("words").alias(w), F.col("lines").alias(x))
    met = met.join(side("u", "aw", "al"), "u").join(side("v", "bw", "bl"), "v")
    # two cores that state lines, but none in common, are two borrowers
    met = met.where((F.size("al") == 0) | (F.size("bl") == 0) | F.arrays_overlap("al", "bl")).select("u", "v", "aw", "bw")
    found = stored(met.mapInPandas(_rewritings, "u bigint, v bigint, rule string, p string, q string, weight double"))
    # the other words beside which a word stands, told by their first letters, as slips are rare there
    beside = F.flatten(F.transform("words", lambda a, i: F.transform(F.filter("words", lambda b, j: i != j), lambda b: F.struct(a.alias("word"), F.substring(b, F.lit(1), F.lit(3)).alias("beside")))))
    beside = cores.select(F.inline(beside)).groupBy("word").agg(F.count_distinct("beside").alias("k"))
    k = lambda c, x: beside.select(F.col("word").alias(c), F.col("k").alias(x))
    scored = found.join(k("p", "kp"), "p", "left").join(k("q", "kq"), "q", "left").fillna(1, ["kp", "kq"])
    rare, common = F.least("kp", "kq"), F.greatest("kp", "kq")
    # an initial is worth less the more full words it may stand for
    short = F.when(F.col("rule") == "initial", F.when(F.length("p") == 1, F.col("u")).otherwise(F.col("v"))).otherwise(F.xxhash64("u", "v"))
    initial = F.count("*").over(Window.partitionBy(short))
    score = F.when(F.col("rule") == "initial", F.col("weight") / initial).when(F.col("rule") == "same", F.lit(1.0)).otherwise(F.col("weight") / (1 + (rare - 1) * rare / common))
    links = scored.select("u", "v", score.alias("rarity")).where(F.col("rarity") >= ACCEPT)
    # rows that state two names of one entity link their cores as they are
    known = parsed.where((F.col("core") != "") & lined).select("name", F.xxhash64("core").alias("u"), F.xxhash64("line", "numeral").alias("x"))
    stated = uses.where("name < other").join(known, "name").join(known.select(F.col("name").alias("other"), F.col("u").alias("v"), F.col("x").alias("y")), "other")
    links = stored(links.unionByName(stated.where("u <> v and x = y").select("u", "v", F.lit(1.0).alias("rarity"))))
    part = components(links)
    best = links.select(F.explode(F.array("u", "v")).alias("id"), "rarity").groupBy("id").agg(F.max("rarity").alias("rarity"))
    own = cores.select("id", "core", "n", "words").join(part, "id", "left").join(best, "id", "left")
    head = own.where("part is not null").groupBy("part").agg(F.max_by(F.struct("core", "words"), F.struct("n", "core")).alias("h"))
    own = own.join(head, "part", "left").select("core", F.coalesce("h.core", "core").alias("own"), F.coalesce("h.words", "words").alias("words"), F.coalesce("rarity", F.lit(1.0)).alias("rarity"))
    p = parsed.select("name", "n", "core", "line", "numeral", "brands").join(own, "core", "left")
    p = stored(p.withColumn("own", F.coalesce("own", "name")))
    full = p.where(lined).select("name", "own", "line", "numeral", F.lit("full").alias("how"), "rarity")

    # names without a line: by the rows that use them, else the only entity they fit
    bare = p.where(~lined)
    users = full.select(F.col("name").alias("other"), F.struct("own", "line", "numeral").alias("e"))
    used = bare.select("name").join(uses, "name").join(users, "other").select("name", "e").distinct()
    used = stored(used)
    left = bare.join(used.select("name").distinct(), "name", "left_anti")
    entities = full.select("own", "line", "numeral").distinct()
    marks = p.where(lined).groupBy("own", "line", "numeral").agg(F.flatten(F.collect_set("brands")).alias("brands"), F.first("words").alias("words"))
    marks = marks.select(F.struct("own", "line", "numeral").alias("e"), F.explode(F.array_distinct(F.concat("brands", brand_forms(F.col("words"))))).alias("brand"))
    by_core = left.select("name", "own", F.col("numeral").alias("k"), "rarity").join(entities, "own").where("k = 1 or k = numeral").select("name", F.struct("own", "line", "numeral").alias("e"), "rarity")
    by_brand = left.select("name", F.col("core").alias("brand"), "rarity").join(marks, "brand").select("name", "e", "rarity")
    fit = stored(by_core.unionByName(by_brand).groupBy("name").agg(F.count_distinct("e").alias("k"), F.min("e").alias("e"), F.max("rarity").alias("rarity")))
    alone = left.join(fit, "name", "left_anti").select("name", "own", "line", "numeral", F.lit("alone").alias("how"), F.lit(1.0).alias("rarity"))
    told = lambda d, how, r: d.select("name", "e.own", "e.line", "e.numeral", F.lit(how).alias("how"), r.alias("rarity"))
    return stored(full.unionByName(told(used, "rows", F.lit(1.0))).unionByName(told(fit.where("k = 1"), "only", F.col("rarity"))).unionByName(alone))


def variant_pairs(classes: DataFrame) -> DataFrame:
    """(name_a, name_b) of distinct names of one entity, name_a before name_b.

    An entity has as many names as people found ways to write it, not as it has rows.
    """
    c = classes.select("own", "line", "numeral", "name").distinct()
    a, b = c.withColumnRenamed("name", "name_a"), c.withColumnRenamed("name", "name_b")
    return a.join(b, ["own", "line", "numeral"]).where(F.col("name_a") < F.col("name_b")).select("name_a", "name_b").distinct()

"""Free wordings to the closest entry of a reference list (problem 4).

Distinct wordings are reduced to plain words (case, accents, marks and look-alike digits
undone, abbreviations written out). Two searches then run over BK-trees under the Levenshtein
metric, which return every form within the threshold by triangle-inequality pruning:

1. Whole wordings against the entries' labels, their words in any rotation, and their
   unambiguous beginnings.
2. Where none is near, word by word: each word of the wording against the words of every
   entry's label and of its note, the text that says what the entry covers. The words found
   are weighed by how few entries have them; a word that no entry has weighs against all.
   The entry of the largest weight is meant if it explains more of the wording than is left.

The reference is cut by entries into shards of bounded size, each broadcast and searched
apart; word weights are those of the whole reference, and the shards' winners merge in the
order in which one tree would choose, so that the cut changes nothing. Only distinct wordings
are searched. What no entry is near to is reported with entry 0.

Defined results: a null wording gives no row, one without a letter or digit is entry 0; ties go
to the smaller entry number; an empty reference maps every wording to 0; entries without a note
have their label only; only the columns named are read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.metric import BKTree, levenshtein
from tallyforge.session import dealt, stored

#: Entries in one shard.
MAX_SHARD_ENTRIES = 2_000

# Abbreviations, and other forms of a word that no ending tells.
ABBREVIATIONS = {
    "ln": "loan", "rev": "revolver", "dlyd": "delayed", "com": "common", "stk": "stock", "pfd": "preferred",
    "pref": "preferred", "wrnt": "warrant", "wts": "warrants", "sr": "senior", "sub": "subordinated", "nt": "note",
    "nts": "notes", "mezz": "mezzanine", "pship": "partnership", "pshp": "partnership", "mbrshp": "membership", "int": "interest",
    "unsec": "unsecured", "struct": "structured", "tr": "tranche", "fin": "finance", "transp": "transportation",
    "equip": "equipment", "distrib": "distribution", "med": "medical", "dev": "devices", "pkg": "packaging",
    "matls": "materials", "prod": "products", "prods": "products", "prodn": "production", "mach": "machinery",
    "indl": "industrial", "elec": "electric", "utils": "utilities", "ins": "insurance", "brkg": "brokerage",
    "aero": "aerospace", "comp": "components", "sftwr": "software", "svcs": "services", "serv": "services",
    "educ": "education", "environ": "environmental", "spec": "specialty", "chem": "chemicals", "hlth": "health",
    "prvdrs": "providers", "info": "information", "tech": "technology", "consltg": "consulting",
    "prof": "professional", "bldg": "building", "facil": "facilities", "auto": "automotive",
    "telecom": "telecommunications", "telecomms": "telecommunications", "pharma": "pharmaceuticals",
    "hr": "human resources", "tl": "term loan", "ddtl": "delayed draw term loan", "rcf": "revolving credit facility",
    "1st": "first", "2nd": "second", "1l": "first lien", "2l": "second lien", "lp": "limited partnership",
    "llc": "limited liability company", "healthcare": "health care",
    "lending": "loans", "lender": "loan", "lenders": "loans",
}
# Words that tell no entries apart.
COMMON_WORDS = set("a an and as any also by called for from in into is of on or other others such that the their to used with including class series".split())

_TAIL = re.compile(r"\s*[(\[](?:usd|eur|euro|€|gbp|£|sterling|cad|aud|sek|nok|chf|(?:[a-z]+ )?(?:dollar|kron[ae]|franc|pound))[^)\]]*[)\]]\s*$")
_MARKS = re.compile(r"(?:\s*(?:\((?:\d{1,2}[a-z]?|[a-z])\)|\[(?:\d{1,2}|[a-z])\]|[*†‡#.]+|(?<=\s)\d{1,2}))+\s*$")

#: Weights of a word of a label, and of a note; of a word that other entries have; of one that none has.
IN_LABEL, IN_NOTE, ELSEWHERE, UNKNOWN = 1.0, 0.8, 0.5, 1.25

#: Words decide if the entry's weight exceeds what is left, if its whole label is said, or half of it and mostly.
WHOLE_LABEL, HALF_LABEL, MOSTLY = 0.999, 0.5, 0.6


def words_of(text: str) -> list[str]:
    """The plain words of ``text``, abbreviations as they are."""
    s = unicodedata.normalize("NFKD", text)
    s = "".join(c for c in s if not unicodedata.combining(c)).lower()
    s = _MARKS.sub("", _TAIL.sub("", " ".join(s.split())))
    s = re.sub(r"\bl[. ]{1,2}l[. ]{1,2}c\b", "llc", re.sub(r"\bl[. ]{1,2}p\b", "lp", s))
    out = []
    for w in re.findall(r"[a-z0-9]+", s.replace("'", "")):
        if len(w) > 2 and not re.fullmatch(r"\d+(?:st|nd|rd|th)?|1st\w?|2nd\w?", w):
            w = w.replace("0", "o").replace("1", "l")
        if w != "and" and not (w.isdecimal() and len(w) < 3):
            out.append("to" if w == "t0" else w)
    return out


def plain_form(text: str) -> str:
    """``text`` without what does not tell entries apart."""
    return " ".join(ABBREVIATIONS.get(w, w) for w in words_of(text))


def threshold(form: str) -> int:
    """Edits within which a wording still means a form: a swap of letters is two."""
    n = len(form)
    return 0 if n < 4 else 1 if n < 6 else 2 if n < 9 else 3 if n < 20 else 4


def _stem(word: str) -> str:
    """``word`` without the endings of number and kind."""
    for end in ("ations", "ation", "ional", "ions", "ion", "ials", "ial", "ings", "ing", "ies", "ers", "ist", "er", "ed", "es", "al", "s", "y", "e"):
        if word.endswith(end) and len(word) - len(end) >= 4:
            return word[: -len(end)]
    return word


def _swapped(a: str, b: str) -> bool:
    """Whether two words differ by neighbours that changed places."""
    return len(a) == len(b) and sorted(a) == sorted(b) and levenshtein(a, b) <= 2


class _Shard:
    """Trees over the forms of some entries, and over the words of the whole reference."""

    def __init__(self, rows: list[tuple], weights: dict[tuple[str, str], tuple[float, float]]) -> None:
        self.weights = weights
        self.memo: dict[tuple[str, str, bool], dict[str, float]] = {}
        whole: dict[tuple[str, str], list[int]] = {}
        begin: dict[tuple[str, str], list[int]] = {}
        self.has: dict[tuple[str, str], dict[int, float]] = {}
        self.labels: dict[int, list[str]] = {}
        for kind, entry, forms, beginnings, words in rows:
            for f in forms:
                whole.setdefault((kind, f), []).append(entry)
            for f in beginnings:
                begin.setdefault((kind, f), []).append(entry)
            for w, x in words:
                self.has.setdefault((kind, w), {})[entry] = x
            self.labels[entry] = [w for w, x in words if x == IN_LABEL]
        self.forms = (whole, begin)
        self.trees = [{k: BKTree([f for kk, f in d if kk == k]) for k in {k for k, _ in d}} for d in self.forms]
        self.short = BKTree([a for a in ABBREVIATIONS if len(a) > 2])
        self.stems: dict[str, dict[str, list[str]]] = {}
        for k, w in weights:
            self.stems.setdefault(k, {}).setdefault(_stem(w), []).append(w)
        self.words = {kind: BKTree([w for k, w in weights if k == kind]) for kind in self.stems}
        self.roots = {k: BKTree(list(d)) for k, d in self.stems.items()}
        self.unknown = {kind: UNKNOWN * max(x for (k, _), (x, _) in weights.items() if k == kind) for kind in self.stems}

    def most(self, kind: str, word: str, last: bool) -> float:
        """The largest weight that ``word`` has in any entry of the reference."""
        return max((y * self.weights[kind, w][0] * self.weights[kind, w][1] for w, y in self.near(kind, word, last).items()), default=0.0)

    def expand(self, kind: str, words: list[str]) -> list[str]:
        """``words`` with abbreviations, perhaps mistyped or cut short, written out, and split words joined."""
        out = []
        for k, w in enumerate(words):
            if (kind, w) in self.weights and w not in ("1st", "2nd"):
                out.append(w)
                continue
            if w not in ABBREVIATIONS and len(w) >= 4 and kind in self.words and not self.near(kind, w, False):
                near = {a for d, a in self.short.within(w, 2) if (d == 1 or _swapped(a, w)) and (len(a) > 3 or (len(w) == 4 and set(a) <= set(w)))}
                near |= {a for a in ABBREVIATIONS if k == len(words) - 1 and a.startswith(w)}
                if len({ABBREVIATIONS[a].rstrip("s") for a in near}) == 1:
                    w = min(near)
            out += ABBREVIATIONS.get(w, w).split()
        k = 0
        while kind in self.words and k + 1 < len(out):
            both = out[k] + out[k + 1]
            if len(both) >= 6 and not self.near(kind, out[k], False) and self.most(kind, both, False) > self.most(kind, out[k + 1], k + 2 == len(out)):
                out[k : k + 2] = [both]
            k += 1
        return out

    def by_form(self, kind: str, form: str, rank: int) -> tuple | None:
        """The least (inexact, rank, distance, entry) of labels (0) or beginnings (1) within the threshold."""
        forms, trees = self.forms[rank], self.trees[rank]
        if (kind, form) in forms:
            return False, rank, 0, min(forms[kind, form])
        near = trees[kind].within(form, max(0, threshold(form) - rank)) if kind in trees else ()
        return min(((True, rank, d, min(forms[kind, f])) for d, f in near if d <= threshold(f)), default=None)

    def search(self, kind: str, words: list[str]) -> tuple[tuple | None, tuple | None]:
        """What forms and what words say; forms near to a beginning are asked only where neither label nor words tell."""
        words = self.expand(kind, words)
        if not words:
            return None, None
        form = " ".join(words)
        hit = self.by_form(kind, form, 0)
        if hit is None and (kind, form) in self.forms[1]:
            hit = self.by_form(kind, form, 1)
        if hit:
            return hit, None
        said = self.by_words(kind, words)
        return (None if said and said[0] else self.by_form(kind, form, 1)), said

    def near(self, kind: str, word: str, last: bool) -> dict[str, float]:
        """Words of the reference that are ``word`` or near to it, with their likeness."""
        if (kind, word, last) in self.memo:
            return self.memo[kind, word, last]

        def around(tree: BKTree, w: str) -> dict[str, float]:
            n = len(w)
            found = tree.within(w, 0 if n < 4 else 2)
            return {x: 1 - 0.1 * d for d, x in found if d <= (1 if n < 7 else 2) or _swapped(x, w)}

        # a word of the reference, in whatever number, needs no search
        known = [word] if (kind, word) in self.weights else self.stems[kind].get(_stem(word), [])
        if known:
            self.memo[kind, word, last] = {w: 0.95 for w in self.stems[kind].get(_stem(word), [])} | {w: 1.0 for w in known if w == word}
            return self.memo[kind, word, last]
        hits = around(self.words[kind], word)
        for root, likeness in around(self.roots[kind], _stem(word)).items():
            for w in self.stems[kind][root]:
                hits[w] = max(hits.get(w, 0), likeness - 0.05)
        if len(word) >= 4 or (last and len(word) == 3):
            # a word cut short, or a longer one of the same beginning
            for w in (w for ws in self.stems[kind].values() for w in ws):
                if w.startswith(word) and w not in hits:
                    hits[w] = 0.9 if last else 0.8
        self.memo[kind, word, last] = hits
        return hits

    def by_words(self, kind: str, words: list[str]) -> tuple[bool, float, float, int] | None:
        """(meant, weight, share of its label, -entry) of the entry of most weight, among those meant if any is."""
        told = [w for w in words if w not in COMMON_WORDS and len(w) > 1]
        if kind not in self.words or not told:
            return None
        got: dict[int, list[float]] = {}
        for k, w in enumerate(told):
            for x, likeness in self.near(kind, w, k == len(told) - 1).items():
                for entry, where in self.has.get((kind, x), {}).items():
                    own = got.setdefault(entry, [0.0] * len(told))
                    own[k] = max(own[k], likeness * where * self.weights[kind, x][0])
        most = [self.most(kind, w, k == len(told) - 1) for k, w in enumerate(told)]
        best = None
        for entry, own in got.items():
            said = sum(self.weights[kind, w][0] for w in self.labels[entry] if any(self.same(w, t) for t in told))
            label = round(said / (sum(self.weights[kind, w][0] for w in self.labels[entry]) or 1.0), 9)
            weight = round(sum(own), 9)
            left = sum(self.unknown[kind] if m == 0 else ELSEWHERE * m for x, m in zip(own, most) if x == 0)
            meant = weight > left or label >= WHOLE_LABEL or (label >= HALF_LABEL and weight > MOSTLY * left)
            found = (meant, weight, label, -entry)
            best = found if best is None or found > best else best
        return best

    def same(self, word: str, told: str) -> bool:
        """Whether a label's word stands in a wording."""
        return word == told or _stem(word) == _stem(told) or _swapped(word, told) or (len(told) >= 6 and levenshtein(word, told) <= 1)


def reference_rows(entries: list[tuple[int, str, str, str | None]]) -> tuple[list[tuple], dict[tuple[str, str], tuple[float, float]]]:
    """The searchable rows (kind, entry, forms, beginnings, words) of entries (id, kind, label, note).

    With them, of each word of a kind its rarity and the most that any entry makes of it.
    """

    def rotations(words: list[str]) -> list[str]:
        return [" ".join(words[k:] + words[:k]) for k in range(len(words))]

    begin: dict[tuple[str, str], set[int]] = {}
    whole: dict[tuple[str, str], set[int]] = {}
    words: dict[tuple[int, str], dict[str, float]] = {}
    for i, kind, label, note in entries:
        form = plain_form(label)
        for f in rotations(form.split()):
            if f:
                whole.setdefault((kind, f), set()).add(i)
            for n in range(max(6, -(-len(f) * 11 // 20)), len(f)):
                for cut in rotations(f[:n].split()):
                    begin.setdefault((kind, cut), set()).add(i)
        has = words.setdefault((i, kind), {})
        # what a note writes in capitals is a name of the thing
        capitals = {w.lower() for w in re.findall(r"\b[A-Z]{2,}\b", note or "")}
        for w in words_of(note or ""):
            for x in ABBREVIATIONS.get(w, w).split():
                if x not in COMMON_WORDS and len(x) > 1:
                    has[x] = IN_LABEL if w in capitals else IN_NOTE
        for w in form.split():
            if w not in COMMON_WORDS:
                has[w] = IN_LABEL
    count: dict[tuple[str, str], int] = {}
    per: dict[str, int] = {}
    for (_, kind), has in words.items():
        per[kind] = per.get(kind, 0) + 1
        for w in {_stem(w) for w in has}:
            count[kind, w] = count.get((kind, w), 0) + 1
    weights: dict[tuple[str, str], tuple[float, float]] = {}
    for (_, kind), has in words.items():
        for w, x in has.items():
            weights[kind, w] = (math.log((per[kind] + 1) / count[kind, _stem(w)]), max(x, weights.get((kind, w), (0, 0))[1]))
    own: dict[int, list[str]] = {}
    for (k, f), ids in begin.items():
        if len(ids) == 1 and (k, f) not in whole:
            own.setdefault(next(iter(ids)), []).append(f)
    rows = []
    for i, kind, label, _ in sorted(entries, key=lambda e: e[0]):
        forms = rotations(plain_form(label).split())
        rows.append((kind, i, [f for f in forms if f], sorted(own.get(i, [])), sorted(words[i, kind].items())))
    return rows, weights


_FOUND = "kind string, text string, form struct<inexact:boolean,rank:int,d:int,entry:int>, words struct<meant:boolean,weight:double,label:double,minus:int>"


def _searching(kept):
    """Rows (kind, text, form, words) of batches of wordings."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = _Shard(*kept.value)
        memo: dict[tuple[str, str], tuple] = {}
        for pdf in batches:
            out = []
            for kind, text in zip(pdf["kind"], pdf["text"]):
                words = words_of(text)
                at = kind, " ".join(words)
                if at not in memo:
                    form, said = shard.search(kind, words)
                    memo[at] = (form and dict(zip(("inexact", "rank", "d", "entry"), form)), said and dict(zip(("meant", "weight", "label", "minus"), said)))
                out.append((kind, text, *memo[at]))
            yield pd.DataFrame(out, columns=["kind", "text", "form", "words"])

    return search


def closest_entries(wordings: DataFrame, entries: list[tuple[int, str, str, str | None]], max_shard: int = MAX_SHARD_ENTRIES) -> DataFrame:
    """(kind, text, entry, distance) for every distinct wording (kind, text); entry 0 means none.

    ``entries`` are (id, kind, label, note), ids above 0. ``distance`` is in edits where a whole
    form was near, null where words decided. Beginnings, which are short of letters already, are
    searched within one edit less than labels.
    """
    spark = wordings.sparkSession
    texts = dealt(wordings.select("kind", "text").where(F.col("text").isNotNull()).distinct())
    rows, weights = reference_rows(entries)
    shards = [rows[i : i + max_shard] for i in range(0, len(rows), max_shard)] or [[]]
    if len(shards) > 1:
        texts = stored(texts)
    found = None
    for shard in shards:
        kept = spark.sparkContext.broadcast((shard, weights))  # at most max_shard entries, and the reference's words
        part = texts.mapInPandas(_searching(kept), _FOUND)
        found = part if found is None else found.unionByName(part)
    if len(shards) > 1:
        # as many rows a wording as there are shards
        found = found.groupBy("kind", "text").agg(F.min("form").alias("form"), F.max("words").alias("words"))
    sure = F.col("form").isNotNull() & ~(F.col("form.inexact") & (F.col("form.rank") == 1))
    by_words = ~sure & F.coalesce("words.meant", F.lit(False))
    entry = F.when(by_words, -F.col("words.minus")).otherwise(F.coalesce("form.entry", F.lit(0)))
    return found.select("kind", "text", entry.cast("int").alias("entry"), F.when(~by_words, F.col("form.d")).alias("distance"))

"""The Levenshtein metric and a BK-tree over it."""

from __future__ import annotations


def levenshtein(a: str, b: str) -> int:
    """Edit distance, by Myers' bit vectors: one step of integer arithmetic a character of ``b``."""
    if a == b:
        return 0
    if not a or not b:
        return len(a) or len(b)
    n = len(a)
    peq: dict[str, int] = {}
    for i, ch in enumerate(a):
        peq[ch] = peq.get(ch, 0) | (1 << i)
    mask, last = (1 << n) - 1, 1 << (n - 1)
    pv, mv, score = mask, 0, n
    for ch in b:
        eq = peq.get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        ph = ((ph << 1) | 1) & mask
        mh = (mh << 1) & mask
        pv = mh | ~(xv | ph) & mask
        mv = ph & xv
    return score


class BKTree:
    """Entries under the edit metric; a search prunes by the triangle inequality and misses none."""

    def __init__(self, words: list[str]) -> None:
        self.words: list[str] = []
        self.children: list[dict[int, int]] = []
        for w in dict.fromkeys(words):
            self._add(w)

    def _add(self, w: str) -> None:
        self.words.append(w)
        self.children.append({})
        new = len(self.words) - 1
        at = 0
        while new:
            d = levenshtein(self.words[at], w)
            if d not in self.children[at]:
                self.children[at][d] = new
                return
            at = self.children[at][d]

    def within(self, w: str, threshold: int) -> list[tuple[int, str]]:
        """(distance, entry) of every entry at most ``threshold`` away."""
        out, stack = [], [0] if self.words else []
        while stack:
            at = stack.pop()
            d = levenshtein(self.words[at], w)
            if d <= threshold:
                out.append((d, self.words[at]))
            for k, child in self.children[at].items():
                if d - threshold <= k <= d + threshold:
                    stack.append(child)
        return out

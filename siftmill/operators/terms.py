"""Vocabulary met by words: a text's words are listed once, and only terms whose first word is among them are looked for.

So a text costs one pass over its words, however many terms there are, and one search for each term that it may hold."""

from __future__ import annotations

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = r"[\p{L}\p{N}]+"


#: Letters that a search in any case takes for another, though their lower case is another (fixed values).
_ODD, _EVEN = "ıſςµϐϑϕϖϰϱϵẛ", "isσμβθφπκρεṡ"


def folded(c: Column) -> Column:
    """Text in one case, as patterns that ignore case see it."""
    low = F.lower(F.replace(c, F.lit("İ"), F.lit("i")))
    # one range is met far faster than a class of single letters, and few texts have any of it
    return F.when(low.rlike(f"[{min(_ODD)}-{max(_ODD)}]") & low.rlike(f"[{_ODD}]"), F.translate(low, _ODD, _EVEN)).otherwise(low)


def fold(s: str) -> str:
    return s.replace("İ", "i").lower().translate(str.maketrans(_ODD, _EVEN))


def first_words(term: str) -> tuple[list[str], list[str]] | None:
    """Words one of which begins any place of the term: whole ones, and beginnings of words; None if it may begin in any way.
    A term's words may be written as one, so ``third party`` begins with ``third`` or with ``thirdparty``."""
    if term.startswith("re:"):
        return None
    body = term.removeprefix("cs:")
    words = [w for w in regex.split(r"[\s-]+", body.rstrip("*")) if w]
    whole, open_end = [], []
    for k in range(1, len(words) + 1):
        joined = fold("".join(words[:k]))
        run = regex.search(_WORD, joined)
        if not run:
            if k == len(words):
                return None
            continue
        goes_on = k == len(words) and body.endswith("*") and run.end() == len(joined)
        (open_end if goes_on else whole).append(run[0])
    return list(dict.fromkeys(whole)), list(dict.fromkeys(open_end))


class TermIndex:
    """First words of a vocabulary as a trie. ``present`` lists those that a text has, in one pass; ``may`` tells whether a term can
    be in it: a necessary condition, so that other terms need no search."""

    def __init__(self, terms: list[str]):
        first = {t: first_words(t) for t in terms}
        begins = sorted({b for f in first.values() if f for b in f[1]}, key=len)
        shortest: list[str] = []
        for b in begins:
            if not b.startswith(tuple(shortest)):
                shortest.append(b)
        key = lambda w: next((b for b in shortest if w.startswith(b)), w)  # noqa: E731  a word is met where its beginning is
        self.keys = {t: None if f is None else sorted({key(w) for w in (*f[0], *f[1])}) for t, f in first.items()}
        self.open = set(shortest)
        self.words = sorted({k for ks in self.keys.values() if ks for k in ks})

    def trie(self) -> str:
        """The words as one pattern that shares their beginnings, for folded text."""
        edge = r"(?![\p{L}\p{N}])"

        def node(words: list[str], at: int, whole: str) -> str:
            groups: dict[str, list[str]] = {}
            for w in words:
                groups.setdefault(w[at : at + 1], []).append(w)
            parts = [regex.sub(r"([^\p{L}\p{N}])", r"\\\1", c) + node(own, at + 1, whole + c) for c, own in groups.items() if c]
            if "" in groups:
                parts.append("" if whole in self.open else edge)
            return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"

        return r"(?<![\p{L}\p{N}])" + node(self.words, 0, "")

    def present(self, text: Column) -> Column:
        """First words of the vocabulary that the text has."""
        return F.array_distinct(F.regexp_extract_all(folded(text), F.lit(self.trie()), F.lit(0))) if self.words else F.array().cast("array<string>")

    def may(self, term: str, present: Column) -> Column:
        keys = self.keys[term]
        if keys is None:
            return F.lit(True)
        return F.array_contains(present, keys[0]) if len(keys) == 1 else F.arrays_overlap(present, F.array(*map(F.lit, keys)))

"""Vocabulary of terms: patterns, overlap-free hits in a text, named entities by alias."""

from __future__ import annotations

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

_HITS = ArrayType(StructType([StructField("term", StringType()), StructField("start", IntegerType()), StructField("weight", DoubleType())]))


def pattern(term: str) -> str:
    """Regular expression of a term: whole words, joined by a space, a hyphen or nothing; a final ``*`` lets the last word go
    on; any case, but for ``cs:``; ``re:`` is a pattern already. It means the same to Java and to ``regex``."""
    if term.startswith("re:"):
        return f"(?iu){term[3:]}"
    cased = term.startswith("cs:")
    body = term.removeprefix("cs:")
    words = [regex.sub(r"([^\p{L}\p{N}_])", r"\\\1", w) for w in regex.split(r"[\s-]+", body.rstrip("*")) if w]
    tail = r"[\p{L}\p{N}]*" if body.endswith("*") else ""
    return ("" if cased else "(?iu)") + r"(?<![\p{L}\p{N}])" + r"[\s\-]?".join(words) + tail + r"(?![\p{L}\p{N}])"


def hits(text: Column, terms: dict[str, float]) -> Column:
    """``array<struct<term, start, weight>>`` in order of place: each term's first match, and of those that overlap the
    heaviest, then the longest, then the earliest. Null or empty texts give an empty array."""
    compiled = [(t, w, pattern(t)) for t, w in terms.items()]

    def chosen(s: str | None) -> list[tuple[str, int, float]]:
        found = [(-w, m.start() - m.end(), m.start(), t) for t, w, p in compiled if s and (m := regex.search(p, s))]
        taken: list[tuple[int, int, str, float]] = []
        for w, size, start, t in sorted(found):
            if all(start - size <= a or b <= start for a, b, _, _ in taken):
                taken.append((start, start - size, t, -w))
        return [(t, a, w) for a, _, t, w in sorted(taken)]

    @F.pandas_udf(_HITS)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(chosen)

    any_term = "|".join(f"(?:{p})" for _, _, p in compiled) or r"(?!)"
    return run(F.when(text.rlike(any_term), text))  # texts without any term reach Python as nulls


def term_counts(df: DataFrame, text: str, terms: dict[str, float]) -> DataFrame:
    """``term, n``: texts in which each term is a chosen hit."""
    found = df.select(F.explode(hits(F.col(text), terms)).alias("h")).select("h.term")
    return found.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def entities(df: DataFrame, key: str, text: str, aliases: dict[str, str]) -> DataFrame:
    """``key, name, start`` (one row a name and text, at its first mention) for aliases (alias -> name), the longest of
    overlapping aliases counting."""
    found = df.select(key, F.explode(hits(F.col(text), dict.fromkeys(aliases, 1.0))).alias("h"))
    names = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return found.select(key, names[F.col("h.term")].alias("name"), F.col("h.start").alias("start")).groupBy(key, "name").agg(F.min("start").alias("start"))

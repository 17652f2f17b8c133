"""Lexicon scoring with ordered, explainable drop rules. The lexicon is a parameter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmill.functions.text import half_up

#: (component, group, weight, pattern); component caps; factor of a hit in the lead.
LEXICON = (
    ("domain", "rights", 3.0, "license"), ("domain", "rights", 2.0, "mit "), ("domain", "money", 3.0, "[$£€]"),
    ("materiality", "that", 2.0, "(^|[^a-z])that([^a-z]|$)"), ("materiality", "with", 1.0, "(^|[^a-z])with([^a-z]|$)"),
    ("sector", "this", 1.0, "(^|[^a-z])this([^a-z]|$)"), ("noise", "shout", 2.0, "!!"),
)
CAPS = {"domain": 8.0, "materiality": 6.0, "sector": 5.0}
LEAD_FACTOR, PASS_AT = 0.5, 3.0


def hit(title: Column, lead: Column, weight: float, pattern: str) -> Column:
    return F.when(title.rlike(pattern), F.lit(weight)).when(lead.rlike(pattern), F.lit(weight * LEAD_FACTOR)).otherwise(F.lit(0.0))


def components(df: DataFrame, title: str = "title", lead: str = "lead", lexicon=LEXICON, caps=CAPS) -> DataFrame:
    """Adds one column per component and ``score``: the best hit of each group counts, groups are summed up to the
    component's cap, noise is taken off. One projection, no join: a lexicon is small, patterns are constants."""
    t, d = F.lower(F.coalesce(F.col(title), F.lit(""))), F.lower(F.coalesce(F.col(lead), F.lit("")))
    out = {}
    for name in dict.fromkeys(x[0] for x in lexicon):
        groups = []
        for g in dict.fromkeys(x[1] for x in lexicon if x[0] == name):
            hits = [hit(t, d, w, p) for c, own, w, p in lexicon if (c, own) == (name, g)]
            groups.append(F.greatest(*hits) if len(hits) > 1 else hits[0])
        total = reduce(lambda a, b: a + b, groups)
        out[name] = F.least(total, F.lit(caps[name])) if name in caps else total
    df = df.withColumns(out)
    plus = reduce(lambda a, b: a + b, [F.col(n) for n in out if n != "noise"])
    return df.withColumn("score", half_up(plus - (F.col("noise") if "noise" in out else F.lit(0.0)), 1))


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds; null if none does."""
    return reduce(lambda rest, r: F.when(r[1], F.lit(r[0])).otherwise(rest), reversed(rules), F.lit(None).cast("string"))


def stage_one(df: DataFrame, pass_at: float = PASS_AT) -> DataFrame:
    """``reason`` (null: passed) for rows with ``title``, ``lead`` and ``seen``, the first failing rule counting."""
    scored = components(df)
    rules = [
        ("seen", F.col("seen")), ("empty", F.coalesce(F.length("title"), F.lit(0)) == 0), ("table", F.col("title").contains(" | ")), ("marketing", F.col("title").rlike("!!")),
        ("off_domain", (F.col("domain") == 0) & (F.col("materiality") == 0)), ("below_threshold", F.col("score") < pass_at),
    ]
    return scored.withColumn("reason", first_reason(rules))


def funnel(df: DataFrame, source: str = "source") -> DataFrame:
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("input"), F.count_if(~F.col("seen")).alias("unseen"), F.count_if(F.col("reason").isNull()).alias("passed"))

"""Registered queries of the first stage with profiles; the vocabulary is this library's own, of words in the given texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftmill.operators import prefilter
from siftmill.operators.prefilter import Profile, Rules, Term
from siftmill.plans.queries import candidates, query

RULES = Rules(
    terms=(
        Term("domain", "licensing", 3.0, "license*", "strong"), Term("domain", "licensing", 2.0, "licensed under", "medium"), Term("domain", "licensing", 1.0, "free", "weak"),
        Term("domain", "wording", 2.0, "that", "strong"), Term("domain", "wording", 1.0, "with", "weak"), Term("domain", "wording", 1.0, "this", "weak"),
        Term("materiality", "scope", 2.0, "from"), Term("materiality", "scope", 1.0, "there"), Term("materiality", "formal", 3.0, "copyright"), Term("sector", "all", 2.0, "der"), Term("sector", "all", 1.0, "den"),
        Term("enterprise", "all", 2.0, "cs:The"), Term("noise", "shouting", 2.0, "re:[a-z]+!!"), Term("noise", "offers", 3.0, "buy"),
    ),
    profiles={"standard": Profile(3.0, noise=("shouting",)), "high_volume": Profile(4.0, True, ("shouting", "offers")), "lenient": Profile(1.5)},
    gated=("formal",), bare_headline=r"^[A-Z]{2,4} \d+$", event_segments=("events", "webinar"), roundups=(("weekly", r"(?i)week in review"),),
    marketing=(("offer", r"(?i)\bbuy\b", r"(?i)thieves"), ("sponsored", r"(?i)\bsponsored\b", None)), high_volume_hosts=r"(^|\.)example\.com$", class_profiles={"regulator": "lenient"},
)


def profiled(spark, sf_dir):
    k = F.col("doc_id")
    c = candidates(spark, sf_dir).withColumn("url", F.concat(F.lit("https://"), F.when(k % 4 == 0, "example.com").otherwise("example.org"), F.when(k % 13 == 0, "/events/").otherwise("/a/"), k.cast("string")))
    kind = F.when(k % 3 == 0, "regulator").otherwise("news")
    return c.withColumn("profile", prefilter.profile_of(RULES, F.lit(None).cast("string"), kind, F.col("url")))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'high_volume' WHEN doc_id % 3 = 0 THEN 'lenient' ELSE 'standard' END AS profile FROM documents")
def profile_choice(spark, sf_dir):
    return profiled(spark, sf_dir).select("doc_id", "profile")


@query()
def profiled_scores(spark, sf_dir):
    s = prefilter.scores(profiled(spark, sf_dir), RULES)
    return s.select("doc_id", "profile", F.array_join("domains", ",").alias("domains"), "domain", "materiality", "sector", "enterprise", "noise", "score", "strong_in_title")


@query()
def profiled_drops(spark, sf_dir):
    return prefilter.stage_one(profiled(spark, sf_dir), RULES).select("doc_id", "profile", "reason", "detail")

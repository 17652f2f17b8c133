"""Passes over the past: references of drafts through merged candidates to items, and what stands in the way of a pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmill.operators.similar import chain_root


def resolved_references(drafts: DataFrame, merged: DataFrame, archive: DataFrame, this_pass: Column) -> DataFrame:
    """``draft, update_of, item, problem`` of drafts with a reference.

    ``drafts``: draft, item_id (as assigned), candidate_ids, update_of (an item's or a candidate's id), at. ``merged``: candidate, into (the
    candidate that tells its story; chains are followed to their end, a cycle is an error). ``archive``: item_id, candidate_ids,
    at, pass_key (null: a live item). A candidate leads to the item that owns the end of its chain, in the archive or among
    the drafts. ``problem``: ``unknown``, ``self``, ``later`` (the item is newer than the draft: a reference never points ahead), ``later_pass`` (an
    item of a pass after this one, which will be planned anew), or ``twice`` (several items own the candidate)."""
    own = drafts.select("item_id", F.explode("candidate_ids").alias("candidate"), "at", this_pass.alias("pass_key")).union(archive.select("item_id", F.explode("candidate_ids").alias("candidate"), "at", "pass_key"))
    every = merged.select("candidate", "into").union(merged.join(merged.select(F.col("candidate").alias("into")), "into", "left_anti").select(F.col("into").alias("candidate"), F.lit(None).cast("string").alias("into")).distinct())
    ends = chain_root(every, "candidate", "into").select("candidate", F.col("root").alias("end"))
    owners = own.groupBy("candidate").agg(F.min(F.struct("item_id", "at", "pass_key")).alias("o"), F.count_distinct("item_id").alias("owners"))
    items = drafts.select("item_id", "at", this_pass.alias("pass_key")).union(archive.select("item_id", "at", "pass_key")).select(F.col("item_id").alias("update_of"), F.struct("item_id", "at", "pass_key").alias("i"))
    refs = drafts.where(F.col("update_of").isNotNull()).select("draft", F.col("item_id").alias("_own"), F.col("at").alias("_at"), "update_of")
    refs = refs.join(items, "update_of", "left").join(ends.withColumnRenamed("candidate", "update_of"), "update_of", "left")
    refs = refs.withColumn("candidate", F.coalesce("end", "update_of")).join(owners, "candidate", "left")
    found = F.coalesce("i", "o")
    problem = (
        F.when(found.isNull(), "unknown").when(F.col("i").isNull() & (F.col("owners") > 1), "twice").when(found["item_id"] == F.col("_own"), "self")
        .when(found["pass_key"] > this_pass, "later_pass").when(found["at"] > F.col("_at"), "later")
    )
    return refs.select("draft", "update_of", found["item_id"].alias("item"), problem.alias("problem"))


def pass_problems(judgments: DataFrame, candidates: DataFrame, drafts: DataFrame, sections: list[str], start: Column, until: Column, now: Column) -> DataFrame:
    """Violations ``rule, severity, entity, field, message`` of a pass's decisions.

    ``judgments``: candidate_id, section, draft; ``candidates``: candidate_id, at; ``drafts``: draft, section, at. A judged candidate is registered and
    published inside the window, its section one of the pass's; a draft lies in the window and in the section of its judgments;
    every registered candidate is judged; the window is closed."""
    row = lambda rule, entity, field, message: F.struct(F.lit(rule).alias("rule"), F.lit("error").alias("severity"), entity.cast("string").alias("entity"), F.lit(field).alias("field"), message.cast("string").alias("message"))
    inside = lambda c: F.coalesce((c >= start) & (c < until), F.lit(False))
    j = judgments.join(candidates.select("candidate_id", "at", F.lit(True).alias("known")), "candidate_id", "left").join(drafts.select("draft", F.col("section").alias("draft_section")), "draft", "left")
    judged = F.array_compact(F.array(
        F.when(F.col("known").isNull(), row("not_registered", F.col("candidate_id"), "candidate_id", F.col("candidate_id"))), F.when(F.col("known") & ~inside(F.col("at")), row("outside_window", F.col("candidate_id"), "at", F.col("at"))),
        F.when(F.col("section").isNotNull() & ~F.col("section").isin(*sections), row("section", F.col("candidate_id"), "section", F.col("section"))), F.when(F.col("draft").isNotNull() & ~F.col("section").eqNullSafe(F.col("draft_section")), row("draft_section", F.col("candidate_id"), "draft", F.col("draft_section"))),
    ))
    out = j.select(F.explode(judged).alias("v"))
    out = out.union(drafts.where(~inside(F.col("at"))).select(row("draft_outside", F.col("draft"), "at", F.col("at")).alias("v")))
    left = candidates.where(inside(F.col("at"))).join(judgments.select("candidate_id"), "candidate_id", "left_anti")
    out = out.union(left.select(row("unjudged", F.col("candidate_id"), "candidate_id", F.col("candidate_id")).alias("v")))
    spark = judgments.sparkSession
    return out.union(spark.range(1).where(until > now).select(row("open_window", F.lit("pass"), "until", until).alias("v"))).select("v.*")

"""Checks of judgments, drafts, runs and the ledger: each rule gives rows ``rule, severity, entity, field, message``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftmill.functions import dates, url
from siftmill.operators.checks import _row, collected, references, row_checks, unique

PUBLISHED, CARRIED = ("new", "material_update"), ("verdict", "reason_code", "section", "draft")


def published(verdict: Column, dedup: Column) -> Column:
    return (verdict == "pass") & dedup.isin(*PUBLISHED)


def _violations(df: DataFrame, rule: str, field: str, entity: str, message: str, severity: str = "error") -> DataFrame:
    return df.select(_row(rule, severity, F.col(entity), field, F.col(message)).alias("v")).select("v.*")


def judged_once(survivors: DataFrame, judgments: DataFrame, key: str = "candidate_id") -> DataFrame:
    """Survivors without a judgment, judgments of others, and judgments that repeat."""
    missing = survivors.select(key).distinct().join(judgments.select(key), key, "left_anti")
    return collected(_violations(missing, "unjudged", key, key, key), references(judgments, key, key, survivors, key, "no_survivor"), unique(judgments, key, "judged_twice"))


def cluster_members(judgments: DataFrame, key: str = "candidate_id") -> DataFrame:
    """Members merged into a cluster name its lead, which is no member itself, and carry the lead's verdict, code, section and draft."""
    lead = judgments.select(F.col(key).alias("match_id"), F.struct("dedup", *CARRIED).alias("lead"))
    m = judgments.where("dedup = 'cluster_merged'").join(lead, "match_id", "left")
    bare = (F.col("match_id") == F.col(key)) | F.col("lead").isNull()
    broken = [F.when(bare, _row("cluster_lead", "error", F.col(key), "match_id", F.col("match_id"))), F.when(~bare & (F.col("lead.dedup") == "cluster_merged"), _row("lead_is_member", "error", F.col(key), "match_id", F.col("match_id")))]
    broken += [F.when(~bare & ~F.col(c).eqNullSafe(F.col(f"lead.{c}")), _row("carries_lead", "error", F.col(key), c, F.col(f"lead.{c}"))) for c in CARRIED]
    return m.select(F.explode(F.array_compact(F.array(*broken))).alias("v")).select("v.*")


def draft_primaries(drafts: DataFrame, judgments: DataFrame, draft: str = "draft") -> DataFrame:
    """Drafts that not exactly one publishing judgment points to, and those that no judgment points to at all."""
    n = judgments.groupBy(draft).agg(F.count(F.lit(1)).alias("any"), F.count_if(published(F.col("verdict"), F.col("dedup"))).alias("primaries"))
    d = drafts.select(draft).join(n, draft, "left").fillna(0, ["any", "primaries"])
    return collected(_violations(d.where("primaries != 1"), "one_primary", draft, draft, "primaries"), _violations(d.where("any = 0"), "unreferenced", draft, draft, "any"))


def owned_once(drafts: DataFrame, ids: str, candidates: DataFrame, draft: str = "draft", key: str = "candidate_id") -> DataFrame:
    """Candidates that drafts attach: known ones, and each by one draft."""
    each = drafts.select(draft, F.explode(ids).alias(key))
    owners = each.groupBy(key).agg(F.count_distinct(draft).alias("n")).where("n > 1")
    return collected(references(each, draft, key, candidates, key, "unknown_candidate"), _violations(owners, "two_owners", key, key, "n"))


def provenance(drafts: DataFrame, ids: str, sources: str, candidates: DataFrame, draft: str = "draft", key: str = "candidate_id", address: str = "url") -> DataFrame:
    """Sources that are no address of the draft's own candidates."""
    own = drafts.select(draft, F.explode(ids).alias(key)).join(candidates.select(key, url.normalise(F.col(address)).alias("n")), key).select(draft, "n").distinct()
    used = drafts.select(draft, F.explode(sources).alias("used")).withColumn("n", url.normalise(F.col("used")))
    return _violations(used.join(own, [draft, "n"], "left_anti"), "no_provenance", sources, draft, "used")


def resurfaced(drafts: DataFrame, sources: str, archive: DataFrame, archive_sources: str, roots: DataFrame, draft: str = "draft", update: str = "update_of", item: str = "item_id") -> DataFrame:
    """Sources that a published item has already, unless the draft updates an item of the same chain (``roots``: item, root)."""
    old = archive.select(item, F.explode(archive_sources).alias("u")).select(item, url.normalise(F.col("u")).alias("n")).join(roots.select(item, "root"), item, "left")
    new = drafts.select(draft, update, F.explode(sources).alias("used")).withColumn("n", url.normalise(F.col("used")))
    new = new.join(roots.select(F.col(item).alias(update), F.col("root").alias("own_root")), update, "left")
    met = new.join(old, "n").groupBy(draft, "used").agg(F.max(F.coalesce(F.col("root") == F.col("own_root"), F.lit(False))).alias("same"))
    return _violations(met.where("NOT same"), "resurfaced", sources, draft, "used")


def ranked_order(df: DataFrame, key: str, position: str, rank: Column, rule: str, severity: str = "error") -> DataFrame:
    """Sources that stand behind one of lower standing: ``rank`` grows as standing falls; any earlier one counts."""
    worst = F.max(rank).over(Window.partitionBy(key).orderBy(position).rowsBetween(Window.unboundedPreceding, -1))
    return _violations(df.withColumn("_worst", worst).where(F.col("_worst") > rank), rule, position, key, position, severity)


def run_checks(runs: DataFrame, key: str = "run_id") -> DataFrame:
    """Rules of a run record: ``run_id, slot_at, started, finished, status, items`` (ids), ``in_window, unseen, stage1,
    stage2, published`` and ``mechanisms`` (map of counts)."""
    slot, n, c = F.col(key), F.size("items"), F.col
    starts = dates.slot_instant(slot)
    stem = F.date_format(F.try_to_timestamp(F.substring(slot, 1, 10), F.lit("yyyy-MM-dd")), "yyyy-MM-dd")
    down = [("in_window", "unseen"), ("unseen", "stage1"), ("stage1", "stage2"), ("stage2", "published")]
    rules = [
        ("run_id", "error", key, starts.isNotNull()), ("slot", "error", "slot_at", starts.isNull() | (c("slot_at") == starts)), ("finished_first", "error", "finished", c("finished") >= c("started")),
        ("early", "warning", "started", c("started") >= c("slot_at")), ("status", "error", "status", c("status").isin("published", "silent", "failed")), ("no_items", "error", "status", (c("status") != "published") | (n > 0)),
        ("items_listed", "error", "status", ~c("status").isin("silent", "failed") | (n == 0)), ("item_slot", "error", "items", F.forall("items", lambda i: F.startswith(i, stem))), ("items_repeat", "error", "items", F.size(F.array_distinct("items")) == n),
        ("published_count", "error", "published", c("published") == n), ("mechanism_sum", "error", "mechanisms", F.aggregate(F.map_values("mechanisms"), F.lit(0).cast("long"), lambda a, x: a + x) == n),
        *[("funnel", "warning", b, c(b) <= c(a)) for a, b in down],
    ]
    return row_checks(runs, key, rules)


def ledger_checks(seen: DataFrame, key: str = "url", verdicts: tuple[str, ...] = ("pass", "fail")) -> DataFrame:
    """Rules of the ledger: ``url, first_seen, run_id, verdict, item_id``; the key is a normalised address."""
    c = F.col
    item = c("item_id").isNull() | c("item_id").rlike(r"^\d{4}-\d\d-\d\d-(06|10|14|18)00-\d{2,}$")
    return row_checks(seen, key, [
        ("normalised", "warning", key, url.normalise(c(key)) == c(key)), ("first_seen", "error", "first_seen", c("first_seen").isNotNull()),
        ("run_id", "error", "run_id", dates.slot_instant(c("run_id")).isNotNull()), ("verdict", "error", "verdict", c("verdict").isin(*verdicts)), ("item_id", "error", "item_id", item),
    ])


def stage_two(judgments: DataFrame, sections: list[str], section: str = "section") -> DataFrame:
    """``section, ord, tested, passed`` for every section, zeros too; members of clusters are left out: stories count, not sources."""
    from siftmill.operators.readmodel import zero_filled

    return zero_filled(judgments.where(~F.coalesce(F.col("dedup") == "cluster_merged", F.lit(False))), section, sections, F.count(F.lit(1)).alias("tested"), F.count_if(F.col("verdict") == "pass").alias("passed"))

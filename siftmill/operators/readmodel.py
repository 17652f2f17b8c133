"""Reporting: facets, windows, zero-filled tallies, ids by rank, latest edition, cross-checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftmill.functions import dates, reasons
from siftmill.functions.text import half_up


def facets(df: DataFrame, chosen: dict[str, list]) -> DataFrame:
    """``facet, value, n``: counts of each facet's values among rows that pass the filters of all other facets. One pass:
    every row is tested against all filters, and counted where at most the facet's own one fails."""
    ok = {c: F.col(c).isin(*v) if v else F.lit(True) for c, v in chosen.items()}
    failed = reduce(lambda a, b: a + b, [(~o).cast("int") for o in ok.values()])
    per = [F.when(failed - (~o).cast("int") == 0, F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value"))) for c, o in ok.items()]
    return df.select(F.explode(F.array_compact(F.array(*per))).alias("f")).groupBy("f.facet", "f.value").agg(F.count(F.lit(1)).alias("n"))


def with_failed(df: DataFrame, chosen: dict[str, list], name: str = "failed") -> DataFrame:
    """Adds ``name``, a mask with bit ``i`` set where filter ``i`` (in the order of ``chosen``) fails. A list passes if it shares a value
    with those chosen, a single value if it is one of them; nothing chosen passes all, null passes nothing else."""
    def ok(c: str, values: list) -> Column:
        if not values:
            return F.lit(True)
        if df.schema[c].dataType.typeName() == "array":
            return F.coalesce(F.arrays_overlap(c, F.array(*map(F.lit, values))), F.lit(False))
        return F.coalesce(F.col(c).isin(*values), F.lit(False))

    bits = [F.when(ok(c, v), 0).otherwise(1 << i) for i, (c, v) in enumerate(chosen.items())]
    return df.withColumn(name, reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0)))


def list_view(df: DataFrame, chosen: dict[str, list], section: str) -> DataFrame:
    """``kind, name, value, n`` of a filtered list, in one pass over its rows.

    ``facet``: rows that pass all filters but the facet's own, by its values (a row counts once for each value of a list).
    ``section``: rows shown (``value`` shown) or hidden by the filters (``hidden``). ``only``: rows that fail one filter alone, by its name:
    what dropping it would bring back. ``total``: rows shown."""
    names = list(chosen)
    df = with_failed(df, chosen, "_failed")
    failed = F.col("_failed")
    entry = lambda kind, name, value: F.struct(F.lit(kind).alias("kind"), name.cast("string").alias("name"), value.cast("string").alias("value"))
    none = F.array().cast("array<struct<kind: string, name: string, value: string>>")
    parts = []
    for i, c in enumerate(names):
        many = df.schema[c].dataType.typeName() == "array"
        values = F.array_distinct(F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType))) if many else F.array(F.col(c))
        own = F.transform(values, (lambda name: lambda v: entry("facet", F.lit(name), v))(c))
        parts += [F.when(failed.bitwiseAND(F.lit(~(1 << i))) == 0, own).otherwise(none), F.when(failed == (1 << i), F.array(entry("only", F.lit(c), F.lit(None)))).otherwise(none)]
    shown = F.when(failed == 0, "shown").otherwise("hidden")
    parts += [F.array(entry("section", F.col(section), shown)), F.when(failed == 0, F.array(entry("total", F.lit(None), F.lit(None)))).otherwise(none)]
    return df.select(F.explode(F.concat(*parts)).alias("x")).groupBy("x.kind", "x.name", "x.value").agg(F.count(F.lit(1)).alias("n"))


def windows(df: DataFrame, ts: str, now: Column, spans: dict[str, int], by: str) -> DataFrame:
    """``span, by, n``: rows at or after ``now`` less each span of hours, with no upper end. A row is counted in every span that holds it."""
    inside = F.array_compact(F.array(*[F.when(F.col(ts) >= now - F.make_dt_interval(F.lit(0), F.lit(h)), F.lit(n)) for n, h in spans.items()]))
    return df.select(by, F.explode(inside).alias("span")).groupBy("span", by).agg(F.count(F.lit(1)).alias("n"))


def zero_filled(df: DataFrame, key: str, values: list[str], *aggs: Column) -> DataFrame:
    """A row for each of ``values``, in their order (``ord``), zeros too; other keys follow with the next number, so that no row of
    ``df`` is lost but those without a key."""
    names = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(values)], f"{key} string, ord int")
    found = df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    return names.join(found, key, "full").withColumn("ord", F.coalesce("ord", F.lit(len(values)))).fillna(0)


def ratio(n: Column, d: Column) -> Column:
    """Three decimals, half up; null if the denominator is 0."""
    return F.when(d != 0, half_up(n / d, 3))


def rank_ids(df: DataFrame, group: str, order: list[Column], stem: Column) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("item_id", F.concat(stem, F.lit("-"), F.when(n < 10, F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string")))).withColumn("nn", n)


def top_k(df: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k)


def sections(df: DataFrame, section: str, inside: Column, chosen: Column) -> DataFrame:
    """``section, shown, hidden``: rows in the range that the filters show, and those that they hide."""
    return df.where(inside).groupBy(section).agg(F.count_if(chosen).alias("shown"), F.count_if(~chosen).alias("hidden"))


def search(df: DataFrame, key: Column, wanted: str) -> DataFrame:
    """Rows whose search key holds the words asked for, as one string; nothing asked keeps all."""
    return df.where(F.contains(key, F.lit(" ".join(wanted.lower().split())))) if wanted.strip() else df


def shares(df: DataFrame, by: list[str], value: str, above: float, least: int = 2) -> DataFrame:
    """Values with at least ``least`` rows and more than ``above`` of their group's."""
    n = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    total = n.groupBy(*by).agg(F.sum("n").alias("total"))
    return n.join(total, by).where((F.col("n") >= least) & (F.col("n") > F.col("total") * above)).withColumn("share", ratio(F.col("n"), F.col("total")))


def runs_between(runs: DataFrame, key: str, since: Column, until: Column) -> DataFrame:
    """Runs whose id is a slot from ``since`` to ``until``, both included; a null end is open. Rows with any other id are left out."""
    at = dates.slot_instant(F.col(key))
    return runs.where(at.isNotNull() & F.coalesce(at >= since, F.lit(True)) & F.coalesce(at <= until, F.lit(True)))


def recent_archive(items: DataFrame, at: str, now: Column, days: int = 21) -> DataFrame:
    """Items of the last ``days`` days and of the day ahead, both ends included; an item without a time is none of them."""
    return items.where((F.col(at) >= now - F.make_dt_interval(F.lit(days))) & (F.col(at) <= now + F.make_dt_interval(F.lit(1))))


def latest_at(df: DataFrame, order: str, *times: str) -> DataFrame:
    """One row ``as_of``: the first known time of the latest run."""
    return df.agg(F.max_by(F.coalesce(*times), F.col(order)).alias("as_of"))


def in_range(at: Column, start: Column, end: Column) -> Column:
    """``[start, end)``; a null end is open."""
    return (start.isNull() | (at >= start)) & (end.isNull() | (at < end))


def last_before(df: DataFrame, at: str, start: Column, *ties: str) -> DataFrame:
    """The newest row before a range."""
    return df.where(F.col(at) < start).agg(F.max(F.struct(at, *ties, *[c for c in df.columns if c not in (at, *ties)])).alias("r")).where("r IS NOT NULL").select("r.*")


def board(df: DataFrame, key: str, values: list[str], item: str, first: Column, at: str, most: int = 100) -> DataFrame:
    """``key, ord, n, items``: each value's rows, those first for which ``first`` holds, then the newest; the list shows
    ``most`` of them, ``n`` counts all."""
    n = zero_filled(df, key, values, F.count(F.lit(1)).alias("n"))
    top = top_k(df.withColumn("_first", first.cast("int")), key, [F.desc("_first"), F.desc(at), F.col(item)], most)
    lists = top.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", item))), lambda x: x[item]).alias("items"))
    return n.join(lists, key, "left").withColumn("items", F.coalesce("items", F.array().cast(lists.schema["items"].dataType)))


def effective_now(clock: Column, *latest: tuple[DataFrame, str]) -> DataFrame:
    """One row ``now``: the latest of the clock and of the frames' times."""
    out = latest[0][0].agg(F.max(latest[0][1]).alias("t0"))
    for i, (df, c) in enumerate(latest[1:], 1):
        out = out.crossJoin(df.agg(F.max(c).alias(f"t{i}")))  # one row each
    return out.select(F.greatest(clock, *[F.col(f"t{i}") for i in range(len(latest))]).alias("now"))


def run_status(status: Column) -> Column:
    """A run's status; what is none counts as failed."""
    return F.when(status.isin("published", "silent", "failed"), status).otherwise("failed")


def empty_reason(applied: Column, failed: Column, hidden: Column) -> Column:
    """Why a section shows nothing: the filters hide its rows, the test was applied and nothing passed, all runs failed, or none ran."""
    return F.when(hidden > 0, "hidden").when(applied > 0, "nothing_passed").when(failed > 0, "runs_failed").otherwise("no_runs")


def neighbours(runs: DataFrame, slot: str) -> DataFrame:
    """Adds ``previous`` (the slot before), ``latest`` and ``superseded`` (a later run exists). Run records are few, one a slot."""
    w = Window.orderBy(slot)
    last = runs.agg(F.max(slot).alias("latest"))
    return runs.withColumn("previous", F.lag(slot).over(w)).crossJoin(F.broadcast(last)).withColumn("superseded", F.col(slot) < F.col("latest"))


def calibration_totals(runs: DataFrame, status: str, *counters: str) -> DataFrame:
    """One row: runs by status, and the counters summed over those that didn't fail."""
    ok = F.col(status) != "failed"
    return runs.agg(*[F.count_if(F.col(status) == s).alias(s) for s in ("published", "silent", "failed")], *[F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).alias(c) for c in counters])


def near_misses(log: DataFrame, reason: str) -> DataFrame:
    """``kind, name, n``: elements that reasons were near to, with their knob (``element``), those of no knob again (``fixed``), other
    ways (``alt``), and rows near each knob, one for each that a row names (``knob``). The reasons' form is that of ``reasons.parsed``."""
    p = F.col("_p")
    name = lambda kind, c, when: F.when(when.isNotNull(), F.struct(F.lit(kind).alias("kind"), c.alias("name")))
    parts = F.array(
        name("element", F.concat_ws("/", p["element"], p["knob"]), p["element"]), name("fixed", p["element"], F.when(p["knob"].isNull(), p["element"])),
        name("alt", F.concat_ws("/", p["alt_element"], p["alt_knob"]), p["alt_knob"]), name("knob", p["knob"], p["knob"]), name("knob", p["alt_knob"], p["alt_knob"]),
    )
    rows = log.select(reasons.parsed(F.col(reason)).alias("_p"))
    return rows.select(F.explode(F.array_distinct(F.array_compact(parts))).alias("x")).groupBy("x.kind", "x.name").agg(F.count(F.lit(1)).alias("n"))


def run_table(runs: DataFrame, log: DataFrame, key: str, status: str, survivors: str, counters: tuple[str, ...], mechanisms: str) -> DataFrame:
    """A row for each run: its status and counters, ``items`` (the sum of its map ``mechanisms``), ``logged`` rows, ``stories`` among
    them (members of clusters left out), those passed, and ``log_missing`` where it has survivors and no log."""
    own = F.coalesce(F.col("dedup") != "cluster_merged", F.lit(True))
    rows = log.groupBy(key).agg(F.count(F.lit(1)).alias("logged"), F.count_if(own).alias("stories"), F.count_if(own & (F.col("verdict") == "pass")).alias("passed"))
    n = F.aggregate(F.map_values(mechanisms), F.lit(0).cast("long"), lambda a, x: a + x)
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("logged", "stories", "passed")]
    return runs.select(key, status, *counters, F.coalesce(n, F.lit(0)).alias("items"), survivors).join(rows, key, "left").select(key, status, *counters, "items", *zero, (F.col("logged").isNull() & (F.col(survivors) > 0)).alias("log_missing"))


def archive_by_mechanism(runs: DataFrame, slot: str, mechanisms: str, items: DataFrame, at: str, mechanism: str, live: Column) -> DataFrame:
    """``mechanism, claimed, archived``: what the runs say that they published, and live items of the archive at their slots."""
    said = runs.select(F.explode(mechanisms).alias("mechanism", "n")).groupBy("mechanism").agg(F.sum("n").alias("claimed"))
    kept = items.where(live).select(F.col(at).alias(slot), F.col(mechanism).alias("mechanism")).join(runs.select(slot).distinct(), slot, "left_semi")
    both = said.join(kept.groupBy("mechanism").agg(F.count(F.lit(1)).alias("archived")), "mechanism", "full")
    return both.select("mechanism", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("claimed", "archived")])


def calibration_warnings(totals: DataFrame, share: Column, most_share: float = 0.4, most_pass: float = 0.25) -> DataFrame:
    """``warning, value`` for a mechanism's share of the items, and for the first stage's share of what was unseen, where too large."""
    passed = ratio(F.col("stage1"), F.col("unseen"))
    rows = F.array(F.when(share > most_share, F.struct(F.lit("mechanism_share").alias("warning"), share.alias("value"))), F.when(passed > most_pass, F.struct(F.lit("stage1_pass").alias("warning"), passed.alias("value"))))
    return totals.select(F.explode(F.array_compact(rows)).alias("w")).select("w.*")


def missing_logs(runs: DataFrame, log: DataFrame, key: str, survivors: str) -> DataFrame:
    """Runs with survivors of the first stage that have no log rows."""
    return runs.where(F.col(survivors) > 0).select(key).join(log.select(key).distinct(), key, "left_anti")

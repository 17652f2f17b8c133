"""Collecting entries into candidates: window, exclusions, dates that addresses and leads state, totals by source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmill.functions import dates, url

OVERLAP_HOURS, FLOOR_HOURS, FUTURE_HOURS, REPOST_DAYS = 6, 72, 24, 2


def hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def default_since(runs: DataFrame, status: str, started: str, order: str, now: Column, good: tuple[str, ...] = ("published", "silent")) -> DataFrame:
    """One row ``since, basis``: the latest successful run's start less the overlap, but not before the floor. Failed runs
    judged nothing, so they don't move the window; nor do runs without a start."""
    last = runs.where(F.col(status).isin(*good) & F.col(started).isNotNull()).agg(F.max_by(started, order).alias("at"))
    floor, start = now - hours(FLOOR_HOURS), F.col("at") - hours(OVERLAP_HOURS)
    basis = F.when(F.col("at").isNull(), "no run").when(start < floor, "floor").otherwise("run")
    return last.select(F.coalesce(F.greatest(start, floor), floor).alias("since"), basis.alias("basis"))


def window_status(at: Column, date_only: Column, status: Column, since: Column, now: Column, replay: bool = False) -> Column:
    """What the window says of an entry: ``future``, ``old``, ``inside``, ``implausible`` or ``undated`` (to be capped by source).

    Rows with a date alone compare Eastern calendar dates, so that none of the day is lost; others compare instants. Live,
    a day ahead is tolerated; a replay tolerates nothing."""
    limit = now if replay else now + hours(FUTURE_HOURS)
    day = F.date_format(at, "yyyy-MM-dd")
    by_day = F.when(day > dates.et_date(limit), "future").when(day < dates.et_date(since), "old").otherwise("inside")
    by_time = F.when(at > limit, "future").when(at < since, "old").otherwise("inside")
    return F.when(at.isNotNull() & date_only, by_day).when(at.isNotNull(), by_time).when(status == "implausible", "implausible").otherwise("undated")


def excluded(u: Column, patterns: Column) -> Column:
    """Whether an address holds one of a source's patterns, in any case; null patterns exclude nothing."""
    return F.coalesce(F.exists(patterns, lambda p: F.contains(F.lower(u), F.lower(p))), F.lit(False))


def path_date(u: Column, rules: dict[str, str]) -> Column:
    """The date (``yyyy-MM-dd``) that an address's path states, by rules (pattern of hosts -> pattern of paths with year, month
    and day); null without a rule, a match or a real date from 1990 on."""

    def read(pattern: str) -> Column:
        y, m, d = (F.regexp_extract(url.path(u), pattern, i) for i in (1, 2, 3))
        text = F.concat_ws("-", y, m, d)
        return F.when(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).isNotNull() & (y >= "1990"), text)

    return F.coalesce(*[F.when(url.host(u).rlike(h), read(p)) for h, p in rules.items()], F.lit(None).cast("string"))


def stated_date(lead: Column) -> Column:
    """The date after the last comma of a lead, as in ``Minutes, 4 July 2019.``"""
    day, month, year = (F.regexp_extract(lead, r",\s*(\d{1,2})\s+(\p{Lu}\p{Ll}+)\s+(\d{4})\.?\s*$", i) for i in (1, 2, 3))
    at = F.try_to_timestamp(F.concat_ws(" ", day, month, year), F.lit("d MMMM yyyy"))
    return F.when((year >= "1990") & at.isNotNull(), F.date_format(at, "yyyy-MM-dd"))


def reposted(lead: Column, feed_day: Column, days: int = REPOST_DAYS) -> Column:
    """Whether a lead states a date so many days or more before the feed's."""
    return F.coalesce(F.datediff(F.try_to_timestamp(F.substring(feed_day.cast("string"), 1, 10), F.lit("yyyy-MM-dd")).cast("date"), stated_date(lead).cast("date")) >= days, F.lit(False))


def candidates(entries: DataFrame, sources: DataFrame, now: Column, since: Column, rules: dict[str, str], replay: bool = False, undated: int = 20) -> DataFrame:
    """Entries ``source_id, link, headline, lead, ts, date_only, date_status`` of ``sources`` (``source_id, publication,
    source_class, exclude``) -> candidates with ``window`` (``outside_rules`` for what is no address, has no headline or is
    excluded), ``published_date``, ``redated`` and ``reposted``; of undated ones the first of each source, by address."""
    c = entries.join(sources, "source_id", "left")
    link, own = F.col("link"), path_date(F.col("link"), rules)
    c = c.withColumns({"url_normalised": url.normalise(link), "candidate_id": url.candidate_id(link), "path_day": own, "headline": F.trim(F.regexp_replace(F.coalesce("headline", F.lit("")), r"\s+", " "))})
    feed_day = F.when(F.col("date_only"), F.date_format("ts", "yyyy-MM-dd")).otherwise(dates.et_date(F.col("ts")))
    c = c.withColumn("feed_day", feed_day).withColumns({"redated": F.col("path_day").isNotNull() & ~F.coalesce(F.col("path_day") == F.col("feed_day"), F.lit(False)), "published_date": F.coalesce("path_day", "feed_day")})
    dated = F.col("path_day").isNotNull()
    at, day_only = F.when(dated, F.to_timestamp("path_day")).otherwise(F.col("ts")), dated | F.coalesce("date_only", F.lit(False))
    bad = F.col("url_normalised").isNull() | (F.col("headline") == "") | excluded(link, F.col("exclude"))
    c = c.withColumn("window", F.when(bad, "outside_rules").otherwise(window_status(at, day_only, F.col("date_status"), since, now, replay)))
    c = c.withColumn("reposted", reposted(F.col("lead"), F.col("published_date")))
    loose = c.where("window = 'undated'")
    from siftmill.operators.state import capped

    return c.where("window != 'undated'").unionByName(capped(loose, "source_id", ["url_normalised", "candidate_id"], undated)).drop("path_day", "feed_day", "exclude")


def samples(df: DataFrame, by: str, value: str, order: str, most: int = 2) -> DataFrame:
    """Each group's first distinct values, in order of first appearance; combined before they are shuffled."""
    first = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.min(order).alias("_at"))
    from siftmill.operators.state import capped

    kept = capped(first, by, ["_at", value], most)
    return kept.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", value))), lambda x: x[value]).alias("samples"))


def fetch_totals(report: DataFrame, status: str, *counters: str) -> DataFrame:
    """One row: sources fetched, failed and manual, and the sums of the counters."""
    return report.agg(F.count(F.lit(1)).alias("sources"), *[F.count_if(F.col(status) == s).alias(s) for s in ("ok", "failed", "manual")], *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters])


def unhealthy(totals: DataFrame) -> Column:
    """Fewer than half of the sources that were fetched answered."""
    return F.col("ok") * 2 < F.col("ok") + F.col("failed")


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)

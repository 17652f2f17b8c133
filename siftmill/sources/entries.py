"""Entries written by hand, settings, and item records as readers see them."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmill.functions import dates, text, url
from siftmill.sources import registry


def manual_entries(entries: DataFrame, registry: DataFrame, floor: Column) -> DataFrame:
    """Entries ``source_id, url, headline, published_date`` beside ``registry`` (``source_id, publication, source_class, home``):
    adds the registry's columns, ``candidate_id`` and ``problem``, the first of: unknown source, address that is no https, other
    site than the source's, no headline, no real date, before the window. All problems are rows, so that a caller can refuse the whole file."""
    e = entries.join(registry, "source_id", "left")
    day = F.col("published_date")
    problem = (
        F.when(F.col("publication").isNull(), "unknown_source").when(url.safe_link(F.col("url")).isNull(), "address").when(~F.coalesce(url.same_site(F.col("url"), F.col("home")), F.lit(False)), "other_site")
        .when(text.collapse(F.coalesce("headline", F.lit(""))) == "", "headline").when(~dates.is_iso_date(day), "date").when(day < dates.et_date(floor), "before_window")
    )
    return e.withColumns({"candidate_id": url.candidate_id(F.col("url")), "problem": problem}).drop("home")


def extra_entries(entries: DataFrame, registry: DataFrame, known: DataFrame) -> DataFrame:
    """Addresses found by search (``url, headline``) as attachments: ``extra``, with the publication of the registered source of
    the same site (the least by id), else of the host; of addresses of one candidate the least stays; those that ``known`` (``candidate_id``) has already are left out."""
    sites = registry.select(url.registrable(url.host(F.col("home"))).alias("site"), "source_id", "publication", "source_class", "paywalled")
    sites = sites.groupBy("site").agg(F.min(F.struct("source_id", "publication", "source_class", "paywalled")).alias("s")).select("site", "s.publication", "s.source_class", "s.paywalled")
    e = entries.withColumns({"candidate_id": url.candidate_id(F.col("url")), "site": url.registrable(url.host(F.col("url")))})
    first = F.min(F.struct("url", *[c for c in e.columns if c not in ("candidate_id", "url")])).alias("e")
    e = e.where("candidate_id IS NOT NULL").groupBy("candidate_id").agg(first).select("candidate_id", "e.*").join(known.select("candidate_id"), "candidate_id", "left_anti").join(sites, "site", "left")
    return e.withColumns({"publication": F.coalesce("publication", url.host(F.col("url"))), "paywalled": F.coalesce("paywalled", F.lit(False)), "extra": F.lit(True)}).drop("site")


#: An instant with its offset, and one at midnight, which says no more than the date.
_INSTANT, _MIDNIGHT = r"^\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d{1,9})?)?(Z|[+-]\d\d:\d\d)$", r"^(\d{4}-\d\d-\d\d)T00:00(:00(\.0+)?)?(Z|[+-]\d\d:\d\d)$"
MODES = ("archive", "search", "feed")


def past_entries(entries: DataFrame, sources: DataFrame, start: Column, until: Column, classes: tuple[str, ...], later: bool = False, words: int = 60, paywalled_words: int = 30, known: tuple[str, ...] = (), shared: tuple[str, ...] = ()) -> DataFrame:
    """Entries for a pass over ``[start, until)`` (``url, publication, source_class, headline, lead, published, paywalled, discovery_mode, notes``)
    as candidates, beside ``problems`` (all that apply, in the order of fields; a caller refuses the whole file if any has one) and ``notices``.

    ``published`` is a date, or an instant with its offset; midnight counts as a date. A date alone counts as its last slot when it is held
    against the window. What lies after the window is taken with ``later`` alone, as ``outside_window``. ``sources``: the registry; its source of the same
    host or site gives ``source_id``, ``region``, ``tier`` (of news) and the words of a lead; a paywall anywhere on the domain counts though the entry denies it. Nulls and empty fields are problems, no errors."""
    c, published = F.col, F.col("published")
    live = sources.where(F.coalesce("enabled", F.lit(True)))
    e = registry.with_paywalls(registry.source_of(entries, "url", live.select("id", "url", "paywalled"), url.site_host), "url", live, known, shared)
    e = e.join(live.select(c("id").alias("source_id"), c("region").alias("region"), c("tier").alias("_tier"), c("lead_words").alias("_words")).dropDuplicates(["source_id"]), "source_id", "left")
    midnight = F.when(published.rlike(_MIDNIGHT), F.regexp_extract(published, _MIDNIGHT, 1))
    date = F.coalesce(F.when(dates.is_iso_date(published), published), F.when(dates.is_iso_date(midnight), midnight))
    instant = F.when(date.isNull() & published.rlike(_INSTANT), F.try_to_timestamp(F.regexp_replace(published, r"(T\d\d:\d\d)(?=[Z+-])", "$1:00")))
    day = F.try_to_timestamp(date, F.lit("yyyy-MM-dd"))
    e = e.withColumns({"published_date": F.coalesce(date, F.date_format(dates.et_date(instant), "yyyy-MM-dd")), "published_at": F.coalesce(F.to_utc_timestamp(day, dates.ZONE), instant), "published_precision": F.when(date.isNotNull(), "date").when(instant.isNotNull(), "time")})
    counted = F.coalesce(dates.publication_instant(day, F.lit(True)), instant)
    headline, publication = (text.collapse(F.coalesce(n, F.lit(""))) for n in ("headline", "publication"))
    told = F.coalesce("lead", F.lit(""))
    wrong = [
        ("url", url.safe_link(c("url")).isNull()), ("disallowed", url.disallowed(c("url")).isNotNull()), ("publication", ~F.length(publication).between(1, 200)), ("source_class", ~F.coalesce(c("source_class").isin(*classes), F.lit(False))),
        ("headline", ~F.length(headline).between(1, 300)), ("paywalled", c("paywalled").isNull()), ("discovery_mode", ~F.coalesce(c("discovery_mode").isin(*MODES), F.lit(False))), ("notes", F.length("notes") > 500),
        ("published", c("published_precision").isNull()), ("early", counted < start), ("late", (counted >= until) & F.lit(not later)),
    ]
    shut = c("walled").isNotNull() | F.coalesce("paywalled", F.lit(False))
    most = F.when(shut, F.least(F.lit(paywalled_words), F.coalesce("_words", F.lit(paywalled_words)))).otherwise(F.coalesce("_words", F.lit(words)))
    w = text.words(told)
    notes = [("midnight", midnight.isNotNull() & dates.is_iso_date(midnight)), ("walled", c("walled").isNotNull() & ~c("paywalled")), ("lead_cut", F.size(w) > most)]
    named = lambda rules: F.array_compact(F.array(*[F.when(r, F.lit(n)) for n, r in rules]))
    out = e.withColumns({"problems": named(wrong), "notices": named(notes), "outside_window": F.coalesce(counted >= until, F.lit(False)), "_shut": shut, "_lead": F.concat(F.array_join(F.slice(w, F.lit(1), most), " "), F.when(F.size(w) > most, "…").otherwise(""))})
    out = out.withColumns({"url_normalised": url.normalise(c("url")), "candidate_id": url.candidate_id(c("url")), "headline": headline, "publication": publication, "paywalled": c("_shut"), "lead": c("_lead"), "notes": F.nullif(text.collapse(F.coalesce("notes", F.lit(""))), F.lit("")), "tier": F.when(c("source_class") == "news", c("_tier"))})
    return out.drop("_shut", "_lead", "_tier", "_words", "walled")


class Settings:
    """A JSON file of settings, looked up by dotted names; what it lacks comes from ``defaults`` (by dotted name)."""

    def __init__(self, spark: SparkSession, path: str | None = None, defaults: dict | None = None):
        self.found = json.loads(spark.read.text(path, wholetext=True).first()[0]) if path else {}  # one small file, read where Spark reads
        self.defaults = defaults or {}

    def get(self, name: str):
        at = self.found
        for part in name.split("."):
            if not isinstance(at, dict) or part not in at:
                return self.defaults.get(name)
            at = at[part]
        return at

    def number(self, name: str) -> float:
        value = self.get(name)
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            raise ValueError(f"{name} is no number: {value!r}")
        return value

    def flag(self, name: str) -> bool:
        value = self.get(name)
        if not isinstance(value, bool):
            raise ValueError(f"{name} is neither true nor false: {value!r}")
        return value


def items_as_read(items: DataFrame, mechanisms: tuple[str, ...], labels: dict[str, str]) -> DataFrame:
    """Items ``item_id, at, section, mechanism, claim, domains, classes, sources (array<struct<url, publication, source_class>>)`` as
    readers see them: rows without id, time, claim or known mechanism go; arrays lose repeats and nulls; sources keep safe
    addresses; ``classes`` are the item's, then its sources'; ``search`` holds all words; ``uncovered`` the other domains."""
    whole = items.where(F.col("item_id").isNotNull() & F.col("at").isNotNull() & F.col("mechanism").isin(*mechanisms) & (F.coalesce(F.trim("claim"), F.lit("")) != ""))
    none = F.array().cast("array<string>")
    list_of = lambda c: F.array_distinct(F.array_compact(F.coalesce(c, none)))
    sources = F.transform(F.coalesce(F.col("sources"), F.array().cast(items.schema["sources"].dataType)), lambda s: F.struct(url.safe_link(s["url"]).alias("url"), s["publication"].alias("publication"), s["source_class"].alias("source_class")))
    out = whole.withColumns({"domains": list_of(F.col("domains")), "sources": sources, "backfilled": F.coalesce("backfilled", F.lit(False))})
    out = out.withColumn("classes", list_of(F.concat(F.coalesce("classes", none), F.transform("sources", lambda s: s["source_class"]))))
    all_domains = F.array(*map(F.lit, labels))
    words = F.concat_ws(" ", "claim", F.transform("domains", lambda d: text.label(d, labels)), F.transform("sources", lambda s: s["publication"]))
    return out.withColumns({"search": text.search_key(words), "uncovered": F.array_except(all_domains, "domains")})


def item_details(items: DataFrame, now: Column, labels: dict[str, str]) -> DataFrame:
    """What an item's own page shows of ``items_as_read`` rows: labels of its domains, how many sources bear it out, when it was
    published, and the claim of the item that it updates."""
    old = items.select(F.col("item_id").alias("update_of"), F.col("claim").alias("updates_claim"))
    n = F.size("sources")
    return items.join(old, "update_of", "left").select(
        "item_id", "claim", F.array_join(F.transform("domains", lambda d: text.label(d, labels)), ", ").alias("domain_labels"),
        F.when(n > 1, text.plural(n, "source")).otherwise("one source").alias("corroboration"), dates.when_short(F.col("at"), now, 0).alias("shown_date"), "updates_claim", "uncovered",
    )

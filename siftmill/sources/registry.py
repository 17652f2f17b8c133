"""Registries, line files, code tables and paged answers as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmill.functions import url
from siftmill.operators import checks

SOURCE = "id string, publication string, source_class string, type string, url string, paywalled boolean, region string, lead_words int, tier string, enabled boolean, exclude_url_patterns array<string>, prefilter string"
RULE_PAGE = "count int, next_page_url string, results array<struct<title string, type string, abstract string, html_url string, publication_date string, document_number string, agencies array<struct<raw_name string, name string, slug string>>>>"


def documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents that span lines; one that does not fit the schema fails the read."""
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")


def lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; lines that can't be read come back in ``broken`` with the rest null."""
    return spark.read.schema(f"{schema}, broken string").json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="broken")


def source_violations(sources: DataFrame, kinds: list[str], most_words: int = 120, paywalled_words: int = 60) -> DataFrame:
    c = F.col
    rules = [
        ("id", "error", "id", c("id").rlike("^[a-z0-9]+(-[a-z0-9]+)*$")), ("publication", "error", "publication", F.length("publication") > 0), ("type", "error", "type", c("type").isin(kinds)),
        ("https", "error", "url", (c("type") == "manual") | c("url").startswith("https://")), ("lead_words", "error", "lead_words", c("lead_words").isNull() | c("lead_words").between(0, most_words)),
        ("paywall", "error", "lead_words", ~F.coalesce("paywalled", F.lit(False)) | (F.coalesce("lead_words", F.lit(0)) <= paywalled_words)),
    ]
    return checks.collected(checks.row_checks(sources, "id", rules), checks.unique(sources, "id"))


def source_of(pages: DataFrame, address: str, sources: DataFrame, site_of=url.registrable) -> DataFrame:
    """Adds ``source_id``: the source on the same host, else on the same site; paywalled ones first, then by id. A site is what ``site_of``
    makes of a host: its registrable domain, or with ``url.site_host`` the host itself, so that offices of one domain stay apart."""
    ranked = F.struct(F.when(F.coalesce("paywalled", F.lit(False)), 0).otherwise(1).alias("o"), F.col("id"))
    h, site = url.host(F.col("url")), site_of(url.host(F.col("url")))
    hosts = sources.groupBy(h.alias("_host")).agg(F.min(ranked)["id"].alias("_by_host"))
    sites = sources.groupBy(site.alias("_site")).agg(F.min(ranked)["id"].alias("_by_site"))
    own = pages.withColumns({"_host": url.host(F.col(address)), "_site": site_of(url.host(F.col(address)))})
    out = own.join(hosts, "_host", "left").join(sites, "_site", "left")
    return out.withColumn("source_id", F.coalesce("_by_host", "_by_site")).drop("_host", "_site", "_by_host", "_by_site")


def with_paywalls(pages: DataFrame, address: str, sources: DataFrame, known: tuple[str, ...] = (), shared: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``walled``: the least id of a paywalled source on the page's registrable domain (of ``shared`` platforms, whose subdomains are
    different publications, on its host), ``known`` on a domain that is known for one without being registered; null for others."""
    h = url.host(F.col(address))
    domain = lambda c: F.when(url.registrable(c).isin(*shared), c).otherwise(url.registrable(c)) if shared else url.registrable(c)
    walls = sources.where(F.coalesce("paywalled", F.lit(False)) & F.coalesce("enabled", F.lit(True)) & F.col("url").isNotNull())
    walls = walls.groupBy(domain(url.host(F.col("url"))).alias("_site")).agg(F.min("id").alias("_wall"))
    listed = F.when(url.registrable(h).isin(*known), "known") if known else F.lit(None).cast("string")
    out = pages.withColumn("_site", F.nullif(domain(h), F.lit(""))).join(walls, "_site", "left")
    return out.withColumn("walled", F.coalesce("_wall", listed)).drop("_site", "_wall")


def code_table(spark: SparkSession, path: str, least: int = 10) -> DataFrame:
    """``code, verdict`` from the rows of a Markdown table whose first cell is a code in back quotes."""
    row = r"^\|\s*`([A-Z][A-Z0-9_]*)`\s*\|\s*([^|]*?)\s*\|"
    out = spark.read.text(path).where(F.col("value").rlike(row)).select(F.regexp_extract("value", row, 1).alias("code"), F.regexp_extract("value", row, 2).alias("verdict"))
    if out.limit(least).count() < least:
        raise ValueError(f"fewer than {least} codes")
    return out


def rule_candidates(pages: DataFrame, start: Column, until: Column) -> DataFrame:
    """Entries of paged answers with ``skipped``: why an entry is no candidate (null: it is one)."""
    r = pages.select(F.explode("results").alias("r")).select("r.*").withColumn("day", F.try_to_date("publication_date"))
    ok = (F.length(F.trim("title")) > 0) & url.normalise(F.col("html_url")).isNotNull() & F.col("day").isNotNull()
    reason = F.when(~F.coalesce(ok, F.lit(False)), "invalid").when(F.col("type") != "Rule", "not_rule").when((F.col("day") < start) | (F.col("day") >= until), "out_of_window")
    return r.select("document_number", "title", F.col("abstract").alias("lead"), url.normalise(F.col("html_url")).alias("url_normalised"), "day", F.get("agencies", 0)["slug"].alias("agency"), reason.alias("skipped"))

"""JSON catalogues and feeds as DataFrames."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VULNERABILITIES = "catalogVersion string, vulnerabilities array<struct<cveID string, vendorProject string, product string, vulnerabilityName string, dateAdded string, knownRansomwareCampaignUse string>>"


def known_exploited(spark: SparkSession, path: str, since: str, until: str) -> DataFrame:
    """Entries with a well-formed id, added between two dates inclusive, with a composed headline."""
    v = spark.read.schema(VULNERABILITIES).json(path, multiLine=True).select(F.explode("vulnerabilities").alias("v")).select("v.*")
    v = v.where(F.col("cveID").rlike(r"^CVE-\d{4}-\d{4,}$") & F.col("dateAdded").rlike(r"^\d{4}-\d\d-\d\d$") & F.col("dateAdded").between(since, until))
    return v.withColumn("headline", F.concat_ws(" ", "cveID", "vendorProject", "product", "vulnerabilityName")).withColumn("headline_composed", F.lit(True))


def feed_entries(df: DataFrame, xml: str = "xml") -> DataFrame:
    """``feed, format, title, link, published, description`` of RSS 2.0, RSS 1.0 and Atom documents (columns ``feed`` and
    ``xml``), one row per entry; a document that can't be read gives one row with ``error``."""

    def local(e):
        return e.tag.rpartition("}")[2]

    def pick(e, *names):
        found = {local(c): c for c in reversed(list(e))}
        for n in names:
            c = found.get(n)
            if c is not None and (t := "".join(c.itertext()).strip() or c.get("href", "")):
                return t
        return None

    def parse(feed, raw):
        try:
            root = ET.fromstring(raw[raw.index("<") :] if raw else "")
            kind = {"rss": "rss", "RDF": "rdf", "feed": "atom"}[local(root)]
        except (ET.ParseError, ValueError, KeyError) as e:
            return [(feed, None, None, None, None, None, type(e).__name__)]
        return [(feed, kind, pick(e, "title"), pick(e, "link", "guid", "id") or e.get("{http://www.w3.org/1999/02/22-rdf-syntax-ns#}about"), pick(e, "pubDate", "date", "published", "updated"), pick(e, "description", "summary"), None) for e in root.iter() if local(e) in ("item", "entry")]

    names = ["feed", "format", "title", "link", "published", "description", "error"]

    def run(frames):
        for f in frames:
            yield pd.DataFrame([r for feed, raw in zip(f["feed"], f[xml], strict=True) for r in parse(feed, raw)], columns=names)

    return df.select("feed", xml).mapInPandas(run, ", ".join(f"{n} string" for n in names))

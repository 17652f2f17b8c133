"""Entries for a pass over the past, paywalls by domain, items as archived, ranges of runs and items."""

import pytest
from pyspark.sql import functions as F

from siftmill.functions import url
from siftmill.operators import publish, readmodel
from siftmill.sources import entries, registry

ENTRY = "url string, publication string, source_class string, headline string, lead string, published string, paywalled boolean, discovery_mode string, notes string"
SOURCE = "id string, url string, paywalled boolean, region string, lead_words int, tier string, enabled boolean"
GOOD = ("https://a.com/1", " The  A ", "news", "One", "w " * 70, "2026-01-15", False, "archive", " n ")


@pytest.fixture(scope="module")
def sources(spark):
    rows = [("a", "https://www.a.com/feed", False, "US", 5, "general", True), ("w", "https://news.wall.com/f", True, "EU", 80, None, None), ("off", "https://off.com/f", True, "US", None, None, False), ("t", "https://one.hosts.com/f", True, "US", None, None, True), ("n", None, True, None, None, None, True)]
    return spark.createDataFrame(rows, SOURCE)


def past(spark, sources, rows, later=False):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {ENTRY}")
    window = (F.lit(d).cast("timestamp") for d in ("2026-01-01 05:00:00", "2026-02-01 05:00:00"))
    out = entries.past_entries(df, sources, *window, ("news", "regulator"), later, known=("known.com",), shared=("hosts.com",))
    return [r for r in out.orderBy("i").collect()]


def test_published(spark, sources):
    cases = [
        ("2026-01-15", "date", "2026-01-15", "2026-01-15 05:00:00", []), ("2026-01-15T00:00:00Z", "date", "2026-01-15", "2026-01-15 05:00:00", []), ("2026-01-15T00:00-05:00", "date", "2026-01-15", "2026-01-15 05:00:00", []),
        ("2026-01-15T02:30:00.5Z", "time", "2026-01-14", "2026-01-15 02:30:00.500000", []), ("2026-01-15T09:30-05:00", "time", "2026-01-15", "2026-01-15 14:30:00", []), ("2026-01-15T09:30:00", None, None, None, ["published"]), ("2026-02-30", None, None, None, ["published"]),
        ("2026-02-30T00:00:00Z", None, None, None, ["published"]), ("2026-13-01T09:00:00Z", None, None, None, ["published"]), (None, None, None, None, ["published"]), ("2025-12-31", "date", "2025-12-31", "2025-12-31 05:00:00", ["early"]), ("2026-01-31", "date", "2026-01-31", "2026-01-31 05:00:00", []),
        ("2026-02-01", "date", "2026-02-01", "2026-02-01 05:00:00", ["late"]), ("2026-02-01T04:59:59Z", "time", "2026-01-31", "2026-02-01 04:59:59", []), ("2026-02-01T05:00:00Z", "time", "2026-02-01", "2026-02-01 05:00:00", ["late"]),
    ]
    rows = [(*GOOD[:5], p, *GOOD[6:]) for p, *_ in cases]
    got = past(spark, sources, rows)
    assert [(r["published_precision"], r["published_date"], str(r["published_at"]) if r["published_at"] else None, r["problems"]) for r in got] == [c[1:] for c in cases]
    assert ["midnight" in r["notices"] for r in got][:5] == [False, True, True, False, False]
    late = past(spark, sources, rows, later=True)
    assert [r["outside_window"] for r in late][-3:] == [True, False, True] and all("late" not in r["problems"] for r in late) and late[10]["problems"] == ["early"]


def test_fields_and_paywalls(spark, sources):
    at = lambda u, **k: tuple(k.get(n, u if n == "url" else v) for n, v in zip([x.split()[0] for x in ENTRY.split(", ")], GOOD, strict=True))
    rows = [at(GOOD[0]), at("https://wall.com/x"), at("https://known.com/x"), at("https://two.hosts.com/x"), at("https://one.hosts.com/x"), at("https://off.com/x"), at("http://a.com/1"), at("https://t.co/1"), at("https://a.com/2", publication="  ", source_class="blog", headline="h" * 301, discovery_mode=None, notes="n" * 501), (None,) * 9]
    got = past(spark, sources, rows)
    assert [(r["source_id"], r["paywalled"], len(r["lead"].split()), r["lead"].endswith("…")) for r in got[:6]] == [("a", False, 5, True), (None, True, 30, True), (None, True, 30, True), (None, False, 60, True), ("t", True, 30, True), (None, False, 60, True)]
    assert (got[0]["publication"], got[0]["notes"], got[0]["tier"], got[0]["region"]) == ("The A", "n", "general", "US") and got[0]["notices"] == ["lead_cut"] and got[1]["notices"] == ["walled", "lead_cut"]
    assert [r["problems"] for r in got[6:9]] == [["url"], ["disallowed"], ["publication", "source_class", "headline", "discovery_mode", "notes"]]
    assert set(got[9]["problems"]) >= {"url", "publication", "source_class", "headline", "paywalled", "discovery_mode", "published"} and len(got) == len(rows)
    assert past(spark, sources.limit(0), rows[:1])[0]["source_id"] is None and past(spark, sources, []) == []


def test_site_hosts(spark):
    cases = {"www.a.com": "a.com", "feeds.www2.a.com": "a.com", "m.com": "m.com", "www.m.com": "m.com", "news.a.com": "news.a.com", "www.feeds.com": "feeds.com", "wwws.a.com": "wwws.a.com", "localhost": "localhost", "": ""}
    assert {r[0]: r[1] for r in spark.createDataFrame([(h,) for h in cases], "h string").select("h", url.site_host(F.col("h"))).collect()} == cases


def test_walls(spark, sources):
    df = spark.createDataFrame([(u,) for u in ("https://x.wall.com/1", "https://wall.com", "https://one.hosts.com/", "https://two.hosts.com/", "https://hosts.com/", "https://k.known.com/", "https://off.com/", "odd", None)], "u string")
    got = {r["u"]: r["walled"] for r in registry.with_paywalls(df, "u", sources, ("known.com",), ("hosts.com",)).collect()}
    assert got == {"https://x.wall.com/1": "w", "https://wall.com": "w", "https://one.hosts.com/": "t", "https://two.hosts.com/": None, "https://hosts.com/": None, "https://k.known.com/": "known", "https://off.com/": None, "odd": None, None: None}


def test_final_items(spark):
    schema = "item_id string, timestamp string, section string, claim string, domains array<string>, source_class string, mechanism string, interpretation array<struct<domain: string, text: string, draft: int>>, validation_question string, candidate_issue_statement string, awareness_rationale string, sources array<struct<publication: string, url: string, headline: string, published: string, source_class: string, own: int>>, update_of string, candidate_ids array<string>, extra int"
    row = lambda m: ("i", "t", "s", "c", ["d"], "news", m, [("d", "x", 1)], "q", "s", "r", [("P", "u", None, None, None, 7)], None, ["c-1"], 5)
    out = publish.final_items(spark.createDataFrame([row("awareness_only"), row("process"), row(None)], schema))
    assert out.columns == ["item_id", "timestamp", "section", "claim", "domains", "source_class", "mechanism", "interpretation", "validation_question", "candidate_issue_statement", "awareness_rationale", "sources", "backfilled", "update_of"]
    assert [(r["validation_question"], r["candidate_issue_statement"], r["awareness_rationale"]) for r in out.collect()] == [(None, None, "r"), ("q", "s", None), ("q", "s", None)]
    assert out.first()["sources"][0].asDict() == {"publication": "P", "url": "u", "headline": None, "published": None, "source_class": None} and out.first()["interpretation"][0].asDict() == {"domain": "d", "text": "x"} and out.first()["backfilled"] is False


def test_ranges(spark):
    ids = ["2026-03-07-1800", "2026-03-08-0600", "2026-03-08-1000", "2026-03-08-0700", "2026-02-30-0600", "odd", None]
    runs = spark.createDataFrame([(i,) for i in ids], "run_id string")
    between = lambda a, b: sorted(r[0] for r in readmodel.runs_between(runs, "run_id", F.lit(a).cast("timestamp"), F.lit(b).cast("timestamp")).collect())
    assert between("2026-03-08 10:00:00", "2026-03-08 14:00:00") == ids[1:3] and between("2026-03-08 10:00:01", None) == ids[2:3] and between(None, None) == ids[:3]
    items = spark.createDataFrame([("2026-03-01 00:00:00",), ("2026-02-28 23:59:59",), ("2026-03-23 00:00:00",), ("2026-03-23 00:00:01",), (None,)], "at string").withColumn("at", F.col("at").cast("timestamp"))
    assert [str(r["at"]) for r in readmodel.recent_archive(items, "at", F.lit("2026-03-22").cast("timestamp")).orderBy("at").collect()] == ["2026-03-01 00:00:00", "2026-03-23 00:00:00"]

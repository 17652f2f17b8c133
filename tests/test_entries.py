"""Entries by hand, settings, items as read."""

import pytest
from pyspark.sql import functions as F

from siftmill.sources import entries


def test_manual(spark):
    registry = spark.createDataFrame([("a", "A News", "news", "https://www.a.com/feed", True)], "source_id string, publication string, source_class string, home string, paywalled boolean")
    rows = [("a", "https://b.a.com/1", "One", "2026-10-02"), ("z", "https://a.com/1", "One", "2026-10-02"), ("a", "http://a.com/1", "One", "2026-10-02"), ("a", "https://other.com/1", "One", "2026-10-02"), ("a", "https://a.com/2", "  ", "2026-10-02"), ("a", "https://a.com/3", "x", "2026-02-30"), ("a", "https://a.com/4", "x", "2026-09-30")]
    e = spark.createDataFrame(rows, "source_id string, url string, headline string, published_date string")
    got = [r["problem"] for r in entries.manual_entries(e, registry, F.lit("2026-10-01 12:00:00").cast("timestamp")).orderBy("source_id", "url", "headline").collect()]
    assert sorted(map(str, got)) == sorted(map(str, [None, "unknown_source", "address", "other_site", "headline", "date", "before_window"]))
    known = entries.manual_entries(e.limit(1), registry, F.lit("2026-10-01").cast("timestamp")).select("candidate_id")
    found = spark.createDataFrame([("https://b.a.com/1/", "x"), ("https://a.com/9", "y"), ("https://a.com/9?utm_id=1", "y"), ("https://new.org/1", "z"), ("nowhere", "n")], "url string, headline string")
    out = {(r["publication"], r["paywalled"], r["extra"]) for r in entries.extra_entries(found, registry, known).collect()}
    assert out == {("A News", True, True), ("new.org", False, True)}


def test_settings(spark, tmp_path):
    f = tmp_path / "settings.json"
    f.write_text('{"stage1": {"threshold": 3.5, "strict": true}}')
    s = entries.Settings(spark, str(f), {"stage1.cap": 8})
    assert s.number("stage1.threshold") == 3.5 and s.flag("stage1.strict") and s.number("stage1.cap") == 8 and s.get("stage2.x") is None
    with pytest.raises(ValueError):
        s.number("stage1.strict")


def test_items(spark):
    schema = "item_id string, at timestamp, section string, mechanism string, claim string, domains array<string>, classes array<string>, sources array<struct<url: string, publication: string, source_class: string>>, backfilled boolean, update_of string"
    src = [("https://a.com/1", "A", "news"), ("http://b.com", "B", "regulator"), ("https://c.com/", "C", "news")]
    df = spark.createDataFrame([("i1", None, "s", "m", "Claim", ["x", "x", None], ["own"], src, None, None), ("i2", None, "s", "m", "Second", None, None, None, True, "i1"), ("i3", None, "s", "odd", "c", None, None, None, None, None), (None, None, "s", "m", "c", None, None, None, None, None)], schema)
    read = entries.items_as_read(df.withColumn("at", F.lit("2026-10-02 18:00:00").cast("timestamp")), ("m",), {"x": "Cloud risk", "y": "Models"})
    got = {r["item_id"]: r for r in read.collect()}
    assert set(got) == {"i1", "i2"} and got["i1"]["domains"] == ["x"] and got["i1"]["classes"] == ["own", "news", "regulator"] and got["i1"]["sources"][1]["url"] is None
    assert got["i1"]["search"] == "claim cloud risk a b c" and got["i1"]["uncovered"] == ["y"] and got["i2"]["uncovered"] == ["x", "y"] and got["i2"]["backfilled"] and not got["i1"]["backfilled"]
    d = {r["item_id"]: tuple(r)[1:6] for r in entries.item_details(read, F.lit("2026-10-05").cast("timestamp"), {"x": "Cloud risk", "y": "Models"}).collect()}
    assert d == {"i1": ("Claim", "Cloud risk", "3 sources", "2 Oct", None), "i2": ("Second", "", "one source", "2 Oct", "Claim")}

"""Markup, extraction, feed dates, checks, publishing, passes: rows of our own, nulls and odd rows included."""

import json

import pytest
from pyspark.sql import functions as F

from siftmill.functions import dates, extract, markup, url
from siftmill.operators import backfill, checks, lexicon, publish, similar
from siftmill.sources import registry
from siftmill.streaming import ledger


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


def test_markup(spark):
    page = "<html><head><title> A \n b </title></head><body><nav>x<nav>y</nav>z</nav><h1>Not <b>here</b></h1><div class='a sidebar'>s<div>t</div></div>text&nbsp;&#8217;</body></html>"
    assert one(spark, page, markup.title) == "A b"
    assert one(spark, page, markup.headings) == ["Not here"]
    assert one(spark, page, markup.main_text) == "A b Not here text&nbsp;&#8217;"
    assert one(spark, "a &amp;amp; b &#146;&eacute;", markup.element_text) == "a & b ’é"
    assert one(spark, None, markup.element_text) is None and one(spark, None, markup.main_text) is None
    assert markup.without("a<p>b<p>c", lambda t, a: t == "p") == "a"
    assert one(spark, "<a href=\"x\">&", markup.escape) == "&lt;a href=&quot;x&quot;&gt;&amp;"
    assert one(spark, "<meta http-equiv=refresh content='0; url=/next'>", markup.refresh_target) == "/next"
    assert [one(spark, m, markup.content_kind) for m in ("Text/HTML; charset=x", "application/ld+json", "image/png", "")] == ["html", "json", "other", None]
    soft = [one(spark, f"<title>{t}</title><h1>{h}</h1><p>{p}</p>", markup.soft404) for t, h, p in (("Page not found", "", ""), ("x", "Error 404", ""), ("x", "y", "This article was removed"), ("1404 x", "y", "z"))]
    assert soft == ["title", "heading", "text", None]


def test_addresses(spark):
    df = spark.createDataFrame([("../c", "https://a.org/x/y"), ("javascript:x", "https://a.org"), (None, None), ("http://[", "http://b")], "a string, b string")
    assert [r[0] for r in df.select(markup.resolve("a", "b")).collect()] == ["https://a.org/c", None, None, None]
    wall = spark.createDataFrame([("https://a.org/x", "https://a.org/login?x"), ("https://a.org/x/y", "https://a.org/"), ("https://a.org/", "https://a.org/"), ("https://a.org/login", "https://a.org/login")], "a string, b string")
    assert [r[0] for r in wall.select(markup.access_wall(F.col("a"), F.col("b"))).collect()] == ["login", "home", None, None]
    assert [one(spark, u, url.disallowed) for u in ("https://t.co/x", "https://a.org/amp/x", "https://a.org/?u=https%3A//b.org", "https://at.co/x", None)] == ["relay", "amp", "redirect", None, None]
    assert one(spark, "https://x.gov/c?q=cve-2024-12345", url.cve_of) == "CVE-2024-12345"
    assert one(spark, "https://a.org/b/?q#f", lambda c: url.canary(c, F.lit("zz"))) == "https://a.org/b-zz"


def test_extraction(spark):
    assert one(spark, "cve-2024-12345 and CVE-2024-12345", extract.cves) == ["CVE-2024-12345"]
    assert one(spark, "In 2024, 1,500 of 12 firms paid $3 bn or 5 percent; 099", extract.numbers) == ["1500", "3b", "5%"]
    assert one(spark, "The report by Acme Corp on NATO and iPhone used AES256. Later it ended.", extract.proper_nouns) == ["AES256", "Acme", "Corp", "NATO", "iPhone"]
    assert [one(spark, t, extract.first_person) for t in ("As we said", "The US said", "Then I ran", "power", None)] == ["we", "", "i", "", ""]
    assert one(spark, 'Dr. Smith spoke. "Yes." He left.', extract.extra_sentences) == 2
    assert one(spark, "Café U.S. state-of-art 1,000 & x", extract.verbatim_words) == ["cafe", "us", "stateofart", "1000", "and", "x"]
    assert one(spark, "NEAR E2 (min_reach): x", extract.near_marker).asDict() == {"element": "E2", "knob": "min_reach"}
    assert one(spark, "none", extract.near_marker) is None
    lead = lambda t: one(spark, t, lambda c: extract.without_headline(c, F.lit("Big news")))
    assert (lead("BIG NEWS: it came"), lead("Big newspapers"), lead("")) == ("it came", "Big newspapers", "")
    words = spark.createDataFrame([(["a", "b"], ["b", "c", "d"]), ([], ["a"])], "a array<string>, b array<string>")
    assert [r[0] for r in words.select(extract.overlap(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0]


def test_feed_dates(spark):
    texts = ["Tue, 03 Mar 2026 10:00:00 GMT", "3 Mar 2026 10:00 -0500", "2026-03-03T10:00:00.5Z", "2026-03-03", "03-Mar-2026", "", None, "soon", "1 Jan 1901", "31 Feb 2026 10:00 EST", "Tue, 03 Mar 2026 10:00 EDT"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", dates.feed_date(F.col("t")).alias("d")).orderBy("i")
    rows = [(str(r.ts) if r.ts else None, r.status, r.date_only) for r in df.select("d.*").collect()]
    day = "2026-03-03"
    assert rows[:5] == [(f"{day} 10:00:00", "ok", False), (f"{day} 15:00:00", "ok", False), (f"{day} 10:00:00", "ok", False), (f"{day} 00:00:00", "ok", True), (f"{day} 00:00:00", "ok", True)]
    assert [r[1] for r in rows[5:]] == ["missing", "missing", "unparsed", "implausible", "unparsed", "ok"]
    assert rows[10][0] == f"{day} 14:00:00"
    w = one(spark, "2026-03", dates.month_window)
    assert (str(w.start), str(w.until)) == ("2026-03-01 05:00:00", "2026-04-01 04:00:00")
    assert str(one(spark, "2026-03-08-0600", dates.slot_instant)) == "2026-03-08 10:00:00" and one(spark, "2026-03-08-0700", dates.slot_instant) is None


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, None, 3), (2, "b", 9)], "id long, name string, at long")
    found = checks.collected(checks.row_checks(df, "id", [("name", "error", "name", F.col("name") == "a")]), checks.unique(df, "id"), checks.ordered(df.withColumn("g", F.lit(1)), "id", ["g"], "name", "at"))
    assert sorted((r.rule, r.entity, r.message) for r in found.na.fill("-").collect()) == [("name", "2", "-"), ("name", "2", "b"), ("unique", "2", "2")]
    with pytest.raises(ValueError, match="3 errors"):
        checks.gate(found)
    assert checks.gate(found.where("false")) == 0


def test_commit(spark, tmp_path):
    rows, record = spark.range(3).withColumn("x", F.lit("y")), spark.range(1)
    publish.commit({"items": rows}, str(tmp_path), "r1", record)
    rows.write.parquet(f"{tmp_path}/items/run_id=r2")  # a run that broke off before its record
    assert publish.committed(spark, str(tmp_path), "items").count() == 3
    publish.commit({"items": rows.limit(2)}, str(tmp_path), "r2", record)
    assert publish.committed(spark, str(tmp_path), "items").count() == 5
    with pytest.raises(ValueError, match="recorded"):
        publish.commit({"items": rows}, str(tmp_path), "r1", record)


def test_passes(spark):
    assert [r.pass_key for r in backfill.months(spark, "2025-12", "2026-02").collect()] == ["2025-12", "2026-01", "2026-02"]
    items = spark.createDataFrame([("i", ["u1", "u2", "u3"]), ("j", ["u9"])], "id string, urls array<string>")
    seen = spark.createDataFrame([("u2", 5), ("u3", 5), ("u1", 7)], "url string, at int")
    assert [tuple(r) for r in backfill.item_timing(items, "id", "urls", seen, "url", "at").collect()] == [("i", "u2", 5)]
    checks_ = spark.createDataFrame([("u", 1, 404), ("u", 2, 200), ("u", 2, 200)], "url string, at int, status int")
    r = backfill.check_history(checks_, "url", "at").first()
    assert (r.latest.status, len(r.history)) == (200, 2)
    c = spark.sql("SELECT 200 AS s, 'html' AS k, CAST(NULL AS string) AS n, timestamp'2026-01-02' AS at, timestamp'2026-01-02 12:00:00' AS now")
    assert c.select(backfill.check_verdict(F.col("s"), F.col("k"), F.col("n"), F.col("n"), F.col("at"), F.col("now"))).first()[0] is None


def test_chains(spark):
    rows = [(i, i - 1 if i else None) for i in range(70)] + [(100, 99), (101, None)]
    got = {r.k: (r.root, r.hops) for r in similar.chain_root(spark.createDataFrame(rows, "k long, up long"), "k", "up").collect()}
    assert got[69] == (0, 69) and got[0] == (0, 0) and got[100] == (100, 0) and got[101] == (101, 0)


def test_registry(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps([{"id": "a-b", "publication": "A", "type": "feed", "url": "https://www.a.org/f"}, {"id": "Bad", "publication": "B", "type": "feed", "url": "http://b.org", "paywalled": True, "lead_words": 90}]))
    s = registry.documents(spark, str(tmp_path / "s.json"), registry.SOURCE)
    assert sorted(r.rule for r in registry.source_violations(s, ["feed"]).collect()) == ["https", "id", "paywall"]
    pages = spark.createDataFrame([("https://news.a.org/1",), ("https://c.org/",)], "u string")
    assert {r.u: r.source_id for r in registry.source_of(pages, "u", s).collect()} == {"https://news.a.org/1": "a-b", "https://c.org/": None}
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n{bad\n')
    assert sorted((r.a or 0, r.broken) for r in registry.lines(spark, str(tmp_path / "l.jsonl"), "a int").collect()) == [(0, "{bad"), (1, None)]
    (tmp_path / "c.md").write_text("| Code | Verdict |\n|---|---|\n| `GL_X` | drop |\n| `CS_Y` | pass |\n")
    assert [tuple(r) for r in registry.code_table(spark, str(tmp_path / "c.md"), 2).collect()] == [("GL_X", "drop"), ("CS_Y", "pass")]
    with pytest.raises(ValueError, match="fewer"):
        registry.code_table(spark, str(tmp_path / "c.md"))
    entry = lambda n, t, d: {"title": n, "type": t, "html_url": f"https://r.gov/{n}", "publication_date": d, "agencies": [{"slug": "x"}]}
    (tmp_path / "p.json").write_text(json.dumps({"results": [entry("a", "Rule", "2026-01-05"), entry("b", "Notice", "2026-01-05"), entry("c", "Rule", "2025-01-05"), entry("", "Rule", "x")]}))
    r = registry.rule_candidates(registry.documents(spark, str(tmp_path / "p.json"), registry.RULE_PAGE), F.lit("2026-01-01").cast("date"), F.lit("2026-02-01").cast("date"))
    assert [x.skipped for x in r.collect()] == [None, "not_rule", "out_of_window", "invalid"]


def test_lexicon(spark):
    terms = {"data centre": 1.0, "data": 2.0, "centre*": 1.0, "cs:US": 1.0, r"re:\\d+%": 1.0}
    terms = {t.replace("\\\\", "\\"): w for t, w in terms.items()}
    got = one(spark, "US data-centres, for us: 5%", lambda c: lexicon.hits(c, terms))
    assert [(h.term, h.start) for h in got] == [("cs:US", 0), ("data", 3), ("centre*", 8), (r"re:\d+%", 25)]
    assert one(spark, None, lambda c: lexicon.hits(c, terms)) == []
    df = spark.createDataFrame([(1, "Bank of England and the Bank; bank of england"), (2, None)], "id int, t string")
    assert [tuple(r) for r in lexicon.entities(df, "id", "t", {"Bank of England": "BoE", "the Bank": "BoE"}).collect()] == [(1, "BoE", 0)]


def test_publish_batches(spark, tmp_path):
    for i in (0, 1):
        spark.range(i, i + 3).selectExpr("id", f"{i} AS x").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("id long, x int").parquet(f"{tmp_path}/in")
        ledger.publish_batches(stream, "id", f"{tmp_path}/out", f"{tmp_path}/state")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select("id", "x").collect()) == [(0, 0), (1, 0), (2, 0), (3, 1)]

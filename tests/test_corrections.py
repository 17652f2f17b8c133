"""Cases written by hand for answers that were wrong, and rules of reasons, pages and entries."""

from pyspark.sql import functions as F

from siftmill.functions import dates, markup, reasons, url
from siftmill.operators import backfill, collect, judging, readmodel
from siftmill.sources import entries
from tests.test_functions import one


def test_malformed_dates_are_rows(spark):
    schema = "run_id string, slot_at timestamp, started timestamp, finished timestamp, status string, items array<string>, in_window long, unseen long, stage1 long, stage2 long, published long, mechanisms map<string, long>"
    bad = [("bad-run",), ("2026-99-99-1400",), (None,), ("",)]
    df = spark.createDataFrame([(*r, None, None, None, "published", ["x"], 1, 1, 1, 1, 1, {"a": 1}) for r in bad], schema)
    assert {r["entity"] for r in judging.run_checks(df).where("rule = 'run_id'").collect()} == {"bad-run", "2026-99-99-1400", None, ""}
    assert [one(spark, s, dates.next_slot) for s in ("2026-10-02-1800", "garbage", "2026-13-02-0600", None, "2026-10-02-0700")] == ["2026-10-03-0600", None, None, None, None]
    lead = "Minutes, Oslo, 4 July 2019."
    assert [one(spark, s, lambda c: collect.reposted(F.lit(lead), c)) for s in ("2020-01-01", "soon", None, "2019-07-05")] == [True, False, False, False]


def test_reasons(spark):
    p = lambda s: tuple(one(spark, s, reasons.parsed))
    assert p("[M3] NEAR E3/min_outlets: two outlets [alt EV:E4a/min_scope]") == (3, "E3", "min_outlets", "EV", "E4a", "min_scope", "two outlets")
    assert p("NEAR R3f: late") == (None, "R3f", None, None, None, None, "late") and p("[M1] plain [alt CS:C2]") == (1, None, None, "CS", "C2", None, "plain")
    assert p("it was NEAR E3: no") == (None, None, None, None, None, None, "it was NEAR E3: no") and p(None) == (None,) * 7


def test_reason_marks(spark):
    codes = spark.createDataFrame([("EV_SMALL", "E2"), ("GL_OLD", "G7")], "code string, element string")
    knobs = spark.createDataFrame([("min_scope", "E2, C4"), ("max_age", "G7")], "knob string, elements string")
    rows = [
        ("EV_SMALL", "NEAR E2/min_scope: x", None), ("EV_SMALL", "NEAR E2a/min_scope: x", None), ("EV_SMALL", "NEAR E3: x", "near_element"), ("EV_SMALL", "NEAR E2/odd: x", "knob_unknown"), ("EV_SMALL", "NEAR E2/max_age: x", "knob_element"),
        ("GL_OLD", "NEAR G7/max_age: x", None), ("GL_OLD", "NEAR G7: x", "near_fixed"), ("GL_NEW", "NEAR G1: x", "near_gate"), ("EV_SMALL", "very NEAR", "near_form"), ("EV_SMALL", "x [alt EV]", "alt_form"), ("EV_SMALL", "x [alt EV:C4/min_scope]", None),
        ("EV_SMALL", "x [alt EV:C5/min_scope]", "alt_knob_element"), ("EV_SMALL", None, None), (None, "NEARLY", None), ("RT_FORMAL", "x", "scope"), ("GL_FORMAL", "x", None),
    ]
    log = spark.createDataFrame([(i, c, r, "drop") for i, (c, r, _) in enumerate(rows)] + [(99, "EV_SMALL", "NEAR E2: x", "pass")], "id int, code string, reason string, verdict string")
    out = reasons.mark_problems(log, "id", "code", "reason", "verdict", codes, knobs, {"GL_OLD": ("G7", "max_age")}, scope="none", scoped={"none": ("GL_FORMAL",), "any": ("RT_FORMAL",)})
    assert {(int(r["entity"]), r["rule"]) for r in out.collect()} == {(i, r[2]) for i, r in enumerate(rows) if r[2]} | {(99, "near_pass")}


def test_run_table_and_archive(spark):
    runs = spark.createDataFrame([("r1", "published", 9, 3, {"a": 2, "b": 1}, "s1"), ("r2", "failed", 0, 2, None, "s2"), ("r3", "silent", 4, 0, {"a": 0}, "s3")], "run string, status string, unseen int, stage1 int, mech map<string, long>, slot string")
    log = spark.createDataFrame([("r1", "new", "pass"), ("r1", "cluster_merged", "pass"), ("r1", None, "drop")], "run string, dedup string, verdict string")
    got = {tuple(r) for r in readmodel.run_table(runs, log, "run", "status", "stage1", ("unseen",), "mech").collect()}
    assert got == {("r1", "published", 9, 3, 3, 2, 1, False), ("r2", "failed", 0, 0, 0, 0, 0, True), ("r3", "silent", 4, 0, 0, 0, 0, False)}
    items = spark.createDataFrame([("s1", "a", False), ("s1", "a", True), ("s1", "c", False), ("s9", "b", False)], "at string, m string, back boolean")
    assert {tuple(r) for r in readmodel.archive_by_mechanism(runs, "slot", "mech", items, "at", "m", ~F.col("back")).collect()} == {("a", 2, 1), ("b", 1, 0), ("c", 0, 1)}


def test_unknown_keys_are_kept(spark):
    df = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    assert {tuple(r) for r in readmodel.zero_filled(df, "k", ["a", "b"], F.count(F.lit(1)).alias("n")).collect()} == {("a", 0, 1), ("b", 1, 0), ("x", 2, 2)}


def test_addresses(spark):
    norm = lambda u: one(spark, u, url.normalise)
    assert [norm(u) for u in ("https://a.com/x/../y/./z", "https://a.com:0443/x", "https://a.com/%2e%2e/b", "https://bücher.example/ä", "https://a.com/a b?q=c d", "https://a.com/..", "https://a.com/x..y/.z")] == [
        "https://a.com/y/z", "https://a.com/x", "https://a.com/b", "https://xn--bcher-kva.example/ä", "https://a.com/a%20b?q=c+d", "https://a.com", "https://a.com/x..y/.z",
    ]
    assert norm("https://a.com/?mod=rss_World") == "https://a.com" and norm("https://a.com/?mod=cart") == "https://a.com?mod=cart"


def test_missing_pages_and_walls(spark):
    soft = lambda h: one(spark, h, markup.soft404)
    long = "<p>" + "words and more words " * 200 + "</p>"
    assert [soft(f"<title>x</title><h1>y</h1><h2>Not found</h2>{long}"), soft(f"<title>x</title>{long}<div>The page you were looking for could not be found</div>"), soft(f"<title>Error 404</title>{long}"), soft(f"<title>The 404 best hikes of this whole region</title>{long}"), soft(long + "404")] == ["heading", "text", "title", None, None]
    rows = [
        ("https://a.test/x/1", "https://unblock.a.test/", "", 1, "wall_host"), ("https://a.test/x/1", "https://a.test/x/1", "Just a moment...", 0, "wall_title"), ("https://a.test/x/1", "https://a.test/x/1", "How to request access to records held by the state archive", 0, None),
        ("https://a.test/x/1", "https://a.test/en/", "", 1, "home"), ("https://a.test/x/1", "https://a.test/", "", 0, None), ("https://a.test/?id=5", "https://a.test/?lang=en&id=5", "", 1, None), ("https://a.test/x/1", "https://a.test/404.html", "", 1, "error_page"),
        ("https://a.test/x/1", "https://a.test/search", "", 1, "search_page"), ("https://a.test/x/1", "https://www.a.test/x/", "", 1, "parent"), ("https://a.test/x/1", "https://a.test/x/1/", "", 1, None), ("https://a.test/", "https://a.test/en", "", 1, None),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, f string, t string, n int, want string")
    assert df.select("want", markup.wall_reason(F.col("a"), F.col("f"), F.col("t"), F.col("n")).alias("got")).where("NOT (want <=> got)").count() == 0


def test_extra_entries_take_the_least(spark):
    registry = spark.createDataFrame([("s2", "Second", "news", False, "https://a.test"), ("s1", "First", "trade", True, "https://www.a.test/x")], "source_id string, publication string, source_class string, paywalled boolean, home string")
    e = spark.createDataFrame([("https://a.test/p/", "later"), ("https://a.test/p", "earlier"), ("https://b.test/q", "q"), ("nowhere", "n")], "url string, headline string").repartition(4)
    known = spark.createDataFrame([], "candidate_id string")
    got = {(r["url"], r["headline"], r["publication"], r["paywalled"]) for r in entries.extra_entries(e, registry, known).collect()}
    assert got == {("https://a.test/p", "earlier", "First", True), ("https://b.test/q", "q", "b.test", False)}


def test_passes(spark):
    items = spark.createDataFrame([("b", True, 5), ("a", True, 5), ("c", True, 3), ("d", False, 4), ("e", None, 4), ("f", True, 9)], "item_id string, back boolean, at int")
    assert [r["item_id"] for r in backfill.backfilled_in_window(items, "back", "at", F.lit(3), F.lit(9)).collect()] == ["c", "a", "b"]
    words = lambda s: s.split()
    df = spark.createDataFrame([(1, words("a b c d e")), (2, words("x a b c d")), (3, words("b c d e z")), (4, words("q r s t"))], "id int, w array<string>")
    got = {(r["id"], r["earlier"]) for r in backfill.repeats_earlier(df.withColumn("o", F.col("id")), "id", "o", "w", 4).collect()}
    assert got == {(2, 1), (3, 1)}

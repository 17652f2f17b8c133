"""Column functions on rows of our own, daylight-saving days included; feeds, catalogues, ledger stream."""

import json
import math

from pyspark.sql import functions as F

from siftmill.functions import dates, text, url
from siftmill.operators import readmodel, score, similar, state
from siftmill.plans import queries
from siftmill.sources import catalogue
from siftmill.streaming import ledger


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


def test_text(spark):
    assert one(spark, " a ​ b\n", text.collapse) == "a b"
    assert one(spark, "<p>A<b>b</b></p><script>x</script><br>c", text.strip_html) == "Ab c"
    assert one(spark, "one two three", lambda c: text.lead(c, 2)) == "one two…"
    assert one(spark, "don't 1.5 x-ray — ok", text.word_count) == 4
    assert one(spark, "B a 12 b cd-ef CD", text.tokens) == ["cd", "ef"]
    assert [one(spark, w, text.stem) for w in ("policies", "testing", "class", "cars", "red")] == ["policy", "test", "class", "car", "red"]
    assert one(spark, 1.005, lambda c: text.half_up(c, 2), "double") == 1.0
    assert one(spark, ["a", "b", "c"], lambda c: text.ngrams(c, 2), "array<string>") == ["a b", "b c"]
    assert one(spark, [], lambda c: text.jaccard(c, c), "array<string>") == 0.0


def test_url(spark):
    n = lambda u: one(spark, u, url.normalise)
    assert n("HTTP://User@News.Example.COM:80//a//b/?utm_source=x&q=1#top") == "https://news.example.com/a/b?q=1"
    assert n("ftp://x/") is None and n(None) is None
    assert one(spark, "a.b.example.co.uk", url.registrable) == "example.co.uk"
    assert one(spark, "x", url.registrable) == "x"


def test_slots(spark):
    at = lambda t, f: spark.sql(f"SELECT timestamp'{t}' AS x").select(f(F.col("x"))).first()[0]
    assert at("2026-03-08 09:59:59", dates.slot_of) == "2026-03-07-1800"  # 05:59 EDT on the day clocks go forward
    assert at("2026-03-08 10:00:00", dates.slot_of) == "2026-03-08-0600"
    assert at("2026-11-01 10:59:59", dates.slot_of) == "2026-10-31-1800"  # 05:59 EST
    assert at("2026-11-01 11:00:00", dates.slot_at_or_after) == "2026-11-01-0600"
    assert at("2026-11-01 23:00:00.5", dates.slot_at_or_after) == "2026-11-02-0600"


def test_score_first_reason(spark):
    rows = [("free license for $5", "", False), ("free license", "", True), ("", "x", False), ("plain words", "", False), (None, None, False)]
    out = score.stage_one(spark.createDataFrame(rows, "title string, lead string, seen boolean")).collect()
    assert [r["reason"] for r in out] == [None, "seen", "empty", "off_domain", "empty"] and out[0]["score"] == 6.0


def test_state(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("k", 3, "b"), (None, 1, "c")], "key string, ord int, src string")
    assert [tuple(r) for r in state.first_wins(df, "key", ["ord"], "src").collect()] == [("k", 1, "a", ["b"])]
    a = spark.createDataFrame([(1, 1, "x"), (2, 2, "y"), (3, 3, "z")], "id int, pos int, v string")
    b = spark.createDataFrame([(1, 1, "X"), (3, 2, "z"), (4, 3, "n")], "id int, pos int, v string")
    assert sorted(map(tuple, state.append_only_diff(a, b, "id", "pos").collect())) == [(1, "changed"), (2, "removed"), (3, "moved")]


def test_similar_brute_force(spark):
    import itertools
    import random

    rng = random.Random(1)
    sets = [sorted(rng.sample("abcdefghijkl", rng.randint(0, 9))) for _ in range(90)]
    df = spark.createDataFrame(list(enumerate(sets)), "id int, t array<string>")
    got = {(r["a"], r["b"]): r["jaccard"] for r in similar.jaccard_pairs(df, "id", "t", 0.55).collect()}
    want = {(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(sets), 2) if a and b and len(set(a) & set(b)) >= 0.55 * len(set(a) | set(b))}
    assert set(got) == want
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "a int, b int")
    assert {r["root"] for r in similar.clusters(path).collect()} == {0}


def test_sources(spark, tmp_path):
    v = [{"cveID": "CVE-2026-1234", "vendorProject": "V", "product": "P", "vulnerabilityName": "N", "dateAdded": "2026-01-05"}, {"cveID": "bad", "dateAdded": "2026-01-05"}, {"cveID": "CVE-2026-1235", "dateAdded": "2025-01-05"}]
    (tmp_path / "k.json").write_text(json.dumps({"catalogVersion": "1", "vulnerabilities": v}))
    assert [r["headline"] for r in catalogue.known_exploited(spark, str(tmp_path / "k.json"), "2026-01-01", "2026-02-01").collect()] == ["CVE-2026-1234 V P N"]
    rss = "junk <rss><channel><title>c</title><item><title>A &amp; b</title><link>http://x/1</link><pubDate>d</pubDate></item></channel></rss>"
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>T</title><link href="http://x/2"/><updated>u</updated></entry></feed>'
    out = catalogue.feed_entries(spark.createDataFrame([("r", rss), ("a", atom), ("z", "nope"), ("n", None)], "feed string, xml string")).collect()
    assert [(r["feed"], r["format"], r["title"], r["link"], r["published"], r["error"] is None) for r in out] == [("r", "rss", "A & b", "http://x/1", "d", True), ("a", "atom", "T", "http://x/2", "u", True), ("z", None, None, None, None, False), ("n", None, None, None, None, False)]


def test_ledger_stream(spark, sf_dir, tmp_path):
    src = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    src.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(src.schema).parquet(str(tmp_path / "in"))
    out = ledger.dedup_to_table(spark, stream, "user_id", "ts", str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r["user_id"] for r in out.collect()) == sorted(r["user_id"] for r in src.select("user_id").distinct().collect())
    again = ledger.dedup_to_table(spark, stream, "user_id", "ts", str(tmp_path / "out"), str(tmp_path / "cp"))
    assert again.count() == out.count()  # nothing twice


def test_matches_from_either_end(spark):
    pairs = spark.createDataFrame([(1, 2, 0.6), (1, 3, 0.9), (2, 3, 0.7)], "a int, b int, jaccard double")
    best = readmodel.top_k(similar.both_ways(pairs), "a", [F.desc("jaccard"), F.col("b")], 1)
    assert {(r.a, r.b, r.jaccard) for r in best.collect()} == {(1, 3, 0.9), (2, 3, 0.7), (3, 1, 0.9)}


def test_rank_ids_above_99(spark, tmp_path):
    rows = "SELECT id AS o_orderkey, 'O' AS o_orderstatus, '1-URGENT' AS o_orderpriority, TIMESTAMP_NTZ '2024-01-05 00:00:00' AS o_orderdate FROM range(1, 124)"
    spark.sql(rows).write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.o_orderkey: r.item_id for r in queries.rank_ids(spark, str(tmp_path)).collect()}
    assert len(got) == 123 and (got[1], got[99], got[123]) == ("240105-01", "240105-99", "240105-123")
    assert [tuple(r) for r in queries.rank_id_violations(spark, str(tmp_path)).collect()] == [("rank", "error", "2024-01-05", "day", "123")]


def test_scored_pairs_brute_force(spark):
    import itertools
    import random

    rng = random.Random(3)
    some = lambda letters, n: sorted(rng.sample(letters, rng.randint(0, n)))
    rows = [(i, some("abcdefghijkl", 9), some("PQRSTUVW", 3), some("123456", 2), some("xyzuvw", 3) if i % 5 == 0 else []) for i in range(80)]
    rows += [(80, list("abcd"), [], ["1", "2"], []), (81, list("abef"), [], ["1", "2"], []), (82, list("abc"), [], ["7", "8"], []), (83, list("abd"), [], ["7", "8"], [])]
    df = spark.createDataFrame(rows, "id int, tokens array<string>, proper array<string>, figures array<string>, cves array<string>")
    got = {(r.a, r.b): (r.score, r.level) for r in similar.scored_pairs(df, "id").collect()}
    want = {}
    for (i, *x), (j, *y) in itertools.combinations(rows, 2):
        t, p, n, c = (len(set(u) & set(v)) for u, v in zip(x, y, strict=True))
        s = (t / len(set(x[0]) | set(y[0])) if t else 0) + 0.12 * min(p, 3) + 0.08 * min(n, 2)
        if c:
            s = max(s, 0.9 if min(len(x[3]), len(y[3])) <= 2 else 0.6)
        s = math.floor(min(s, 1) * 100 + 0.5) / 100
        if s >= 0.35:
            want[i, j] = (s, "likely" if s >= 0.55 else "possible")
    assert got == want
    assert got[82, 83] == (0.66, "likely")  # Jaccard 0.5 and two figures

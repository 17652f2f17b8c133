"""The first stage against a plain version, and cases written by hand."""

import random

import regex
from pyspark.sql import functions as F

from siftmill.functions import dates, text, url
from siftmill.operators import collect, judging, prefilter, readmodel, similar
from siftmill.operators.lexicon import pattern
from siftmill.plans.scorer import RULES


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


def plain_hits(title, lead, terms):
    raw = []
    for i, t in enumerate(terms):
        for name, s, factor in (("title", title, 1.0), ("lead", lead, 0.5)):
            m = regex.search(pattern(t.term), s)
            if m:
                raw.append((-t.weight * factor, m.start() - m.end(), i, name, m.start(), m.end(), t))
                break
    kept = []
    for h in sorted(raw, key=lambda h: h[:3]):
        if not any(k[3] == h[3] and h[4] < k[5] and k[4] < h[5] for k in kept):
            kept.append(h)
    return kept


def up(x, digits=1):
    import math

    return math.floor(x * 10**digits + 0.5) / 10**digits


def plain_scores(title, lead, profile):
    if lead and regex.search(RULES.bare_headline, title):
        title, lead = f"{title}: {lead}", ""
    of = lambda c, g=None: [t for t in RULES.terms if t.component == c and g in (None, t.group)]
    names = list(dict.fromkeys(t.group for t in of("domain")))
    hits = {n: plain_hits(title, lead, of("domain", n)) for n in names}
    score = {n: up(min(sum(-h[0] for h in hits[n]), 6.0)) for n in names if hits[n]}
    domains = sorted((n for n in names if score.get(n, 0) >= 2.0), key=lambda n: (-score[n], names.index(n)))
    material = 0.0
    for g in dict.fromkeys(t.group for t in of("materiality")):
        if domains or g not in RULES.gated:
            material += max([t.weight * (1.0 if regex.search(pattern(t.term), title) else 0.5 if regex.search(pattern(t.term), lead) else 0.0) for t in of("materiality", g)])
    total = lambda terms: sum(-h[0] for h in plain_hits(title, lead, terms))
    parts = up(min(sum(score[n] for n in domains), 8.0)), min(material, 6.0), min(total(of("sector")), 5.0), min(total(of("enterprise")), 2.0), total([t for t in of("noise") if t.group in RULES.profiles[profile].noise])
    strong = any(h[6].tier == "strong" and h[3] == "title" for n in names for h in hits[n])
    return domains, score, *parts, up(sum(parts[:4]) - parts[4]), strong


def test_scores(spark):
    rng = random.Random(9)
    words = "license licensed under free that with this from there copyright der den The the buy now!! thatched with-out Licenses wow!! 12".split()
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, say(rng.randint(0, 7)), say(rng.randint(0, 12)), rng.choice(list(RULES.profiles))) for i in range(400)]
    rows += [(1000, "SR 26", "license that from", "standard"), (1001, "SR 26", "", "standard"), (1002, "", "", "lenient")]
    df = spark.createDataFrame([*rows, (1003, None, None, "standard")], "id long, title string, lead string, profile string")
    got = {r["id"]: r for r in prefilter.scores(df, RULES).collect()}
    for i, title, lead, profile in rows:
        r = got[i]
        assert (r["domains"], r["domain_scores"], *[r[c] for c in ("domain", "materiality", "sector", "enterprise", "noise", "score", "strong_in_title")]) == plain_scores(title, lead, profile), (title, lead)
    assert got[1003]["score"] == 0.0 and got[1003]["domains"] == []


def test_drops(spark):
    a = "https://news.test/a/1"
    rows = [
        ("license that from", "", "https://x.test/events/2", "standard", False, False, ("event", "events")), ("license that from", "", "https://x.test/eventsx/2", "standard", False, False, (None, None)),
        ("Week in review: license", "", a, "standard", False, False, ("roundup", "weekly")), ("Buy a license", "", a, "standard", False, False, ("marketing", "offer")), ("Thieves buy that license", "", a, "standard", False, False, (None, None)),
        ("Buy that license from", "", a, "lenient", False, False, (None, None)), ("license that from", "Sponsored words", a, "standard", False, False, ("marketing", "sponsored")), ("buy that license", "", a, "standard", True, False, ("seen", None)),
        ("nothing here", "", a, "standard", False, False, ("off_domain", None)), ("free license", "", a, "high_volume", False, False, (None, None)), ("with this words", "license that", a, "high_volume", False, False, ("below_threshold", "no strong term in title")),
        ("that", "", a, "standard", False, False, ("below_threshold", "2.0 < 3.0")), ("that", "", a, "standard", False, True, ("below_threshold", "entry of no consequence")), ("that der", "", "https://x.test/events/2", "standard", False, True, (None, None)),
    ]
    df = spark.createDataFrame([(i, *r[:6]) for i, r in enumerate(rows)], "id long, title string, lead string, url string, profile string, seen boolean, kev boolean")
    got = {r["id"]: (r["reason"], r["detail"]) for r in prefilter.stage_one(df, RULES, entry=F.col("kev")).collect()}
    assert got == {i: r[6] for i, r in enumerate(rows)}


def test_profiles(spark):
    p = lambda override, kind, u: spark.createDataFrame([(override, kind, u)], "o string, k string, u string").select(prefilter.profile_of(RULES, F.col("o"), F.col("k"), F.col("u"))).first()[0]
    assert [p("lenient", "news", "https://example.com/"), p("unheard", "news", "https://a.example.com/"), p(None, "regulator", "https://example.org/"), p(None, "news", None), p(None, "regulator", "https://notexample.com/")] == ["lenient", "high_volume", "lenient", "standard", "lenient"]


def test_terms():
    hit = lambda term, s: bool(regex.search(pattern(term), s))
    assert hit("third party", "Third-Party risk") and hit("third party", "thirdparty") and hit("third-party", "third party") and not hit("third party", "third parties")
    assert hit("cyber*", "Cybersecurity2 now") and not hit("cyber", "cybersecurity") and hit("cs:US", "the US") and not hit("cs:US", "tell us") and hit("re:out\\s?age", "OUTAGE") and hit("c++", "in C++ code")


def test_addresses(spark):
    norm = lambda u, **k: one(spark, u, lambda c: url.normalise(c, **k))
    assert norm("https://a.com:8443/x") == "https://a.com:8443/x" and norm("http://user:pw@A.com:80//x///?utm_source=1&id=2#top") == "https://a.com/x?id=2" and norm("https://a.com:443/") == "https://a.com"
    assert norm("https://a.com/?cmpid=1&CMP=2&partner=3&smid=4&syn-25a6b1a6=1&mc_x=1&id=5") == "https://a.com?id=5"
    assert norm("https://a.com/?mod=hp_lead_pos1") == "https://a.com" and norm("https://a.com/?mod=news") == "https://a.com?mod=news" and norm("https://github.com/a?ref=main") == "https://github.com/a?ref=main" and norm("https://a.com/?ref=main") == "https://a.com"
    assert norm("ftp://a.com") is None and norm(None) is None
    pages = {"status.test": (r"^/history/?$", r"^incident-[A-Za-z0-9-]+$")}
    assert norm("https://status.test/history/#incident-A1", pages=pages) == "https://status.test/history#incident-A1" and norm("https://status.test/history#other", pages=pages) == "https://status.test/history"
    assert one(spark, "https://www.federalregister.gov/documents/2026/03/04/2026-04321/title", url.government_document) == "2026-03-04/2026-04321"
    assert one(spark, "http://a.com/x", url.safe_link) is None and one(spark, "https://a.com/x?y#z", url.safe_link) == "https://a.com/x?y#z" and one(spark, "https://u@a.com/", url.safe_link) is None


def test_words(spark):
    stem = lambda w: one(spark, w, text.stem)
    assert [stem(w) for w in ("virus", "analysis", "access", "banks", "policies", "testing", "breached")] == ["virus", "analysis", "access", "bank", "policy", "test", "breach"]
    assert one(spark, "The banks' CVE-2024-12345 were breached in 2024, a bank", lambda c: text.story_tokens(c, ("the", "were", "in"))) == ["bank", "breach"]
    assert one(spark, "it’s don't a-b 1.5", text.word_count) == 4 and one(spark, "risk_and_more", lambda c: text.label(c, {"x": "y"})) == "Risk and more"


def test_times(spark):
    ts = lambda f: one(spark, "2026-10-02 18:00:00", lambda c: f(c.cast("timestamp")))
    assert ts(dates.et_iso) == "2026-10-02T14:00:00-04:00" and ts(dates.et_offset) == -240
    ok = lambda s: one(spark, s, dates.is_et_iso)
    assert [ok("2026-10-02T14:00:00-04:00"), ok("2026-10-02T14:00:00-05:00"), ok("2026-12-02T14:00:00-05:00"), ok("2026-13-02T14:00:00-05:00"), ok("x"), ok(None)] == [True, False, True, False, False, False]
    assert [one(spark, s, dates.is_iso_date) for s in ("2024-02-29", "2023-02-29", "2023-2-9", None)] == [True, False, False, False]
    now = F.lit("2026-10-05 12:00:00").cast("timestamp")
    assert [one(spark, s, lambda c: dates.when_short(c.cast("timestamp"), now)) for s in ("2026-10-02 18:00:00", "2026-03-02 18:00:00", "2025-03-02 18:00:00")] == ["Fri 14:00", "2 Mar", "2 Mar 2025"]


def test_candidates(spark):
    sources = spark.createDataFrame([("a", "A", "news", ["/video/"]), ("b", "B", "regulator", None)], "source_id string, publication string, source_class string, exclude array<string>")
    rows = [
        ("a", "https://a.test/1", " One  two ", "x", "2026-10-04 12:00:00", False, "ok"), ("a", "https://a.test/Video/2", "t", "x", "2026-10-04 12:00:00", False, "ok"), ("a", "https://a.test/3", "", "x", "2026-10-04 12:00:00", False, "ok"), ("a", "nowhere", "t", "x", None, None, "missing"),
        ("b", "https://eu.test/news/x-2026-10-03_en", "t", "said, Paris, 9 September 2026.", "2026-10-05 03:00:00", False, "ok"), ("b", "https://b.test/4", "t", "x", "2026-09-01 00:00:00", False, "ok"), ("b", "https://b.test/5", "t", "x", "2026-10-08 00:00:00", False, "ok"),
        *[("b", f"https://b.test/u{i}", "t", None, None, None, "missing") for i in range(5)], ("b", "https://b.test/6", "t", "x", None, None, "implausible"),
    ]
    entries = spark.createDataFrame(rows, "source_id string, link string, headline string, lead string, ts string, date_only boolean, date_status string").withColumn("ts", F.col("ts").cast("timestamp"))
    now, since = (F.lit(s).cast("timestamp") for s in ("2026-10-05 12:00:00", "2026-10-02 12:00:00"))
    got = {r["link"]: r for r in collect.candidates(entries, sources, now, since, {r"eu\.test$": r"-(\d{4})-(\d{2})-(\d{2})_[a-z]{2}$"}, undated=2).collect()}
    assert {k: r["window"] for k, r in got.items()} == {"https://a.test/1": "inside", "https://a.test/Video/2": "outside_rules", "https://a.test/3": "outside_rules", "nowhere": "outside_rules", "https://eu.test/news/x-2026-10-03_en": "inside", "https://b.test/4": "old", "https://b.test/5": "future", "https://b.test/u0": "undated", "https://b.test/u1": "undated", "https://b.test/6": "implausible"}
    eu = got["https://eu.test/news/x-2026-10-03_en"]
    assert eu["redated"] and eu["reposted"] and eu["published_date"] == "2026-10-03" and got["https://a.test/1"]["headline"] == "One two"


def test_run_checks(spark):
    good = ("2026-10-02-1400", "2026-10-02 18:00:00", "2026-10-02 18:05:00", "2026-10-02 18:40:00", "published", ["2026-10-02-1400-01"], 9, 5, 4, 3, 1, {"x": 1, "y": 0})
    schema = "run_id string, slot_at string, started string, finished string, status string, items array<string>, in_window long, unseen long, stage1 long, stage2 long, published long, mechanisms map<string, long>"
    changes = {"run_id": {"run_id": "2026-10-02-1500"}, "slot": {"slot_at": "2026-10-02 14:00:00"}, "finished_first": {"finished": "2026-10-02 18:01:00"}, "no_items": {"items": [], "published": 0, "mechanisms": {}}, "status": {"status": "odd"}, "items_listed": {"status": "silent"},
               "item_slot": {"items": ["2026-10-03-1400-01"]}, "items_repeat": {"items": ["2026-10-02-1400-01"] * 2, "published": 2, "mechanisms": {"x": 2}}, "published_count": {"published": 2}, "mechanism_sum": {"mechanisms": {"x": 2}}, "funnel": {"unseen": 10}}
    names = [c.split(" ")[0] for c in schema.replace("map<string, long>", "map").split(", ")]
    for rule, change in changes.items():
        row = tuple(change.get(n, v) for n, v in zip(names, good, strict=True))
        df = spark.createDataFrame([row], schema).withColumns({c: F.col(c).cast("timestamp") for c in ("slot_at", "started", "finished")})
        assert rule in {r["rule"] for r in judging.run_checks(df).collect()}, rule
    df = spark.createDataFrame([good], schema).withColumns({c: F.col(c).cast("timestamp") for c in ("slot_at", "started", "finished")})
    assert judging.run_checks(df).count() == 0


def test_resurfaced(spark):
    drafts = spark.createDataFrame([(1, None, ["https://a.test/x/"]), (2, "i2", ["http://a.test/x"]), (3, None, ["https://new.test"])], "draft long, update_of string, sources array<string>")
    archive = spark.createDataFrame([("i1", ["https://a.test/x"])], "item_id string, s array<string>")
    roots = spark.createDataFrame([("i1", "i1"), ("i2", "i1")], "item_id string, root string")
    assert [r["entity"] for r in judging.resurfaced(drafts, "sources", archive, "s", roots).collect()] == ["1"]


def test_hints_and_near(spark):
    s = spark.createDataFrame([(1, 0), (3, 1), (5, 2)], "id long, ord long")
    pairs = spark.createDataFrame([(1, 2, 0.6, "likely"), (1, 4, 0.9, "likely"), (1, 3, 0.7, "likely"), (3, 5, 0.4, "possible")], "a long, b long, score double, level string")
    got = {r["id"]: (r["cluster"], [m["id"] for m in r["archive_matches"] or []], [m["id"] for m in r["candidate_matches"] or []]) for r in similar.hints(s, pairs, "id", k=1).collect()}
    assert got == {1: ("k1", [4], [3]), 3: ("k1", [], [1, 5]), 5: (None, [], [3])}
    log = spark.createDataFrame([("NEAR B2/k_a: x [alt EV:C1/k_a]",), ("[M2] NEAR D3f: y",), (None,), ("it was NEAR D: no",), ("x [alt EV:C1/k_a] more",)], "reason string")
    assert {tuple(r) for r in readmodel.near_misses(log, "reason").collect()} == {("element", "B2/k_a", 1), ("alt", "C1/k_a", 1), ("knob", "k_a", 1), ("element", "D3f", 1), ("fixed", "D3f", 1)}

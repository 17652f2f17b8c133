"""The index of first words, and the rules of the first stage that came with it."""

import random
from dataclasses import replace

import regex
from pyspark.sql import functions as F

from siftmill.operators import prefilter
from siftmill.operators.lexicon import pattern
from siftmill.operators.prefilter import Profile, Rules, Term
from siftmill.operators.terms import TermIndex

TERMS = ["cyber*", "cybersecurity", "third party", "third-party risk*", "c++", "cs:US", ".net", "at&t", "re:out\\s?age", "straße*", "ai agent*", "ai", "l'été", "istanbul", "k2", "sub*", "σοφοσ"]


def test_index_misses_nothing(spark):
    rng = random.Random(3)
    parts = ["Cyber", "cybersecurity2", "cyberrisk", "THIRD", "party", "thirdparty", "-", " ", " ", " ", "risky", "C++", "us", "US", "asp.NET", ".net", "AT&T", "at", "outage", "STRAẞE", "Straßen", "ſ", "ΣΟΦΟΣ", "σοφος", "AI", "agents", "aiagent", "L'Été", "İstanbul", "K2", "K", "x", "é", "ſub", "Sub"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 8))) for _ in range(1500)] + ["", None]
    ix = TermIndex(TERMS)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", *[F.col("t").rlike(pattern(t)).alias(f"h{i}") for i, t in enumerate(TERMS)], *[ix.may(t, ix.present(F.col("t"))).alias(f"m{i}") for i, t in enumerate(TERMS)]).collect()
    met = 0
    for r in rows:
        for i in range(len(TERMS)):
            assert not r[f"h{i}"] or r[f"m{i}"], (r["t"], TERMS[i])
            met += bool(r[f"h{i}"])
    assert met > 500 and sum(not r[f"m{i}"] for r in rows for i in range(len(TERMS))) > 10_000  # and most searches are spared


def test_large_vocabulary_is_one_pass(spark):
    words = [f"w{i}x" for i in range(3000)]
    ix = TermIndex([*words, "w7*"])
    got = spark.createDataFrame([("W12X w7zz w2999x w3000x w71x",)], "t string").select(ix.present(F.col("t"))).first()[0]
    assert got == ["w12x", "w7", "w2999x"] and ix.keys["w71x"] == ["w7"]
    assert regex.fullmatch(ix.trie().replace(r"(?<![\p{L}\p{N}])", ""), "w12x")


RULES = Rules(
    terms=(Term("domain", "risk", 3.0, "loss model*", "strong"), Term("domain", "cloud", 2.0, "cloud", "strong"), Term("domain", "cloud", 1.0, "data", "weak"), Term("sector", "all", 1.0, "bank*")),
    profiles={"standard": Profile(2.0), "authority": Profile(1.0), "high_volume": Profile(9.0)}, narrow="risk", narrow_terms=("capital", "liquidity"), rescue_terms=("technology",),
    institutions={"cs:ECB": "European Central Bank", "central bank": "a central bank", "bundesbank": "Deutsche Bundesbank"}, by_path={"vendor": (("advisories",), r"(^|\.)lab\.test$")}, high_volume_hosts=r"(^|\.)busy\.test$",
)


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, title string, lead string, kev boolean, extra boolean").withColumns({"profile": F.lit("standard"), "seen": F.lit(False), "url": F.lit("https://a.test/x")})
    return {r["id"]: r for r in prefilter.stage_one(df, RULES, entry=F.col("kev"), **more).collect()}


def test_narrow_domain(spark):
    rows = [
        ("A loss model for capital", "", False, False), ("A loss model for capital", "and technology", False, False), ("A loss model for capital in the cloud", "", False, False), ("A loss model of data", "for liquidity", False, False),
        ("A loss model", "", False, False), ("Cloud capital", "", False, False), ("A bank's loss model for capital", "", True, False), (None, None, False, False),
    ]
    got = run(spark, rows)
    assert {i: (r["reason"], r["detail"]) for i, r in got.items()} == {
        0: ("off_domain", "capital"), 1: (None, None), 2: (None, None), 3: ("off_domain", "liquidity"), 4: (None, None), 5: (None, None), 6: (None, None), 7: ("off_domain", None),
    }
    plain = prefilter.stage_one(spark.createDataFrame([("A loss model for capital", "", "standard", False, "https://a.test")], "title string, lead string, profile string, seen boolean, url string"), replace(RULES, narrow=None)).first()
    assert plain["reason"] is None


def test_extra_rows_are_left_out(spark):
    rows = [("Cloud", "", False, True), ("Cloud", "", False, False), ("Cloud", "", False, None)]
    assert set(run(spark, rows, extra=F.col("extra"))) == {1, 2}


def test_institutions(spark):
    rows = [("Cloud at the ECB", "bundesbank", False, False), ("Cloud at the ecb", "Bundesbank speaks", False, False), ("Cloud banks, central bank, Bundesbank and ECB", "", False, False), ("Cloud", "", False, False)]
    assert {i: r["sector"] for i, r in run(spark, rows).items()} == {0: 2.0, 1: 1.0, 2: 3.0, 3: 0.0}


def test_profile_by_path(spark):
    p = lambda kind, own, source: spark.createDataFrame([(kind, own, source)], "k string, u string, s string").select(prefilter.profile_of(RULES, F.lit(None).cast("string"), F.col("k"), F.col("u"), F.col("s"))).first()[0]
    assert [p("vendor", "https://x.lab.test/Advisories/1", None), p("vendor", "https://x.lab.test/blog/1", None), p("vendor", "https://y.test/blog", "https://lab.test"), p("news", "https://lab.test/x", None), p("vendor", "https://busy.test/advisories/1", None)] == ["standard", "authority", "authority", "standard", "high_volume"]

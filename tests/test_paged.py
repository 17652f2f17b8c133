"""Recorded pages as a data source, agencies of a registry, rules of pages, records of documents."""

import json

import pytest
from pyspark.sql import functions as F

from siftmill.functions import url
from siftmill.sources import paged

HOSTS = r"(?:^|\.)rules\.test$"
BASE = "https://rules.test/api"


@pytest.fixture(scope="module")
def registry(spark):
    rows = [
        (1, "b", "Bureau", "https://rules.test/f?conditions%5Bagencies%5D%5B%5D=bureau&conditions[agencies][]=board", "US", 3, True),
        (0, "c", "Council", "https://x.rules.test/f?a=1&conditions[agencies][]=board&conditions[agencies][]=", "EU", None, None),
        (2, "d", "Off", "https://rules.test/f?conditions[agencies][]=off", "US", None, False), (3, "e", "Other", "https://rules.tests/f?conditions[agencies][]=other", "US", None, True),
        (4, "f", "Bad", "https://rules.test/f?conditions[agencies][]=%zz&%zz=1", "US", None, True), (5, "g", None, None, None, None, True),
    ]
    return spark.createDataFrame(rows, "position int, id string, publication string, url string, region string, lead_words int, enabled boolean")


def test_agencies(registry):
    got = {r["slug"]: (r["source_id"], r["publication"], r["region"], r["lead_words"]) for r in paged.agencies(registry, HOSTS).collect()}
    assert got == {"bureau": ("b", "Bureau", "US", 3), "board": ("c", "Council", "EU", None)}
    assert paged.agencies(registry.limit(0), HOSTS).count() == 0


def test_query_address(spark):
    r = spark.range(1).select(paged.query_address(BASE, F.lit("a b&c"), F.lit("2026-01-01").cast("date"), F.lit("2026-01-31").cast("date"), ("title",)).alias("u")).first()["u"]
    assert r.startswith(f"{BASE}?per_page=100&order=oldest&conditions%5Bagencies%5D%5B%5D=a+b%26c&") and r.endswith("%5Bgte%5D=2026-01-01&conditions%5Bpublication_date%5D%5Blte%5D=2026-01-31&fields%5B%5D=title")


def rule(n, day="2026-01-05", kind="Rule", host="rules.test", agencies=("bureau",), title="A  rule"):
    return {"title": title, "type": kind, "abstract": "one two three four five", "html_url": f"https://{host}/documents/2026/01/05/2026-{n:05d}/x", "publication_date": day, "document_number": f"2026-{n:05d}", "agencies": [{"slug": s} for s in agencies]}


@pytest.fixture(scope="module")
def recording(spark, tmp_path_factory):
    page = lambda results, link=None, **more: json.dumps({"results": results, "next_page_url": link, **more})
    rows = [
        (f"{BASE}?q=ok", 200, page([rule(1), rule(2, "2026-02-01"), "odd"], "/api?q=ok&page=2", count=9)), (f"{BASE}?q=ok&page=2", 200, page([rule(3, kind="Notice"), rule(4, agencies=("?", "board")), rule(5, title=" ")], f"{BASE}?q=ok&page=3", count=7)),
        (f"{BASE}?q=ok&page=3", 200, page([rule(6, "2026-13-01"), rule(7, host="elsewhere.test"), {**rule(8), "agencies": "none"}])), (f"{BASE}?q=ok", 500, "zzz"),
        (f"{BASE}?q=gone", 200, page([rule(9)], f"{BASE}?q=missing")), (f"{BASE}?q=away", 200, page([rule(10)], "https://other.test/api")), (f"{BASE}?q=busy", 503, None), (f"{BASE}?q=text", 200, "<html>"),
        (f"{BASE}?q=list", 200, "[1]"), (f"{BASE}?q=odd", 200, page({"a": 1})), (f"{BASE}?q=none", 200, '{"count": 0}'), (f"{BASE}?q=loop", 200, page([rule(11)], f"{BASE}?q=loop")), (None, 200, "x"),
    ]
    return paged.record(spark.createDataFrame(rows, "address string, status int, body string"), paged.Recording(str(tmp_path_factory.mktemp("r") / "rec"), 4))


def test_pages_and_report(spark, registry, recording):
    names = ["ok", "gone", "away", "busy", "text", "list", "odd", "none", "loop"]
    starts = spark.createDataFrame([(n, f"{BASE}?q={n}") for n in [*names, "ok"]], "agency string, address string")
    pages = paged.answers(spark, starts, recording, pages=4)
    assert pages.rdd.getNumPartitions() == len(names)
    errors = {(r["agency"], r["page"]): r["error"] for r in pages.collect() if r["error"]}
    assert errors == {("gone", 1): "no answer recorded", ("away", 0): "next page elsewhere", ("busy", 0): "HTTP 503", ("text", 0): "not JSON", ("list", 0): "not an object", ("odd", 0): "results are no list", ("loop", 4): "more than 4 pages"}
    rows = paged.rule_rows(pages, paged.agencies(registry, HOSTS), F.lit("bureau"), F.lit("2026-01-01").cast("date"), F.lit("2026-02-01").cast("date"), HOSTS)
    got = {r["document_number"]: r for r in rows.where("agency = 'ok'").collect()}
    assert {k: r["skipped"] for k, r in got.items()} == {"2026-00001": None, "2026-00002": "out_of_window", None: "invalid", "2026-00003": "not_rule", "2026-00004": None, "2026-00005": "invalid", "2026-00006": "invalid", "2026-00007": "invalid", "2026-00008": None}
    assert (got["2026-00001"]["lead"], got["2026-00001"]["headline"], got["2026-00001"]["source_id"]) == ("one two three…", "A rule", "b")
    assert (got["2026-00004"]["lead"], got["2026-00004"]["source_id"], got["2026-00004"]["found_in"], got["2026-00004"]["region"]) == ("one two three four five", "c", "b", "EU")
    table = {r["agency"]: tuple(r)[1:] for r in paged.report(pages, rows).collect()}
    assert table["ok"] == ("ok", 3, 9, 3, 4, 1, 1, None) and table["gone"] == ("failed", 1, None, 1, 0, 0, 0, "no answer recorded") and table["away"] == ("failed", 1, None, 1, 0, 0, 0, "next page elsewhere")
    assert table["busy"] == ("failed", 0, None, 0, 0, 0, 0, "HTTP 503") and table["none"] == ("ok", 1, 0, 0, 0, 0, 0, None) and table["loop"][:2] == ("failed", 4) and table["loop"][3] == 4
    assert paged.answers(spark, starts.limit(0), recording).count() == 0


def test_too_many_queries(spark, recording):
    with pytest.raises(ValueError):
        paged.answers(spark, spark.range(paged.MOST_STARTS + 1).selectExpr("'a' AS agency", "string(id) AS address"), recording)


def test_government_documents(spark):
    at = "https://www.federalregister.gov/documents/2026/03/04"
    cases = {f"{at}/2026-04321/title": "2026-03-04/2026-04321", f"{at}/C1-2026-04321": "2026-03-04/C1-2026-04321", f"{at}/E9-123/": "2026-03-04/E9-123", f"{at}/title": None, f"{at}/2026-1/a/b": None, f"{at}/2026--1": None, "https://www.federalregister.gov/documents/2026/02/30/2026-1": None, "http://www.federalregister.gov/documents/2026/03/04/2026-1": None, "https://a.federalregister.gov/documents/2026/03/04/2026-1": None, "https://www.federalregister.gov/d/2026-1": None, "odd": None}
    got = spark.createDataFrame([(u,) for u in cases], "u string").select("u", url.government_document(F.col("u")).alias("d")).collect()
    assert {r["u"]: r["d"] for r in got} == cases


def test_record_problem(spark):
    at = "https://www.federalregister.gov/documents/2026/03/04/2026-04321"
    own = {"html_url": f"{at}/another-title", "document_number": "2026-04321", "publication_date": "2026-03-04"}
    cases = [(own, None), ({**own, "html_url": at.upper().replace("HTTPS://WWW.FEDERALREGISTER.GOV/DOCUMENTS", "https://www.federalregister.gov/documents")}, None), ([1], "no_object"), ({**own, "html_url": "https://example.org"}, "no_document"), ({**own, "html_url": at.replace("04321", "04322")}, "other_document"),
             ({**own, "document_number": "2026-1"}, "other_number"), ({**own, "document_number": 5}, "other_number"), ({**own, "publication_date": "March"}, "no_date"), ({**own, "publication_date": "2026-03-05"}, "other_date"), ({"html_url": at, "publication_date": "2026-03-04"}, None)]
    df = spark.createDataFrame([(i, at, json.dumps(j)) for i, (j, _) in enumerate(cases)] + [(98, at, "{"), (99, at, None)], "i int, u string, j string")
    got = {r["i"]: r["p"] for r in df.select("i", paged.record_problem(F.col("u"), F.col("j"), F.lit("2026-03-04").cast("date")).alias("p")).collect()}
    assert got == {i: p for i, (_, p) in enumerate(cases)} | {98: "no_object", 99: "no_object"}

"""Nested rules, references through passes, filtered lists: cases written by hand."""

import itertools

from pyspark.sql import functions as F

from siftmill.operators import nested, passes, readmodel

ITEM = """item_id string, timestamp string, backfilled boolean, candidate_ids array<string>, section string, claim string, source_class string, mechanism string, domains array<string>,
 interpretation array<struct<domain: string, text: string>>, question string, rationale string, sources array<struct<publication: string, url: string, headline: string, published: string, source_class: string>>, update_of string, position int"""
GOOD = {
    "item_id": "I-260102-1400-01", "timestamp": "2026-01-02T14:00:00-05:00", "backfilled": False, "candidate_ids": None, "section": "events", "claim": "A claim.", "source_class": "news", "mechanism": "ask", "domains": ["a", "b"],
    "interpretation": [("a", "one"), ("b", "two"), ("c", "three")], "question": "Is it?", "rationale": None, "sources": [("P", "https://p.test/x", "H", "2026-01-01", "news"), ("Q", "https://q.test/x", None, None, None)], "update_of": None, "position": 1,
}
NAMES = list(GOOD)


def rules():
    return nested.item_rules(["events", "rules"], ["a", "b", "c"], ["news", "regulator"], {"ask": (("question",), ("rationale",)), "note": (("rationale",), ("question",))}, r"^I-\d{6}-(?:06|10|14|18)00-\d{2,}$")


def frame(spark, *changes):
    return spark.createDataFrame([tuple((GOOD | c)[n] for n in NAMES) for c in changes], ITEM)


def test_item_rules(spark):
    cases = [
        ({}, None), ({"item_id": "x"}, ("id", "item_id")), ({"item_id": "I-260102-1400-00"}, ("first_number", "item_id")), ({"timestamp": "2026-01-02T14:00:00-04:00"}, ("timestamp", "timestamp")), ({"backfilled": None}, ("backfilled", "backfilled")),
        ({"section": "odd"}, ("section", "section")), ({"claim": " "}, ("claim", "claim")), ({"mechanism": None}, ("mechanism", "mechanism")), ({"domains": ["a", "z"], "interpretation": [("a", "1"), ("z", "2")]}, ("domain", "domains[1]")), ({"domains": ["a", "a"]}, ("domains_repeat", "domains")),
        ({"interpretation": [("a", "one")]}, ("entry_missing", "domains")), ({"interpretation": [("c", "x"), ("a", "y"), ("b", "z")]}, ("entry_order", "interpretation")), ({"interpretation": [("a", "one"), ("b", "")]}, ("entry_text", "interpretation[1].text")), ({"interpretation": [("a", "1"), ("b", "2"), ("a", "3")]}, ("entry_repeats", "interpretation")),
        ({"question": None}, ("needed", "question")), ({"rationale": "x"}, ("barred", "rationale")), ({"mechanism": "note", "rationale": "r"}, ("barred", "question")), ({"sources": []}, ("sources", "sources")), ({"sources": None}, ("sources", "sources")),
        ({"sources": [("P", "http://p.test", None, None, None)]}, ("url", "sources[0].url")), ({"sources": [("P", "https://p.test/x", None, None, None), (None, "https://q.test", None, None, None)]}, ("publication", "sources[1].publication")),
        ({"sources": [("P", "https://p.test/x/", None, None, None), ("Q", "https://p.test/x?utm_source=1", None, None, None)]}, ("urls_repeat", "sources")), ({"sources": [("P", "https://p.test/x", "h" * 201, None, None)]}, ("headline", "sources[0].headline")), ({"sources": [("P", "https://p.test/x", None, "2026-13-01", None)]}, ("published", "sources[0].published")),
        ({"update_of": "c-0123456789"}, ("update_of", "update_of")),
    ]
    df = frame(spark, *[c | {"position": i} for i, (c, _) in enumerate(cases)])
    found = {}
    for r in nested.violations(df, "position", rules(), "archive").collect():
        found.setdefault(int(r["entity"]), set()).add((r["rule"], r["field"]))
    for i, (_, want) in enumerate(cases):
        assert (i not in found) if want is None else (want in found[i]), (i, found.get(i))
    draft = {"item_id": None, "timestamp": None, "backfilled": None, "candidate_ids": ["c-0123456789", "c-x", "c-x"], "update_of": "c-0123456789", "position": 7}
    got = {(r["rule"], r["field"]) for r in nested.violations(frame(spark, draft), "position", rules(), "draft").collect()}
    assert got == {("candidate", "candidate_ids[1]"), ("candidate", "candidate_ids[2]"), ("candidates_repeat", "candidate_ids")}


def test_unknown_fields(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "s": [{"u": 1, "x": 2}], "extra": {"deep": 1}, "t": ["p"]}'), (2, '{"a": 2}')], "id int, doc string")
    assert {(r["entity"], r["field"]) for r in nested.unknown_fields(df, "id", "doc", ["a", "s[].u", "t[]"]).collect()} == {("1", "s[0].x"), ("1", "extra.deep")}


def test_archive_and_new_rows(spark):
    second = {"item_id": "I-260102-1400-02", "position": 2}
    old = frame(spark, {}, {"item_id": "bad", "position": 0, "timestamp": "2026-01-01T10:00:00-05:00"})
    new = frame(spark, second, {"item_id": "I-260102-1400-01", "position": 3}, {"item_id": "I-260101-1000-01", "timestamp": "2026-01-01T10:00:00-05:00", "position": 4, "update_of": "I-991231-1800-01"})
    got = {(r["rule"], r["entity"]) for r in nested.revalidated(old, new, rules()).collect()}
    assert got == {("id_repeats", "I-260102-1400-01"), ("order", "I-260101-1000-01"), ("update_unknown", "I-260101-1000-01")}  # the old fault of "bad" is not counted again
    assert nested.revalidated(old, frame(spark, second), rules()).count() == 0


def test_references(spark):
    drafts = spark.createDataFrame([
        (0, "n0", ["c1"], None, 5), (1, "n1", ["c2"], "i1", 5), (2, "n2", ["c3"], "c1", 6), (3, "n3", ["c4"], "c9", 6), (4, "n4", ["c5"], "n2", 5), (5, "n5", ["c6"], "c6", 5), (6, "n6", ["c7"], "ghost", 5), (7, "n7", ["c8"], "i3", 9), (8, "n8", ["x1"], "dup", 9),
    ], "draft int, item_id string, candidate_ids array<string>, update_of string, at int")
    merged = spark.createDataFrame([("c9", "c10"), ("c10", "c11"), ("c11", "old1")], "candidate string, into string")
    archive = spark.createDataFrame([("i1", ["old1"], 1, None), ("i3", [], 2, "2026-09"), ("i4", ["dup"], 1, None), ("i5", ["dup"], 1, "2026-01")], "item_id string, candidate_ids array<string>, at int, pass_key string")
    got = {r["draft"]: (r["item"], r["problem"]) for r in passes.resolved_references(drafts, merged, archive, F.lit("2026-03")).collect()}
    assert got == {1: ("i1", None), 2: ("n0", None), 3: ("i1", None), 4: ("n2", "later"), 5: ("n5", "self"), 6: (None, "unknown"), 7: ("i3", "later_pass"), 8: ("i4", "twice")}


def test_pass_problems(spark):
    candidates = spark.createDataFrame([("a", 5), ("b", 9), ("c", 6), ("d", 7)], "candidate_id string, at int")
    judgments = spark.createDataFrame([("a", "ev", 0), ("b", "ev", None), ("c", "odd", 1), ("z", "ev", None)], "candidate_id string, section string, draft int")
    drafts = spark.createDataFrame([(0, "ev", 5), (1, "ev", 12)], "draft int, section string, at int")
    got = {(r["rule"], r["entity"]) for r in passes.pass_problems(judgments, candidates, drafts, ["ev", "rt"], F.lit(5), F.lit(9), F.lit(8)).collect()}
    assert got == {("outside_window", "b"), ("section", "c"), ("draft_section", "c"), ("not_registered", "z"), ("draft_outside", "1"), ("unjudged", "d"), ("open_window", "pass")}
    assert passes.pass_problems(judgments.where("candidate_id = 'a'"), candidates.where("candidate_id = 'a'"), drafts.where("draft = 0"), ["ev"], F.lit(5), F.lit(9), F.lit(9)).count() == 0


def test_list_view(spark):
    rows = [(i, tags, kind, "s" if i % 2 else None) for i, (tags, kind) in enumerate(itertools.product([None, [], ["x"], ["x", "x", "y"], ["z", None]], ["k", "m", None]))]
    df = spark.createDataFrame(rows, "id int, tags array<string>, kind string, sec string")
    chosen = {"tags": ["x", "z"], "kind": ["k"]}
    got = {(r["kind"], r["name"], r["value"]): r["n"] for r in readmodel.list_view(df, chosen, "sec").collect()}
    tag_ok = lambda t: bool(set(t or []) & {"x", "z"})
    want = {}
    add = lambda *k: want.__setitem__(k, want.get(k, 0) + 1)
    for _, tags, kind, sec in rows:
        ok = (tag_ok(tags), kind == "k")
        if ok[1]:
            for v in set(tags or []):
                add("facet", "tags", v)
        if ok[0]:
            add("facet", "kind", kind)
        if sum(ok) == 1:
            add("only", ("tags", "kind")[ok.index(False)], None)
        add("section", sec, "shown" if all(ok) else "hidden")
        if all(ok):
            add("total", None, None)
    assert got == want

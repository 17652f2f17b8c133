"""Rules of wording: cases written by hand for each finder, nested fields, exceptions, the earliest match."""

import pytest
from siftmill.operators import lint
from siftmill.operators.lint import SpanRule

KINDS, EVENTS = ("bank", "lender", "insurer", "exchange", "credit union"), ("hack", "outage", "outages", "failures?", "breach")


@pytest.fixture(scope="module")
def first(spark):
    def run(rule, *cases):
        df = spark.createDataFrame(list(enumerate(cases)), "id int, t string")
        got = {int(r["entity"]): r["message"] for r in lint.spans(lint.texts(df, "id", ["t"]), "id", [rule]).collect()}
        return [got.get(i) for i in range(len(cases))]

    return run


def test_unique_descriptor(first):
    rule = lint.unique_descriptor(KINDS, EVENTS, own=r"(?iu)organi[sz]ation['’]s")
    assert first(rule, "The second-largest regional bank fell.", "Spain's oldest insurer said", "the largest bank failures of 2023", "the only way a bank can win", "a lender", "the bank whose app failed", "the organisation's largest lender", "the largest bank failures; its sole exchange closed", None) == [
        "The second-largest regional bank", "Spain's oldest insurer", None, None, None, "the bank whose", None, "its sole exchange", None,
    ]


def test_name_by_ending(first):
    hard, soft = lint.name_by_ending(("Bank", "Credit Union", "Bancorp"), ("Insurance",), ("Central", "World", "National"), ("The", "A", "An", "UK"))
    assert first(hard, "Today Harbour Savings Bank paid", "The World Bank said", "the Swiss National Bank", "A Bank", "The Patel Credit Union", "Bank of Harbour Town", "UK Acme Bancorp", "World Bank and Acme Bank") == ["Today Harbour Savings Bank", None, None, None, "Patel Credit Union", None, "Acme Bancorp", "Acme Bank"]
    assert first(soft, "Cyber Insurance costs", "insurance", "Acme Bank") == ["Cyber Insurance", None, None] and soft.severity == "warning"


def test_named_event(first):
    rule = lint.named_event(KINDS, EVENTS, ("UK", "Hong", "Kong", "Crypto", "British"), ("The", "That"))
    assert first(rule, "Acmecoin $3m exchange hack", "The UK bank outage", "a Lagos bank outage", "Another Acme bank outage", "Crypto exchange hack; then Zed's lender breach", "an exchange hack", "The Hong Kong bank outage", "Acme Pay exchange outages") == ["Acmecoin", None, None, None, "Zed's", None, None, "Acme Pay"]


def test_back_reference(first):
    rule = lint.back_reference(KINDS, ("issuing", "central", "receiving"))
    assert first(rule, "The affected lender's staff", "the issuing bank", "the bank", "the European Central Bank", "The receiving bank and the targeted credit union") == ["The affected lender's", None, None, None, "the targeted credit union"]


def test_event_reference(first):
    rule = lint.event_reference(EVENTS)
    assert first(rule, "after the 3 May outage", "after the long outage", "following the recent Acme breach", "during the outage", "before the first hack, since the disclosed breach") == ["3 May", None, "recent Acme", None, "disclosed"]


def test_product_name(first):
    assert first(lint.product_name(("SaaS", "iOS")), "Is MailForge patched", "SaaS on iOS", "SaaS and eMailer", "plain WORDS") == ["MailForge", None, "eMailer", None]


def test_exceptions_and_order(first):
    rule = SpanRule("hedge", rf"{lint.B}(may|might){lint.E}", before=r"(?iu)\bin\s+$", after=r"^\s+\d{4}", unless="^MAY$")
    assert first(rule, "in May it may fail", "May 2024 might do", "in may", "MAY", "dismay", "It might. It may.") == ["may", "might", None, None, None, "might"]
    thrice = SpanRule("checklist", r"(?:^|,\s*|\band\s+)(is|are|does)\b", least=3)
    assert first(thrice, "Is it on, is it set and does it log?", "Is it on and does it log?") == ["Is", None]


def test_context_softens(spark):
    rows = [(1, "It had not patched the host."), (2, "It had not patched the host, the agency said."), (3, "x")]
    df = lint.texts(spark.createDataFrame(rows, "id int, t string"), "id", ["t"])
    rule = SpanRule("lapse", rf"{lint.B}had\s+not\s+patched{lint.E}", context=r"\bsaid\b", softened_to="warning")
    assert {(r["entity"], r["severity"]) for r in lint.spans(df, "id", [rule]).collect()} == {("1", "error"), ("2", "warning")}
    free = SpanRule("lapse", rule.pattern, context=r"\bsaid\b")
    assert {r["entity"] for r in lint.spans(df, "id", [free]).collect()} == {"1"}


def test_nested_fields(spark):
    schema = "id int, claim string, notes array<struct<domain: string, text: string, links: array<string>>>, deep struct<a: array<struct<b: array<struct<t: string>>>>>"
    rows = [
        (1, "you see", [("x", "plain", ["yours", None]), ("y", "all of you", None), ("z", None, ["ok", "your"])], ([([("you",), ("no",)],), (None,)],)),
        (2, None, None, None), (3, "bayou", [], ([],)), (4, "a\x01you\x02", None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    t = lint.texts(df, "id", ["claim", "notes[].text", "notes[].links[]", "deep.a[].b[].t"])
    you = SpanRule("second_person", rf"{lint.B}(?:you|yours?){lint.E}")
    got = {(r["entity"], r["field"], r["message"], r["start"]) for r in lint.spans(t, "id", [you]).collect()}
    assert got == {("1", "claim", "you", 1), ("1", "notes[0].links[0]", "yours", 1), ("1", "notes[1].text", "you", 8), ("1", "notes[2].links[1]", "your", 1), ("1", "deep.a[0].b[0].t", "you", 1), ("4", "claim", "you", 3)}
    only = {(r["entity"], r["field"]) for r in lint.spans(t, "id", [SpanRule("r", you.pattern, fields=("claim", "notes.text"), not_fields=("claim",))]).collect()}
    assert only == {("1", "notes[1].text")}
    assert lint.spans(t.limit(0), "id", [you]).count() == 0


def test_restated_and_order(spark):
    rows = [
        (1, "Harbour lights failed during winter storms", [("a", "Winter storms made harbour lights fail, failed"), ("b", "Insurance premiums climbed quickly afterwards"), ("a", "Quickly climbed premiums: insurance afterwards")], ["a", "b"]),
        (2, "Short claim here", [("b", "Nothing alike whatsoever"), ("c", None), ("a", "Other content entirely")], ["a", "b"]), (3, None, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, claim string, notes array<struct<domain: string, text: string>>, domains array<string>")
    t = lint.texts(df, "id", ["claim", "notes[].text"])
    got = {(r["rule"], r["entity"], r["field"], r["message"]) for r in lint.restated(t, "id", "claim", "notes.text").collect()}
    assert got == {("restates", "1", "notes[0].text", "claim 83"), ("repeats", "1", "notes[2].text", "notes[1].text 100")}
    assert {(r["entity"], r["message"]) for r in lint.out_of_order(df, "id", "domains", "notes", "domain").collect()} == {("1", "a,b,a"), ("2", "b,a")}


def test_spelling(first):
    assert first(lint.american_spelling({"organiz": "organis", "analyz": "analys"}), "they organized it", "Center for Organization", "analysis", "to reanalyze, analyzing") == ["organized", None, None, "analyzing"]

"""Rules of wording over nested text fields: matches with their surroundings, exceptions, the earliest that stands.

A rule is data. All vocabulary is a parameter; the finders below build rules from lists of words."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmill.functions import extract
from siftmill.operators.checks import COLUMNS

_OPEN, _SHUT = "\x01", "\x02"
#: Before and after a whole word, and a word of letters that may come between an article and a noun.
B, E = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_LINKS = "of for to that which who whom whose a an the and or in on at by with from as is are was were be been its their this these those than can could may might will would should must has have had not".split()
BETWEEN = rf"(?:(?!(?:{'|'.join(_LINKS)})\s)[\p{{L}}-]+\s+)"


@dataclass(frozen=True)
class SpanRule:
    """A pattern, and what excuses a match of it. Patterns are Java's, in any case unless ``cased``.

    ``group``: what is reported and, with ``strip`` (a pattern that is taken off first), what ``unless``, ``needs`` and ``names`` look at.
    ``before``, ``after``: a match is excused where the text up to it, or from its end on, has this. ``names``: words that say
    nothing; a match with no other word is excused. ``softened`` by ``context``: where the whole text has it, the severity is
    ``softened_to``, or none. ``fields``: names of fields (without numbers) that the rule reads, all if empty; ``not_fields``:
    those that it doesn't. ``least``: so many matches must stand."""

    name: str
    pattern: str
    severity: str = "error"
    cased: bool = False
    group: int = 0
    strip: str | None = None
    unless: str | None = None
    needs: str | None = None
    before: str | None = None
    after: str | None = None
    names: tuple[str, ...] = ()
    context: str | None = None
    softened_to: str | None = None
    fields: tuple[str, ...] = ()
    not_fields: tuple[str, ...] = ()
    least: int = 1

    def compiled(self) -> str:
        return self.pattern if self.cased else f"(?iu){self.pattern}"


def texts(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """``key, name, field, text``: a row for each text. A field is a column (``claim``), a field of a struct (``note.text``), the
    elements of an array (``tags[]``), or a field of each of its structs, at any depth (``sections[].notes[].text``); ``field``
    has numbers from 0 (``notes[2].text``), ``name`` has none. Null texts give no row."""

    def steps(c: Column, kind, path: list[str], label: Column) -> Column:
        """An array of ``field, text``."""
        if not path:
            return F.array(F.struct(label.alias("field"), c.cast("string").alias("text")))
        head, rest = path[0], path[1:]
        if head == "[]":
            none = F.array().cast("array<struct<field: string, text: string>>")
            each = F.transform(c, lambda x, i: steps(x, kind.elementType, rest, F.concat(label, F.lit("["), i.cast("string"), F.lit("]"))))
            return F.coalesce(F.flatten(each), none)
        dotted = F.concat(label, F.lit("."), F.lit(head))
        return steps(c[head], kind[head].dataType, rest, dotted)

    def one(field: str) -> Column:
        path = [p for p in regex.split(r"\.|(\[\])", field) if p]
        found = steps(F.col(path[0]), df.schema[path[0]].dataType, path[1:], F.lit(path[0]))
        return F.transform(found, lambda x: F.struct(F.lit(field.replace("[]", "")).alias("name"), x["field"].alias("field"), x["text"].alias("text")))

    return df.select(key, F.explode(F.concat(*map(one, fields))).alias("x")).select(key, "x.*").where("text IS NOT NULL")


def matches(c: Column, rule: SpanRule) -> Column:
    """``array<struct<word, start>>`` of the matches that stand, in order: marks are put around each match, so that it is seen
    with what comes before and after it, in the JVM and without a step for each character."""
    pattern = rule.compiled()
    plain = F.translate(c, _OPEN + _SHUT, "  ")
    parts = F.split(F.regexp_replace(plain, pattern, f"{_OPEN}$0{_SHUT}"), _OPEN)

    def seen(i: Column) -> Column:
        part = F.get(parts, i)
        whole = F.substring_index(part, _SHUT, 1)
        ahead = F.replace(F.array_join(F.slice(parts, F.lit(1), i), ""), F.lit(_SHUT), F.lit(""))
        return F.struct(whole.alias("whole"), ahead.alias("ahead"))

    def stands(m: Column) -> Column:
        word = F.regexp_extract(m["whole"], pattern, rule.group) if rule.group else m["whole"]
        if rule.group:  # where the surroundings are part of the pattern, the match alone doesn't show it again
            word = F.regexp_extract(F.substr(plain, F.length(m["ahead"]) + 1), pattern, rule.group)
        if rule.strip:
            word = F.regexp_replace(word, rule.strip, "")
        after = F.substr(plain, F.length(m["ahead"]) + F.length(m["whole"]) + 1)
        ok = [F.trim(word) != ""]
        if rule.unless:
            ok.append(~word.rlike(rule.unless))
        if rule.needs:
            ok.append(word.rlike(rule.needs))
        if rule.before:
            ok.append(~m["ahead"].rlike(rule.before))
        if rule.after:
            ok.append(~after.rlike(rule.after))
        if rule.names:
            told = F.filter(F.split(F.trim(word), r"\s+"), lambda w: (w != "") & ~w.isin(*rule.names))
            ok.append(F.size(told) > 0)
        good = reduce(lambda a, b: a & b, ok)
        shown = F.trim(word) if rule.group or rule.strip else F.trim(m["whole"])
        return F.when(good, F.struct(shown.alias("word"), (F.length(m["ahead"]) + 1).alias("start")))

    places = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: stands(seen(i)))
    return F.when(c.rlike(pattern), F.array_compact(places))  # texts without a match cost one search


def spans(rows: DataFrame, key: str, rules: Sequence[SpanRule]) -> DataFrame:
    """Violations ``rule, severity, entity, field, message, start`` of ``texts`` rows: for each rule and text the earliest match that
    stands, and the character (from 1) at which it begins. One pass over the texts for all rules."""

    def found(r: SpanRule) -> Column:
        here = F.lit(True)
        if r.fields:
            here = here & F.col("name").isin(*r.fields)
        if r.not_fields:
            here = here & ~F.col("name").isin(*r.not_fields)
        severity = F.lit(r.severity)
        if r.context:
            severity = F.when(F.col("text").rlike(f"(?iu){r.context}"), F.lit(r.softened_to)).otherwise(severity)

        def row(ms: Column) -> Column:
            first = F.get(ms, 0)
            values = (F.lit(r.name), severity, F.col(key).cast("string"), F.col("field"), first["word"])
            one = F.struct(*[v.alias(n) for n, v in zip(COLUMNS, values, strict=True)], first["start"].alias("start"))
            return F.when((F.size(ms) >= r.least) & severity.isNotNull(), one)

        return F.when(here, F.get(F.transform(F.array(matches(F.col("text"), r)), row), 0))

    return rows.select(F.explode(F.array_compact(F.array(*map(found, rules)))).alias("v")).select("v.*")


def restated(rows: DataFrame, key: str, claim: str, parts: str, of_claim: float = 0.7, of_earlier: float = 0.6, stop: tuple[str, ...] = ()) -> DataFrame:
    """Violations of texts ``parts`` (a name of ``texts``) that share most content words with the text ``claim`` of their row, or
    with an earlier part: the share of the smaller set. A row's parts are few; the first earlier part that is alike is named."""
    w = rows.where(F.col("name").isin(claim, parts)).select(key, "name", "field", extract.content_words(F.col("text"), stop=stop).alias("w"))
    own = F.array_sort(F.collect_list(F.when(F.col("name") == parts, F.struct(F.regexp_extract("field", r"\[(\d+)\]", 1).cast("int").alias("i"), "field", "w"))))
    each = w.groupBy(key).agg(F.max_by("w", F.when(F.col("name") == claim, 1)).alias("c"), own.alias("ps"))
    share = lambda n: F.floor(n * 100 + 0.5).cast("int")

    def said(p: Column, i: Column) -> Column:
        a = extract.overlap(F.col("c"), p["w"])
        of = F.when(F.coalesce(a, F.lit(0.0)) >= of_claim, F.struct(F.lit("restates").alias("rule"), p["field"].alias("field"), F.concat(F.lit(f"{claim} "), share(a).cast("string")).alias("message")))
        met = F.get(F.filter(F.transform(F.slice("ps", F.lit(1), i), lambda q: F.struct(q["field"].alias("field"), extract.overlap(q["w"], p["w"]).alias("o"))), lambda q: q["o"] >= of_earlier), 0)
        return F.array(of, F.when(met.isNotNull(), F.struct(F.lit("repeats").alias("rule"), p["field"].alias("field"), F.concat(met["field"], F.lit(" "), share(met["o"]).cast("string")).alias("message"))))

    out = each.select(key, F.explode(F.array_compact(F.flatten(F.transform("ps", said)))).alias("v"))
    return out.select("v.rule", F.lit("warning").alias("severity"), F.col(key).cast("string").alias("entity"), "v.field", "v.message")


def out_of_order(df: DataFrame, key: str, wanted: str, entries: str, tag: str, rule: str = "order") -> DataFrame:
    """Rows whose ``entries`` (array of structs) don't follow the order of ``wanted`` by their ``tag``; tags that it lacks are passed over."""
    tags = F.filter(F.transform(entries, lambda e: e[tag]), lambda t: F.array_contains(F.col(wanted), t))
    at = F.transform(tags, lambda t: F.array_position(F.col(wanted), t))
    broken = F.coalesce(F.exists(F.transform(at, lambda a, i: (i > 0) & (a < F.get(at, i - 1))), lambda b: b), F.lit(False))
    return df.where(broken).select(F.lit(rule).alias("rule"), F.lit("error").alias("severity"), F.col(key).cast("string").alias("entity"), F.lit(entries).alias("field"), F.array_join(tags, ",").alias("message"))


# ---- finders: rules from lists of words


def _any(words: Sequence[str]) -> str:
    return "(?:" + "|".join(r"\s+".join(map(regex.escape, w.split())) if not regex.search(r"[\[(|?*\\]", w) else w for w in words) + ")"


def unique_descriptor(kinds: Sequence[str], events: Sequence[str], own: str | None = None) -> SpanRule:
    """``the second-largest bank``, ``Spain's oldest insurer``, ``the bank whose``: words that point at one of its kind. ``the largest bank
    failures`` speaks of events and is none; ``own`` excuses the reader's own."""
    most = r"(?:(?:(?:second|third|fourth|fifth)-)?(?:largest|biggest)|oldest|only|sole)"
    kind = _any(kinds)
    whose = rf"(?:the|its)\s+(?:[\p{{L}}.]+['’]s\s+)?|[\p{{L}}.]+['’]s\s+"
    return SpanRule("unique_descriptor", rf"{B}(?:(?:{whose}){most}\s+{BETWEEN}{{0,3}}?{kind}(?![\p{{L}}\p{{N}}-])(?!\s+{_any(events)}{E})|the\s+{BETWEEN}{{0,2}}?{kind}\s+whose{E})", unless=own)


def name_by_ending(endings: Sequence[str], soft: Sequence[str], not_names: Sequence[str], determiners: Sequence[str]) -> list[SpanRule]:
    """Names known by their last word (``Harbour Savings Bank``); words of ``not_names`` before it make it no name (``World Bank``),
    ``determiners`` don't belong to it. ``soft`` endings also end everyday phrases, so they only warn."""
    last = rf"(?:{'|'.join(not_names)})\s+(?:{'|'.join([*endings, *soft])})$"
    at = lambda words: rf"{B}(?:\p{{Lu}}[\p{{L}}\p{{N}}&'’.-]*\s+){{1,3}}{_any(words)}{E}(?!\s+(?:of|for|and)\s+\p{{Lu}})"
    front = rf"^(?:(?:{'|'.join(determiners)})\s+)+"
    bare = rf"^(?:{'|'.join([*endings, *soft])})$"
    hard = SpanRule("name_by_ending", at(endings), "error", cased=True, strip=front, unless=rf"(?:^|\s){last}|{bare}")
    return [hard, replace(hard, name="name_by_ending_soft", pattern=at(soft), severity="warning")] if soft else [hard]


def named_event(kinds: Sequence[str], events: Sequence[str], generic: Sequence[str], determiners: Sequence[str]) -> SpanRule:
    """A capitalised name straight before a kind and an event (``Acmecoin $3m exchange hack``). Names of places and kinds alone
    (``UK bank outage``) are none, and so is what an indefinite word introduces (``a Lagos bank outage``)."""
    name = r"(\p{Lu}[\p{L}\p{N}&.'’-]*(?:\s+\p{Lu}[\p{L}\p{N}&.'’-]*){0,2})"
    some = r"(?iu)(?:^|[^\p{L}\p{N}])(?:a|an|one|another|any|each|every|some|several|no)\s+$"
    sum_of = r"(?:[$£€][\d.,]+\s?(?:k|m|bn)?\s+)?"
    return SpanRule("named_event", rf"(?<![\p{{L}}\p{{N}}-]){name}(?:['’]s)?\s+{sum_of}{_any(kinds)}\s+{_any(events)}{E}", cased=True, group=1, before=some, unless=r"^(?:A|An|One|Another|Any|Each|Every|Some|Several|No)\s", names=(*generic, *determiners))


def back_reference(kinds: Sequence[str], roles: Sequence[str]) -> SpanRule:
    """``the affected lender``: a word between article and kind that tells which; ``roles`` tell none (``the issuing bank``)."""
    return SpanRule("back_reference", rf"{B}[Tt]he\s+{BETWEEN}{{1,3}}?{_any(kinds)}(?:['’]s)?{E}", "warning", cased=True, unless=rf"(?iu)\s(?:{'|'.join(roles)})\s")


def event_reference(events: Sequence[str]) -> SpanRule:
    """``after the 3 May outage``: a known event, told by a figure, a name, or a word such as recent."""
    return SpanRule("event_reference", rf"{B}(?:[Aa]fter|[Ff]ollowing|[Ss]ince|[Tt]o|[Ff]rom|[Bb]y|[Ii]n|[Dd]uring|[Bb]efore)\s+the\s+((?:[\p{{L}}\p{{N}}-]+\s+){{1,3}}?){_any(events)}{E}", cased=True, group=1, needs=r"\d|(?<![\p{L}])\p{Lu}\p{Ll}|(?<![\p{L}])(?:recent|reported|disclosed|latest|same|above|aforementioned)(?![\p{L}])")


def product_name(known: Sequence[str]) -> SpanRule:
    """Words of mixed case (``MailForge``) but for ``known`` ones."""
    return SpanRule("product_name", rf"{B}(?:\p{{Lu}}\p{{Ll}}+\p{{Lu}}[\p{{L}}\p{{N}}]*|\p{{Lu}}{{2,}}\p{{Ll}}{{2,}}[\p{{L}}\p{{N}}]*|\p{{Ll}}+\p{{Lu}}[\p{{L}}\p{{N}}]*){E}", "warning", cased=True, names=tuple(known))


def american_spelling(pairs: dict[str, str]) -> SpanRule:
    """Lower-case words with a beginning of ``pairs`` (American: British); capitals are proper names."""
    return SpanRule("american_spelling", rf"{B}(?:{'|'.join(pairs)})\p{{Ll}}*{E}", "warning", cased=True)

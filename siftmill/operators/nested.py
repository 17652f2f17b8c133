"""Rules of nested records, compiled to one projection: each rule is a path and a test, and a violation names the place that breaks it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmill.functions import dates, url
from siftmill.operators.checks import COLUMNS, collected, ordered, references, unique
from siftmill.operators.structure import leaves

#: What a test sees: the value, and the row (for rules that compare fields).
Test = Callable[[Column], Column]


@dataclass(frozen=True)
class Rule:
    """``path`` leads to a value: a column, fields of structs, ``[]`` for each element of a list (``sources[].url``). ``test`` says
    whether a value is right; null is wrong, unless ``optional``. ``modes``: where the rule holds (all if empty). ``when``: a condition
    of the row, as a column or in SQL. A list that is null has no elements; a rule for the list itself sees it."""

    name: str
    path: str
    test: Test
    severity: str = "error"
    optional: bool = False
    modes: tuple[str, ...] = ()
    when: Column | str | None = None


def violations(df: DataFrame, key: str, rules: Sequence[Rule], mode: str = "") -> DataFrame:
    """``rule, severity, entity, field, message`` of all places that break a rule of the mode; ``field`` has the numbers of elements,
    ``message`` the value as JSON. One pass, however many rules there are."""
    row = "array<struct<rule: string, severity: string, entity: string, field: string, message: string>>"

    def walk(r: Rule, c: Column, kind, steps: list[str], label: Column) -> Column:
        if steps and steps[0] == "[]":
            each = F.transform(c, lambda x, i: walk(r, x, kind.elementType, steps[1:], F.concat(label, F.lit("["), i.cast("string"), F.lit("]"))))
            return F.coalesce(F.flatten(each), F.array().cast(row))
        if steps:
            return walk(r, c[steps[0]], kind[steps[0]].dataType, steps[1:], F.concat(label, F.lit(f".{steps[0]}")))
        wrong = ~F.coalesce(r.test(c), F.lit(False))
        if r.optional:
            wrong = wrong & c.isNotNull()
        if r.when is not None:
            wrong = wrong & F.coalesce(F.expr(r.when) if isinstance(r.when, str) else r.when, F.lit(False))
        shown = c if kind.typeName() == "string" else F.to_json(c) if kind.typeName() in ("array", "struct", "map") else c.cast("string")
        v = F.struct(*[x.alias(n) for n, x in zip(COLUMNS, (F.lit(r.name), F.lit(r.severity), F.col(key).cast("string"), label, shown), strict=True)])
        return F.when(wrong, F.array(v)).otherwise(F.array().cast(row))

    def one(r: Rule) -> Column:
        steps = [s for s in regex.split(r"\.|(\[\])", r.path) if s]
        return walk(r, F.col(steps[0]), df.schema[steps[0]].dataType, steps[1:], F.lit(steps[0]))

    mine = [one(r) for r in rules if not r.modes or mode in r.modes]
    return df.select(F.explode(F.concat(*mine)).alias("v")).select("v.*")


def unknown_fields(df: DataFrame, key: str, doc: str, known: Sequence[str]) -> DataFrame:
    """Violations of fields that the data model lacks, from JSON texts: ``known`` are paths as in ``Rule``; what lies below a known path
    that names no further field is known with it."""
    plain = F.regexp_replace(F.substring(F.regexp_replace("path", r"\[\d+\]", "[]"), 3, 1 << 20), r"(?:\[\])+$", "")
    ok = reduce(lambda a, b: a | b, [(F.col("_p") == k.rstrip("[]")) | F.startswith("_p", F.lit(f"{k.rstrip('[]')}.")) | F.startswith("_p", F.lit(f"{k.rstrip('[]')}[")) for k in known])
    odd = leaves(df, key, doc).where("path != '$'").withColumn("_p", plain).where(~ok)
    return odd.select(F.lit("unknown_field").alias("rule"), F.lit("error").alias("severity"), F.col(key).cast("string").alias("entity"), F.substring("path", 3, 1 << 20).alias("field"), F.col("value").alias("message")).distinct()


# ---- tests


def filled(c: Column) -> Column:
    return F.trim(c) != ""


def one_of(*values: str) -> Test:
    return lambda c: c.isin(*values)


def matches(pattern: str) -> Test:
    return lambda c: c.rlike(pattern)


def sized(least: int, most: int) -> Test:
    return lambda c: F.size(c).between(least, most)


def distinct(of: Test | None = None) -> Test:
    """No element, or what ``of`` makes of it, comes twice."""
    return lambda c: F.size(F.array_distinct(F.transform(c, of) if of else c)) == F.size(c)


def absent(c: Column) -> Column:
    return c.isNull()


def either(*tests: Test) -> Test:
    return lambda c: reduce(lambda a, b: a | b, [F.coalesce(t(c), F.lit(False)) for t in tests])


def item_rules(sections: Sequence[str], domains: Sequence[str], classes: Sequence[str], mechanisms: dict[str, tuple[tuple[str, ...], tuple[str, ...]]], item_id: str, candidate_id: str = r"^c-[0-9a-f]{10}$", headline: int = 200) -> list[Rule]:
    """The rules of an item, in the modes ``draft`` (``candidate_ids`` in place of id and time) and ``archive``. ``mechanisms``: which texts each needs, and
    which it must not have."""
    c = F.col
    tagged = F.transform("interpretation", lambda x: F.array_contains(c("domains"), x["domain"]))
    late = F.exists(F.transform(tagged, lambda t, i: t & (i > 0) & ~F.get(tagged, i - 1)), lambda b: b)
    rules = [
        Rule("id", "item_id", matches(item_id), modes=("archive",)), Rule("first_number", "item_id", lambda x: ~x.rlike("-0+$"), modes=("archive",)), Rule("timestamp", "timestamp", dates.is_et_iso, modes=("archive",)),
        Rule("backfilled", "backfilled", lambda x: x.isNotNull(), modes=("archive",)), Rule("no_id", "item_id", absent, modes=("draft",), optional=True), Rule("candidates", "candidate_ids", sized(1, 1000), modes=("draft",)),
        Rule("candidate", "candidate_ids[]", matches(candidate_id), modes=("draft",)), Rule("candidates_repeat", "candidate_ids", distinct(), modes=("draft",), optional=True),
        Rule("section", "section", one_of(*sections)), Rule("claim", "claim", filled), Rule("class", "source_class", one_of(*classes)), Rule("mechanism", "mechanism", one_of(*mechanisms)),
        Rule("domains", "domains", sized(1, len(domains))), Rule("domain", "domains[]", one_of(*domains)), Rule("domains_repeat", "domains", distinct(), optional=True),
        Rule("interpretation", "interpretation", sized(1, 1000)), Rule("entry_domain", "interpretation[].domain", one_of(*domains)), Rule("entry_text", "interpretation[].text", filled), Rule("entry_repeats", "interpretation", distinct(lambda x: x["domain"]), optional=True),
        Rule("entry_missing", "domains", lambda x: F.size(F.array_except(x, F.transform("interpretation", lambda e: e["domain"]))) == 0, optional=True, when=c("interpretation").isNotNull()),
        Rule("entry_order", "interpretation", lambda _: ~late, optional=True, when=c("domains").isNotNull()),
        Rule("sources", "sources", sized(1, 1000)), Rule("publication", "sources[].publication", filled), Rule("url", "sources[].url", lambda x: url.safe_link(x).isNotNull()), Rule("urls_repeat", "sources", distinct(lambda s: url.normalise(s["url"])), optional=True),
        Rule("headline", "sources[].headline", lambda x: filled(x) & (F.length(x) <= headline), optional=True), Rule("published", "sources[].published", dates.is_iso_date, optional=True), Rule("source_class", "sources[].source_class", one_of(*classes), optional=True),
        Rule("update_of", "update_of", either(matches(item_id), matches(candidate_id)), optional=True, modes=("draft",)), Rule("update_of", "update_of", matches(item_id), optional=True, modes=("archive",)),
    ]
    for name, (needed, barred) in mechanisms.items():
        rules += [Rule("needed", f, filled, when=c("mechanism") == name) for f in needed] + [Rule("barred", f, absent, when=c("mechanism") == name, optional=True) for f in barred]
    return rules


def archive_checks(items: DataFrame, rules: Sequence[Rule], position: str = "position") -> DataFrame:
    """Rules of a whole archive: its items', ids that repeat, updates of items that it lacks, and order by time."""
    at = items.withColumn("_all", F.lit(1))
    return collected(violations(items, "item_id", rules, "archive"), unique(items, "item_id", "id_repeats"), references(items, "item_id", "update_of", items, "item_id", "update_unknown"), ordered(at, "item_id", ["section"], position, "timestamp", "order"))


def revalidated(archive: DataFrame, new: DataFrame, rules: Sequence[Rule], position: str = "position") -> DataFrame:
    """The checks of the archive as it would be, with new rows behind it: what is wrong only together comes out too. Faults that the archive
    has already are left out, so that a run is not held up by them."""
    both = archive_checks(archive.unionByName(new, allowMissingColumns=True), rules, position)
    old = archive_checks(archive, rules, position).select("rule", "entity", "field").distinct()
    return both.join(old, ["rule", "entity", "field"], "left_anti").select(*COLUMNS)

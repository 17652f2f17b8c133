"""First stage: profiles, outright drops, and scores summed over overlap-free hits of a vocabulary. All of it is one projection."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmill.functions import text, url
from siftmill.functions.text import half_up
from siftmill.operators.lexicon import pattern
from siftmill.operators.terms import TermIndex

#: Factor of a hit in the lead; caps; least score of a domain that counts.
LEAD_FACTOR, DOMAIN_CAP, DOMAIN_TOTAL_CAP, QUALIFY = 0.5, 6.0, 8.0, 2.0
CAPS = {"materiality": 6.0, "sector": 5.0, "enterprise": 2.0}


_HITS = "array<struct<less: double, shorter: int, ord: int, field: string, start: int, stop: int, tier: string, term: string>>"


@dataclass(frozen=True)
class Term:
    """``component`` is domain, materiality, sector, enterprise or noise; ``tier`` strong, medium or weak."""

    component: str
    group: str
    weight: float
    term: str
    tier: str = "medium"


@dataclass(frozen=True)
class Profile:
    threshold: float
    strong_in_title: bool = False
    noise: tuple[str, ...] = ()


@dataclass(frozen=True)
class Rules:
    """All vocabulary is a parameter. ``marketing``: (name, pattern, subjects before it that excuse it). ``institutions``: name by
    alias; one in the title adds 2 to the sector, else one in the lead 1. ``narrow``: a domain that alone does not count where a
    text has one of ``narrow_terms`` and none of ``rescue_terms``. ``by_path``: a class whose profile is ``standard`` on pages below
    one of the segments, and ``authority`` on the hosts."""

    terms: tuple[Term, ...]
    profiles: dict[str, Profile]
    gated: tuple[str, ...] = ()
    bare_headline: str | None = None
    event_segments: tuple[str, ...] = ()
    roundups: tuple[tuple[str, str], ...] = ()
    redundant: str | None = None
    marketing: tuple[tuple[str, str, str | None], ...] = ()
    unmarketed: tuple[str, ...] = ("lenient",)
    high_volume_hosts: str | None = None
    class_profiles: dict[str, str] = field(default_factory=dict)
    institutions: dict[str, str] = field(default_factory=dict)
    narrow: str | None = None
    narrow_terms: tuple[str, ...] = ()
    rescue_terms: tuple[str, ...] = ()
    by_path: dict[str, tuple[tuple[str, ...], str]] = field(default_factory=dict)

    def words(self) -> list[str]:
        return [*(t.term for t in self.terms), *self.institutions, *self.narrow_terms, *self.rescue_terms]


def scored_text(title: Column, lead: Column, bare: str | None) -> tuple[Column, Column]:
    """Title and lead as they are scored: a title that is an identifier alone takes the lead in."""
    t, d = (text.typographic(F.coalesce(c, F.lit(""))) for c in (title, lead))
    if not bare:
        return t, d
    joined = (d != "") & t.rlike(bare)
    return F.when(joined, F.concat(t, F.lit(": "), d)).otherwise(t), F.when(joined, "").otherwise(d)


@dataclass(frozen=True)
class Scored:
    """Title and lead, with the first words of the vocabulary that each has."""

    index: TermIndex
    title: Column
    lead: Column
    in_title: Column
    in_lead: Column

    def where(self, term: str) -> tuple[Column, Column]:
        """Whether the term is in the title, and in the lead; a text without its first word is not searched."""
        p = pattern(term)
        return F.when(self.index.may(term, self.in_title), self.title.rlike(p)).otherwise(False), F.when(self.index.may(term, self.in_lead), self.lead.rlike(p)).otherwise(False)


def chosen(on: Scored, terms: list[Term]) -> Column:
    """Hits ``value, size, ord, field, start, stop, tier, term``: each term's first place in the title, else in the lead; of those
    that overlap in one field the heaviest, then the longest, then the first in the vocabulary."""

    def hit(i: int, t: Term) -> Column:
        p = F.lit(pattern(t.term))

        def at(c: Column, present: Column, name: str, factor: float) -> Column:
            def place(m: Column) -> Column:
                start, size = F.regexp_instr(c, p), F.length(m)
                cols = {"less": F.lit(-t.weight * factor), "shorter": -size, "ord": F.lit(i), "field": F.lit(name), "start": start, "stop": start + size, "tier": F.lit(t.tier), "term": F.lit(t.term)}
                return F.when(m.isNotNull(), F.struct(*[v.alias(k) for k, v in cols.items()]))

            # the match is looked for once, and only where the text has the term's first word
            return F.when(on.index.may(t.term, present), F.get(F.transform(F.array(F.regexp_substr(c, p)), place), 0))

        return F.coalesce(at(on.title, on.in_title, "title", 1.0), at(on.lead, on.in_lead, "lead", LEAD_FACTOR))

    found = F.array_sort(F.array_compact(F.array(*[hit(i, t) for i, t in enumerate(terms)])))
    apart = lambda kept, h: ~F.exists(kept, lambda k: (k["field"] == h["field"]) & (h["start"] < k["stop"]) & (k["start"] < h["stop"]))
    return F.aggregate(found, F.array().cast(_HITS), lambda kept, h: F.when(apart(kept, h), F.concat(kept, F.array(h))).otherwise(kept))


def total(hits: Column) -> Column:
    return F.aggregate(hits, F.lit(0.0), lambda a, h: a - h["less"])


def scores(df: DataFrame, rules: Rules, title: str = "title", lead: str = "lead", profile: str = "profile") -> DataFrame:
    """Adds ``domains`` (qualifying, best first), ``domain_scores`` (map), ``domain, materiality, sector, enterprise, noise, score``
    and ``strong_in_title``."""
    t, d = scored_text(F.col(title), F.col(lead), rules.bare_headline)
    index = TermIndex(rules.words())
    df = df.withColumns({"_t": t, "_d": d}).withColumns({"_wt": index.present(F.col("_t")), "_wd": index.present(F.col("_d"))})
    on = Scored(index, *map(F.col, ("_t", "_d", "_wt", "_wd")))
    of = lambda component, group=None: [x for x in rules.terms if x.component == component and group in (None, x.group)]
    names = list(dict.fromkeys(x.group for x in of("domain")))
    df = df.withColumns({f"_h{i}": chosen(on, of("domain", n)) for i, n in enumerate(names)})
    all_scores = F.array(*[F.struct((-half_up(F.least(total(F.col(f"_h{i}")), F.lit(DOMAIN_CAP)), 1)).alias("less"), F.lit(i).alias("ord"), F.lit(n).alias("name")) for i, n in enumerate(names)])
    strong = reduce(lambda a, b: a | b, [F.exists(f"_h{i}", lambda h: (h["tier"] == "strong") & (h["field"] == "title")) for i in range(len(names))], F.lit(False))
    df = df.withColumns({"_scores": F.filter(all_scores, lambda s: s["less"] < 0), "strong_in_title": strong})
    df = df.withColumn("_best", F.array_sort(F.filter("_scores", lambda s: s["less"] <= -QUALIFY)))
    groups = []
    for g in dict.fromkeys(x.group for x in of("materiality")):
        best = F.greatest(F.lit(0.0), *[F.when(on.where(x.term)[0], x.weight).when(on.where(x.term)[1], x.weight * LEAD_FACTOR).otherwise(0.0) for x in of("materiality", g)])
        groups.append(F.when(F.size("_best") > 0, best).otherwise(0.0) if g in rules.gated else best)
    plain = {c: total(chosen(on, of(c))) if of(c) else F.lit(0.0) for c in ("sector", "enterprise")}
    seat = institution(on, rules)
    plain["sector"] = plain["sector"] + F.when(seat["field"] == "title", 2.0).when(seat["field"] == "lead", 1.0).otherwise(0.0)
    plain = {c: F.least(v, F.lit(CAPS[c])) for c, v in plain.items()}
    noise = F.lit(0.0)
    for n, p in rules.profiles.items():
        own = [x for x in of("noise") if x.group in p.noise]
        noise = F.when(F.col(profile) == n, total(chosen(on, own)) if own else F.lit(0.0)).otherwise(noise)
    df = df.withColumns({
        "domains": F.transform("_best", lambda s: s["name"]), "domain_scores": F.map_from_entries(F.transform("_scores", lambda s: F.struct(s["name"], -s["less"]))),
        "domain": half_up(F.least(F.aggregate("_best", F.lit(0.0), lambda a, s: a - s["less"]), F.lit(DOMAIN_TOTAL_CAP)), 1),
        "materiality": F.least(reduce(lambda a, b: a + b, groups, F.lit(0.0)), F.lit(CAPS["materiality"])), **plain, "noise": noise,
    })
    if rules.narrow:
        df = df.withColumn("narrow_term", narrow_term(on, rules, names))
    out = df.withColumn("score", half_up(F.col("domain") + F.col("materiality") + F.col("sector") + F.col("enterprise") - F.col("noise"), 1))
    return out.drop("_t", "_d", "_wt", "_wd", "_scores", "_best", *[f"_h{i}" for i in range(len(names))])


def institution(on: Scored, rules: Rules) -> Column:
    """``field, name`` of the first institution that the title names, else the lead: by place, the longer alias first; null without one."""

    def first(c: Column, which: int, name: str) -> Column:
        def at(alias: str) -> Column:
            return F.when(on.where(alias)[which], F.struct(F.regexp_instr(c, F.lit(pattern(alias))).alias("start"), F.lit(-len(alias)).alias("shorter"), F.lit(name).alias("field"), F.lit(rules.institutions[alias]).alias("name")))

        return F.array_min(F.array_compact(F.array(*map(at, rules.institutions))))

    if not rules.institutions:
        return F.lit(None).cast("struct<field: string, name: string>")
    return F.coalesce(first(on.title, 0, "title"), first(on.lead, 1, "lead"))


def narrow_term(on: Scored, rules: Rules, names: list[str]) -> Column:
    """The term for which a row of the narrow domain alone counts as off domain: it has one of ``narrow_terms``, none of
    ``rescue_terms``, and no more than weak hits of any other domain; null for all others."""
    alone = (F.size("_best") == 1) & (F.get("_best", 0)["name"] == rules.narrow)
    other = reduce(lambda a, b: a | b, [F.exists(f"_h{i}", lambda h: h["tier"] != "weak") for i, n in enumerate(names) if n != rules.narrow], F.lit(False))
    anywhere = lambda t: on.where(t)[0] | on.where(t)[1]
    saved = reduce(lambda a, b: a | b, map(anywhere, rules.rescue_terms), F.lit(False))
    first = F.coalesce(*[F.when(anywhere(t), t) for t in rules.narrow_terms], F.lit(None).cast("string"))
    return F.when(alone & ~other & ~saved, first)


def profile_of(rules: Rules, override: Column, source_class: Column, *addresses: Column) -> Column:
    """A source's own profile, else that of high-volume hosts, else what its class and path give, else its class's, else
    standard. The first address is the row's own, others are its source's."""
    own = F.when(override.isin(*rules.profiles), override)
    busy = reduce(lambda a, b: a | b, [F.coalesce(url.host(a).rlike(rules.high_volume_hosts), F.lit(False)) for a in addresses]) if rules.high_volume_hosts else F.lit(False)
    by_class = F.coalesce(*[F.when(source_class == c, p) for c, p in rules.class_profiles.items()], F.lit("standard"))
    paths = []
    for c, (segments, hosts) in rules.by_path.items():
        below = F.coalesce(F.arrays_overlap(url.path_segments(addresses[0]), F.array(*map(F.lit, segments))), F.lit(False)) if addresses and segments else F.lit(False)
        heard = reduce(lambda a, b: a | b, [F.coalesce(url.host(a).rlike(hosts), F.lit(False)) for a in addresses], F.lit(False))
        paths += [F.when((source_class == c) & below, "standard"), F.when((source_class == c) & heard, "authority")]
    return F.coalesce(own, F.when(busy, "high_volume"), *paths, by_class)


def outright(rules: Rules, title: Column, lead: Column, address: Column, profile: Column, catalogue: Column, entry: Column) -> Column:
    """``reason, detail`` of what goes before it is scored, the first rule counting; null for the rest. ``catalogue``: the run has
    the catalogue, so that its announcements repeat it; ``entry``: the row is one of its entries, which are not marketing."""
    t, d = (text.typographic(F.coalesce(c, F.lit(""))) for c in (title, lead))
    say = lambda reason, detail: F.struct(F.lit(reason).alias("reason"), detail.cast("string").alias("detail"))
    segment = url.event_segment(address, rules.event_segments) if rules.event_segments else F.lit(None)
    steps = [F.when(~entry & segment.isNotNull(), say("event", segment))]
    steps += [F.when(t.rlike(p), say("roundup", F.lit(n))) for n, p in rules.roundups]
    if rules.redundant:
        steps.append(F.when(catalogue & t.rlike(rules.redundant), say("redundant", F.lit("announces the catalogue"))))
    may = ~entry & ~profile.isin(*rules.unmarketed)
    for n, p, excuse in rules.marketing:
        said = t.rlike(p) if excuse is None else t.rlike(p) & ~F.substr(t, F.lit(1), F.regexp_instr(t, F.lit(p)) - 1).rlike(excuse)
        if n == "sponsored":
            said = said | d.rlike(p)
        steps.append(F.when(may & said, say("marketing", F.lit(n))))
    return F.coalesce(*steps)


def stage_one(df: DataFrame, rules: Rules, title: str = "title", lead: str = "lead", address: str = "url", seen: str = "seen", catalogue: Column | None = None, entry: Column | None = None, known_use: Column | None = None, extra: Column | None = None) -> DataFrame:
    """Adds the scores, ``reason`` (null: passed) and ``detail`` to rows with ``profile``; the first failing rule counts. With
    ``extra``, rows for which it holds are attachments: they are left out before anything is scored or counted."""
    if extra is not None:
        df = df.where(~F.coalesce(extra, F.lit(False)))
    entry = F.lit(False) if entry is None else F.coalesce(entry, F.lit(False))
    catalogue = F.lit(False) if catalogue is None else catalogue
    scored = scores(df, rules, title, lead).withColumn("_out", outright(rules, F.col(title), F.col(lead), F.col(address), F.col("profile"), catalogue, entry))
    use = F.lit(False) if known_use is None else F.coalesce(known_use, F.lit(False))
    table = [F.struct(F.lit(n).alias("name"), F.lit(p.threshold).alias("least"), F.lit(p.strong_in_title).alias("strong")) for n, p in rules.profiles.items()]
    own = F.get(F.filter(F.array(*table), lambda p: p["name"] == F.col("profile")), 0)
    rule = F.coalesce(own, *[x for x, n in zip(table, rules.profiles, strict=True) if n == "standard"])
    matters = (F.col("enterprise") > 0) | (F.col("sector") > 0) | use
    say = lambda reason, detail: F.struct(F.lit(reason).alias("reason"), detail.cast("string").alias("detail"))
    none, narrow = F.lit(None), F.col("narrow_term") if rules.narrow else F.lit(None).cast("string")
    verdict = (
        F.when(F.col(seen), say("seen", none)).when(F.col("_out").isNotNull(), F.col("_out")).when(F.size("domains") == 0, say("off_domain", none))
        .when(~entry & narrow.isNotNull(), say("off_domain", narrow))
        .when(entry & ~matters, say("below_threshold", F.lit("entry of no consequence"))).when(entry, none)
        .when(rule["strong"] & ~F.col("strong_in_title"), say("below_threshold", F.lit("no strong term in title"))).when(F.col("score") < rule["least"], say("below_threshold", F.concat_ws(" < ", F.col("score").cast("string"), rule["least"].cast("string"))))
    )
    return scored.withColumn("_v", verdict).withColumns({"reason": F.col("_v.reason"), "detail": F.col("_v.detail")}).drop("_v", "_out")

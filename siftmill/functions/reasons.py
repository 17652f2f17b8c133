"""Reasons of judgments as a parsed column, and what is wrong with their marks.

``["[M" 1-6 "] "] ["NEAR " element ["/" knob] ": "] text [" [alt " section ":" element ["/" knob] "]"]``"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HEAD = r"^(?:\[M([1-6])\] )?NEAR ([^:/]+?)(?:/([^:]+))?:"
_ALT = r" \[alt (EV|CS):([A-Z][A-Za-z0-9]*)(?:/([a-z][a-z0-9_]*))?\]$"
_WELL_HEAD = r"^(?:\[M[1-6]\] )?NEAR [A-Z][A-Za-z0-9]*(?:/[a-z][a-z0-9_]*)?: "
_WORD_NEAR = r"(?<![\p{L}\p{N}])NEAR(?![\p{L}\p{N}])"


def parsed(c: Column) -> Column:
    """``material`` (1 to 6), ``element, knob`` of the NEAR mark, ``alt_section, alt_element, alt_knob`` of the other way, and the
    ``text`` between; each null where the reason lacks it. A null reason has none."""
    s = F.coalesce(c, F.lit(""))
    part = lambda p, i: F.nullif(F.trim(F.regexp_extract(s, p, i)), F.lit(""))
    told = F.regexp_replace(F.regexp_replace(s, _ALT, ""), _HEAD + r"\s*|^\[M[1-6]\] ", "")
    material = F.nullif(F.regexp_extract(s, r"^\[M([1-6])\] ", 1), F.lit("")).cast("int")
    cols = {"material": material, "element": part(_HEAD, 2), "knob": part(_HEAD, 3), "alt_section": part(_ALT, 1), "alt_element": part(_ALT, 2), "alt_knob": part(_ALT, 3), "text": F.nullif(F.trim(told), F.lit(""))}
    return F.struct(*[v.alias(k) for k, v in cols.items()])


def covers(elements: Column, element: Column) -> Column:
    """Whether a knob's ``elements`` (``E2, R3f``) hold an element or the one that it is a part of (``E2`` holds ``E2a``)."""
    own = F.regexp_extract_all(F.coalesce(elements, F.lit("")), F.lit(r"[A-Z][A-Za-z0-9]*"), F.lit(0))
    return F.exists(own, lambda e: (e == element) | (element.startswith(e) & F.substr(element, F.length(e) + 1).rlike("^[a-z]$")))


def mark_problems(log: DataFrame, key: str, code: str, reason: str, verdict: str, codes: DataFrame, knobs: DataFrame, fixed: dict[str, tuple[str, str]], gates: str = r"^(?:GL|DD)_", scope: str | None = None, scoped: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Violations ``rule, severity, entity, field, message`` of reasons' marks.

    ``codes``: code, element; ``knobs``: knob, elements (what it controls). ``fixed``: codes whose only NEAR is one element and knob. Codes
    that ``gates`` fits are never near otherwise. A near element is the code's own or a part of it; a knob must be known and control
    it; a passed row is near to nothing; marks that are written otherwise are malformed. ``scope`` is the setting of formal
    instruments, ``scoped`` the codes that may be recorded in each setting (codes of no setting always may)."""
    p, c, v = F.col("_p"), F.col(code), F.col(verdict)
    rows = log.select(key, c, F.col(reason), v, parsed(F.col(reason)).alias("_p")).join(codes.toDF(code, "_own"), code, "left")
    rows = rows.withColumn("_knob", F.col("_p.knob")).join(knobs.toDF("_knob", "_controls"), "_knob", "left")
    rows = rows.withColumn("_alt_knob", F.col("_p.alt_knob")).join(knobs.toDF("_alt_knob", "_alt_controls"), "_alt_knob", "left")
    el, near = p["element"], p["element"].isNotNull()
    only = F.lit(None).cast("string")
    for name, (e, k) in fixed.items():
        only = F.when(c == name, f"{e}/{k}").otherwise(only)
    whole = F.concat_ws("/", el, p["knob"])
    own = F.col("_own")
    part = el.startswith(own) & F.substr(el, F.length(own) + 1).rlike("^[a-z]$")
    free = near & only.isNull() & ~F.coalesce(c.rlike(gates), F.lit(False))
    rules = [
        ("near_form", F.coalesce(F.col(reason), F.lit("")).rlike(_WORD_NEAR) & ~F.coalesce(F.col(reason), F.lit("")).rlike(_WELL_HEAD), F.col(reason)),
        ("alt_form", F.coalesce(F.col(reason), F.lit("")).rlike(r"\[alt\b") & p["alt_element"].isNull(), F.col(reason)),
        ("near_pass", near & (v == "pass"), whole), ("near_fixed", near & only.isNotNull() & (whole != only), whole),
        ("near_gate", near & only.isNull() & F.coalesce(c.rlike(gates), F.lit(False)), whole), ("near_element", free & own.isNotNull() & (el != own) & ~part, whole),
        ("knob_unknown", p["knob"].isNotNull() & F.col("_controls").isNull(), p["knob"]), ("knob_element", F.col("_controls").isNotNull() & ~covers(F.col("_controls"), el), whole),
        ("alt_knob_unknown", p["alt_knob"].isNotNull() & F.col("_alt_controls").isNull(), p["alt_knob"]), ("alt_knob_element", F.col("_alt_controls").isNotNull() & ~covers(F.col("_alt_controls"), p["alt_element"]), F.concat_ws("/", p["alt_element"], p["alt_knob"])),
    ]
    if scoped is not None:
        bound = sorted({x for own in scoped.values() for x in own})
        rules.append(("scope", c.isin(*bound) & ~c.isin(*(scoped.get(scope, bound) or ("",))), c))
    row = lambda n, m: F.struct(F.lit(n).alias("rule"), F.lit("error").alias("severity"), F.col(key).cast("string").alias("entity"), F.lit(reason).alias("field"), m.cast("string").alias("message"))
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), row(n, m)) for n, bad, m in rules]))
    return rows.select(F.explode(found).alias("x")).select("x.*")

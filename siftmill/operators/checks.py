"""Constraints as rows: each check gives ``rule, severity, entity, field, message`` for what breaks it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

COLUMNS = ("rule", "severity", "entity", "field", "message")


def _row(rule: str, severity: str, entity: Column, field: str, message: Column) -> Column:
    values = (F.lit(rule), F.lit(severity), entity.cast("string"), F.lit(field), message.cast("string"))
    return F.struct(*[v.alias(n) for n, v in zip(COLUMNS, values, strict=True)])


def row_checks(df: DataFrame, key: str, rules: list[tuple[str, str, str, Column]]) -> DataFrame:
    """``rules``: (rule, severity, field, condition that must hold; null counts as broken). One pass for all rules."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), _row(rule, severity, F.col(key), field, F.col(field))) for rule, severity, field, ok in rules]
    return df.select(F.explode(F.array_compact(F.array(*broken))).alias("v")).select("v.*")


def unique(df: DataFrame, key: str, rule: str = "unique") -> DataFrame:
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return n.select(_row(rule, "error", F.col(key), key, F.col("n")).alias("v")).select("v.*")


def crowded(df: DataFrame, by: str, most: int, rule: str) -> DataFrame:
    """Groups of more than ``most`` rows, with their number."""
    n = df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    return n.select(_row(rule, "error", F.col(by), by, F.col("n")).alias("v")).select("v.*")


def references(df: DataFrame, key: str, field: str, other: DataFrame, other_key: str, rule: str) -> DataFrame:
    """Values of ``field`` that no row of ``other`` has; null refers to nothing."""
    known = other.select(F.col(other_key).alias(field)).distinct()
    lost = df.where(F.col(field).isNotNull()).join(known, field, "left_anti")
    return lost.select(_row(rule, "error", F.col(key), field, F.col(field)).alias("v")).select("v.*")


def ordered(df: DataFrame, key: str, by: list[str], position: str, at: str, rule: str = "order") -> DataFrame:
    """Rows whose ``at`` is before that of the row ahead of them in their group."""
    ahead = F.lag(at).over(Window.partitionBy(*by).orderBy(position))
    late = df.withColumn("_ahead", ahead).where(F.col(at) < F.col("_ahead"))
    return late.select(_row(rule, "error", F.col(key), at, F.col(at)).alias("v")).select("v.*")


def text_lint(df: DataFrame, key: str, fields: list[str], patterns: list[tuple[str, str, str]]) -> DataFrame:
    """``patterns``: (rule, severity, pattern). One row for each rule that a text field breaks, with the first match."""
    found = [F.when(F.col(f).rlike(p), _row(rule, severity, F.col(key), f, F.regexp_extract(f, p, 0))) for f in fields for rule, severity, p in patterns]
    return df.select(F.explode(F.array_compact(F.array(*found))).alias("v")).select("v.*")


def collected(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def gate(violations: DataFrame) -> int:
    """Fails if there are errors; else the number of warnings."""
    n = {r["severity"]: r["n"] for r in violations.groupBy("severity").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows at most
    if n.get("error"):
        raise ValueError(f"{n['error']} errors")
    return n.get("warning", 0)

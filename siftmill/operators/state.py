"""Keyed state: first occurrence, ledger with a time limit, newest record, snapshot difference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_wins(df: DataFrame, key: str, order: list[str], others: str) -> DataFrame:
    """The first row of each key, with the other rows' distinct ``others`` as ``also_in`` (sorted). Aggregates only, so a
    key with very many rows is combined before it is shuffled."""
    row = F.struct(*order, *[c for c in df.columns if c not in (key, *order)])
    g = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(row).alias("r"), F.collect_set(others).alias("all"))
    return g.select(key, *[F.col(f"r.{c}").alias(c) for c in df.columns if c != key], F.array_sort(F.array_except("all", F.array(f"r.{others}"))).alias("also_in"))


def unseen(df: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    return df.join(ledger.select(key), key, "left_anti")


def upsert_ledger(ledger: DataFrame, new: DataFrame, key: str, at: str, now: Column, days: int = 120) -> DataFrame:
    """Keys are added if absent and never overwritten; those first seen more than ``days`` ago go."""
    both = ledger.select(key, at).unionByName(new.join(ledger.select(key), key, "left_anti").select(key, at))
    return both.groupBy(key).agg(F.min(at).alias(at)).where(F.col(at) >= now - F.make_dt_interval(F.lit(days)))


def newest(df: DataFrame, key: str, at: str, *ties: str) -> DataFrame:
    """Each key's newest row and its number of rows."""
    rest = [c for c in df.columns if c not in (key, at, *ties)]
    g = df.groupBy(key).agg(F.max(F.struct(at, *ties, *rest)).alias("r"), F.count(F.lit(1)).alias("n"))
    return g.select(key, *[f"r.{c}" for c in (at, *ties, *rest)], "n")


def append_only_diff(before: DataFrame, after: DataFrame, key: str, position: str) -> DataFrame:
    """``key, change``: rows removed, changed or moved between two snapshots; added rows are no violation."""
    same = lambda df: F.to_json(F.struct(*sorted(c for c in df.columns if c not in (key, position))))
    a = before.select(key, F.col(position).alias("p0"), same(before).alias("h0"))
    b = after.select(key, F.col(position).alias("p1"), same(after).alias("h1"))
    change = F.when(F.col("h1").isNull(), "removed").when(F.col("h0") != F.col("h1"), "changed").when(F.col("p0") != F.col("p1"), "moved")
    return a.join(b, key, "left").select(key, change.alias("change")).where("change IS NOT NULL")


def capped(df: DataFrame, by: str, order: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each group."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_n") <= most).drop("_n")


def canonical(json: Column) -> Column:
    """JSON as text that does not depend on the order of keys, at any depth; null for what is no JSON."""
    return F.to_json(F.try_parse_json(json))


def first_difference(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """``key, field, was, now`` of the first column, in the order of ``before``, that differs; equal rows are left out."""
    cols = [c for c in before.columns if c != key]
    both = before.alias("a").join(after.alias("b"), key)
    changed = [F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.struct(F.lit(c).alias("field"), F.col(f"a.{c}").cast("string").alias("was"), F.col(f"b.{c}").cast("string").alias("now"))) for c in cols]
    return both.select(key, F.coalesce(*changed).alias("d")).where("d IS NOT NULL").select(key, "d.*")

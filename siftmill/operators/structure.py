"""Differences of nested documents: every leaf is a row, so that two snapshots are compared by one join, at any depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmill.session import checkpointing


def leaves(df: DataFrame, key: str, doc: str) -> DataFrame:
    """``key, path, place, value``: a row for each leaf of a JSON text. ``path`` reads ``$.a[0].b``; ``place`` sorts as the document
    is read, numbers by value. Empty objects and lists are leaves, and so is null; what is no JSON is one leaf, its whole text, with
    path ``$``. A null document has no leaves. Rows go one level deeper at a time, all documents at once."""
    checkpointing(df.sparkSession)
    spark = df.sparkSession
    parsed = F.try_parse_json(F.col(doc))
    rows = df.where(F.col(doc).isNotNull()).select(key, F.lit("$").alias("path"), F.lit("").alias("place"), parsed.alias("v"), F.when(parsed.isNull(), F.col(doc)).alias("raw"))
    kind = F.schema_of_variant("v")
    inner = F.coalesce(kind.rlike(r"^(?:OBJECT|ARRAY)<") & ~F.to_json("v").isin("{}", "[]"), F.lit(False))
    out = None
    while True:
        rows = rows.withColumn("inner", inner).checkpoint()
        ends = rows.where("NOT inner").select(key, "path", "place", F.coalesce("raw", F.to_json("v"), F.lit("null")).alias("value"))
        out = ends if out is None else out.unionByName(ends)
        rows = rows.where("inner")
        if rows.isEmpty():
            return out
        each = spark.tvf.variant_explode(F.col("v").outer()).toDF("at", "name", "part")
        step = F.when(F.col("name").isNull(), F.concat(F.lit("["), F.col("at").cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("."), F.col("name")))
        order = F.when(F.col("name").isNull(), F.lpad(F.col("at").cast("string"), 10, "0")).otherwise(F.col("name"))
        rows = rows.lateralJoin(each).select(key, F.concat("path", step).alias("path"), F.concat("place", F.lit("\x01"), order).alias("place"), F.col("part").alias("v"), F.lit(None).cast("string").alias("raw"))


def differences(before: DataFrame, after: DataFrame, key: str, doc: str) -> DataFrame:
    """``key, path, place, change, was, now`` of leaves that differ: ``added``, ``removed`` or ``changed``. The order of names doesn't
    count, that of lists does. A list or object that replaces a value gives its leaves as added, and the value as removed."""
    a = leaves(before, key, doc).withColumnRenamed("value", "was")
    b = leaves(after, key, doc).withColumnRenamed("value", "now")
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").otherwise("changed")
    return a.join(b, [key, "path", "place"], "full").where("NOT (was <=> now)").select(key, "path", "place", change.alias("change"), "was", "now")


def first_difference(before: DataFrame, after: DataFrame, key: str, doc: str) -> DataFrame:
    """``key, path, change, was, now``: the first place of each document at which it differs, as it is read."""
    d = differences(before, after, key, doc)
    first = d.groupBy(key).agg(F.min(F.struct("place", "path", "change", "was", "now")).alias("d"))
    return first.select(key, "d.path", "d.change", "d.was", "d.now")


def append_only(before: DataFrame, after: DataFrame, key: str, doc: str) -> DataFrame:
    """Violations ``rule, severity, entity, field, message`` of an archive that may only grow: documents that went (``removed``), and
    the first place of those that changed (``changed``)."""
    gone = before.select(key).join(after.select(key), key, "left_anti").select(F.lit("removed").alias("rule"), F.lit("error").alias("severity"), F.col(key).cast("string").alias("entity"), F.lit("$").alias("field"), F.lit(None).cast("string").alias("message"))
    kept = first_difference(before.join(after.select(key), key, "left_semi"), after.join(before.select(key), key, "left_semi"), key, doc)
    changed = kept.select(F.lit("changed").alias("rule"), F.lit("error").alias("severity"), F.col(key).cast("string").alias("entity"), F.col("path").alias("field"), F.concat_ws(" -> ", F.coalesce("was", F.lit("nothing")), F.coalesce("now", F.lit("nothing"))).alias("message"))
    return gone.unionByName(changed)

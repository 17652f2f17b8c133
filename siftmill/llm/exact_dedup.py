"""Exact deduplication by content-defined chunk recipes, in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmill.llm.common import LOWER, UPPER, fresh, staged, table

#: A chunk ends at the first sentence end or line end after 512 characters, and at 4,096 at the latest.
CHUNK = r"(?s).{512,4095}?[.!?;\n。]|.{1,4096}"


def recipes(chunks: DataFrame) -> DataFrame:
    """``chunks(_row..., parts array<struct<h, d>>)`` -> the same rows with ``recipe array<long>`` in place of ``parts``.

    ``h`` (64 bits) is a chunk's short name and ``d`` its SHA-256. The dictionary of all distinct chunks shows which
    short names stand for more than one content; those get a further number, so that equal identifiers mean equal
    contents in every case."""
    names = chunks.select(F.explode("parts").alias("p")).select("p.h", "p.d").distinct()
    shared = names.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("d")).alias("ds")).where("n > 1")
    # a name's distinct contents: two or three even in the worst real case, since names have 64 bits
    twins = staged(shared.select("h", F.posexplode("ds").alias("variant", "d")))
    if twins.isEmpty():
        return chunks.withColumn("recipe", F.transform("parts", lambda p: p["h"])).drop("parts")
    rest = [c for c in chunks.columns if c != "parts"]
    spread = chunks.withColumn("_uid", F.monotonically_increasing_id())
    spread = staged(spread)
    placed = spread.select("_uid", F.posexplode("parts").alias("i", "p")).select("_uid", "i", F.col("p.h").alias("h"), F.col("p.d").alias("d"))
    named = placed.join(twins, ["h", "d"], "left").select("_uid", "i", "h", F.coalesce("variant", F.lit(0)).cast("long").alias("variant"))
    lists = named.groupBy("_uid").agg(F.sort_array(F.collect_list(F.struct("i", "h", "variant"))).alias("l"))
    flat = F.flatten(F.transform("l", lambda x: F.array(x["h"], x["variant"])))
    lists = staged(lists.select("_uid", flat.alias("recipe")))
    empty = F.array().cast("array<bigint>")
    return spread.join(lists, "_uid", "left").select(*rest, F.coalesce("recipe", empty).alias("recipe"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z. A null text counts as empty; all empty texts are one group.
    Of equal texts the largest id stays; rows repeated with one id are counted singly, and all of them bear
    ``kept = true`` if theirs is the id that stays. A null id never stays beside another id. An empty table gives no
    rows. Other columns are not read, whatever their names.

    Texts are cut into content-defined chunks where they lie; only names and digests of chunks leave the scan. Groups
    are made by comparing the ordered lists of verified chunk identifiers. ``name`` replaces the 64-bit hash of a
    chunk (tests use a weak one)."""
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    short = name or F.xxhash64
    parts = F.transform(F.regexp_extract_all("t", F.lit(CHUNK), F.lit(0)), lambda c: F.struct(short(c).alias("h"), F.unhex(F.sha2(c, 256)).alias("d")))
    cut = staged(rows.select("doc_id", F.sha2("t", 256).alias("text_sha256"), parts.alias("parts")))
    listed = recipes(cut)
    groups = listed.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    found = listed.join(staged(groups), "recipe", "left")  # two exchanges, so that a large group's rows can be split
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whatever their names, that stay; of rows repeated with one id and equal texts, one.
    Null texts count as empty, texts of any length are compared whole, a null id stays only where no other id has the text."""
    i, sha, kept_sha, n = fresh(docs, "id", "sha", "kept_sha", "n")
    kept = exact_duplicates(docs, id_col, text_col).where("kept").groupBy(F.col("doc_id").alias(i), F.col("text_sha256").alias(kept_sha)).agg(F.count(F.lit(1)).alias(n))
    kept, seen = staged(kept, F.max(n).alias("most"))
    rows = docs.withColumn(sha, F.sha2(F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER), 256))
    rows = rows.join(kept, F.col(id_col).eqNullSafe(F.col(i)) & (F.col(sha) == F.col(kept_sha)), "left_semi")
    if (seen["most"] or 0) > 1:
        rows = rows.dropDuplicates([id_col, sha])
    return rows.select(*docs.columns)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""

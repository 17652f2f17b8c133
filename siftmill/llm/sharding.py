"""Sharding by vector bin packing: bytes, tokens and rows are balanced together."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmill.llm.common import WORD, numbered, staged, table

#: Small groups are placed in so many lots; a group above a lot's fair share of any measure is placed on its own.
LOTS = 4096
MEASURES = ("bytes", "tokens", "rows")


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each row of ``vectors`` (shares of the whole, by measure): largest first, each where its dot
    product with the residual capacity is highest among the shards that it fits, else where it overfills least."""
    left = np.full((shards, vectors.shape[1]), 1 / shards)
    at = np.zeros(len(vectors), int)
    for i in np.lexsort((-vectors.sum(1), -vectors.max(1))):
        fits = (left >= vectors[i]).all(1)
        at[i] = np.where(fits, left @ vectors[i], -np.inf).argmax() if fits.any() else (left - vectors[i]).min(1).argmax()
        left[at[i]] -= vectors[i]
    return at


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", lots: int = LOTS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Equal texts are a group and stay together, unless a group has more than half of a shard's fair share of bytes,
    tokens or rows; such a group is split by document id. A null text counts as empty. Repeated rows are rows of
    their own. An empty table gives no rows. The law is ``bytes``. Only the vectors of lots and of single heavy
    groups, at most ``4 * lots`` plus the pieces of groups that are split, are placed on the driver, however many
    documents there are; slots are numbered by cells, not by a task per shard."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"), F.xxhash64(text).alias("gid"), F.xxhash64(F.lit(1), F.col(id_col), text).alias("_h"),
    )
    base, whole = staged(base, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    most = F.greatest(*[F.col(m) / F.lit(float(max(1, whole[m]))) for m in MEASURES])
    heavy = base.groupBy("gid").agg(*sums).where(most > 1.0 / lots).select("gid", F.when(most > 0.5 / shards, F.ceil(most * 256)).otherwise(1).cast("long").alias("pieces")).collect()
    heavy = F.broadcast(spark.createDataFrame([(r["gid"], r["pieces"]) for r in heavy], "gid long, pieces long"))  # 3 * lots rows at most
    units = base.join(heavy, "gid", "left").withColumn("unit", F.when(F.col("pieces").isNull(), F.pmod("gid", F.lit(lots))).otherwise(F.col("gid")))
    units = units.withColumn("piece", F.when(F.col("pieces").isNull(), F.lit(-1)).otherwise(F.pmod("_h", F.col("pieces"))).cast("long"))
    loads = sorted(tuple(r) for r in units.groupBy("unit", "piece").agg(*sums).collect())
    vectors = np.array([r[2:] for r in loads], float).reshape(-1, 3) / [max(1, whole[m]) for m in MEASURES]
    where = [(r[0], r[1], int(s)) for r, s in zip(loads, place(vectors, shards), strict=True)]
    dealt = units.join(F.broadcast(spark.createDataFrame(where, "unit long, piece long, shard int")), ["unit", "piece"])
    dealt = dealt.select("doc_id", "size", "text_crc32", "shard", "_h", F.lit(1).alias("one"))
    slots = numbered(dealt, ["shard"], ["_h", "doc_id", "text_crc32"], "one", whole["rows"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("before").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))

"""Micro-batch ledger: exactly-once by key, idempotent across retries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dedup_to_table(spark: SparkSession, stream: DataFrame, key: str, ts: str, out: str, checkpoint: str, within: str = "120 days") -> DataFrame:
    """Runs all available input once, keeps the first row of each key within the watermark, appends to a Parquet table and
    returns that table."""
    kept = stream.withWatermark(ts, within).dropDuplicatesWithinWatermark([key])
    query = kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def slot_counts(df: DataFrame, slot) -> DataFrame:
    return df.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))


def publish_batches(stream: DataFrame, key: str, folder: str, checkpoint: str) -> None:
    """Runs all available input; each micro-batch adds the keys that earlier ones have not written, under its own number,
    so a batch that is retried replaces what it wrote."""
    spark = stream.sparkSession

    def add(batch: DataFrame, n: int) -> None:
        fresh = batch.dropDuplicates([key])
        if n:
            done = spark.read.schema(fresh.schema).option("recursiveFileLookup", True).parquet(*[f"{folder}/batch={i}" for i in range(n)])
            fresh = fresh.join(done.select(key), key, "left_anti").select(*batch.columns)
        fresh.write.mode("overwrite").parquet(f"{folder}/batch={n}")

    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

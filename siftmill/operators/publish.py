"""Publishing a run: ids, log rows, run record, references, and a commit that readers see whole or not at all."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def offset_ids(new: DataFrame, old: DataFrame, stem: str, number: str, order: list[Column]) -> DataFrame:
    """Numbers new rows of each stem on from the largest number that its old rows have: ``number`` and ``item_id``."""
    top = old.groupBy(stem).agg(F.max(number).alias("_top"))
    n = F.row_number().over(Window.partitionBy(stem).orderBy(*order)) + F.coalesce("_top", F.lit(0))
    out = new.join(top, stem, "left").withColumn(number, n.cast("int")).drop("_top")
    return out.withColumn("item_id", F.concat(stem, F.lit("-"), F.when(F.length(F.col(number).cast("string")) < 2, F.lpad(F.col(number).cast("string"), 2, "0")).otherwise(F.col(number).cast("string"))))


def final_items(drafts: DataFrame, unexplained: str = "awareness_only") -> DataFrame:
    """Drafts with ``item_id, timestamp`` as archive items, fields in the archive's order, ``candidate_ids`` and whatever else they carry left out.
    Items of the mechanism ``unexplained`` have a rationale in place of a question and an issue, all others the reverse; sources and
    interpretations keep their fields alone. Nulls stay null; ``backfilled`` is false."""
    c, aware = F.col, F.coalesce(F.col("mechanism") == unexplained, F.lit(False))
    only = lambda name, *fields: F.transform(name, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(name)
    return drafts.select(
        c("item_id"), "timestamp", "section", "claim", "domains", "source_class", "mechanism", only("interpretation", "domain", "text"), F.when(~aware, c("validation_question")).alias("validation_question"),
        F.when(~aware, c("candidate_issue_statement")).alias("candidate_issue_statement"), F.when(aware, c("awareness_rationale")).alias("awareness_rationale"),
        only("sources", "publication", "url", "headline", "published", "source_class"), F.lit(False).alias("backfilled"), "update_of",
    )


def log_rows(survivors: DataFrame, judgments: DataFrame, key: str) -> DataFrame:
    """Every survivor with its judgment; ``verdict`` is ``unjudged`` without one."""
    return survivors.join(judgments, key, "left").withColumn("verdict", F.coalesce("verdict", F.lit("unjudged")))


def funnel(log: DataFrame, **stages: Column) -> DataFrame:
    """One row: how many rows each stage's condition lets through."""
    return log.agg(*[F.count_if(c).alias(n) for n, c in stages.items()])


def seen_conflicts(survivors: DataFrame, ledger: DataFrame, key: str, verdict: str = "verdict") -> DataFrame:
    """Survivors that the ledger has as published."""
    return survivors.join(ledger.where(F.col(verdict) == "pass").select(key), key, "left_semi")


def resolved(df: DataFrame, ref: str, items: DataFrame, item_key: str, at: str) -> DataFrame:
    """Adds ``ref_at`` and ``ref_problem``: ``unknown`` if no item has the id, ``later`` if it is newer than the row."""
    known = items.select(F.col(item_key).alias(ref), F.col(at).alias("ref_at"))
    problem = F.when(F.col(ref).isNull(), None).when(F.col("ref_at").isNull(), "unknown").when(F.col("ref_at") > F.col(at), "later")
    return df.join(known, ref, "left").withColumn("ref_problem", problem)


def commit(frames: dict[str, DataFrame], folder: str, run_id: str, record: DataFrame) -> None:
    """Writes each frame below ``folder/name/run_id=...``, and ``record`` last: a run counts once its record is there. A
    run that broke off is written anew; one that is recorded is refused."""
    spark = record.sparkSession
    if not runs(spark, folder).where(F.col("run_id") == run_id).isEmpty():
        raise ValueError(f"run {run_id} is recorded")
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}/run_id={run_id}")
    record.select(F.lit(run_id).alias("run_id"), F.to_json(F.struct("*")).alias("record")).coalesce(1).write.mode("append").parquet(f"{folder}/runs")


def runs(spark: SparkSession, folder: str) -> DataFrame:
    schema = "run_id string, record string"
    try:
        return spark.read.schema(schema).parquet(f"{folder}/runs")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def committed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The rows of all recorded runs."""
    return spark.read.option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}").withColumn("run_id", F.col("run_id").cast("string")).join(runs(spark, folder).select("run_id").distinct(), "run_id", "left_semi")

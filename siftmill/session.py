"""SparkSession with the settings that the library expects."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "siftmill", **conf: str) -> SparkSession:
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.ansi.enabled": "true"}
    return SparkSession.builder.appName(name).config(map=base | conf).getOrCreate()


def checkpointing(spark: SparkSession) -> SparkSession:
    """Keeps the session's checkpoint folder; sets a temporary one only where none is set, in local mode."""
    sc = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()):
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="siftmill-"))
    return spark


def staged(df: DataFrame) -> DataFrame:
    """Writes ``df`` once as a table below the checkpoint folder and reads it back: rows are computed once, and a lost executor costs a reread."""
    spark = checkpointing(df.sparkSession)
    path = f"{spark.conf.get('spark.checkpoint.dir', None) or spark.sparkContext.getCheckpointDir()}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Helpers that the operators of this subpackage share: staged tables, components, numbering, grouped Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Words, as every contract of this subpackage defines them (Java and Python syntax).
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.siftmill.stage.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="siftmill-")
        spark.conf.set("spark.siftmill.stage.dir", folder)
    return folder


#: Paths of this application's staged tables.
_STAGED: list[str] = []


def staged(df: DataFrame, *metrics) -> DataFrame | tuple[DataFrame, dict]:
    """Write ``df`` as a table into the shared folder and read it back, which cuts the lineage: a lost executor costs
    a reread, not the whole history. With ``metrics`` (aggregate columns), also returns their values by name."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
    _STAGED.append(path)
    seen = Observation() if metrics else None
    (df.observe(seen, *metrics) if metrics else df).write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    return (back, seen.get) if metrics else back


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def contracted(batches: Iterable[pa.RecordBatch], most: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Edges ``a, b`` of a partition -> one edge from each node to the smallest node that the partition's edges join it to.

    Whenever ``most`` edges are held, they are contracted to such a forest; a forest that stays that large is passed on."""
    held: list[np.ndarray] = []
    rows = 0

    def forest() -> np.ndarray:
        ids, at = np.unique(np.concatenate(held), return_inverse=True)
        tree = Forest(len(ids))  # roots are the least places, that is, the smallest ids
        for i, j in at.reshape(-1, 2).tolist():
            tree.join(i, j)
        root = np.array([tree.root(i) for i in range(len(ids))], np.int64)
        keep = root != np.arange(len(ids))
        return np.stack([ids[keep], ids[root[keep]]], 1)

    for batch in batches:
        held.append(np.stack([batch["a"].to_numpy(), batch["b"].to_numpy()], 1))
        rows += len(held[-1])
        if rows > most:
            held = [forest()]
            rows = len(held[0])
            if rows > most // 2:
                yield pa.RecordBatch.from_arrays([pa.array(held[0][:, 0]), pa.array(held[0][:, 1])], ["a", "b"])
                held, rows = [], 0
    if rows:
        left = forest()
        yield pa.RecordBatch.from_arrays([pa.array(left[:, 0]), pa.array(left[:, 1])], ["a", "b"])


def clear_staged(spark: SparkSession) -> int:
    """Deletes the tables that this application has staged so far, and gives their number. For when their readers are done."""
    n = 0
    while _STAGED:
        path = spark._jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        n += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``edges(a, b)``; self-loops and nulls are ignored.

    Each partition's edges become a forest first, where they lie and again by their larger end, so that a large group
    counts about one edge a member, however many edges its members had. Then each round joins every node's neighbours to
    the smallest of them and removes repeats, until nothing changes: a number of rounds near the logarithm of the
    longest path. The table of minima is staged before it is joined, so that Spark can split a node with very many
    neighbours between tasks."""
    change = (F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.shiftright(F.xxhash64("a", "b"), 32)), F.lit(0)).alias("h"))
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    links = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").mapInArrow(contracted, "a long, b long")
    links, last = staged(links.repartition("a").mapInArrow(contracted, "a long, b long"), *change)
    while last["n"]:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        moved = both.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        links, now = staged(moved.where("a > b").distinct(), *change)
        if now == last:
            break
        last = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def numbered(df: DataFrame, groups: list[str], order: list[str], value: str, rows: int, per_cell: int = 1000) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the rows that precede in the group, in an order seeded by ``order[0]``
    (a hash). Groups of any size are spread over cells of about ``per_cell`` rows; only the cells' sums are summed up
    in sequence, so no task sees a whole group. Rows equal in all columns are counted first and numbered as one, so
    that however many there are they fill no cell; which of them gets which number makes no difference."""
    cells = max(1, -(-rows // per_cell))
    df = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_times")).withColumns({"_cell": F.pmod(F.col(order[0]), F.lit(cells)), "_all": F.col(value) * F.col("_times")})
    own = Window.partitionBy(*groups, "_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*groups, "_cell").agg(F.sum("_all").alias("_sum"))
    ahead = Window.partitionBy(*groups).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = staged(sums.withColumn("_base", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).drop("_sum"))
    inside = df.withColumn("_in", F.coalesce(F.sum("_all").over(own), F.lit(0)))
    placed = inside.join(sums, [*groups, "_cell"]).withColumn("_nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_times") - 1)))
    return placed.withColumn("before", F.col("_base") + F.col("_in") + F.col("_nth") * F.col(value)).drop("_cell", "_base", "_in", "_all", "_times", "_nth")


def positions(df: DataFrame, group: list[str], order: list[str], name: str = "n") -> DataFrame:
    """Add ``name``: the row's place (from 0) in its group, in ``order``, nulls first. Rows are dealt out by ranges of group and
    order, so a group of any size lies in many tasks; places come from the sizes of the ranges, a row each."""
    spread = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    base = staged(spread.withColumns({"_pid": F.spark_partition_id(), "_in": F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))}))
    sizes = base.groupBy("_pid").agg(F.count(F.lit(1)).alias("_size"))
    ahead = sizes.select("_pid", (F.sum("_size").over(Window.orderBy("_pid")) - F.col("_size")).alias("_ahead"))
    at = base.join(F.broadcast(ahead), "_pid").withColumn("_at", F.col("_ahead") + F.col("_in"))
    first = staged(at.groupBy(*group).agg(F.min("_at").alias("_first")))
    return at.join(first, group).withColumn(name, F.col("_at") - F.col("_first")).drop("_pid", "_in", "_ahead", "_at", "_first")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` is called so (whatever the case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def grouped(batches: Iterable[pa.RecordBatch], *keys: str, least: int = 1) -> Iterator[pa.Table]:
    """Tables of whole runs of equal whole-number ``keys``, from batches sorted by them; runs may go on over batches.
    One run each, or as many as make ``least`` rows. Each row is copied once, however long its run is."""
    held: list[pa.Table] = []
    rows, last = 0, {}
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        new = np.zeros(table.num_rows, bool)
        for k in keys:
            values = table[k].to_numpy()
            new[1:] |= values[1:] != values[:-1]
            new[0] |= bool(held) and values[0] != last[k]
            last[k] = values[-1]
        at = 0
        for end in np.flatnonzero(new).tolist():
            if rows + end - at >= least:
                yield pa.concat_tables([*held, table.slice(at, end - at)]).combine_chunks()
                held, rows, at = [], 0, end
        held.append(table.slice(at))
        rows += table.num_rows - at
    if rows:
        yield pa.concat_tables(held).combine_chunks()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

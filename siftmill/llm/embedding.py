"""Embedding near-deduplication by a subspace pigeonhole join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftmill.llm.common import components, grouped, staged, table

#: Blocks that rotated vectors are split into, rows of a strip compared in one task with as many of another, and of these at once.
BLOCKS, CHUNK, SLAB = 4, 4096, 512
SEED, SLACK, ROUNDING = 11, 1e-9, 1e-5


def rotation(d: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere: it spreads any difference over all blocks."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def bounds(d: int, blocks: int) -> np.ndarray:
    return np.linspace(0, d, min(blocks, d) + 1).astype(int)


def unit(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(1, keepdims=True)
    x = x / np.where(big > 0, big, 1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_vectors(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", blocks: int = BLOCKS) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Two vectors are linked if their labels are equal and not null, their dimensions are equal and their cosine, in
    double precision, is at least ``least``. Null and zero vectors and those with null or non-finite components link
    with nothing, nor do rows with a null id. Rows repeated with one id are linked with each other as any equal
    vectors. An empty table gives no rows.

    Equal vectors of a label become one class. If two unit vectors differ by squared distance D, they differ by D / m or
    less in one of m blocks of their rotated coordinates. So each block is range-joined under its share of the budget
    ``2 - 2 * least``: it is sorted into strips of the share's width over its first coordinate, and by the triangle
    inequality a strip meets itself and its two neighbours alone. Of a strip above CHUNK rows each chunk meets each
    chunk. Within a task the whole block decides who is a candidate; a pair counts in the first block that finds it,
    after its cosine was computed from the whole vectors. Tasks give numbers of links and spanning forests, not pairs.
    Comparisons of block coordinates still grow with the square of a label's classes, about half of all pairs of a label
    for each block where vectors lie in all directions; candidates, and whole vectors' cosines, are few."""
    budget = 2 - 2 * least
    ok = F.col("_v").isNotNull() & F.col("_l").isNotNull() & F.col("vec_id").isNotNull() & (F.size("_v") > 0)
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("_v", lambda x: x != 0)
    real = "float" if dict(vectors.dtypes)[vector_col] == "array<float>" else "double"
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{real}>").alias("_v"), F.col(label_col).alias("_l"))
    base = staged(base.withColumn("_ok", F.coalesce(ok & finite, F.lit(False))))
    plain = F.transform("_v", lambda x: x + F.lit(0.0).cast(real))  # no negative zeros
    valid = base.where("_ok").select("vec_id", "_l", plain.alias("_v"))
    classes = staged(valid.groupBy("_l", "_v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")))

    def strips(batches):
        for b in batches:
            v, size = b["_v"].flatten().to_numpy(), b["_v"].value_lengths().to_numpy()
            first = np.cumsum(size) - size
            for d in np.unique(size).tolist():
                at = np.flatnonzero(size == d)
                x = v[first[at][:, None] + np.arange(d)]
                y, edge = unit(x.astype(float)) @ rotation(d), bounds(d, blocks)
                width = np.sqrt(budget / (len(edge) - 1)) * (1 + 1e-6) + SLACK
                raw, own = pa.array([r.tobytes() for r in x], pa.binary()), pa.array(at)
                for k, lo in enumerate(edge[:-1].tolist()):
                    strip = np.floor(y[:, lo] / width).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([d] * len(at), pa.int32()), b["_l"].take(own), pa.array([k] * len(at), pa.int32()), pa.array(strip), b["rep"].take(own), b["copies"].take(own), raw], ["d", "l", "block", "strip", "rep", "copies", "v"])

    kind = dict(base.dtypes)["_l"]
    dealt = classes.select("_l", "_v", "rep", "copies").mapInArrow(strips, f"d int, l {kind}, block int, strip long, rep long, copies long, v binary")
    dealt = staged(dealt.withColumn("place", F.xxhash64("d", "l", "block")))
    # chunks are numbered along a place's strips, so that those which a row meets are a range of numbers
    line = Window.partitionBy("place").orderBy("strip")
    counts = dealt.groupBy("place", "strip").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("parts"))
    counts = counts.withColumn("upto", F.sum("parts").over(line))
    beside = lambda f, step, c: F.when(f("strip").over(line) == F.col("strip") + step, f(c).over(line))
    counts = staged(counts.withColumns({"base": F.col("upto") - F.col("parts"), "low": F.coalesce(beside(F.lag, -1, "upto") - beside(F.lag, -1, "parts"), F.col("upto") - F.col("parts")), "high": F.coalesce(beside(F.lead, 1, "upto"), "upto") - 1}))
    rows = dealt.join(counts, ["place", "strip"]).withColumn("own", F.col("base") + F.pmod(F.xxhash64("rep"), F.col("parts")))
    rows = rows.select("place", "block", "d", "rep", "copies", "v", "own", F.explode(F.sequence("low", "high")).alias("c"))
    rows = rows.select("place", F.least("own", "c").alias("i"), F.greatest("own", "c").alias("j"), (F.col("own") <= F.col("c")).alias("left"), "block", "d", "rep", "copies", "v")

    def compare(batches):
        kind = np.float32 if real == "float" else np.float64
        for g in grouped(batches, "place", "i", "j"):
            left = np.asarray(g["left"].combine_chunks().to_numpy(zero_copy_only=False), bool)
            within = g["i"][0].as_py() == g["j"][0].as_py()
            if g.num_rows < 2 or not within and (left.all() or not left.any()):
                continue
            d, k = g["d"][0].as_py(), g["block"][0].as_py()
            x = np.frombuffer(b"".join(g["v"].to_pylist()), kind).reshape(-1, d).astype(float)
            u, edge = unit(x), bounds(d, blocks)
            y = u @ rotation(d)
            share = budget / (len(edge) - 1) + SLACK
            rep, copies = g["rep"].to_numpy(), g["copies"].to_numpy()
            a, b = (np.arange(len(x)),) * 2 if within else (np.flatnonzero(left), np.flatnonzero(~left))
            z = y[:, edge[k] : edge[k + 1]].astype(np.float32)
            norm = (z**2).sum(1)
            links, component = np.zeros(len(x), np.int64), np.arange(len(x))
            for at in range(0, len(a), SLAB):
                some = a[at : at + SLAB]
                apart = norm[some][:, None] + norm[b] - 2 * z[some] @ z[b].T
                near = apart <= share + ROUNDING
                if within:
                    near &= some[:, None] < b
                i, j = np.nonzero(near)
                i, j = some[i], b[j]
                for part in range(0, len(i), 1 << 18):
                    p, q = i[part : part + (1 << 18)], j[part : part + (1 << 18)]
                    by_block = np.add.reduceat((y[p] - y[q]) ** 2, edge[:-1], axis=1) <= share
                    fresh = by_block[:, k] & ~by_block[:, :k].any(1)
                    p, q = p[fresh], q[fresh]
                    linked = np.einsum("ij,ij->i", u[p], u[q]) >= least
                    p, q = p[linked], q[linked]
                    np.add.at(links, p, copies[q])
                    np.add.at(links, q, copies[p])
                    component = joined_places(component, p, q)
            met = np.flatnonzero(links)
            if len(met):
                yield pa.RecordBatch.from_arrays([pa.array(rep[met]), pa.array(links[met]), pa.array(rep[component[met]])], ["rep", "links", "parent"])

    found = rows.repartition("place", "i", "j").sortWithinPartitions("place", "i", "j")
    found = staged(found.mapInArrow(compare, "rep long, links long, parent long"))
    joined = components(found.where("rep != parent").select(F.col("rep").alias("a"), F.col("parent").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = classes.join(links, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    named = staged(named.select("_l", "_v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("c")))
    key = base.select("vec_id", F.when(F.col("_ok"), F.col("_l")).alias("_l"), F.when(F.col("_ok"), plain).alias("_v"))
    out = key.join(named, ["_l", "_v"], "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def joined_places(component: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``component`` (one place for each place, of its own component) with the components of ``i`` and ``j`` joined."""
    while True:
        low = np.minimum(component[i], component[j])
        after = component.copy()
        np.minimum.at(after, component[i], low)
        np.minimum.at(after, component[j], low)
        after = after[after]
        after = np.minimum(after, after[component])
        if (after == component).all():
            return component
        component = after


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP9_SQL = """
WITH RECURSIVE f AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
ok AS (SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM f WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
  AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT m.vec_id, coalesce(n_links, 0) AS n_links, component_id, m.vec_id = component_id AS kept
FROM embeddings m JOIN c ON c.a = m.vec_id LEFT JOIN n ON n.a = m.vec_id
"""

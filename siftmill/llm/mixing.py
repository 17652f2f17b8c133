"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

import hashlib
import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmill.llm.common import WORD, fresh, numbered, staged, table

WEIGHTS, SHARE, LIMIT = (5, 2, 1), 1.5, 2
BLOCK_WORDS, SHARDS, SEED = 16, 8, 20240501
#: Above so many sources their plan is joined by shuffling instead of broadcast.
BROADCAST_SOURCES = 100_000


def targets(sizes: list[int], weights: list[float], share: float = SHARE, limit: float = LIMIT) -> list[float]:
    """Divide ``share`` of all sizes by weight; what exceeds ``limit`` times a source's size is divided among the rest."""
    goal = [0.0] * len(sizes)
    left, free = min(share, limit) * sum(sizes), sorted(range(len(sizes)), key=lambda i: (limit * sizes[i] / weights[i], i))
    weight = float(sum(weights))
    for k, i in enumerate(free):
        if limit * sizes[i] * weight <= left * weights[i]:
            goal[i] = float(limit * sizes[i])
            left -= goal[i]
            weight -= weights[i]
        else:
            for j in free[k:]:
                goal[j] = left * weights[j] / weight
            break
    return goal


def apportion(votes: list[float], seats: int) -> list[int]:
    """Sainte-Laguë: each seat goes to the highest ``votes / (2 * seats so far + 1)``, ties to the first.

    Starts from the rounded shares, which differ from the result by about one seat per source at most, so the work
    does not depend on the number of seats."""
    total = sum(votes)
    if total <= 0 or seats <= 0:
        return [0] * len(votes)
    got = [int(v * seats / total + 0.5) for v in votes]
    over = sum(got) - seats
    if over < 0:
        heap = [(-v / (2 * g + 1), i) for i, (v, g) in enumerate(zip(votes, got, strict=True))]
        heapq.heapify(heap)
        for _ in range(-over):
            i = heap[0][1]
            got[i] += 1
            heapq.heapreplace(heap, (-votes[i] / (2 * got[i] + 1), i))
    elif over > 0:
        heap = [(v / (2 * g - 1), -i) for i, (v, g) in enumerate(zip(votes, got, strict=True)) if g]
        heapq.heapify(heap)
        for _ in range(over):
            i = -heap[0][1]
            got[i] -= 1
            if got[i]:
                heapq.heapreplace(heap, (votes[i] / (2 * got[i] - 1), -i))
            else:
                heapq.heappop(heap)
    return got


def shard_quotas(votes: list[float], seats: int, shards: int) -> list[list[int]]:
    """Blocks of each source in each shard. Shard j gets what the first j + 1 shards get together, less what the
    first j get; the method never takes a seat back when seats are added, so no quota is negative."""
    steps = [apportion(votes, seats * (j + 1) // shards) for j in range(shards)]
    return [[b - a for a, b in zip(before, after, strict=True)] for before, after in zip([[0] * len(votes), *steps], steps, strict=False)]


def shard_ranges(n: int, block: int, shards: int) -> list[tuple[int, int]]:
    """Words of a source, in its seeded order, that lie in each shard: whole blocks, dealt evenly; the last has the rest too."""
    blocks = max(1, n // block)
    at = [blocks * j // shards * block for j in range(shards)] + [n]
    return list(zip(at, at[1:], strict=False))


def chosen(ranges: list[tuple[int, int]], quotas: list[int], block: int, limit: int, seed: str) -> list[tuple[int, int, int]]:
    """Segments ``(from, to, times)`` of a source's words: each shard's words whole as often as its quota of blocks holds
    them, and a run of blocks once more, from a seeded start and round the shard's end. What a shard can't hold, at
    ``limit`` times its words, goes on to the others."""
    room, give, carry = [limit * (b - a) for a, b in ranges], [], 0
    for q, most in zip(quotas, room, strict=True):
        give.append(min(q * block + carry, most))
        carry += q * block - give[-1]
    for j in range(len(give)):
        more = min(carry, room[j] - give[j])
        give[j], carry = give[j] + more, carry - more
    out = []
    for j, ((a, b), words) in enumerate(zip(ranges, give, strict=True)):
        if b == a:
            continue
        passes, extra = divmod(words, b - a)
        blocks = max(1, (b - a) // block)
        lo = a + int.from_bytes(hashlib.sha256(f"{seed}:{j}".encode()).digest()[:8], "big") % blocks * block
        over = max(0, lo + extra - b)
        parts = [(a, a + over, passes + 1), (a + over, lo, passes), (lo, lo + extra - over, passes + 1), (lo + extra - over, b, passes)]
        out += [p for p in parts if p[1] > p[0]]
    return out


def plan(spark: SparkSession, totals: list[tuple[str | None, int]], weights, share: float, limit: int, block: int, shards: int, seed: int) -> DataFrame:
    """One row per source: ``_key, source_size, target, quota`` (blocks by shard), and ``segments`` of its words in their
    seeded order, each with the number of times that it is taken."""
    totals = sorted(totals, key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [n for _, n in totals]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(totals))], share, limit)
    quotas = shard_quotas(goal, round(sum(goal) / block), shards)
    out = []
    for i, (source, n) in enumerate(totals):
        own = [q[i] for q in quotas]
        out.append(("n" if source is None else f"s{source}", n, goal[i], own, chosen(shard_ranges(n, block, shards), own, block, limit, f"{seed}:{source}")))
    return spark.createDataFrame(out, "_key string, source_size long, target double, quota array<long>, segments array<struct<lo: long, hi: long, times: long>>")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT, block: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken`` and, for callers that cut texts, ``passes``
    (whole copies) and ``cuts`` (ranges of words, from and to, taken once more in a further ``copy``); ``row`` is a hash
    of the text.

    A null text has size 0 and is never taken; null sources are one source, the last. Rows repeated with one id are
    separate documents. An empty table gives no rows; if all texts are empty, all targets are 0. ``limit`` is whole.
    Documents of any length are cut by word ranges. Other columns are not read. The words of a source lie in a seeded
    order of its documents, which depends on ids and texts alone, so reruns agree; equal-token blocks of them are dealt to
    shards, and each shard gives the number of blocks of its quota. The list of sources (one row each) is planned on the
    driver; documents never go there."""
    key = F.when(F.col(source_col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source_col)))
    size = F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long")
    row = F.xxhash64(text_col)
    sized, seen = staged(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), key.alias("_key"), size.alias("size"), row.alias("row"), F.xxhash64(F.lit(seed), F.col(id_col), row).alias("_h")), F.count(F.lit(1)).alias("n"))
    totals = [(r["source"], r["n"]) for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()]
    sources = plan(docs.sparkSession, totals, weights, share, limit, block, shards, seed)
    sources = F.broadcast(sources) if len(totals) <= BROADCAST_SOURCES else sources
    placed = numbered(sized, ["_key"], ["_h", "doc_id", "row"], "size", seen["n"]).join(sources, "_key")
    o, end = F.col("before"), F.col("before") + F.col("size")
    met = F.transform(F.filter("segments", lambda s: (s["lo"] < end) & (s["hi"] > o)), lambda s: F.struct((F.greatest(s["lo"], o) - o).alias("from"), (F.least(s["hi"], end) - o).alias("to"), s["times"].alias("times")))
    placed = placed.withColumn("_met", met).withColumn("passes", F.coalesce(F.array_min(F.transform("_met", lambda s: s["times"])), F.lit(0)))
    again = lambda e: F.transform(F.filter("_met", lambda s: s["times"] - F.col("passes") > e), lambda s: F.struct(s["from"].alias("from"), s["to"].alias("to"), F.lit(e).alias("copy")))
    taken = F.aggregate("_met", F.lit(0).cast("long"), lambda a, s: a + (s["to"] - s["from"]) * s["times"])
    return placed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "passes", F.concat(*map(again, range(limit))).alias("cuts"), "row")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``, whatever their names: one row for each whole copy taken, and
    one with the words of the ranges taken once more, joined by one space. ``n_chars``, if there is such a column, becomes
    the new text's length. Documents of which nothing is taken go, null texts among them; of rows repeated with one id and
    equal texts each counts as a document, and any of them stands for the others' further columns."""
    i, h, p, c, w = fresh(docs, "id", "text_hash", "part", "copy", "words")
    parts = staged(mix(docs, id_col, text_col, **options).where("taken > 0").select(F.col("doc_id").alias(i), F.col("row").alias(h), F.struct("passes", "cuts").alias(p)))
    most = parts.groupBy(i, h).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most")).first()["most"]
    rows = docs.withColumn(h, F.xxhash64(text_col))
    if (most or 0) > 1:  # repeated rows: one of each meets the parts of all
        rows = rows.dropDuplicates([id_col, h])
    rows = rows.withColumnRenamed(h, f"{h}_2").join(parts, F.col(id_col).eqNullSafe(F.col(i)) & (F.col(f"{h}_2") == F.col(h)))
    cuts = f"{p}.cuts"
    words = F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0))
    some = lambda e: F.array_join(F.flatten(F.transform(F.filter(cuts, lambda x: x["copy"] == e), lambda x: F.slice(w, (x["from"] + 1).cast("int"), (x["to"] - x["from"]).cast("int")))), " ")
    extra = F.transform(F.array_distinct(F.transform(cuts, lambda x: x["copy"])), some)
    copies = F.concat(F.array_repeat(F.col(text_col), F.col(f"{p}.passes").cast("int")), extra)
    rows = rows.withColumn(w, F.when(F.size(cuts) > 0, words)).withColumn(c, F.explode(copies))
    new = {text_col: F.col(c), "n_chars": F.length(c).cast("long")}
    return rows.select(*[new[x].alias(x) if x in new else F.col(x) for x in docs.columns])


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")

"""The trie of conversation prefixes: a skeleton of splitter paths is shared, sorted shards finish all other nodes."""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmill.llm.common import WORD, staged, table

#: A turn in a path: 16 bytes of the SHA-256 of its role and text, then the words of its text in 8.
TURN = 24
#: Shards, and turns of a splitter path at most, which bound the skeleton: SHARDS * DEEP nodes.
SHARDS, DEEP = 256, 64
#: Paths looked at for each splitter, and ids whose digest is taken in one piece.
LOOKS, PIECE = 16, 5000
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, end binary"
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_of(role: Column, text: Column) -> Column:
    """A turn as 48 hexadecimal digits: equal if and only if role and text are (but for a collision of 128 bits of SHA-256)."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    return F.concat(F.upper(F.substring(digest, 1, 32)), F.lpad(F.hex(words), 16, "0"))


def conversation_paths(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turns`` (one string of ``turn_of`` each, in order): a row for each conversation.

    Turns are ordered by number, null first; turns of one number by role and then by digest. A null role or text is empty.
    Rows without a conversation are left out. Texts stay where they lie: of a turn only 48 digits move. A conversation's digits
    are held in one row, 48 bytes a turn."""
    lean = rows.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), F.struct(F.col(turn_col).isNotNull().alias("some"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), turn_of(F.col(role_col), F.col(text_col)).alias("t")).alias("x"))
    return lean.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("x")).select("conv_id", F.transform("x", lambda x: x["t"]).alias("turns"))


def rebuilt(paths: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """The paths whose first ``h`` turns are those of conversation ``c - c % every`` (all if it has fewer, none if it is
    absent), then the conversation's own after its first ``h``; ``h`` is the CRC-32 of the id modulo ``heads``."""
    base = paths.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("first"))
    own = paths.withColumns({"base": F.col("conv_id") - F.col("conv_id") % every, "h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")})
    first = F.slice(F.coalesce("first", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns") + 1)
    return own.join(base, "base", "left").select("conv_id", F.concat(first, rest).alias("turns"))


def ends_of(members: DataFrame) -> DataFrame:
    """``key, conv_id`` -> ``key, n, least, digest`` (SHA-256 of the ids, ascending, comma-joined).

    Ids are dealt out in order of key and id, so that a key with very many ids lies in many tasks; each joins runs of up
    to PIECE ids, and only these pieces of a key meet in one task, which streams them through the digest."""

    def pieces(batches):
        for b in batches:
            keys, ids = b["key"].to_pylist(), b["conv_id"].to_numpy()
            new = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or i % PIECE == 0), len(keys)]
            runs = [(i, j) for i, j in zip(new, new[1:], strict=False) if i < j]
            cols = [pa.array([keys[i] for i, _ in runs], pa.binary()), pa.array([ids[i] for i, _ in runs], pa.int64()), pa.array([j - i for i, j in runs], pa.int64()), pa.array([",".join(map(str, ids[i:j].tolist())) for i, j in runs], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["key", "first", "n", "ids"])

    cut = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(pieces, "key binary, first long, n long, ids string")
    cut = staged(cut)
    several = cut.groupBy("key").agg(F.count(F.lit(1)).alias("pieces"))
    cut = staged(cut.join(several, "key"))

    def streamed(batches):
        last, n, least, sha = None, 0, 0, None
        out: list[tuple] = []
        for b in batches:
            for key, first, more, ids in zip(*(b[c].to_pylist() for c in ("key", "first", "n", "ids")), strict=True):
                if key != last:
                    if last is not None:
                        out.append((last, n, least, sha.hexdigest()))
                    last, n, least, sha = key, 0, first, hashlib.sha256()
                sha.update(("," if n else "").encode() + ids.encode())
                n += more
            yield batch(out)
            out = []
        if last is not None:
            yield batch([(last, n, least, sha.hexdigest())])

    def batch(rows):
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [[]] * 4, kinds, strict=True)], ["key", "n", "least", "digest"])

    many = cut.where("pieces > 1").repartition("key").sortWithinPartitions("key", "first").mapInArrow(streamed, "key binary, n long, least long, digest string")
    return cut.where("pieces = 1").select("key", "n", F.col("first").alias("least"), F.sha2("ids", 256).alias("digest")).union(many)


def splitters_of(paths: DataFrame, shards: int, deep: int) -> list[bytes]:
    """At most ``shards - 1`` distinct paths, of ``deep`` turns at most, that deal the sorted paths evenly: quantiles of a
    sample by hash, about LOOKS paths for each. They decide where a path is worked on, never what comes out."""
    n = paths.count()
    if shards < 2 or n < 2:
        return []
    step = max(1, n // (shards * LOOKS))
    some = paths.where(F.pmod(F.xxhash64(F.lit(17), "path"), F.lit(step)) == 0).select(F.substring("path", 1, deep * TURN).alias("p"))
    rows = sorted(bytes(r["p"]) for r in some.limit(4 * shards * LOOKS).collect())  # a hash gives about shards * LOOKS
    return sorted({rows[len(rows) * i // shards] for i in range(1, shards)} - {b""}) if rows else []


def skeleton_of(splitters: list[bytes]) -> dict[bytes, int]:
    """All prefixes of the splitters, the root among them, numbered in sorted order (a parent before its children)."""
    nodes = {b""} | {s[:i] for s in splitters for i in range(TURN, len(s) + 1, TURN)}
    return {p: i for i, p in enumerate(sorted(nodes))}


class Node:
    """A node on the way to the path at hand: what is known of its subtree so far, and children that wait for its smallest member."""

    __slots__ = ("children", "convs", "end", "leaves", "least", "saved", "waiting", "words")

    def __init__(self, words: int):
        self.words, self.convs, self.least, self.children, self.leaves, self.saved, self.end, self.waiting = words, 0, None, 0, 0, 0, None, []


def finished(shard: Iterator[tuple[bytes, int, int, bytes]], skeleton: dict[bytes, int]):
    """Sorted distinct paths ``path, n, least, key`` of one shard -> rows ``(kind, skeleton number, node)``.

    ``kind`` 0: a finished node, its parent's skeleton number or -1; 1: what this shard adds to a skeleton node. A node
    outside the skeleton has all its members in one shard, since a splitter between two of them would bear its prefix."""
    way = [Node(0)]  # by depth; the root first
    at: bytes = b""
    marks = [skeleton[b""]]  # skeleton number of each node on the way, or -1

    def close():
        node, mark, depth = way.pop(), marks.pop(), len(way)
        rows = [(0, mark, (c[0], c[1], None if mark >= 0 else node.least, *c[2:])) for c in node.waiting]
        if mark >= 0:
            rows.append((1, mark, (node.least, depth, None, node.convs, node.children, node.leaves, node.saved, node.end)))
        else:
            node.leaves += not node.children
            node.saved += (node.convs - 1) * node.words
        if way:
            up = way[-1]
            up.convs += node.convs
            up.least = node.least if up.least is None else min(up.least, node.least)
            if mark < 0 or marks[-1] < 0:
                up.children += 1
                up.leaves += node.leaves
                up.saved += node.saved
            if mark < 0:
                up.waiting.append((node.least, depth, node.convs, node.children, node.leaves, node.saved, node.end))
                if marks[-1] >= 0 and len(up.waiting) >= 1000:  # children of a skeleton node need not wait
                    rows += [(0, marks[-1], (c[0], c[1], None, *c[2:])) for c in up.waiting]
                    up.waiting = []
        return rows

    for path, n, least, key in shard:
        same = min(len(at), len(path))
        if at[:same] != path[:same]:
            a, b = np.frombuffer(at[:same], np.uint8), np.frombuffer(path[:same], np.uint8)
            same = int((a != b).argmax())
        same //= TURN
        while len(way) > same + 1:
            yield from close()
        for i in range(same, len(path) // TURN):
            way.append(Node(int.from_bytes(path[i * TURN + 16 : (i + 1) * TURN], "big")))
            marks.append(skeleton.get(path[: (i + 1) * TURN], -1) if marks[-1] >= 0 else -1)
        top = way[-1]
        top.convs += n
        top.least = least if top.least is None else min(top.least, least)
        top.end = key
        at = path
    while way:
        yield from close()


def joined_up(partial: dict[int, list], skeleton: dict[bytes, int]) -> list[tuple]:
    """Sums of the shards' parts, by skeleton number -> ``(number, node)`` for each, children before parents: the reduction over the skeleton."""
    order = list(skeleton)
    total = {i: list(v) for i, v in partial.items()}
    for path in reversed(order):  # convs, children, leaves, saved of the subtree
        i = skeleton[path]
        node = total[i]
        words = int.from_bytes(path[-8:], "big") if path else 0
        node[3] += not node[2]
        node[4] += (node[1] - 1) * words
        if path:
            up = total[skeleton[path[:-TURN]]]
            up[2] += 1
            up[3] += node[3]
            up[4] += node[4]
    return [(i, total[i][0], len(p) // TURN, total[skeleton[p[:-TURN]]][0] if p else None, *total[i][1:]) for p, i in skeleton.items()]


def prefix_trie(paths: DataFrame, shards: int = SHARDS, deep: int = DEEP) -> DataFrame:
    """``conv_id, turns`` -> one row per node: ``conv_id`` (its smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.

    A node is a distinct sequence of first turns, from the root of none; its members are the conversations that start so. A
    conversation without turns belongs to the root. An empty table gives no rows, not even the root. Ids that repeat count
    as members each. ``turns`` are strings of ``turn_of``; other columns are not read.

    Equal paths become one row first, with their number and the digest of their ids. Sampled paths split the sorted rest
    into ``shards``; the trie of these splitters (``shards * deep`` nodes at most) is broadcast. Each shard is one sorted stream
    that holds the nodes on its way and their waiting children, and gives every node outside the skeleton whole. To the nodes of
    the skeleton it adds a part; the parts are summed, and the skeleton's subtrees by the driver."""
    spark = paths.sparkSession
    whole = paths.select("conv_id", F.unhex(F.array_join("turns", "")).alias("path"))
    whole = staged(whole.withColumn("key", F.unhex(F.sha2("path", 256))))
    ends = staged(ends_of(whole.select("key", "conv_id")))
    one = whole.join(ends.select("key", F.col("least").alias("conv_id"), "n"), ["key", "conv_id"]).dropDuplicates(["key"])
    distinct = staged(one.select("path", "n", F.col("conv_id").alias("least"), "key"))
    splitters = splitters_of(distinct, shards, deep)
    skeleton = skeleton_of(splitters)
    shared = spark.sparkContext.broadcast((splitters, skeleton))

    def dealt(batches):
        for b in batches:
            cut = shared.value[0]
            yield pa.RecordBatch.from_arrays([pa.array([bisect.bisect_right(cut, p) for p in b["path"].to_pylist()], pa.int64()), *b.columns], ["shard", *b.schema.names])

    def walk(batches):
        names = ["kind", "mark", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end"]
        kinds = [*[pa.int64()] * 9, pa.binary()]
        out: list[tuple] = []

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [[]] * 10, kinds, strict=True)], names)

        for own in streams(batches):
            for kind, mark, node in finished(own, shared.value[1]):
                out.append((kind, mark, *node))
                if len(out) >= 5000:
                    yield batch(out)
                    out = []
        yield batch(out)

    shards_of = distinct.mapInArrow(dealt, "shard long, path binary, n long, least long, key binary")
    nodes = shards_of.repartition("shard").sortWithinPartitions("shard", "path").mapInArrow(walk, f"kind long, mark long, {NODE}")
    nodes = staged(nodes)
    parts = nodes.where("kind = 1").groupBy("mark").agg(F.min("conv_id").alias("least"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("end").alias("end"))
    partial = {r["mark"]: list(r)[1:] for r in parts.collect()}  # a row for each skeleton node
    bones = joined_up(partial, skeleton) if partial else []
    bones = F.broadcast(spark.createDataFrame(bones, f"mark long, {NODE}"))
    leafy = nodes.where("kind = 0").join(bones.select("mark", F.col("conv_id").alias("up")), "mark", "left")
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "end"]
    leafy = leafy.select(*columns, F.coalesce("parent_conv_id", "up").alias("parent_conv_id"))
    both = leafy.unionByName(bones.select(*columns, "parent_conv_id"))
    digests = ends.select(F.col("key").alias("end"), "digest")
    out = both.join(digests, "end", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("digest", F.lit(EMPTY)).alias("ends_sha256"))


def streams(batches) -> Iterator[Iterator[tuple[bytes, int, int, bytes]]]:
    """Batches sorted by shard -> an iterator of rows for each shard; each must be used up before the next."""
    def rows():
        for b in batches:
            yield from zip(*(b[c].to_pylist() for c in ("shard", "path", "n", "least", "key")), strict=True)

    it = rows()
    held = next(it, None)

    def own(shard: int):
        nonlocal held
        while held is not None and held[0] == shard:
            yield held[1:]
            held = next(it, None)

    while held is not None:
        yield own(held[0])


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(conversation_paths(table(spark, sf_dir, "conversations"))))


#: CRC-32 of a string of single-byte characters, in SQL.
CRC = "xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::UBIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]), lambda x, i: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT)"
OP12_SQL = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, sha256(strlen(role) || ':' || role || text) AS k, len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(strlen(role) || ':' || role || text)) AS n FROM t),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, {CRC.format("conv_id::VARCHAR")} % 4 AS h FROM o),
r AS (SELECT c.conv_id, n, k, words FROM c JOIN o ON o.conv_id = base AND n <= h UNION ALL SELECT c.conv_id, n + 10, k, words FROM c JOIN o ON o.conv_id = c.conv_id AND n > h),
p AS (SELECT c.conv_id, coalesce(list(k ORDER BY n) FILTER (n IS NOT NULL), []) AS ks, coalesce(list(words ORDER BY n) FILTER (n IS NOT NULL), []) AS ws FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
m AS (SELECT conv_id, d, len(ks) AS long, array_to_string(ks[1:d], '') AS node, CASE WHEN d > 0 THEN array_to_string(ks[1:d - 1], '') END AS up, coalesce(ws[d], 0) AS words FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM p)),
g AS (SELECT node, up, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (long = d) AS ends FROM m GROUP BY node, up, d),
k AS (SELECT up, count(*) AS n_children FROM g WHERE up IS NOT NULL GROUP BY up),
s AS (SELECT left(g.node, 64 * a.i) AS node, count(*) FILTER (k.up IS NULL) AS n_leaves, sum(saved) AS saved_tokens FROM g LEFT JOIN k ON k.up = g.node, LATERAL (SELECT unnest(range(0, g.depth + 1)) AS i) a GROUP BY 1)
SELECT g.conv_id, g.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, g.n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(g.ends, '')) AS ends_sha256
FROM g LEFT JOIN g q ON q.node = g.up LEFT JOIN k ON k.up = g.node JOIN s ON s.node = g.node
"""

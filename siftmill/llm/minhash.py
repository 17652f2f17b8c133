"""MinHash near-deduplication with an LSH forest: several sorted orders of one signature."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftmill.llm.common import Forest, components, fresh, grouped, staged, table
from siftmill.llm.words import joined_words, places, runs_of, word_hashes

#: Signature values (a byte each), trees, and the least common prefix of neighbours. At similarity 0.85 a pair shares
#: four values in at least one of 16 trees but for about 8 in a million pairs.
VALUES, TREES, LEAST = 64, 16, 4
#: Of 64 values, so many agree in all but about 3 in a million pairs at similarity 0.85: fewer, and two neighbours are no candidates.
AGREE = 40
#: Documents compared with each other in one task at most. Larger regions are split where neighbours' prefixes are shortest.
BLOCK = 128
#: Up to so many blocks of leftovers, a cluster is compared block by block, so that each set is read at most 64 times or so; in a cluster of
#: 2,521 that is faster than a row for each shingle. Beyond, leftovers meet by the shingles that they share.
TURNS = 32
_RNG = np.random.default_rng(20240229)
_A = (_RNG.integers(0, 2**32, VALUES, dtype=np.uint64) | 1).astype(np.uint32)[:, None]
_B = _RNG.integers(0, 2**32, VALUES, dtype=np.uint64).astype(np.uint32)[:, None]


def shingles(text: str | None, width: int = 3) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; of the whole sequence if it is shorter; empty without words."""
    words = joined_words(text).lower()  # bytes: lower() changes A-Z alone
    starts, ends = places(words)
    h = word_hashes(words, starts, ends)
    for i in np.flatnonzero(ends - starts > 256).tolist():  # long words have hashes of their own
        h[i] = xxhash.xxh3_64_intdigest(words[starts[i] : ends[i]])
    width = min(width, len(h))
    return np.unique(runs_of(h, width)) if width else h


def signature(s: np.ndarray) -> bytes:
    """One byte for each hash function: the top bits, mixed, of the smallest value."""
    x = (s >> np.uint64(16)).astype(np.uint32)
    low = np.full((VALUES, 1), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 4096):
        low = np.minimum(low, (x[None, at : at + 4096] * _A + _B).min(1, keepdims=True))
    return (((low * np.uint32(0x9E3779B1)) ^ (low >> np.uint32(15))) >> np.uint32(24)).astype(np.uint8).tobytes()


def regions(paths: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of sorted ``paths`` whose neighbours share at least LEAST values; those above BLOCK go deeper, that is,
    are split at their shortest common prefix nearest the middle. A further range lies over each cut, so that what a
    cut parts meets there: equal paths would be cut at the same places in every tree."""
    if len(paths) < 2:
        return []
    same = paths[1:] == paths[:-1]
    lcp = np.where(same.all(1), paths.shape[1], same.argmin(1))
    edges = [0, *(np.flatnonzero(lcp < LEAST) + 1).tolist(), len(paths)]
    out, todo = [], [(a, b, a, b) for a, b in zip(edges, edges[1:], strict=False) if b - a > 1]
    while todo:
        a, b, first, last = todo.pop()
        if b - a <= BLOCK:
            if b - a > 1:
                out.append((a, b))
            continue
        third = (b - a) // 4
        inner = lcp[a + third : b - third - 1]
        low = np.flatnonzero(inner == inner.min())
        cut = a + third + 1 + int(low[np.abs(low - len(inner) // 2).argmin()])
        out.append((max(first, cut - BLOCK // 2), min(last, cut + BLOCK // 2)))
        todo += [(a, cut, first, last), (cut, b, first, last)]
    return out


def linked(near: np.ndarray) -> np.ndarray:
    """The smallest row that each row reaches, by a symmetric matrix of neighbours that holds the diagonal."""
    low = np.arange(len(near))
    while True:
        after = np.where(near, low, len(near)).min(1)
        after = after[after]
        if (after == low).all():
            return low
        low = after


def candidates(batches):
    """Sorted rows ``tree, path, key`` -> for every region the members with a neighbour in it: ``region, key, parent``.
    Two members are neighbours if enough of their whole signatures agree; parents join the neighbours of a table's regions."""

    def emit(turn: int, rows: pa.Table):
        paths = np.frombuffer(b"".join(rows["path"].to_pylist()), np.uint8).reshape(-1, VALUES)
        keys, tree = rows["key"].to_pylist(), rows["tree"][0].as_py()
        forest, met, least = Forest(len(keys)), [], list(keys)
        for a, b in regions(paths):
            near = (paths[a:b, None] == paths[None, a:b]).sum(2) >= AGREE
            if near.sum() == b - a:
                continue
            for i, j in enumerate(linked(near).tolist()):
                forest.join(a + i, a + j)
            place = b"".join(x.to_bytes(8, "little", signed=True) for x in (keys[a], b - a, turn))
            name = xxhash.xxh3_64_intdigest(bytes([tree]) + paths[a].tobytes() + place) >> 1
            met += [(name, a + i) for i in np.flatnonzero(near.sum(1) > 1).tolist()]
        for _, i in met:  # the parent is the smallest key: it is the same in most trees, and edges that repeat are one
            r = forest.root(i)
            least[r] = min(least[r], keys[i])
        out = [(name, keys[i], least[forest.root(i)]) for name, i in met]
        cols = list(zip(*out, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["region", "key", "parent"])

    for turn, g in enumerate(runs(batches)):
        yield emit(turn, g)


def runs(batches, most: int = 50_000):
    """Tables of whole regions of one tree: a table ends where the tree or the first LEAST values change. One ends at ``most``
    rows if nothing changes; the next then begins with its last rows, so that both meet in these."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t]).combine_chunks()
        while held.num_rows > most:
            marks = list(zip(held["tree"].to_pylist(), (p[:LEAST] for p in held["path"].to_pylist()), strict=True))
            at = next((i for i in range(most, 0, -1) if marks[i] != marks[i - 1]), None)
            yield from by_tree(held.slice(0, at or most))
            held = held.slice(at or most - min(BLOCK, most // 2))
    if held is not None and held.num_rows:
        yield from by_tree(held)


def by_tree(t: pa.Table):
    trees = np.asarray(t["tree"])
    cuts = [0, *(np.flatnonzero(trees[1:] != trees[:-1]) + 1).tolist(), len(trees)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield t.slice(a, b - a)


def verified(num: int, den: int):
    """Groups ``gid, key, s`` (sorted shingles) -> a spanning forest ``a, b`` of the pairs with intersection / union >= num / den, each proven on full sets."""

    def run(batches):
        for g in grouped(batches, "gid"):
            keys, sets = g["key"].to_pylist(), [np.frombuffer(x, np.uint64) for x in g["s"].to_pylist()]
            common = intersections(sets)
            sizes = np.array([len(s) for s in sets])
            union = sizes[:, None] + sizes[None] - common
            linked = np.triu(den * common >= num * union, 1)
            forest = Forest(len(keys))
            out = [(keys[i], keys[j]) for i, j in zip(*(k.tolist() for k in np.nonzero(linked)), strict=True) if forest.join(i, j)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])

    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections: products of the incidence matrix, a slab of shingles at a time. Shingles of
    one set only are left out."""
    m = len(sets)
    if m == 2:
        n = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), n], [n, len(sets[1])]])
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    kept = n[at] > 1
    place = np.cumsum(n > 1) - 1
    cols, rows = place[at[kept]], owner[kept]
    order = np.argsort(cols, kind="stable")
    cols, rows = cols[order], rows[order]
    out, slab = np.zeros((m, m), np.float64), 8192
    for lo in range(0, int(cols[-1]) + 1 if len(cols) else 0, slab):
        a, b = np.searchsorted(cols, [lo, lo + slab])
        x = np.zeros((m, slab), np.float32)
        x[rows[a:b], cols[a:b] - lo] = 1
        out += x @ x.T
    out[np.diag_indices(m)] = [len(s) for s in sets]
    return np.rint(out).astype(np.int64)


def sharing(placed: DataFrame, whole: DataFrame, num: int, den: int) -> DataFrame:
    """Members ``component, key, rest`` with their sets ``key, s`` -> groups ``component, token, level, key, rest`` such that
    every pair of a component with a rest member in it and intersection / union >= num / den meets in a group.

    Prefix bounds: shingles are ordered by their number of rest members, rarest first. Such a pair shares one of the first
    ``n - ceil(n * num / den) + 1`` of either set, and its sizes lie on one level or two that follow each other. So members
    that have only frequent shingles in common, such as a template, meet nowhere. Shingles that the same members share
    give one group."""

    def tokens(batches):
        for b in batches:
            sets = [np.frombuffer(s, np.int64) for s in b["s"].to_pylist()]
            sizes = np.array([len(s) for s in sets], np.int64)
            for i, one in enumerate(sets):
                for at in range(0, len(one), 100_000):
                    part = one[at : at + 100_000]
                    own = [pa.array(np.full(len(part), b[c][i].as_py())) for c in ("component", "key", "rest")]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(np.full(len(part), sizes[i])), pa.array(part)], ["component", "key", "rest", "n", "token"])

    all_tokens = staged(placed.join(whole, "key").mapInArrow(tokens, "component long, key long, rest boolean, n long, token long"))
    seen = staged(all_tokens.where("rest").groupBy("component", "token").agg(F.count(F.lit(1)).alias("c")))
    own = Window.partitionBy("component", "key")
    ranked = all_tokens.join(seen, ["component", "token"]).withColumns({"nth": F.row_number().over(own.orderBy("c", "token")), "k": F.count(F.lit(1)).over(own)})
    first = F.col("n") - F.expr(f"(n * {num} + {den - 1}) div {den}") + 1
    level = F.floor(F.log(F.col("n")) / (np.log(den / num) * 1.001))
    prefix = ranked.where(F.col("nth") + F.col("n") - F.col("k") <= first)
    prefix = staged(prefix.select("component", "token", F.explode(F.array(level, level + 1)).alias("level"), "key", "rest"))
    by = ["component", "token", "level"]
    same = [F.count(F.lit(1)).alias("all_n"), F.sum(F.col("rest").cast("long")).alias("rest_n"), F.bit_xor(F.xxhash64("key")).alias("x"), F.sum(F.shiftright(F.xxhash64(F.lit(1), "key"), 32)).alias("y")]
    groups = prefix.groupBy(*by).agg(*same).where("all_n > 1 AND rest_n > 0")
    groups = groups.groupBy("component", "all_n", "rest_n", "x", "y").agg(F.min(F.struct("token", "level")).alias("o"))
    return prefix.join(staged(groups.select("component", "o.token", "o.level", "all_n", "rest_n")), by)


def blocks_of(groups: DataFrame) -> DataFrame:
    """Groups of ``sharing`` -> parts ``component, token, level, i, j, main, key`` to compare: each whole if it has at most
    BLOCK members; else every block of rest members with every other block."""
    blocks = lambda n: F.ceil(n / BLOCK).cast("long")
    rest_n, main_n = F.col("rest_n"), F.col("all_n") - F.col("rest_n")
    part = lambda i, j, main: F.struct(i.cast("long").alias("i"), j.cast("long").alias("j"), F.lit(main).alias("main"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), blocks(n) - 1)
    mine = F.pmod(F.xxhash64("key"), F.when(F.col("rest"), blocks(rest_n)).otherwise(blocks(main_n)))
    with_rest = F.transform(upto(rest_n), lambda i: F.when(F.col("rest"), part(F.least(mine, i), F.greatest(mine, i), 0)).otherwise(part(i, mine, 1)))
    with_main = F.when(main_n > 0, F.transform(upto(main_n), lambda j: part(mine, j, 1))).otherwise(F.array().cast("array<struct<i:bigint,j:bigint,main:int>>"))
    parts = F.when(F.col("all_n") <= BLOCK, F.array(part(F.lit(0), F.lit(0), 0))).when(F.col("rest"), F.concat(with_rest, with_main)).otherwise(with_rest)
    return groups.select("component", "token", "level", "key", F.explode(parts).alias("p")).select("component", "token", "level", "p.i", "p.j", "p.main", "key").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 85, den: int = 100, width: int = 3) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when ``den * intersection >= num * union`` of their sets of ``width``-word shingles. A null
    text, or one without words, has the empty set and links with nothing. Rows repeated with one id, and rows with a
    null id, are kept apart as far as their texts differ; a null id never names a component that has another id. An
    empty table gives no rows; other columns are not read.

    Equal sets become one class first. Classes are sorted by 16 rotations of their signatures; neighbours with a long
    common prefix whose signatures agree are candidates, and chains of candidates make clusters. A cluster of at most
    BLOCK classes is compared in one task, pair by pair on the full sets. A larger one is first compared in its forest
    regions; then what that leaves outside the cluster's main component is compared with all of the cluster, block by
    block, or, if it is more than TURNS blocks, with those that share rare shingles with it, as prefix bounds allow. So no task grows with a group, and what leaves a task is a spanning forest, not all pairs."""

    def sign(batches):
        for b in batches:
            sets = [shingles(t, width) for t in b["text"].to_pylist()]
            sigs = [signature(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(map(set_key, sets), pa.int64()), pa.array(sigs, pa.binary())], ["doc_id", "n", "key", "sig"])

    def sets(batches):
        for b in batches:
            own = [shingles(t, width) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(map(set_key, own), pa.int64()), pa.array([s.tobytes() for s in own], pa.binary())], ["key", "s"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = staged(rows.mapInArrow(sign, "doc_id long, n long, key long, sig binary"))
    classes = staged(signed.where("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key", "sig").agg(F.min("doc_id").alias("rep")))

    turn = lambda t: F.concat(F.expr(f"substring(sig, {t * LEAST + 1})"), F.expr(f"substring(sig, 1, {t * LEAST})"))
    orders = F.explode(F.array(*[F.struct(F.lit(t).alias("tree"), turn(t).alias("path")) for t in range(TREES)]))
    forest = classes.select(orders.alias("o"), "key").select("o.tree", "o.path", "key")
    forest = forest.repartitionByRange("tree", "path").sortWithinPartitions("tree", "path", "key")
    met = staged(forest.mapInArrow(candidates, "region long, key long, parent long"))
    clusters = staged(components(met.where("key != parent").select(F.col("key").alias("a"), F.col("parent").alias("b"))))
    large = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > BLOCK)
    clusters = staged(clusters.join(staged(large), "component", "left").withColumnRenamed("node", "key"))
    wanted = staged(classes.join(clusters, "key", "left_semi").select(F.col("rep").alias("doc_id")).distinct())
    whole = staged(rows.join(wanted, "doc_id", "left_semi").mapInArrow(sets, "key long, s binary").dropDuplicates(["key"]))

    def compare(groups: DataFrame) -> DataFrame:
        load = groups.select(F.xxhash64(*[c for c in groups.columns if c != "key"]).alias("gid"), "key").join(whole, "key")
        return load.repartition("gid").sortWithinPartitions("gid", "key").mapInArrow(verified(num, den), "a long, b long")

    small = clusters.where("m IS NULL").select(F.lit(0).alias("kind"), F.col("component").alias("gid"), "key")
    parts = met.join(clusters.where("m IS NOT NULL").select("key"), "key", "left_semi").select(F.lit(1), "region", "key")
    links = staged(compare(staged(small.union(parts))))
    found = staged(components(links))

    members = clusters.where("m IS NOT NULL").join(found.withColumnRenamed("component", "found").withColumnRenamed("node", "key"), "key", "left")
    members = staged(members.select("component", "key", F.coalesce("found", "key").alias("found")))
    tally = members.groupBy("component", "found").agg(F.count(F.lit(1)).alias("n"))
    sums = [F.max_by("found", "n").alias("main"), F.sum("n").alias("all_n"), (F.sum("n") - F.max("n")).alias("rest_n")]
    main = staged(tally.groupBy("component").agg(*sums).where("rest_n > 0"))
    placed = staged(members.join(main, "component").select("component", "key", (F.col("found") != F.col("main")).alias("rest"), "all_n", "rest_n"))
    few = placed.where(F.col("rest_n") <= TURNS * BLOCK).select("component", F.lit(0).cast("long").alias("token"), F.lit(0).cast("long").alias("level"), "key", "rest", "all_n", "rest_n")
    many = sharing(placed.where(F.col("rest_n") > TURNS * BLOCK).select("component", "key", "rest"), whole, num, den)
    spread = blocks_of(few.unionByName(many))
    again, seen = staged(compare(spread), F.count(F.lit(1)).alias("n"))
    if seen["n"]:
        found = staged(components(links.union(again)))

    ids = classes.join(found.withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("component", "key").alias("component"), "rep")
    least = staged(ids.groupBy("component").agg(F.min("rep").alias("component_id")))
    named = staged(ids.join(least, "component").select("key", "component_id"))
    component = F.coalesce("component_id", "doc_id")
    out = signed.select("doc_id", "n", "key").join(named, "key", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whatever their names, whose id names their component; rows that share such an id
    stay together. Null texts and texts without words all stay; texts of any length are compared whole."""
    (i,) = fresh(docs, "id")
    kept = staged(near_duplicates(docs, id_col, text_col, **options).where("kept").select(F.col("doc_id").alias(i)).distinct())
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col(i)), "left_semi")


def set_key(s: np.ndarray) -> int | None:
    """A 64-bit name of a shingle set; none for the empty one."""
    return int.from_bytes(xxhash.xxh3_64_digest(s.tobytes()), "little", signed=True) if len(s) else None


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(3, len(ws)) - 1], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

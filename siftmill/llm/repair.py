"""Repair of conversations: the cheapest edits by Hirschberg's division, with four states of the role grammar."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftmill.llm.common import positions, staged, table
from siftmill.llm.trie import CRC

#: Rows of a conversation in one block. A longer one is first joined up from its blocks' tables, then solved block by block.
BLOCK = 4096
#: Faults of a row, in order of precedence, and their letters: 4 * initial + fault, from A.
FAULTS = ("none", "blank", "duplicate", "truncated")
INITIALS = "sua"
END = "$"
#: Grammar (s?(ua)+)?: 0 nothing yet, 1 after s, 2 after u, 3 after a. It may end in 0 or 3.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPT = (0, 3)
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1


def inserted(s: int) -> dict[int, str]:
    """States that inserts alone reach from ``s``, with the roles inserted; fewest first."""
    out, added = {s: ""}, ""
    while (c := next((c for c in "ua" if (s, c) in STEP), "")) and STEP[s, c] not in out:
        s, added = STEP[s, c], added + c
        out[s] = added
    return out


def options(letter: str) -> list[list[tuple[int, int, str, str]]]:
    """For each state before a row of this kind: ``(state after, cost, audit, edits)``, the least by cost and audit for each state after.
    Inserts come before the row that they precede, so audits up to a row are never prefixes of each other. ``edits`` names
    the roles: u, a inserted, U, A changed to, K kept, D deleted."""
    out = []
    for s in range(4):
        best: dict[int, tuple[int, str, str]] = {}

        def offer(x: int, cost: int, audit: str, edits: str, best=best):
            best[x] = min(best.get(x, (10**9, "", "")), (cost, audit, edits))

        for x, added in inserted(s).items():
            before, cost = "I" * len(added), INSERT * len(added)
            if letter == END:
                if x in ACCEPT:
                    offer(0, cost, before, added)
                continue
            initial, fault = (*INITIALS, "")[(ord(letter) - 65) // 4], FAULTS[(ord(letter) - 65) % 4]
            offer(x, cost + DELETE, before + "D", added + "D")
            if fault in ("none", "truncated"):
                cost += TRUNCATED * (fault == "truncated")
                for c, more, a, e in ((initial, 0, "K", "K"), ("u", REROLE, "R", "U"), ("a", REROLE, "R", "A")):
                    if (x, c) in STEP:
                        offer(STEP[x, c], cost + more, before + a, added + e)
        out.append([(x, *v) for x, v in sorted(best.items())])
    return out


TABLE = {c: options(c) for c in [*map(chr, range(65, 81)), END]}
#: ``(state after, cost, audit)`` without the edits: what the vectors are made of.
MOVES = {c: [[m[:3] for m in t] for t in rows] for c, rows in TABLE.items()}


def ranked(best: dict) -> dict:
    """State -> ``(cost, name)`` becomes state -> ``(cost, rank)``: equal names, equal ranks, in order of the names."""
    rank = {k: i for i, k in enumerate(sorted({v[1] for v in best.values()}))}
    return {s: (cost, rank[name]) for s, (cost, name) in best.items()}


def forward(steps, vector: dict) -> dict:
    """Least costs of states after the steps, and the ranks of their least audits. A key's last part is its state."""
    for moves in steps:
        best: dict = {}
        for (start, s), (cost, rank) in vector.items():
            for x, more, t in moves[s]:
                new = (cost + more, (rank, t))
                if (start, x) not in best or new < best[start, x]:
                    best[start, x] = new
        vector = ranked(best)
    return vector


def backward(steps, vector: dict) -> dict:
    """Least costs from each state over the steps to the end, and the ranks of the audits that follow."""
    for moves in reversed(steps):
        best: dict = {}
        for s in range(4):
            for x, more, t in moves[s]:
                if x in vector:
                    new = (more + vector[x][0], (t, vector[x][1]))
                    if s not in best or new < best[s]:
                        best[s] = new
        vector = ranked(best)
    return vector


def crossings(steps: list, p: int, q: int) -> list[int]:
    """The states between the steps of the cheapest way from ``p`` to ``q``, of ways of one cost the one with the least audit.

    Both halves' vectors meet in the middle: the least total decides, then the rank of the audit before, then of the one
    after (audits up to a row are prefix-free, so the whole audits compare so). Then each half is divided in turn; besides
    the states found, only two vectors are held at a time."""
    found = [p] * len(steps) + [q]
    todo = [(0, len(steps))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        f = forward(steps[lo:mid], {(0, found[lo]): (0, 0)})
        b = backward(steps[mid:hi], {found[hi]: (0, 0)})
        found[mid] = min((cost + b[s][0], rank, b[s][1], s) for (_, s), (cost, rank) in f.items() if s in b)[3]
        todo += [(lo, mid), (mid, hi)]
    return found


def edits_of(letters: str, p: int, q: int) -> tuple[int, str]:
    """Cost and edits of the cheapest way through rows of these kinds."""
    way = crossings([MOVES[c] for c in letters], p, q)
    chosen = [next(m for m in TABLE[c][s] if m[0] == x) for c, s, x in zip(letters, way, way[1:], strict=False)]
    return sum(m[1] for m in chosen), "".join(m[3] for m in chosen)


@lru_cache(100_000)
def short_edits(letters: str, p: int, q: int) -> tuple[int, str]:
    """The same, remembered: short conversations of the same kinds of rows come again and again."""
    return edits_of(letters, p, q)


def block_table(letters: str) -> list[list[int]]:
    """What a block costs from each state to each: rows ``[before, after, cost, rank of its audit among all of the block]``."""
    out = forward([MOVES[c] for c in letters], {(s, s): (0, 0) for s in range(4)})
    return [[s, x, cost, rank] for (s, x), (cost, rank) in sorted(out.items())]


def between(tables: list[list[list[int]]]) -> list[int]:
    """The states between blocks, from their tables, by the same division."""
    steps = [[[(x, cost, rank) for before, x, cost, rank in t if before == s] for s in range(4)] for t in tables]
    return crossings(steps, 0, 0)


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` of the rows with faults put in by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1
    empties its text, 2 takes its ``.!?``, 3 repeats it, 4 makes its role ``user``. A null turn, role or text is one space
    (the turn itself stays null). Rows without a conversation are left out."""
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    turn = F.coalesce(F.col(turn_col).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(F.col(conv_col).cast("string"), F.lit(":"), turn).cast("binary")) % 20
    own = rows.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"), fault.alias("f"))
    text = F.when(F.col("f") == 1, "").when(F.col("f") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("f") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("f") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return own.where("f != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_copy")).drop("_copy")


def digest_of() -> Column:
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def judged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` -> ``conv_id, turn, n`` (place in the conversation, by turn, nulls first, then role and a digest of role
    and text) and ``letter`` (its initial and first fault). Texts stay where they lie: their last sign and digest go along."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    own = F.when(last == "", 1).when(~last.isin(".", "!", "?"), 3).otherwise(0)
    lean = rows.select("conv_id", "turn", "role", digest_of().alias("digest"), own.alias("own"))
    at = staged(positions(lean, ["conv_id"], ["turn", "role", "digest"]))
    again = at.where("own != 1").groupBy("conv_id", "digest").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    fault = F.when((F.col("own") != 1) & (F.col("n") > F.col("first")), 2).otherwise(F.col("own"))
    c = F.substring("role", 1, 1)
    initial = F.when(c == "s", 0).when(c == "u", 1).when(c == "a", 2).otherwise(3)
    return at.join(staged(again), ["conv_id", "digest"], "left").select("conv_id", "turn", "n", F.chr(65 + initial * 4 + fault).alias("letter"))


def repaired(rows: DataFrame, ids: DataFrame, block: int = BLOCK, keep: bool = False) -> DataFrame:
    """One row per conversation of ``ids``: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``rows`` are ``conv_id, turn, role, text``, ordered by turn, nulls first. A row's first fault counts: blank, duplicate (role and
    text seen earlier), truncated (ends without ``.!?``). Repairs keep (0), change the role (2), delete (3; blank and
    duplicate rows must go) and insert empty rows (2), with 1 more for a truncated row that stays, until the initials read
    ``(s?(ua)+)?``; of the cheapest, the one with the least audit. ``gaps``: turns missing between the least and the greatest.
    A conversation without rows has zeros, an empty audit and the digest of nothing. Rows that repeat are duplicates, texts of any
    length are read whole, an empty ``ids`` gives no rows.

    Places, faults and counts are computed in the DataFrame, so a conversation of any length is dealt to many tasks. Rows become
    letters; up to ``block`` of them are solved at once. A longer conversation is joined up from its blocks' four-by-four tables (costs, and ranks
    of audits), which fixes the states between blocks; then each block is solved alone. The digest streams the rows of a
    conversation, one at a time, beside its edits: the one place where texts are shuffled."""
    marked = staged(judged(rows))
    size = F.lit(block).cast("long")
    parts = marked.groupBy("conv_id", F.floor(F.col("n") / size).cast("long").alias("block")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "letter"))), lambda x: x["letter"]), "").alias("letters"))
    last = marked.groupBy("conv_id").agg(F.floor(F.max("n") / size).cast("long").alias("last"))
    parts = staged(parts.join(last, "conv_id").withColumn("letters", F.when(F.col("block") == F.col("last"), F.concat("letters", F.lit(END))).otherwise(F.col("letters"))))

    def tables(batches):
        kind = pa.list_(pa.list_(pa.int64()))
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["conv_id"], b["block"], pa.array(map(block_table, b["letters"].to_pylist()), kind)], ["conv_id", "block", "t"])

    def meet(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["conv_id"], pa.array([between(t) for t in b["ts"].to_pylist()], pa.list_(pa.int64()))], ["conv_id", "states"])

    long_ones = parts.where("last > 0").mapInArrow(tables, "conv_id long, block long, t array<array<long>>")
    long_ones = long_ones.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("block", "t"))), lambda x: x["t"]).alias("ts"))
    states = staged(long_ones.mapInArrow(meet, "conv_id long, states array<long>"))
    ends = states.select("conv_id", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("states") - 1), lambda i: F.struct(F.element_at("states", i).alias("p"), F.element_at("states", i + 1).alias("q")))).alias("block", "s"))
    ends = ends.select("conv_id", F.col("block").cast("long").alias("block"), "s.p", "s.q")

    def solve(batches):
        names = ["conv_id", "block", "cost", "edits"]
        for b in batches:
            found = [(short_edits if len(x) <= 16 else edits_of)(x, p, q) for x, p, q in zip(*(b[c].to_pylist() for c in ("letters", "p", "q")), strict=True)]
            yield pa.RecordBatch.from_arrays([b["conv_id"], b["block"], pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())], names)

    to_solve = parts.join(ends, ["conv_id", "block"], "left").select("conv_id", "block", "letters", F.coalesce("p", F.lit(0)).cast("long").alias("p"), F.coalesce("q", F.lit(0)).cast("long").alias("q"))
    solved = staged(to_solve.mapInArrow(solve, "conv_id long, block long, cost long, edits string"))

    def digest(batches):
        names = ["conv_id", "repaired_sha256"]
        conv, sha, edits, at, some = None, None, "", 0, False
        roles = {"u": "user", "a": "assistant", "U": "user", "A": "assistant"}

        def say(role: str, text: str):
            nonlocal some
            sha.update((("\n" if some else "") + role + ":" + text).encode())
            some = True

        def inserts():
            nonlocal at
            while at < len(edits) and edits[at] in "ua":
                say(roles[edits[at]], "")
                at += 1

        for b in batches:
            done = []
            for c, own, role, text in zip(*(b[x].to_pylist() for x in ("conv_id", "edits", "role", "text")), strict=True):
                if own is not None:  # edits of a block; all of a conversation's come before its rows
                    if c != conv:
                        if conv is not None:
                            inserts()
                            done.append((conv, sha.hexdigest()))
                        conv, sha, edits, at, some = c, hashlib.sha256(), "", 0, False
                    edits += own
                    continue
                inserts()
                edit = edits[at]
                at += 1
                if edit != "D":
                    say(roles.get(edit, role), text)
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names)
        if conv is not None:
            inserts()
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([sha.hexdigest()], pa.string())], names)

    null = lambda c: F.lit(None).cast(rows.schema[c].dataType).alias(c)
    heads = solved.select("conv_id", F.lit(0).alias("kind"), "block", null("turn"), null("role"), F.lit(None).cast("binary").alias("digest"), "edits", null("text"))
    texts = rows.select("conv_id", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("block"), "turn", "role", digest_of().alias("digest"), F.lit(None).cast("string").alias("edits"), "text")
    by = ["conv_id", "kind", "block", "turn", "role", "digest"]
    shas = heads.union(texts).repartition("conv_id").sortWithinPartitions(*by).select("conv_id", "edits", "role", "text").mapInArrow(digest, "conv_id long, repaired_sha256 string")

    # counts: of a block's letters, and of what meets between blocks
    initial = lambda x: F.translate(x, "ABCDEFGHIJKLMNOP", "ssssuuuuaaaaoooo")
    joined = F.concat(F.coalesce(F.lag(F.substring(F.replace("letters", F.lit(END), F.lit("")), -1, 1)).over(Window.partitionBy("conv_id").orderBy("block")), F.lit("")), F.replace("letters", F.lit(END), F.lit("")))
    pairs = parts.select("conv_id", initial(joined).alias("i"), "letters", F.length(joined).alias("len"))
    fine = sum(F.regexp_count("i", F.lit(x)) for x in ("su", "ua", "au"))
    of_kind = lambda k: F.sum(F.regexp_count("letters", F.lit(f"[{''.join(chr(65 + 4 * i + k) for i in range(4))}]"))).cast("long")
    counts = pairs.groupBy("conv_id").agg(*[of_kind(k).alias(FAULTS[k]) for k in (1, 2, 3)], F.sum(F.col("len") - 1 - fine).cast("long").alias("illegal"))
    spans = marked.where("turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).cast("long").alias("gaps"))
    audits = solved.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.translate(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "edits"))), lambda x: x["edits"]), ""), "uaUA", "IIRR").alias("audit"))
    out = ids.select("conv_id").distinct()
    for found in (spans, counts, audits, shas):
        out = out.join(staged(found), "conv_id", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repaired(damaged(rows), rows.where("conv_id IS NOT NULL").select("conv_id"))


OP13_SQL = rf"""
WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {CRC.format("(conv_id || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS f FROM conversations WHERE conv_id IS NOT NULL),
d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE f WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM o WHERE f <> 0),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(strlen(role) || ':' || role || text)) AS n, left(role, 1) AS c, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS z FROM d),
r AS (SELECT *, CASE WHEN z = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'd' WHEN z NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault, lag(c) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM e),
step(s, c, x) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins(s, x, added) AS (VALUES (0, 0, []), (0, 2, ['user:']), (0, 3, ['user:', 'assistant:']), (1, 1, []), (1, 2, ['user:']), (1, 3, ['user:', 'assistant:']), (2, 2, []), (2, 3, ['assistant:']), (3, 3, []), (3, 2, ['user:'])),
moves AS (SELECT conv_id, n, ins.s, ins.x AS x, 3 + 2 * len(added) AS cost, repeat('I', len(added)) || 'D' AS audit, added FROM r, ins
  UNION ALL SELECT conv_id, n, ins.s, step.x, 2 * len(added) + (fault = 't')::INT, repeat('I', len(added)) || 'K', list_append(added, role || ':' || text) FROM r, ins JOIN step ON step.s = ins.x WHERE step.c = r.c AND fault NOT IN ('b', 'd')
  UNION ALL SELECT conv_id, n, ins.s, step.x, 2 + 2 * len(added) + (fault = 't')::INT, repeat('I', len(added)) || 'R', list_append(added, CASE step.c WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text) FROM r, ins JOIN step ON step.s = ins.x AND step.c <> 's' WHERE fault NOT IN ('b', 'd')),
way AS (SELECT conv_id, max(n) + 1 AS n, s, min({{'cost': 2 * len(added), 'audit': repeat('I', len(added)), 'out': added}}) AS b FROM r, ins WHERE x IN (0, 3) GROUP BY conv_id, s
  UNION ALL SELECT w.conv_id, w.n - 1, m.s, min({{'cost': m.cost + w.b.cost, 'audit': m.audit || w.b.audit, 'out': list_concat(m.added, w.b.out)}}) FROM way w JOIN moves m ON m.conv_id = w.conv_id AND m.n = w.n - 1 AND m.x = w.s GROUP BY w.conv_id, w.n, m.s),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.cost, 0)::BIGINT AS cost, coalesce(b.audit, '') AS audit, sha256(coalesce(array_to_string(b.out, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM o) i LEFT JOIN c ON c.conv_id = i.conv_id LEFT JOIN way w ON w.conv_id = i.conv_id AND w.n = 1 AND w.s = 0
"""

"""Benchmark decontamination: one Aho-Corasick automaton over normalised items, each text scanned once."""

from __future__ import annotations

import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmill.llm.common import LOWER, UPPER, staged, table

#: Words of an item in one window; an item of fewer words is one window.
WINDOW = 10
#: Bytes of windows and item numbers in one automaton, at most (a node takes about 50 bytes). A larger benchmark is dealt to several.
MOST_BYTES = 4_000_000
#: Bytes of UTF-8 as they count: A-Z become a-z, digits, letters and all bytes above 0x7F stay, all else parts words. Places don't move.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
SPANS = "array<struct<first:bigint,after:bigint,start:bigint,end:bigint>>"


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(FOLD).split()


def windows_of(words: list[bytes], size: int) -> list[bytes]:
    """Runs of ``size`` words, each between spaces; the whole sequence if it is shorter."""
    size = min(size, len(words))
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(len(words) - size + 1)] if size else []


class Scanner:
    """An automaton of windows, with the number of words and the items of each."""

    def __init__(self, windows: list[bytes], items: list[list[str]]):
        self.items = items
        self.sizes = np.array([w.count(b" ") - 1 for w in windows], np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, w in enumerate(windows):
            self.automaton.add_word(w.decode("latin-1"), i)  # a byte is a letter: UTF-8 matches where its bytes do
        self.automaton.make_automaton()

    def scan(self, raw: bytes | None) -> tuple[int, list[dict], list[str]]:
        """Number of words, maximal runs of hit words with their places in the text (characters), and the items met."""
        words = words_of(raw)
        joined = b" " + b" ".join(words) + b" "
        found = list(self.automaton.iter(joined.decode("latin-1"))) if words and len(self.items) else []
        if not found:
            return len(words), [], []
        at, which = np.array(found, np.int64).T
        after = np.searchsorted(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), at)  # the space that ends a window follows so many words
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, after - self.sizes[which], 1)
        np.add.at(change, after, -1)
        edges = np.diff(np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]]).astype(np.int8))
        runs = np.stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)], 1)
        items = sorted({x for i in np.unique(which).tolist() for x in self.items[i]})
        return len(words), placed(raw, runs), items


def placed(raw: bytes, runs: np.ndarray) -> list[dict]:
    """Runs of words -> also the characters that they take in the text as it was."""
    inside = np.concatenate([[0], np.frombuffer(raw.translate(FOLD), np.uint8) != 32, [0]]).astype(np.int8)
    edges = np.diff(inside)
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [{"first": a, "after": b, "start": int(chars[begins[a]]), "end": int(chars[ends[b - 1]])} for a, b in runs.tolist()]


#: The scanner that this Python worker built last, by its name.
_BUILT: dict[str, Scanner] = {}


def scanner(name: str, windows: list[bytes], items: list[list[str]]) -> Scanner:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Scanner(windows, items)
    return _BUILT[name]


def passages(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> tuple[DataFrame, int]:
    """``w`` (a window), ``item``: staged, each once; and their bytes."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("raw"))

    def cut(batches):
        for b in batches:
            for item, raw in zip(b["item"].to_pylist(), b["raw"].to_pylist(), strict=True):
                own = windows_of(words_of(raw), window)
                for i in range(0, len(own), 5000):
                    part = own[i : i + 5000]
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([item] * len(part), pa.string())], ["w", "item"])

    found, seen = staged(rows.mapInArrow(cut, "w binary, item string").distinct(), F.coalesce(F.sum(F.octet_length("w") + F.coalesce(F.octet_length("item"), F.lit(0)) + 8), F.lit(0)).alias("size"))
    return found, seen["size"]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, most_bytes: int = MOST_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_words, spans, items``.

    Words are runs of digits, letters a-z after lower-casing A-Z, and characters above 0x7F. ``spans`` are the maximal runs
    of words inside occurrences of windows of items: words ``first`` to before ``after``, which are the characters ``start``
    to before ``end`` of the text as it was. ``items`` are the ids (as strings, sorted, each once) of items with occurring
    windows. A null text has no words; an item without words has no windows; an item without an id marks words but is not
    listed. Rows of documents that repeat are rows of their own, rows of items that repeat count once. Texts of any length
    are scanned whole. An empty benchmark hits nothing, an empty table gives no rows. Other columns are not read.

    The windows lie in one automaton, which is sent to all tasks, so documents are scanned where they lie, without a
    shuffle. A benchmark above ``most_bytes`` is dealt to several automata by a hash of the window; then documents get row
    numbers, each automaton has a pass of its own, and only rows with hits are joined."""
    spark = docs.sparkSession
    found, size = passages(benchmark, item_col, item_text_col, window)
    parts = max(1, -(-size // most_bytes))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("raw"))

    def scanned(rows: DataFrame, part: int) -> DataFrame:
        mine = found.where(F.pmod(F.xxhash64("w"), F.lit(parts)) == part).groupBy("w").agg(F.collect_set("item").alias("items"))
        mine = mine.orderBy("w").collect()  # most_bytes or so, by the measure above
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, [bytes(r["w"]) for r in mine], [r["items"] for r in mine]))

        def scan(batches):
            auto = scanner(*shared.value)
            for b in batches:
                n, spans, items = zip(*map(auto.scan, b["raw"].to_pylist()), strict=True) if b.num_rows else ((), (), ())
                kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("first", "after", "start", "end")]))
                cols = [pa.array(n, pa.int64()), pa.array(spans, kind), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*(c for c, f in zip(b.columns, b.schema.names, strict=True) if f != "raw"), *cols], [*(f for f in b.schema.names if f != "raw"), "n_words", "spans", "items"])

        kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "raw")
        return rows.mapInArrow(scan, f"{kept}, n_words long, spans {SPANS}, items array<string>")

    if parts == 1:
        return scanned(rows, 0)
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()))
    first, *others = [scanned(rows, p) for p in range(parts)]
    first = staged(first)
    hits = first.select("row", "spans", "items")
    for x in others:
        hits = hits.union(x.select("row", "spans", "items"))
    hits = hits.where(F.size("spans") > 0).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def join_up(batches):
        for b in batches:
            whole = []
            for spans in b["spans"].to_pylist():
                runs: list[dict] = []
                for s in sorted(spans, key=lambda s: s["first"]):
                    if runs and s["first"] <= runs[-1]["after"]:
                        if s["after"] > runs[-1]["after"]:
                            runs[-1] |= {"after": s["after"], "end": s["end"]}
                    else:
                        runs.append(dict(s))
                whole.append(runs)
            yield pa.RecordBatch.from_arrays([b["row"], pa.array(whole, b["spans"].type), b["items"]], ["row", "spans", "items"])

    hits = staged(hits.mapInArrow(join_up, f"row long, spans {SPANS}, items array<string>"))
    empty = F.from_json(F.lit("[]"), SPANS), F.array().cast("array<string>")
    return first.select("doc_id", "row", "n_words").join(hits, "row", "left").select("doc_id", "n_words", F.coalesce("spans", empty[0]).alias("spans"), F.coalesce("items", empty[1]).alias("items"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["after"] - s["first"])
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (n_hit > 0).alias("contaminated"))


_WORDS = rf"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
OP11_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
p AS (SELECT DISTINCT item_id, least(10, len(ws)) AS k, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(ws) - 8, 2))) AS i FROM b WHERE len(ws) > 0)),
g AS (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS g FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM p) WHERE len(ws) >= k)),
h AS (SELECT doc_id, i, p.k, item_id FROM g JOIN p ON g.k = p.k AND g.g = p.g),
n AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""

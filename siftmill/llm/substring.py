"""Substring deduplication with repeated-phrase automata."""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmill.llm.common import grouped, staged, table
from siftmill.llm.words import joined_words, places, runs_of, word_hashes

#: Words in a window, and in the phrases that anchor windows.
WINDOW, PHRASE = 20, 8
#: Contexts in one automaton, at least.
SHARD = 4000
#: A phrase with more occurrences is dealt out window by window, salted. None: more than a partition's fair share of all
#: occurrences, but not fewer than LEAST_HOT nor more than MOST_WORDS / window, which bounds what one task holds.
HOT, LEAST_HOT, MOST_WORDS = None, 1000, 500_000
#: Bytes of texts that are hashed together.
TOGETHER = 1 << 20
LAST = 2**63 - 1


def together(texts: list[str | None]):
    """Runs of texts, some TOGETHER bytes each: ``(first, joined words of each text)``."""
    held, size, first = [], 0, 0
    for i, t in enumerate(texts):
        held.append(joined_words(t))
        size += len(held[-1])
        if size > TOGETHER:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


class Places:
    """Words of several joined texts, laid end to end."""

    def __init__(self, texts: list[bytes]):
        self.raw = b" ".join(t for t in texts if t)
        self.starts, self.ends = places(self.raw)
        self.count = np.array([t.count(b" ") + 1 if t else 0 for t in texts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        self.text = np.repeat(np.arange(len(texts)), self.count)
        self.hash = word_hashes(self.raw, self.starts, self.ends)

    def windows(self, size: int) -> np.ndarray:
        """Places of the windows that lie within one text."""
        last = len(self.hash) - size + 1
        return np.flatnonzero(self.text[:last] == self.text[size - 1 :]) if last > 0 else np.empty(0, np.int64)


def phrases(words: Places, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last window start of every run of windows that have one anchor: the phrase of least hash in the
    window, leftmost if repeated. Equal windows have equal anchors at equal places."""
    at = words.windows(window)
    size = min(PHRASE, window)
    g = runs_of(words.hash, size)
    if not len(at):
        return np.empty(0, np.int64), at, at
    width, span, low = window - size + 1, 1, np.arange(len(g))
    while span < width:  # the leftmost of the least hashes of 1, 2, 4, ... phrases, then of all in a window
        step = min(span, width - span)
        left, right = low[:-step], low[step:]
        low, span = np.where(g[right] < g[left], right, left), span + step
    anchor = low[at]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)]))
    return g[anchor[new]].view(np.int64), at[new], at[np.concatenate([new[1:], [len(at)]]) - 1]


def automaton_classes(contexts: list[bytes], at: np.ndarray, window: int) -> np.ndarray:
    """A number for each window (word places ``at`` of ``contexts`` laid end to end): equal if and only if the words are.

    Words are numbered, and become the letters of an automaton; it is compiled of one window for each hash that recurs, and
    all contexts are streamed through it. Windows that it does not meet (their hash stood for another window) go into a
    further automaton."""
    split = pc.split_pattern(pa.array(contexts, pa.binary()).cast(pa.string()), " ")
    number = split.flatten().dictionary_encode().indices.to_numpy().astype(np.uint32) + 1
    number[number >= 0xD800] += 0x800  # these are no letters
    letters = number.tobytes().decode("utf-32-le")
    ends = np.cumsum(pc.list_value_length(split).to_numpy()).tolist()
    h = runs_of(number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), window)[at]
    out, slot = np.full(len(at), -1), np.full(len(letters), -1)
    slot[at] = np.arange(len(at))
    done = 0
    while (left := np.flatnonzero(out < 0)).size:
        _, some = np.unique(h[left], return_index=True)
        auto = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, p in enumerate(at[left[some]].tolist()):
            auto.add_word(letters[p : p + window], done + i)
        auto.make_automaton()
        begin = 0
        for end in ends:
            hits = list(auto.iter(letters, begin, end)) if end - begin >= window else []
            if hits:
                where, which = np.array(hits).T
                mine = slot[where - window + 1]
                out[mine[mine >= 0]] = which[mine >= 0]
            begin = end
        done += len(some)
    return out


def located(g: pa.Table, window: int, forward: bool) -> list[tuple[np.ndarray, ...]]:
    """Occurrences ``doc, row, start, words`` of contexts -> ranges of words ``doc, row, from, to`` whose windows start
    earlier elsewhere; with ``forward`` also the first occurrences of salted contexts, for comparison with other shards.

    Equal contexts are one, with a number of occurrences, of which only the first can have windows that start nowhere
    earlier. Windows of one context overlap and differ. A window whose hash is met in one context alone recurs as that
    context does; all others are told apart by the automaton, never by a hash."""
    doc, row, start = (g[c].to_numpy() for c in ("doc", "row", "start"))
    coded = g["words"].combine_chunks().dictionary_encode()
    code, contexts = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    order = np.lexsort((start, row, doc, code))
    least = order[np.searchsorted(code[order], np.arange(len(contexts)))]
    times = np.bincount(code, minlength=len(contexts))
    words = Places(contexts)
    at = words.windows(window)
    mine = words.text[at]
    _, kind, n = np.unique(runs_of(words.hash, window)[at], return_inverse=True, return_counts=True)
    shared = np.flatnonzero(n[kind] > 1)
    if len(shared):
        use, place = np.unique(mine[shared], return_inverse=True)
        begin = np.concatenate([[0], np.cumsum(words.count[use])])
        kind[shared] = len(n) + automaton_classes([contexts[c] for c in use.tolist()], begin[place] + at[shared] - words.first[mine[shared]], window)
    total = np.bincount(kind, times[mine])
    again = total[kind] > 1
    at, mine, kind = at[again], mine[again], kind[again]
    k = at - words.first[mine]
    by = np.lexsort((start[least[mine]] + k, row[least[mine]], doc[least[mine]], kind))
    owner = np.zeros(len(at), bool)
    owner[by[np.concatenate([[True], kind[by][1:] != kind[by][:-1]])] if len(by) else by] = True
    out = []
    is_first = np.zeros(len(code), bool)
    is_first[least] = True
    for firsts, some in ((False, np.ones(len(at), bool)), (True, ~owner)):
        lo, hi = np.full(len(contexts), window * len(doc) + len(words.hash)), np.full(len(contexts), -1)
        np.minimum.at(lo, mine[some], k[some])
        np.maximum.at(hi, mine[some], k[some])
        o = np.flatnonzero((is_first == firsts) & (hi[code] >= 0))
        out.append((doc[o], row[o], start[o] + lo[code[o]], start[o] + hi[code[o]] + window))
    found = [np.concatenate(c) for c in zip(*out, strict=True)]
    salted = least[g["salted"].to_numpy()[least] > 0] if forward else least[:0]
    return found, salted


def shards(window: int, forward: bool):
    """Sorted contexts -> removed ranges (``part`` 0) and, of salted ones, first occurrences (``part`` 1)."""
    names = ["part", "anchor", "sub", "doc", "row", "a", "b", "words"]

    def run(batches):
        for g in grouped(batches, "anchor", "sub", "salt", least=SHARD):
            (doc, row, a, b), firsts = located(g, window, forward)
            zero = np.zeros(len(doc), np.int64)
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in (zero, zero, zero, doc, row, a, b)), pa.nulls(len(doc), pa.binary())], names)
            if len(firsts):
                t = g.take(pa.array(firsts)).combine_chunks().to_batches()[0]
                zero = np.zeros(len(firsts), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(zero + 1), *(t[c] for c in ("anchor", "sub", "doc", "row", "start")), pa.array(zero), t["words"]], names)

    return run, "part long, anchor long, sub long, doc long, row long, a long, b long, words binary"


def digest(joined: bytes) -> str:
    return hashlib.sha256(joined).hexdigest()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, keep_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256`` (and ``kept_text``, the kept words joined by one
    space, with ``keep_text``).

    A word goes if a window that covers it has the same words as one that starts earlier: in a document of smaller id,
    or earlier in its own. A null text has no words, and keeps the empty text. Rows repeated with one id are ordered by
    a hash of their text, and identical rows are all treated as the first of them; null ids come last. An empty table
    gives no rows; other columns are not read.

    Every window is found by its anchor phrase. Only phrases that occur twice lead on: the contexts of their windows
    (not whole texts) are dealt to shards by phrase. A phrase with more than its share of occurrences is dealt window by window and
    salted; shards then pass on only a window's first occurrence."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumns({"doc": F.coalesce("doc_id", F.lit(LAST)), "row": F.xxhash64("text")})

    def scan(batches):
        for b in batches:
            for first, texts in together(b["text"].to_pylist()):
                words = Places(texts)
                anchor, lo, _ = phrases(words, window)
                text = words.text[lo]
                order = np.lexsort((anchor, text))
                anchor, text = anchor[order], text[order]
                new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])) if len(anchor) else order
                times = np.diff(np.append(new, len(anchor)))
                offsets = pa.array(np.searchsorted(text[new], np.arange(len(texts) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (anchor[new], times)]
                part = b.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["doc"], part["row"], pa.array(words.count), pa.array(map(digest, texts), pa.string()), *lists], ["doc_id", "doc", "row", "n_words", "sha", "anchors", "times"])

    base = staged(rows.mapInArrow(scan, "doc_id long, doc long, row long, n_words long, sha string, anchors array<long>, times array<long>"))
    uses = base.select("doc", "row", F.explode(F.arrays_zip("anchors", "times")).alias("u")).select("doc", "row", F.col("u.anchors").alias("anchor"), F.col("u.times").alias("times"))
    often, seen = staged(uses.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1"), F.coalesce(F.sum("n"), F.lit(0)).alias("all"))
    hot = HOT or max(LEAST_HOT, min(MOST_WORDS // window, seen["all"] // int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    need = uses.drop("times").join(often, "anchor").groupBy("doc", "row").agg(F.collect_set(F.struct("anchor", "n")).alias("need"))
    held = staged(rows.join(staged(need), ["doc", "row"]).select("doc", "row", "text", "need").dropDuplicates(["doc", "row"]))

    def contexts(batches):
        names = ["anchor", "sub", "salt", "salted", "doc", "row", "start", "words"]
        for b in batches:
            for first, texts in together(b["text"].to_pylist()):
                part = b.slice(first, len(texts))
                wanted = part["need"].flatten()
                known, which = np.unique(wanted.field("anchor").to_numpy(), return_index=True)
                often = wanted.field("n").to_numpy()[which]
                words = Places(texts)
                anchor, lo, hi = phrases(words, window)
                at = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
                n = np.where(known[at] == anchor, often[at], 0) if len(anchor) else anchor
                docs_, rows_ = part["doc"].to_numpy(), part["row"].to_numpy()

                def batch(anchor, sub, salt, salted, lo, hi):
                    begin, end, text = words.starts[lo], words.ends[hi + window - 1], words.text[lo]
                    raw = pa.array([words.raw[i:j] for i, j in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary())
                    return pa.RecordBatch.from_arrays([*map(pa.array, (anchor, sub, salt, np.full(len(lo), salted), docs_[text], rows_[text], lo - words.first[text])), raw], names)  # noqa: B023

                calm = np.flatnonzero((n > 0) & (n <= hot))
                for i in range(0, len(calm), 20_000):
                    some = calm[i : i + 20_000]
                    zero = np.zeros(len(some), np.int64)
                    yield batch(anchor[some], zero, zero, 0, lo[some], hi[some])
                crowded = np.flatnonzero(n > hot)
                if len(crowded):  # one context for each window
                    each = np.repeat(crowded, (hi - lo + 1)[crowded])
                    k = lo[each] + np.arange(len(each)) - np.repeat(np.cumsum((hi - lo + 1)[crowded]) - (hi - lo + 1)[crowded], (hi - lo + 1)[crowded])
                    sub = runs_of(words.hash, window)[k].view(np.int64)
                    place = np.stack([docs_[words.text[k]], rows_[words.text[k]], k - words.first[words.text[k]]], 1)
                    salt = np.array([xxhash.xxh3_64_intdigest(p.tobytes()) % (1 + m // hot) for p, m in zip(place, n[each].tolist(), strict=True)], np.int64)
                    for i in range(0, len(k), 20_000):
                        yield batch(*(x[i : i + 20_000] for x in (anchor[each], sub, salt)), 1, k[i : i + 20_000], k[i : i + 20_000])

    dealt = held.mapInArrow(contexts, "anchor long, sub long, salt long, salted long, doc long, row long, start long, words binary")
    dealt = dealt.repartition("anchor", "sub", "salt").sortWithinPartitions("anchor", "sub", "salt")
    within, schema = shards(window, True)
    found = staged(dealt.mapInArrow(within, schema))
    ahead = found.where("part = 1").select("anchor", "sub", F.lit(0).cast("long").alias("salt"), F.lit(0).cast("long").alias("salted"), "doc", "row", F.col("a").alias("start"), "words")
    across, _ = shards(window, False)
    last = ahead.repartition("anchor", "sub").sortWithinPartitions("anchor", "sub").mapInArrow(across, schema)
    ranges = found.where("part = 0").select("doc", "row", "a", "b").union(last.select("doc", "row", "a", "b"))
    ranges = staged(ranges.groupBy("doc", "row").agg(F.collect_set(F.struct("a", "b")).alias("ranges")))

    def remove(batches):
        names = ["doc", "row", "n_removed", "sha_kept", "kept_text"]
        for b in batches:
            out = []
            for doc, row, text, cuts in zip(*(b[c] for c in ("doc", "row", "text", "ranges")), strict=True):
                joined = joined_words(text.as_py())
                starts, ends = places(joined)
                cuts = np.stack([cuts.values.field(c).to_numpy() for c in ("a", "b")], 1)
                cuts = cuts[np.lexsort((cuts[:, 1], cuts[:, 0]))]
                upto = np.maximum.accumulate(cuts[:, 1])
                new = np.flatnonzero(np.concatenate([[True], cuts[1:, 0] > upto[:-1]]))
                gone_from, gone_to = cuts[new, 0], upto[np.append(new[1:], len(cuts)) - 1]
                kept = [joined[starts[i] : ends[j - 1]] for i, j in zip([0, *gone_to.tolist()], [*gone_from.tolist(), len(starts)], strict=True) if j > i]
                kept = b" ".join(kept)
                out.append((doc.as_py(), row.as_py(), int((gone_to - gone_from).sum()), digest(kept), kept.decode() if keep_text else None))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out, strict=True)) or [[]] * 5, kinds, strict=True)], names)

    cleaned = held.select("doc", "row", "text").join(ranges, ["doc", "row"]).mapInArrow(remove, "doc long, row long, n_removed long, sha_kept string, kept_text string")
    out = base.select("doc_id", "doc", "row", "n_words", "sha").join(staged(cleaned), ["doc", "row"], "left")
    out = out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("sha_kept", "sha").alias("kept_sha256"), "kept_text", "row", "doc")
    if not keep_text:
        return out.drop("kept_text", "row", "doc")
    whole = rows.select("doc", "row", F.array_join(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), " ").alias("all")).dropDuplicates(["doc", "row"])
    out = out.join(whole, ["doc", "row"])
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256", F.coalesce("kept_text", "all", F.lit("")).alias("kept_text"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i, ws FROM w WHERE len(ws) >= 20),
g AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 19], ' ')) AS k FROM s),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM g),
c AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM r WHERE nth > 1) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN ws ELSE [ws[j] FOR j IN range(1, len(ws) + 1) IF NOT list_contains(gone, j)] END, ' ')) AS kept_sha256
FROM w LEFT JOIN c ON w.doc_id = c.doc_id
"""

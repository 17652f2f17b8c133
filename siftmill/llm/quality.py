"""Quality classifier: random-indexing word vectors pooled per document, a two-layer network, calibrated by temperature."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmill.llm.common import grouped, staged, table

#: Bounds of what is fitted: labelled rows used, words with context vectors, buckets of other words, dimensions.
SAMPLE, VOCABULARY, OTHERS, DIMS = 12_000, 4096, 1024, 128
HIDDEN, EPOCHS, SEED, THRESHOLD = 32, 40, 17, 0.3
#: A worker's memory of words is emptied at so many; words above LONG bytes are not remembered, so it is bounded in bytes too.
REMEMBERED, LONG = 400_000, 64
#: Words whose contexts are summed up together.
TOGETHER = 50_000
#: Parts in which the matrices of contexts are summed up by tasks.
SLICES = 8
_OUTER, _RUNS = re.compile(r"^\W+|\W+$"), re.compile(r"(.)\1+", re.S)
_SHAPE = [(re.compile(r"[a-zß-öø-ÿ]"), "x"), (re.compile(r"[A-ZÀ-ÖØ-Þ]"), "X"), (re.compile(r"\d"), "9")]


def features(word: bytes) -> tuple[str, str]:
    """A word is two terms: itself without case and outer punctuation, and its shape (``NTLY!!`` is ``ntly``, ``X!``)."""
    text = word.decode("utf-8", "replace")
    shape = text
    for pattern, sign in _SHAPE:
        shape = pattern.sub(sign, shape)
    return _OUTER.sub("", text).lower(), "\x00" + _RUNS.sub(r"\1", shape)[:12]


def index_vectors(n: int) -> np.ndarray:
    """Sparse ternary vectors, four places each, drawn once for all terms."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((n, DIMS), np.float32)
    for row in out:
        row[rng.choice(DIMS, 4, replace=False)] = rng.choice([-1.0, 1.0], 4)
    return out


class Terms(dict):
    """Word (bytes) -> the places of its two terms among the vocabulary and the buckets of other words, as one number."""

    def __init__(self, vocabulary: list[str]):
        import xxhash

        self.place, self.digest = {t: i for i, t in enumerate(vocabulary)}, xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        a, b = (self.place[t] if t in self.place else VOCABULARY + self.digest(t) % OTHERS for t in features(word))
        if len(word) <= LONG:
            self[word] = a << 16 | b
        return a << 16 | b

    def of(self, text: str | None) -> np.ndarray:
        """Two columns: words' terms and shapes, in order."""
        words = (text or "").encode().split()
        both = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.stack([both >> 16, both & 0xFFFF], 1)


def pooled(terms: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector of a document's words and of their shapes; zeros for an empty text."""
    out = []
    for column in terms.T:
        at, n = np.unique(column, return_counts=True)
        out.append((n.astype(np.float32) @ vectors[at]) / max(1, len(column)))
    return np.concatenate(out)


def train(x: np.ndarray, y: np.ndarray, tune: np.ndarray) -> dict[str, np.ndarray]:
    """Fit the network on the rows outside ``tune`` (Adam, log loss), then the temperature on those inside. ``x`` may be of
    single precision: only the rows and columns in use are doubles, so the driver holds it once."""
    rng = np.random.default_rng(SEED)
    columns = (x[:, i : i + 16].astype(float) for i in range(0, x.shape[1], 16))
    mean, scale = np.concatenate([(c.mean(0), c.std(0) + 1e-6) for c in columns], 1)
    p = {"w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN), "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "b2": np.zeros(())}
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    fit = np.flatnonzero(~tune) if (~tune).any() else np.arange(len(x))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(fit)
        for rows in np.array_split(order, max(1, len(order) // 128)):
            step += 1
            z = (x[rows] - mean) / scale
            h = np.tanh(z @ p["w1"] + p["b1"])
            d = (1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -30, 30))) - y[rows]) / len(rows)
            dh = np.outer(d, p["w2"]) * (1 - h**2)
            grads = {"w1": z.T @ dh + 1e-4 * p["w1"], "b1": dh.sum(0), "w2": h.T @ d + 1e-4 * p["w2"], "b2": d.sum()}
            for k, g in grads.items():
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g**2
                p[k] = p[k] - 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    p |= {"mean": mean, "scale": scale, "t": np.ones(())}
    held = tune if tune.any() else ~tune
    raw = logits(x[held], p)
    grid = np.geomspace(0.25, 8, 61)
    loss = [np.logaddexp(0, -raw * (2 * y[held] - 1) / t).mean() for t in grid]
    p["t"] = np.asarray(grid[int(np.argmin(loss))])
    return p


def logits(x: np.ndarray, p: dict) -> np.ndarray:
    return np.tanh((x - p["mean"]) / p["scale"] @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"]


def fold(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE):
    """Vocabulary, word vectors and network from at most ``sample`` labelled rows (those of least hash) whose id is not
    held out; None if no usable row has a label. Contexts, counts and features are gathered and summed up by Spark; the
    driver gets the vocabulary, one matrix of contexts and a vector per sampled row, a part at a time."""
    lab = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("double").alias("_y")).where("_y IN (0, 1)").where(fold(F.col("_id")) != 0)
    lab = lab.groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(lab), "_id")
    texts = texts.groupBy("_id", "_y").agg(F.max_by("_text", F.xxhash64("_text")).alias("_text"))  # one row an id, however often it is repeated
    texts = staged(texts.select("_id", "_y", "_text")).coalesce(8)

    def tally(batches):
        seen = Counter()
        for b in batches:
            for t in b["_text"].to_pylist():
                seen.update((t or "").encode().split())
        terms = Counter()
        for w, n in seen.items():
            for f in features(w):
                terms[f] += n
        for i in range(0, len(keys := list(terms)), 10_000):
            part = keys[i : i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([terms[k] for k in part], pa.int64())], ["term", "n"])

    counts = texts.select("_text").mapInArrow(tally, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    vocabulary = [r["term"] for r in counts.orderBy(F.desc("n"), "term").limit(VOCABULARY).collect()]
    if not vocabulary:
        return None
    index = index_vectors(VOCABULARY + OTHERS)

    def contexts(batches):
        terms, total = Terms(vocabulary), np.zeros((VOCABULARY + OTHERS, DIMS), np.float32)
        for b in batches:
            for t in b["_text"].to_pylist():
                whole = terms.of(t)
                for first in range(0, len(whole), TOGETHER):  # a long text in parts, each with two words on either side
                    before = min(first, 2)
                    at = whole[first - before : first + TOGETHER + 2]
                    near = np.zeros((len(at) + 4, DIMS), np.float32)
                    own = index[at[:, 0]] + index[at[:, 1]]
                    for k in (0, 1, 3, 4):  # two words on either side
                        near[k : k + len(at)] += own
                    mine = slice(before, before + min(TOGETHER, len(whole) - first))
                    for column in at[mine].T:
                        np.add.at(total, column, near[2:][mine])
        for k, part in enumerate(np.array_split(total, SLICES)):
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([TaskContext.get().partitionId()]), pa.array([part.tobytes()])], ["k", "task", "m"])

    def summed(batches):
        for g in grouped(batches, "k"):
            parts = (np.frombuffer(m.as_py(), np.float32) for m in g["m"])
            yield pa.RecordBatch.from_arrays([g["k"].combine_chunks()[:1], pa.array([sum(parts, np.float32(0)).tobytes()])], ["k", "m"])

    found = texts.select("_text").mapInArrow(contexts, "k long, task long, m binary").repartition(SLICES, "k").sortWithinPartitions("k", "task")
    found = sorted(found.mapInArrow(summed, "k long, m binary").collect())
    total = np.concatenate([np.frombuffer(r["m"], np.float32) for r in found]).reshape(-1, DIMS)
    unit = lambda a: a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-6)
    vectors = (unit(index) + unit(total)).astype(np.float32)

    def pool(batches):
        terms = Terms(vocabulary)
        for b in batches:
            x = [pooled(terms.of(t), vectors).astype(np.float32).tobytes() for t in b["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["_id"], b["_y"], pa.array(x, pa.binary())], ["_id", "_y", "x"])

    rows = staged(texts.mapInArrow(pool, "_id long, _y double, x binary").withColumn("fold", fold(F.col("_id"))))
    ids, y, tune, x = matrix(rows)
    order = np.argsort(ids)
    return vocabulary, vectors, train(x[order], y[order], tune[order])


def matrix(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``_id, _y, x, fold`` -> ids, labels, whether the fold is 1, and one matrix of single precision, filled as the rows come:
    the driver has one partition beside it, not all rows in several forms."""
    n = rows.count()
    ids, y, tune, x = np.empty(n, np.int64), np.empty(n), np.empty(n, bool), np.empty((n, 2 * DIMS), np.float32)
    for i, r in enumerate(rows.toLocalIterator()):
        ids[i], y[i], tune[i], x[i] = r["_id"], r["_y"], r["fold"] == 1, np.frombuffer(r["x"], np.float32)
    return ids, y, tune, x


def scorer(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str):
    """A function from an Arrow array of texts to scores, for use in tasks; the fitted model is broadcast (its size is bounded)."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col))
    kept: list[Terms] = []

    def scores(texts: pa.Array) -> np.ndarray:
        if not model.value or not len(texts):
            return np.full(len(texts), 0.5)
        vocabulary, vectors, net = model.value
        if not kept:
            kept.append(Terms(vocabulary))
        x = np.stack([pooled(kept[0].of(t.as_py()), vectors) for t in texts]).astype(float)
        return 1 / (1 + np.exp(-np.clip(logits(x, net) / net["t"], -30, 30)))

    return scores


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whatever their names, whose score is at least ``threshold``; nothing is shuffled. Null and
    empty texts have the score of a document without words, rows repeated are judged each, texts of any length whole."""
    scores = scorer(docs, labels, id_col, text_col, label_col)
    return docs.mapInArrow(lambda batches: (b.filter(pa.array(scores(b[text_col]) >= threshold)) for b in batches), docs.schema)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Only whole texts enter a score. Null and empty texts get the score of a document without words. Labels that are
    null or neither 0 nor 1 are ignored; of repeated labels of one id the larger counts; without usable labels every
    score is 0.5. Rows repeated with one id are scored each; a null id is not held out. Nothing is shuffled."""
    scores = scorer(docs, labels, id_col, text_col, label_col)

    def run(batches):
        for b in batches:
            s = scores(b["_text"])
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    scored = rows.mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

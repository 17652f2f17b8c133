"""Each stage of the pipeline on its own input, and rows that repeat."""

from collections import Counter

import corpus_pipeline as cp
from siftmill.llm import quality as q
from tests.llm.test_operators import WORD, brute_near, lower


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
    good = cp.staged(cp.quality(spark, docs, sf_dir))
    want = {r["doc_id"] for r in q.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect() if r["predicted"]}
    assert set(texts(good)) == want and good.schema == docs.schema
    single = cp.staged(cp.exact(spark, good, sf_dir))
    best = {}
    for i, t in texts(good).items():
        best[lower(t)] = max(i, best.get(lower(t), i))
    assert set(texts(single)) == set(best.values()) and single.columns == docs.columns
    apart = cp.staged(cp.near(spark, single, sf_dir))
    comp = brute_near_5(texts(single))
    assert set(texts(apart)) == comp and apart.columns == docs.columns
    mixed = cp.staged(cp.mix(spark, apart, sf_dir))
    before, size = texts(apart), Counter()
    for r in mixed.collect():
        own = WORD.findall(before[r["doc_id"]])
        got = WORD.findall(r["text"])
        size[r["doc_id"]] += len(got)
        assert not Counter(got) - Counter(own) and r["n_chars"] == len(r["text"])
    taken = {r["doc_id"]: r["taken"] for r in cp.mixed_documents.__globals__["mix"](apart).collect()}
    assert mixed.columns == docs.columns and size == Counter({i: n for i, n in taken.items() if n})
    pieces = cp.pack(spark, mixed, sf_dir).collect()
    assert Counter(r["doc_id"] for r in pieces if r["start"] == 0) == Counter(r["doc_id"] for r in mixed.collect())
    assert cp.run(spark, sf_dir).count() == len(pieces)


def brute_near_5(texts):
    """Ids that stay at 5-word shingles and 0.8."""
    sets = {i: ({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := WORD.findall(lower(t))) else set()) for i, t in texts.items()}
    ids, up = sorted(sets), {}
    find = lambda i: i if up.get(i, i) == i else find(up[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i for i in ids if find(i) == i}


def test_repeated_rows(spark, sf_dir):
    rows = [(1, "a b c", "en", "s", 5)] * 3 + [(2, "A b c", "en", "s", 5), (3, None, None, None, None), (None, "x y", "en", None, 3), (None, "x y", "en", None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert Counter(tuple(r)[:2] for r in cp.exact(spark, docs, sf_dir).collect()) == Counter([(2, "A b c"), (3, None), (None, "x y")])
    for stage in (cp.quality, cp.exact, cp.near, cp.mix, cp.pack):
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
        assert stage(spark, docs, sf_dir).count() > 0
    n = sum(len(WORD.findall(r["text"])) for r in cp.mix(spark, docs, sf_dir).collect())
    assert 19 <= n <= 26  # 1.5 times 16 words, by the word
    assert brute_near([(1, "a b")]) == {(1, 1, 1, True)}

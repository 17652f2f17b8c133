"""Clashing column names, rows repeated very often, and texts of more than a million words."""

import hashlib
import time
from collections import Counter

import numpy as np
import pytest

from siftmill.llm import exact_dedup, minhash, mixing, packing, quality, sharding, substring, tokens, urls
from siftmill.llm.common import clear_staged, components, contracted, fresh, staged


@pytest.fixture(scope="module")
def clash(spark):
    """Columns with the names that the operators use inside."""
    names = ["_id", "_row", "_sha", "_kept_sha", "_n", "_parts", "_words", "_p", "_copy", "_text", "_h", "id", "row", "sha", "n", "part", "copy", "words", "text_hash", "kept_sha", "doc", "key", "bin", "size", "component"]
    rows = [(1, "one two three four five six", "a"), (2, "One two three four five six", "a"), (3, "other words are here today again", "b"), (4, None, None)]
    return spark.createDataFrame([(*r, *[f"{n}{r[0]}" for n in names]) for r in rows], "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))


def test_clashing_names(clash, spark):
    docs = clash.collect()
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    for kept, want in ((exact_dedup.without_copies(clash), {2, 3, 4}), (minhash.without_near_copies(clash), {1, 3, 4})):
        assert kept.columns == clash.columns
        assert {r["doc_id"] for r in kept.collect()} == want and all(r in docs for r in kept.collect())
    mixed = mixing.mixed_documents(clash, block=2)
    own = {r["doc_id"]: r for r in docs}
    assert mixed.columns == clash.columns and mixed.count() > 0
    assert all(all(r[c] == own[r["doc_id"]][c] for c in clash.columns if c != "text") for r in mixed.collect())
    assert quality.keep_good(clash, labels, threshold=0.0).collect() == docs
    for out in (substring.remove_repeats(clash), tokens.count_tokens(clash), sharding.shard(clash), quality.score(clash, labels)):
        assert out.count() == 4
    assert packing.pack_documents(clash).select("doc_id").distinct().count() == 4
    assert fresh(clash, "ID", "new") == ["ID_", "new"]


def test_repeated_rows(spark):
    same = spark.range(3000).selectExpr("7L AS doc_id", "'a b c d e f g h i j k l m n o p q r s t u v' AS text", "'s' AS source")
    pieces = packing.pack_documents(same, per_bin=50)
    bins = Counter(r["sequence_id"] >> 32 for r in pieces.collect())
    assert sum(bins.values()) == 3000 and max(bins.values()) < 120  # they don't fill one bin
    out = sharding.shard(same).collect()
    slots = Counter((r["shard"], r["slot"]) for r in out)
    assert len(out) == len(slots) == 3000
    mix = mixing.mix(same).collect()
    assert len(mix) == 3000 and abs(sum(r["taken"] for r in mix) - 1.5 * 3000 * 22) <= 32
    docs = mixing.mixed_documents(same).collect()
    assert sum(len(r["text"].split()) for r in docs) == sum(r["taken"] for r in mix)
    removed = substring.remove_repeats(same).collect()
    assert {tuple(r) for r in removed} == {(7, 22, 0, hashlib.sha256(same.first()["text"].encode()).hexdigest())}


def test_texts_of_millions_of_words(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in rng.integers(0, 40_000, 1_050_000)]
    big, word = " ".join(words), "x" * 2_000_000
    near = " ".join([*words[:700_000], "changed", *words[700_001:]])
    rows = [(1, big, "a"), (2, near, "a"), (3, word, "a"), (4, big, "b"), (5, word, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    began = time.time()
    out = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs).collect()}
    assert out == {1: 1, 2: 1, 3: 3, 4: 1, 5: 3}
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring.remove_repeats(docs).collect()}
    assert got[1] == (1_050_000, 0) and got[2] == (1_050_000, 1_049_999) and got[4] == (1_050_000, 1_050_000) and got[3] == got[5] == (1, 0)
    counts = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(docs).collect()}
    library = tokens.Encoder(*tokens.prove_whole(tokens.default_path()))
    assert counts == {i: len(library.tok.encode(t, add_special_tokens=False).ids) for i, t, _ in rows}
    assert {r["doc_id"]: r["kept"] for r in exact_dedup.exact_duplicates(docs).collect()} == {1: False, 2: True, 3: False, 4: True, 5: True}
    pieces = packing.pack_documents(docs).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] - 1 for r in pieces} == counts
    assert abs(sum(r["taken"] for r in mixing.mix(docs).collect()) - 1.5 * 3_150_002) <= 64
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (4, 1), (5, 0), (6, 0)], "doc_id long, quality int")
    assert quality.score(docs, labels).count() == 5
    assert time.time() - began < 400


def test_blocks_by_shard():
    """Each shard gives the blocks of its quota."""
    rng = np.random.default_rng(2)
    for _ in range(50):
        sizes = [int(n) for n in rng.integers(2000, 90_000, 5)]
        goal = mixing.targets(sizes, [5, 2, 1, 5, 2])
        quotas = mixing.shard_quotas(goal, round(sum(goal) / 16), 8)
        for i, n in enumerate(sizes):
            ranges, own = mixing.shard_ranges(n, 16, 8), [q[i] for q in quotas]
            assert ranges[0][0] == 0 and ranges[-1][1] == n and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:], strict=False))
            parts = mixing.chosen(ranges, own, 16, 2, f"s{i}")
            assert parts[0][0] == 0 and parts[-1][1] == n and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
            assert all(0 <= t <= 2 for _, _, t in parts)
            by_shard = [sum(t * (min(b, hi) - max(a, lo)) for lo, hi, t in parts if lo < b and hi > a) for a, b in ranges]
            if 2 * n - sum(own) * 16 > 8 * 64:  # where no shard is full: exactly its quota
                assert by_shard == [q * 16 for q in own]
            assert sum(by_shard) == min(sum(own) * 16, 2 * n)


def test_contracted_edges():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 400, 3000), rng.integers(0, 400, 3000)
    batches = [pa.RecordBatch.from_arrays([pa.array(a[i : i + 500]), pa.array(b[i : i + 500])], ["a", "b"]) for i in range(0, 3000, 500)]
    for most in (200, 1_000_000):
        edges = [e for x in contracted(batches, most) for e in zip(x["a"].to_pylist(), x["b"].to_pylist(), strict=True)]
        assert all(y < x for x, y in edges)
        up = list(range(400))
        find = lambda i: i if up[i] == i else find(up[i])
        for x, y in edges:
            up[max(find(x), find(y))] = min(find(x), find(y))
        assert len({find(i) for i in set(a.tolist()) | set(b.tolist())}) == 1
        assert most == 200 or len(edges) == len(set(a.tolist()) | set(b.tolist())) - 1


def test_url_trees_held_out(spark, sf_dir):
    right, common = urls.held_out_accuracy(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    assert right >= common


def test_components_of_empty(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_staged_tables_are_cleared(spark):
    t = staged(spark.range(3))
    assert t.count() == 3 and clear_staged(spark) > 0 and clear_staged(spark) == 0
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(t.inputFiles()[0]).count()

"""Placement, differencing and the quality network against plain versions."""

import math
import random
import tracemalloc

import numpy as np

from siftmill.llm import packing, quality, sharding


def plain_place(vectors, shards):
    left = [[1 / shards] * len(vectors[0]) for _ in range(shards)]
    out = [0] * len(vectors)
    for i in sorted(range(len(vectors)), key=lambda i: (-max(vectors[i]), -sum(vectors[i]), i)):
        v = vectors[i]
        fits = [s for s in range(shards) if all(a >= b for a, b in zip(left[s], v, strict=True))]
        if fits:
            out[i] = max(fits, key=lambda s: (sum(a * b for a, b in zip(left[s], v, strict=True)), -s))
        else:
            out[i] = max(range(shards), key=lambda s: (min(a - b for a, b in zip(left[s], v, strict=True)), -s))
        left[out[i]] = [a - b for a, b in zip(left[out[i]], v, strict=True)]
    return out


def test_place():
    rng = random.Random(3)
    for _ in range(60):
        n, shards = rng.randint(1, 40), rng.choice([2, 4, 8])
        raw = [[2.0 ** -rng.randint(4, 9) for _ in range(3)] for _ in range(n)]  # powers of two: sums are exact, so ties are ties
        assert sharding.place(np.array(raw), shards).tolist() == plain_place(raw, shards)


def plain_difference(sizes, windows):
    """Multiway differencing by the book: partitions of all windows, zeros too."""
    parts = [([(s, [i])] + [(0, [])] * (windows - 1)) for i, s in enumerate(sizes)]
    while len(parts) > 1:
        parts.sort(key=lambda p: -(p[0][0] - p[-1][0]))
        a, b = parts.pop(0), parts.pop(0)
        parts.append(sorted(((x[0] + y[0], x[1] + y[1]) for x, y in zip(a, reversed(b), strict=True)), key=lambda p: -p[0]))
    return sorted(s for s, _ in parts[0]) if parts else []


def test_difference():
    rng = random.Random(8)
    for _ in range(80):
        sizes = rng.sample(range(1, 10**6), rng.randint(1, 30))  # apart, so that the order of merging is the only one
        windows = rng.randint(1, 8)
        out = packing.difference(sizes, windows)
        assert sorted(i for p in out for i in p) == list(range(len(sizes)))
        sums = sorted([sum(sizes[i] for i in p) for p in out] + [0] * (windows - len(out)))
        want = plain_difference(sizes, windows)
        assert sums == want or max(sums) - min(sums) <= max(want) - min(want)


def test_pack_keeps_the_capacity():
    rng = random.Random(1)
    for _ in range(40):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(1, 60))]
        parts = packing.pack(sizes, 100)
        assert sorted(i for p in parts for i in p) == list(range(len(sizes))) and all(sum(sizes[i] for i in p) <= 100 for p in parts)


def test_network_by_hand():
    """Scores of a trained network, word by word and unit by unit."""
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(quality.VOCABULARY + quality.OTHERS, quality.DIMS)).astype(np.float32)
    terms = quality.Terms(["good", "bad", "\x00x"])
    texts = ["good words here", "BAD!! bad 12", "", "good good bad new-word"]
    x = np.stack([quality.pooled(terms.of(t), vectors) for t in texts]).astype(float)
    for t, row in zip(texts, x, strict=True):
        places = [terms[w] for w in t.encode().split()]
        for part, shift in ((row[: quality.DIMS], 16), (row[quality.DIMS :], 0)):
            want = sum((vectors[(p >> shift) & 0xFFFF].astype(float) for p in places), np.zeros(quality.DIMS)) / max(1, len(places))
            assert np.allclose(part, want, atol=1e-5)
    data = rng.normal(size=(2000, 6))
    y = (data[:, 0] + data[:, 1] > 0).astype(float)
    net = quality.train(data, y, np.arange(2000) % 5 == 0)
    got = quality.logits(data, net)
    for i in range(20):
        z = [(data[i, j] - net["mean"][j]) / net["scale"][j] for j in range(6)]
        hidden = [math.tanh(sum(z[j] * net["w1"][j, k] for j in range(6)) + net["b1"][k]) for k in range(quality.HIDDEN)]
        assert abs(sum(h * w for h, w in zip(hidden, net["w2"], strict=True)) + float(net["b2"]) - got[i]) < 1e-9
    held = np.arange(2000) % 5 == 0
    assert ((got > 0) == (y > 0)).mean() > 0.9
    loss = lambda t: np.logaddexp(0, -got[held] * (2 * y[held] - 1) / t).mean()
    assert loss(float(net["t"])) <= min(loss(t) for t in (0.3, 0.5, 1.0, 2.0, 4.0)) + 1e-3


def test_quality_network_holds_the_sample_once():
    """Rows of single precision train the same network as doubles do, and no second matrix is made of them."""
    rng = np.random.default_rng(9)
    x = rng.normal(3, 2, (4000, 2 * quality.DIMS)).astype(np.float32)
    y, tune = (x[:, 0] + x[:, 1] > 6).astype(float), np.arange(4000) % 4 == 0
    tracemalloc.start()
    net = quality.train(x, y, tune)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.6 * x.nbytes
    wide = x.astype(float)
    assert np.array_equal(net["mean"], wide.mean(0)) and np.array_equal(net["scale"], wide.std(0) + 1e-6)
    assert all(np.array_equal(v, net[k]) for k, v in quality.train(wide, y, tune).items())


def test_quality_sample_comes_in_parts(spark):
    want = np.random.default_rng(3).normal(size=(9, 2 * quality.DIMS)).astype(np.float32)
    rows = spark.createDataFrame([(i, float(i % 2), want[i].tobytes(), i % 5) for i in range(9)], "_id long, _y double, x binary, fold long").repartition(4)
    ids, y, tune, x = quality.matrix(rows)
    assert x.dtype == np.float32 and sorted(ids) == list(range(9)) and np.array_equal(x, want[ids])
    assert list(y) == [i % 2 for i in ids] and list(tune) == [i % 5 == 1 for i in ids]

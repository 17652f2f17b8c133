"""Each operator against a brute-force version, on given tables and on small tables of odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftmill.llm import common, embedding, exact_dedup, minhash, mixing, packing, quality, sharding, substring, tokens, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, rep long, size string, before long"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def odd_texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    base = [word() for _ in range(160)]
    texts = [None, "", " \n\t ", "one", "One", "one two", "a b c", "A  b\tc", "\u00a0x\u00a0 y\x1cz \x85w", "é" * 9000, "<|endoftext|> a<|endoftext|>", "日本語の文。 " * 300, "it's  we'll\n\n x ", "x" * 5000 + ". " + "y" * 700]
    texts += [" ".join(base)] * 5
    for _ in range(40):  # near copies of all degrees
        own = list(base)
        for _ in range(rng.randint(0, 12)):
            own[rng.randrange(len(own))] = word()
        texts.append(" ".join(own))
    for _ in range(20):  # shared passages
        a = rng.randrange(100)
        texts.append(" ".join([word() for _ in range(rng.randint(0, 40))] + base[a : a + rng.randint(15, 60)] + [word() for _ in range(rng.randint(0, 40))]))
    texts.append(" ".join(["again and"] * 300))
    texts.append("\n".join(["the same line of eleven words that comes again and again"] * 9))
    return texts


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i * 3 + 1, t, "en", None if i % 7 == 0 else f"s{i % 4}", 0, 1, 2, "x", 3) for i, t in enumerate(odd_texts())]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pairs(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


# ---- 1 MinHash


def brute_near(rows):
    sets = {}
    for i, t in rows:
        w = [x for x in WORD.findall(lower(t))]
        sets[i] = {tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))} if w else set()
    comp = {i: i for i in sets}
    find = lambda i: i if comp[i] == i else find(comp[i])
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            comp[y] = x
    return {(i, len(s), find(i), find(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize("name", ["odd", "documents"])
@pytest.mark.parametrize("block, turns", [(128, 32), (8, 32), (8, 0)])
def test_near_duplicates(request, monkeypatch, name, block, turns):
    monkeypatch.setattr(minhash, "BLOCK", block)  # clusters above 8: regions, then blocks against the rest, or shared shingles
    monkeypatch.setattr(minhash, "TURNS", turns)
    df = request.getfixturevalue(name)
    assert {tuple(r) for r in minhash.near_duplicates(df).collect()} == brute_near(pairs(df))


def test_near_duplicates_equal_signatures(spark):
    """More near copies than a block holds, with equal signatures: each tree sorts them alike."""
    words = [f"w{i}" for i in range(3000)]
    base, texts = minhash.signature(minhash.shingles(" ".join(words))), []
    for i in range(0, 3000, 4):
        t = " ".join([*words[:i], f"own{i}", *words[i + 1 :]])
        if minhash.signature(minhash.shingles(t)) == base:
            texts.append(t)
    rows = list(enumerate(texts[:300]))
    assert len(rows) == 300
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["component_id"] for r in out} == {0} and sum(r["kept"] for r in out) == 1


def test_sharing_meets_all_near_pairs(spark, monkeypatch):
    """Sets over one template: every near pair with a rest member meets in a part; sets that share the template alone meet nowhere."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng, sets = np.random.default_rng(3), []
    for k in range(150):
        own = rng.integers(1000, 10**9, 30)
        sets.append(np.concatenate([np.arange(70), own]))
        if k % 3 == 0:  # a partner at 0.85 or just below it, and of another size
            sets.append(np.concatenate([np.arange(70), own[: 30 - k // 3 % 12], rng.integers(1000, 10**9, k // 3 % 7)]))
    sets += [np.concatenate([np.arange(70), np.arange(500, 530), [10**10 + k]]) for k in range(40)]  # a crowd that shares its own part too
    sets = [np.unique(s.astype(np.uint64)) for s in sets]
    rest = [bool(k % 4) for k in range(len(sets))]
    placed = spark.createDataFrame([(1, k, r) for k, r in enumerate(rest)], "component long, key long, rest boolean")
    whole = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in enumerate(sets)], "key long, s binary")
    rows = minhash.blocks_of(minhash.sharing(placed, whole, 85, 100)).collect()
    parts = {}
    for r in rows:
        parts.setdefault(tuple(r)[:-1], set()).add(r["key"])
    met = {p for keys in parts.values() for p in itertools.combinations(sorted(keys), 2)}
    near = lambda a, b: 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))
    wanted = {(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if (rest[a] or rest[b]) and near(a, b)}
    assert wanted and wanted <= met
    crowd = range(200, 240)
    assert len(met) <= 200 + len(list(itertools.combinations(crowd, 2)))


def test_candidates_meet_over_cuts():
    """Rows that all agree make one chain over cut regions and over cut tables."""
    path, n = b"x" * minhash.VALUES, 1000
    batch = pa.RecordBatch.from_arrays([pa.array([0] * n, pa.int32()), pa.array([path] * n, pa.binary()), pa.array(range(n), pa.int64())], ["tree", "path", "key"])
    assert max(b - a for a, b in minhash.regions(np.zeros((n, 64), np.uint8))) <= minhash.BLOCK
    for most in (50_000, 300):
        tables = [t["key"].to_pylist() for t in minhash.runs([batch], most)]
        assert sorted({k for t in tables for k in t}) == list(range(n))
        assert all(set(a) & set(b) for a, b in itertools.pairwise(tables))
    rows = [r for b in minhash.candidates([batch]) for r in b.to_pylist()]
    assert {r["key"] for r in rows} == set(range(n)) and {r["parent"] for r in rows} == {0}
    assert max(Counter(r["region"] for r in rows).values()) <= minhash.BLOCK


def test_near_duplicates_odd_rows(spark, empty):
    assert minhash.near_duplicates(empty).count() == 0
    rows = [(7, "a b c d"), (7, "a b c d"), (7, "other words here now"), (9, "other words here now"), (None, "a b c d"), (None, None)]
    out = Counter(tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert out == Counter({(7, 2, 7, True): 3, (9, 2, 7, False): 1, (None, 2, 7, False): 1, (None, 0, None, True): 1})


def test_regions_split_deep():
    rng = np.random.default_rng(1)
    paths = np.sort(rng.integers(0, 2, (1000, 64), dtype=np.uint8).view("S64"), axis=0).view(np.uint8).reshape(-1, 64)
    got = minhash.regions(paths)
    assert max(b - a for a, b in got) <= minhash.BLOCK
    assert minhash.regions(np.zeros((500, 64), np.uint8))[0][0] >= 0
    x = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(9)]
    assert (minhash.intersections(x) == [[len(set(a) & set(b)) for b in x] for a in x]).all()


def test_components_long_path(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1002), (1002, 1001), (5, 5), (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in common.components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000, 1002: 1000}
    assert common.components(edges.limit(0)).count() == 0


# ---- 2 URL filters


def test_suffixes_counted_over_all_labels(spark, monkeypatch):
    class Stop(Exception):
        pass

    class Trees:
        def __init__(self, **_):
            pass

        def fit(self, df):
            raise Stop(max(r.features[urls.LEXICAL.index("suffix_seen")] for r in df.collect()))

    rows = [(i, f"http://a{i}.org/{'' if i % 2 else 'en/'}") for i in range(60)]
    rules = [("allow", "org", "/en/"), ("block", "org", "/")]
    monkeypatch.setattr(urls, "GBTClassifier", Trees)
    with pytest.raises(Stop) as e:
        urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=rules, sample=20)
    assert abs(e.value.args[0] - np.log1p(60)) < 1e-9  # the sample alone has 20


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = lower(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
    fits = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *max(fits, key=lambda f: len(f[0]), default=(None, None))


def test_url_rules(spark, sf_dir):
    odd = [None, "", "x", "http://", "https://EXAMPLE.org/en/1?x", "http://a.example.org", "http://example.org?/es/", "http://notexample.org/es/", "http://x.com/de/#a://b", "http://u:p@x.COM:80/fr/", "ftp://org/", "a://b://c.org/d", "http://x.com/é/🙂", "http://org"]
    rows = [(i, u, None, 0.5, "s") for i, u in enumerate(odd * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digits double, suffix string")
    for df in (pages, spark.read.parquet(f"{sf_dir}/pages.parquet")):
        got = {r["page_id"]: tuple(r)[1:] for r in urls.judge(df).collect()}
        assert len(got) == df.count()
        for i, u in df.select("page_id", "url").collect():
            host, path, rule, verdict = brute_rule(u)
            assert got[i][:3] == (host, path, rule)
            assert got[i][3] == verdict if verdict else got[i][3] in ("allow", "block")
    assert urls.judge(pages.limit(0)).count() == 0
    assert {r["verdict"] for r in urls.judge(pages.where("page_id < 4")).collect()} == {"allow"}


def test_url_trees_learn(spark):
    rng = random.Random(3)
    bad = lambda: f"http://{rng.randrange(10**9)}.x.test/" + "/".join(str(rng.randrange(10**6)) for _ in range(6)) + "?a=1&b=2"
    good = lambda: "https://" + "".join(rng.choice("aeiounst") for _ in range(8)) + ".test/about"
    rows = [(i, bad().replace("x.test", "x.bad") if i % 2 else good().replace(".test", ".good")) for i in range(300)] + [(300 + i, bad() if i % 2 else good()) for i in range(200)]
    rules = (("block", "bad", "/"), ("allow", "good", "/"))
    out = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=rules).where("page_id >= 300").collect()
    right = [(r["verdict"] == "block") == bool(r["page_id"] % 2) for r in out]
    assert all(r["rule"] is None for r in out) and np.mean(right) > 0.95


# ---- 3 substring


def brute_substring(rows, n=20):
    first, words = {}, {i: [w for w in WORD.findall(t or "")] for i, t in rows}
    gone = {i: set() for i in words}
    for i in sorted(words):
        w = words[i]
        for k in range(len(w) - n + 1):
            if first.setdefault(tuple(w[k : k + n]), (i, k)) != (i, k):
                gone[i].update(range(k, k + n))
    kept = {i: " ".join(w for k, w in enumerate(words[i]) if k not in gone[i]) for i in words}
    return {(i, len(words[i]), len(gone[i]), hashlib.sha256(kept[i].encode()).hexdigest()) for i in words}, kept


@pytest.mark.parametrize("name", ["odd", "documents"])
@pytest.mark.parametrize("hot,shard", [(1000, 4000), (3, 5)])
def test_substring(request, monkeypatch, name, hot, shard):
    monkeypatch.setattr(substring, "HOT", hot)  # above 3: window by window, salted, in two rounds
    monkeypatch.setattr(substring, "SHARD", shard)
    df = request.getfixturevalue(name)
    want, kept = brute_substring(pairs(df))
    assert {tuple(r) for r in substring.remove_repeats(df).collect()} == want
    if name == "odd" and hot == 3:
        assert {r["doc_id"]: r["kept_text"] for r in substring.remove_repeats(df, keep_text=True).collect()} == kept


def test_substring_odd_rows(spark, empty):
    assert substring.remove_repeats(empty).count() == 0
    t = " ".join(f"w{i}" for i in range(25))
    rows = [(4, t), (4, t), (2, t + " z"), (None, t), (None, None)]
    got = Counter((r["doc_id"], r["n_removed"]) for r in substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter({(4, 25): 2, (2, 0): 1, (None, 25): 1, (None, 0): 1})


# ---- 4 quality


def test_quality_held_out(spark):
    from tests.conftest import DATA

    docs, labels = (spark.read.parquet(f"{DATA}/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    out = quality.score(docs, labels).join(labels, "doc_id").where("held_out").select("doc_id", "score", "quality", "predicted").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and (r["score"] >= 0.3) == r["predicted"] for r in out)
    y, s = np.array([r["quality"] for r in out]), np.array([r["score"] for r in out])
    auc = np.mean([np.mean(p > s[y == 0]) + np.mean(p == s[y == 0]) / 2 for p in s[y == 1]])
    assert len(out) > 500 and auc > 0.95
    assert abs(s.mean() - y.mean()) < 0.08  # calibrated
    assert np.mean(s[y == 1] >= 0.3) > 0.98


def test_quality_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1, 0), (7, 0, 0), (10, None, 0), (13, 1, 1), (13, 0, 1), (None, 1, 0), (16, 7, 0)], "doc_id long, quality int, toxic int")
    assert quality.score(empty, labels).count() == 0
    assert {r["score"] for r in quality.score(odd, labels.limit(0)).collect()} == {0.5}
    out = quality.score(odd, labels).collect()
    assert len(out) == odd.count() and all(0 <= r["score"] <= 1 for r in out)


# ---- 5 token counts


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_token_counts(request, name):
    from tokenizers import Tokenizer

    df = request.getfixturevalue(name)
    tok = Tokenizer.from_file(tokens.default_path())
    want = {(i, len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in pairs(df)}
    assert {tuple(r) for r in tokens.count_tokens(df).collect()} == want


def test_encoder_like_library():
    spec, whole = tokens.prove_whole(tokens.default_path())
    enc = tokens.Encoder(spec, whole)
    rng = random.Random(2)
    signs = "ab'sll tr\n\t  \r\x0b\x0c\x1c\x85\xa0éÉß²½9 .,!?<|endoftext|>–“…€日😀\u2009\u3000"
    for _ in range(1500):
        t = "".join(rng.choice(signs) for _ in range(rng.randint(0, 40)))
        t += rng.choice(["", "<|endoftext|>", " we've", "  \n", " I'm"])
        assert enc.encode(t) == enc.library(t), repr(t)
    assert len(whole) > 40_000


# ---- 6 exact


def brute_exact(rows):
    by = defaultdict(list)
    for i, t in rows:
        by[lower(t)].append(i)
    return {(i, max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in by.items() for i in g}


@pytest.mark.parametrize("name", ["odd", "documents"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact(request, name, weak):
    df = request.getfixturevalue(name)
    short = (lambda c: F.length(c).cast("long")) if weak else None  # chunks of one length share a short name
    assert {tuple(r) for r in exact_dedup.exact_duplicates(df, name=short).collect()} == brute_exact(pairs(df))


def test_exact_odd_rows(spark, empty):
    assert exact_dedup.exact_duplicates(empty).count() == 0
    rows = [(1, "A"), (1, "a"), (None, "a"), (2, None), (3, ""), (None, "z")]
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter({(1, 1, 3, True): 2, (None, 1, 3, False): 1, (2, 3, 2, False): 1, (3, 3, 2, True): 1, (None, None, 1, True): 1})


# ---- 7 mixing


def brute_targets(sizes, weights, share=1.5, limit=2):
    fixed, left = {}, share * sum(sizes)
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        w = sum(weights[i] for i in free)
        goal = {i: left * weights[i] / w for i in free} if free else {}
        over = [i for i in goal if goal[i] > limit * sizes[i]]
        if not over:
            return [fixed.get(i, goal.get(i)) for i in range(len(sizes))]
        for i in over:
            fixed[i] = limit * sizes[i]
            left -= fixed[i]


def brute_sainte_lague(votes, seats):
    got = [0] * len(votes)
    for _ in range(seats):
        got[max(range(len(votes)), key=lambda i: (votes[i] / (2 * got[i] + 1), -i))] += 1
    return got


def test_apportionment():
    rng = random.Random(4)
    for _ in range(200):
        k = rng.randint(1, 12)
        sizes, weights = [rng.choice([0, 1, 7, rng.randint(0, 5000)]) for _ in range(k)], [(5, 2, 1)[i % 3] for i in range(k)]
        goal = mixing.targets(sizes, weights)
        assert np.allclose(goal, brute_targets(sizes, weights))
        votes, seats = [v + 0.01 * rng.random() for v in goal], rng.randint(0, 90)
        assert mixing.apportion(votes, seats) == brute_sainte_lague(votes, seats)
        by_shard = mixing.shard_quotas(votes, seats, 5)
        assert all(q >= 0 for row in by_shard for q in row) and [sum(c) for c in zip(*by_shard)] == mixing.apportion(votes, seats)


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_mixing(request, name):
    df = request.getfixturevalue(name)
    out = mixing.mix(df).collect()
    assert sorted(tuple(r)[:5] for r in out) == sorted(tuple(r)[:5] for r in mixing.mix(df.repartition(3)).collect())
    source = {r["doc_id"]: r["source"] for r in df.collect()}
    text = dict(pairs(df))
    total, taken, goal = Counter(), Counter(), {}
    for r in out:
        assert r["size"] == len(WORD.findall(text[r["doc_id"]] or ""))
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["passes"] * r["size"] + sum(c["to"] - c["from"] for c in r["cuts"])
        assert all(0 <= c["from"] < c["to"] <= r["size"] for c in r["cuts"])
        s = source[r["doc_id"]]
        total[s] += r["size"]
        taken[s] += r["taken"]
        goal[s] = (r["target"], r["source_size"])
    order = sorted(goal, key=lambda s: (s is None, s or ""))
    want = brute_targets([total[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))])
    for s, t in zip(order, want, strict=True):
        assert goal[s][1] == total[s] and abs(goal[s][0] - t) < 1e-6 * max(1, t) and abs(taken[s] - t) <= 2 * mixing.BLOCK_WORDS


def test_mixing_odd_rows(spark, empty):
    assert mixing.mix(empty).count() == 0
    none = spark.createDataFrame([(1, None, "a"), (1, "", "a"), (None, " ", None)], "doc_id long, text string, source string")
    assert {(r["size"], r["target"], r["taken"]) for r in mixing.mix(none).collect()} == {(0, 0.0, 0)}


# ---- 8 sharding


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_sharding(request, name):
    df = request.getfixturevalue(name)
    out, text = sharding.shard(df).collect(), dict(pairs(df))
    assert len(out) == df.count()
    slots, load, where = defaultdict(list), Counter(), defaultdict(set)
    for r in out:
        t = text[r["doc_id"]] or ""
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(t.encode()) + 1, zlib.crc32(t.encode()), "bytes", None)
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
        where[t].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    if name == "documents":
        assert max(load.values()) < 1.02 * sum(load.values()) / 8 and all(len(s) == 1 for s in where.values())


def test_sharding_odd_rows(spark, empty):
    assert sharding.shard(empty).count() == 0
    same = spark.range(4000).selectExpr("id AS doc_id", "IF(id < 3000, 'copy', CAST(id AS string)) AS text")
    n = Counter(r["shard"] for r in sharding.shard(same).collect())
    assert max(n.values()) < 560  # a group of three quarters of the rows is split
    repeated = spark.createDataFrame([(1, None), (1, None), (None, "x")], "doc_id long, text string")
    assert sharding.shard(repeated).count() == 3


# ---- 9 embeddings


def brute_vectors(rows, least=0.93):
    good = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = (label, np.asarray(v, float))
    links, comp = Counter(), {i: i for i, _, _ in rows}
    find = lambda i: i if comp[i] == i else find(comp[i])
    for a, b in itertools.combinations(good, 2):
        (la, x), (lb, y) = good[a], good[b]
        if la == lb and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
            links.update((a, b))
            x, y = sorted((find(a), find(b)))
            comp[y] = x
    return {(i, links[i], find(i), find(i) == i) for i in comp}


@pytest.mark.parametrize("chunk", [512, 4])
def test_vectors(spark, sf_dir, monkeypatch, chunk):
    monkeypatch.setattr(embedding, "CHUNK", chunk)
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in given.collect()]
    assert {tuple(r) for r in embedding.near_vectors(given).collect()} == brute_vectors(rows)
    rng = np.random.default_rng(1)
    rows, centre = [], rng.normal(size=64)
    for i in range(160):
        v = centre + rng.normal(size=64) * rng.choice([0.05, 0.2, 0.3, 0.5])
        rows.append((i * 2, [float(np.float32(x)) for x in v * rng.choice([1, 1e-3, 1e6])], int(i % 3) if i % 11 else None))
    rows += [(1000 + i, rows[1][1], 1) for i in range(9)] + [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 64, 1), (2003, [None] + [1.0] * 63, 1), (2004, [float("nan")] * 64, 1), (2005, [float("inf")] * 64, 1), (2006, [1.0, 2.0], 1), (2007, [2.0, 4.0], 1), (2008, [-0.0, 3.0], 2), (2009, [0.0, 3.0], 2)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, rep int, v string")
    assert {tuple(r) for r in embedding.near_vectors(df).collect()} == brute_vectors(rows)


def test_vectors_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert embedding.near_vectors(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (5, [1.0, 0.01], 1)], schema)
    got = Counter(tuple(r) for r in embedding.near_vectors(df).collect())
    assert got == Counter({(3, 2, 3, True): 2, (None, 0, None, True): 1, (5, 2, 3, False): 1})


# ---- 10 packing


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_packing(request, name):
    from tokenizers import Tokenizer

    df = request.getfixturevalue(name)
    tok = Tokenizer.from_file(tokens.default_path())
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in pairs(df)}
    out = packing.pack_documents(df).collect()
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in out:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        docs[r["doc_id"]].append((r["start"], r["length"]))
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    gapless = lambda spans, n: [a for a, _ in sorted(spans)] == list(itertools.accumulate([b for _, b in sorted(spans)], initial=0))[:-1] and (n is None or sum(b for _, b in spans) == n)
    assert all(gapless(s, len(ids[i])) for i, s in docs.items()) and docs.keys() == ids.keys()
    assert all(gapless(s, None) and sum(b for _, b in s) <= 2048 for s in seqs.values())
    if name == "documents":
        assert sum(map(len, ids.values())) / (2048 * len(seqs)) > 0.97


def test_packing_odd_rows(spark, empty):
    assert packing.pack_documents(empty).count() == 0
    out = packing.pack_documents(spark.createDataFrame([(1, None), (1, None), (None, "")], "doc_id long, text string")).collect()
    assert [r["length"] for r in out] == [1, 1, 1] and len({(r["sequence_id"], r["offset"]) for r in out}) == 3


def test_differencing():
    rng = random.Random(7)
    assert sorted(map(sorted, packing.difference([8, 7, 6, 5, 4], 2))) in ([[0, 3], [1, 2, 4]], [[0, 2], [1, 3, 4]], [[0, 4], [1, 2, 3]], [[0, 1], [2, 3, 4]])
    for _ in range(60):
        sizes, windows = [rng.randint(1, 512) for _ in range(rng.randint(0, 150))], rng.randint(1, 30)
        parts = packing.difference(sizes, windows)
        assert sorted(i for p in parts for i in p) == list(range(len(sizes))) and len(parts) <= windows
        assert all(sum(sizes[i] for i in p) <= 2048 for p in packing.pack(sizes, 2048))
    sizes = [rng.randint(200, 512) for _ in range(400)]
    sums = [sum(sizes[i] for i in p) for p in packing.difference(sizes, 70)]
    assert max(sums) - min(sums) < 0.05 * sum(sums) / 70

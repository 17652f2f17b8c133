"""Decontamination, the prefix trie and the repair of conversations, against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siftmill.llm import contamination, repair, trie
from siftmill.llm.common import positions

CONV = "conv_id long, turn long, role string, text string, n long, block long, path string, letter string, word string"
PLAIN = "conv_id long, turn long, role string, text string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ---- 11 decontamination


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def brute_contaminated(docs, items, size=10):
    own = {}
    for item, t in items:
        w = words(t)
        k = min(size, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            own.setdefault(tuple(w[i : i + k]), set()).add(item)
    out = []
    for doc, t in docs:
        w, hit, met = words(t), set(), set()
        for k in {len(g) for g in own}:
            for i in range(len(w) - k + 1):
                if (g := tuple(w[i : i + k])) in own:
                    hit |= set(range(i, i + k))
                    met |= own[g]
        met = sorted(str(x) for x in met if x is not None)
        out.append((doc, len(w), len(hit), len(met), digest(",".join(met)), bool(hit)))
    return Counter(out)


def judged(found):
    n = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["after"] - s["first"])
    rows = found.select("doc_id", "n_words", n.alias("n"), F.size("items").alias("k"), F.sha2(F.array_join("items", ","), 256).alias("d")).collect()
    return Counter((*r, r["n"] > 0) for r in rows)


@pytest.fixture(scope="module")
def leaky():
    rng = random.Random(4)
    word = lambda: rng.choice(["été", "Über", "a1", "X", "no", "yes", "2nd", "日本"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(30)] + [(3, "extra item of the same id here to be found now ok"), (None, "an item without any id of its own 1 2 3 4"), (40, None), (41, " -- ")]
    docs = []
    for i in range(150):
        parts = [" ".join(word() for _ in range(rng.randint(0, 12)))]
        for _ in range(rng.randint(0, 3)):
            w = words(rng.choice(items)[1])
            parts.append(rng.choice([" ", "--\n", "!"]).join(w[rng.randint(0, 3) :]).upper())
        docs.append((i, rng.choice(["; ", " ", "\t"]).join(parts)))
    docs += [(200, None), (201, ""), (202, " ... "), (203, docs[5][1]), (203, docs[5][1]), (None, docs[7][1]), (204, "z" * 3_000_000 + " " + "no yes " * 200_000)]
    return docs, items


@pytest.mark.parametrize("most", [10**9, 700])
def test_contaminated(spark, leaky, most):
    docs, items = leaky
    d = spark.createDataFrame([(*r, 0, "x") for r in docs], "doc_id long, text string, w long, items string").repartition(4)
    b = spark.createDataFrame([(*r, "y") for r in items], "item_id long, text string, w string")
    assert judged(contamination.contaminated(d, b, most_bytes=most)) == brute_contaminated(docs, items)


def test_places_in_the_text_as_it_was(spark):
    text = "Über-all: ÉTÉ  the quick, BROWN fox!"
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    b = spark.createDataFrame([("q", "The Quick brown"), ("r", "all")], "item_id string, text string")
    row = contamination.contaminated(d, b).first()
    assert [text[s["start"] : s["end"]] for s in row["spans"]] == ["all", "the quick, BROWN"] and row["items"] == ["q", "r"]
    assert [(s["first"], s["after"]) for s in row["spans"]] == [(1, 2), (3, 6)]


def test_contaminated_empty(spark, leaky):
    d, b = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert contamination.contaminated(d, b).first()["spans"] == [] and contamination.contaminated(d.limit(0), b).count() == 0


# ---- 12 prefix trie


def ordered(rows):
    """Conversation -> its turns (role, text) in order."""
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", hashlib.sha256(f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest())
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def brute_trie(paths):
    nodes = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            nodes.setdefault(tuple(p[:d]), []).append(c)
    kids = Counter(p[:-1] for p in nodes if p)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        saved = sum((len(nodes[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in members if len(paths[c]) == len(p))))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), kids[p], sum(not kids[q] for q in below), saved, digest(ends)))
    return Counter(out)


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = [*convs.get(c - c % 20 if c >= 0 else c + -c % 20, [])[:h], *own[h:]]
    return out


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(8)
    rows = []
    for c in [*range(0, 90, 1), *range(200, 230), -3, -20, -25, 10**12]:
        for t in range(rng.randint(1, 6)):
            rows.append((c, rng.choice([t, t, t, None, 0]), rng.choice(["user", "assistant", "system", None, "u", ""]), rng.choice(["a", "a b", "Well.", "c d  e", None, "", " \t", "é ?"])))
    rows += [(500 + i, 0, "user", "same first") for i in range(150)] + [(500 + i, 1, "assistant", f"then {i % 3}") for i in range(140)]
    rows += [(900, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(150)] + [(901, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(120)]
    return [*rows, (None, 1, "user", "no conversation"), (77, 3, "user", "x" * 2_000_000)]


@pytest.mark.parametrize("shards, deep, piece", [(256, 64, 5000), (7, 2, 3), (1, 1, 2)])
def test_prefix_trie(spark, talks, monkeypatch, shards, deep, piece):
    monkeypatch.setattr(trie, "PIECE", piece)
    monkeypatch.setattr(trie, "LOOKS", 2)
    df = spark.createDataFrame([(*r, 0, 0, "p", "l", "w") for r in talks], CONV).repartition(5)
    paths = trie.conversation_paths(df)
    own = ordered(talks)
    assert Counter(tuple(r) for r in trie.prefix_trie(paths, shards, deep).collect()) == brute_trie(own)
    if shards == 7:
        assert Counter(tuple(r) for r in trie.prefix_trie(trie.rebuilt(paths), shards, deep).collect()) == brute_trie(rebuilt(own))


def test_prefix_trie_odd(spark):
    none = spark.createDataFrame([], PLAIN)
    assert trie.prefix_trie(trie.conversation_paths(none)).count() == 0
    turnless = spark.createDataFrame([(9, []), (7, [])], "conv_id long, turns array<string>")
    assert [tuple(r) for r in trie.prefix_trie(turnless).collect()] == [(7, 0, None, 2, 0, 1, 0, digest("7,9"))]


def test_a_splitter_bears_the_prefix_of_every_shared_node():
    """What is outside the skeleton has all its members in one shard, whatever the splitters."""
    rng = random.Random(2)
    turn = lambda: bytes([rng.randint(0, 2)]) * 16 + (1).to_bytes(8, "big")
    paths = sorted({b"".join(turn() for _ in range(rng.randint(0, 6))) for _ in range(300)})
    for n in (1, 5, 40):
        cuts = sorted({p[: 3 * trie.TURN] for p in rng.sample(paths, n)} - {b""})
        bones, at = trie.skeleton_of(cuts), {}
        for p in paths:
            for i in range(0, len(p) + 1, trie.TURN):
                at.setdefault(p[:i], set()).add(sum(c <= p for c in cuts))
        assert all(q in bones or len(s) == 1 for q, s in at.items())


# ---- 13 structure repair


def brute_damage(rows):
    out = []
    for c, t, role, text in rows:
        if c is None:
            continue
        role, text = " " if role is None else role, " " if text is None else text
        f = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        if f:
            row = (c, t, "user" if f == 4 else role, "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text)
            out += [row, row] if f == 3 else [row]
    return out


def brute_repair(rows, ids):
    """The least (cost, audit) over all edits, by a table over whole strings from the end."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    names = {"u": "user", "a": "assistant"}
    out = set()
    for c in ids:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).hexdigest()))
        faults, seen = [], set()
        for _, _, role, text in own:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            faults.append("b" if not last else "d" if (role, text) in seen else "t" if last[0] not in ".!?" else "")
            seen.add((role, text))
        best = {0: (0, "", ()), 3: (0, "", ())}
        for r, fault in [*reversed(list(zip(own, faults, strict=True))), None][:-1]:
            best = closed(best, step, names)
            now = {}
            for s in range(4):
                offers = [(3 + best[s][0], "D" + best[s][1], best[s][2])] if s in best else []
                if fault not in ("b", "d"):
                    more = fault == "t"
                    for ch, cost, a, role in [(r[2][:1], 0, "K", r[2]), ("u", 2, "R", "user"), ("a", 2, "R", "assistant")]:
                        if (s, ch) in step and step[s, ch] in best:
                            b = best[step[s, ch]]
                            offers.append((cost + more + b[0], a + b[1], (f"{role}:{r[3]}", *b[2])))
                if offers:
                    now[s] = min(offers)
            best = now
        best = closed(best, step, names)
        turns = [r[1] for r in own if r[1] is not None]
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, text = best[0] if own else (0, "", ())
        out.add((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest("\n".join(text))))
    return out


def closed(best, step, names):
    for _ in range(4):
        for (s, c), x in step.items():
            if c != "s" and x in best:
                new = (2 + best[x][0], "I" + best[x][1], (names[c] + ":", *best[x][2]))
                best = {**best, s: min(best.get(s, new), new)}
    return best


@pytest.mark.parametrize("block", [4096, 3, 1])
def test_repaired(spark, talks, block):
    df = spark.createDataFrame([(*r, 0, 0, "p", "l", "w") for r in talks], CONV).repartition(5)
    ids = sorted({r[0] for r in talks if r[0] is not None})
    broken = repair.damaged(df)
    rows = brute_damage(talks)
    assert Counter(tuple(r) for r in broken.collect()) == Counter(rows)
    got = repair.repaired(broken, df.where("conv_id IS NOT NULL").select("conv_id"), block)
    assert {tuple(r) for r in got.collect()} == brute_repair(rows, ids)


def test_repaired_long_and_empty(spark):
    """A conversation of 20,000 turns in blocks equals one in a single block; no rows, no result but zeros."""
    turns = spark.range(20_000).selectExpr("5L AS conv_id", "id AS turn", "IF(id % 7 = 3, 'assistant', IF(id % 2 = 0, 'user', 'assistant')) AS role", "concat('t', id, IF(id % 5 = 0, '', '.')) AS text")
    ids = turns.select("conv_id").limit(1)
    small, whole = (repair.repaired(turns, ids, block).first() for block in (512, 100_000))
    assert small == whole and small["illegal"] > 1000 and len(small["audit"]) >= 20_000
    none = repair.repaired(turns.limit(0), spark.createDataFrame([(3,)], "conv_id long")).collect()
    assert [tuple(r) for r in none] == [(3, 0, 0, 0, 0, 0, 0, "", digest(""))]
    assert repair.repaired(turns.limit(0), ids.limit(0)).count() == 0


def test_crossings_are_least():
    """The division gives the same cost and audit as trying all ways."""
    rng = random.Random(6)
    for _ in range(300):
        letters = "".join(rng.choice("ABCDEFGHIJKLMNOP") for _ in range(rng.randint(0, 5))) + repair.END
        level = {0: [(0, "")]}
        for c in letters:
            nxt = {}
            for s, own in level.items():
                for x, cost, audit, _ in repair.TABLE[c][s]:
                    nxt.setdefault(x, []).extend((k + cost, a + audit) for k, a in own)
            level = nxt
        cost, edits = repair.edits_of(letters, 0, 0)
        assert (cost, edits.translate(str.maketrans("uaUA", "IIRR"))) == min(level[0])


def test_positions(spark):
    rows = [(g, v) for g in range(3) for v in [None, 5, 1, 1, 9][: g + 3]] + [(7, i) for i in range(500)]
    df = spark.createDataFrame(rows, "g long, v long").repartition(6)
    got = {}
    for r in positions(df, ["g"], ["v"]).collect():
        got.setdefault(r["g"], []).append((r["n"], r["v"]))
    for g, own in got.items():
        want = sorted((v for k, v in rows if k == g), key=lambda v: (v is not None, v or 0))
        assert [v for _, v in sorted(own, key=lambda p: p[0])] == want and sorted(n for n, _ in own) == list(range(len(want)))

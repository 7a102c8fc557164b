"""The prefix trie, SimHash classes and the ranked search against brute force on small tables with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from starloom.llm import lexical, simhash, trie

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPLIT = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


# --- the prefix trie -------------------------------------------------------------------------------------------------

def dialogue():
    """Conversations with common beginnings, equal ones, prefixes of others, a long one and odd rows."""
    random.seed(11)
    rows = []
    for c in [*range(0, 70), 400, 419, 1007]:
        length = random.choice([1, 1, 2, 3, 4, 6])
        start = random.choice([0, 0, 1])
        for turn in range(length):
            rows.append((c, turn, ["user", "assistant"][turn % 2], f"say {start} {turn if turn < 3 else random.choice('ab')}  two\twords"))
    rows += [(500, t, "user", f"long {t // 3}") for t in range(300)] + [(501, t, "user", f"long {t // 3}") for t in range(290)]
    rows += [(502, None, None, "first"), (502, 1, "user", None), (502, 2, "user", ""), (None, 1, "user", "nobody"), (503, 5, None, None)]
    rows += [(c, 0, "system", "the same\x00 Ü") for c in range(600, 640)]
    return rows


def brute_trie(rows, graft):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [x for _, x in sorted(v, key=lambda r: r[0])] for c, v in own.items()}
    built = own
    if graft:
        built = {}
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % 4
            built[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own_members in members.items():
        gain = (len(own_members) - 1) * len(re.findall(SPLIT, p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += gain
            leaves[p[:d]] += kids[p] == 0
    out = Counter()
    for p, own_members in members.items():
        ends = ",".join(str(c) for c in sorted(own_members) if len(built[c]) == len(p))
        out[min(own_members), len(p), min(members[p[:-1]]) if p else None, len(own_members), kids[p], leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("graft,piece", [(False, 1), (True, 3), (True, 64)])
def test_trie_equals_brute_force(spark, monkeypatch, graft, piece):
    monkeypatch.setattr(trie, "LIST_IDS", 7)
    rows = dialogue()
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "conv_id long, turn int, role string, text string, c string, n string, depth string").repartition(5)
    f = trie.grafted_trie if graft else trie.trie
    got = Counter(tuple(r) for r in f(table, piece=piece).select(*NODE).collect())
    assert got == brute_trie(rows, graft)


def test_trie_of_an_empty_table_and_of_turnless_conversations(spark):
    ddl = "conv_id long, turn int, role string, text string"
    assert trie.grafted_trie(spark.createDataFrame([], ddl)).collect() == []
    # crc32("22") % 4 is 1 or more: the only own turn goes, and there is no conversation 20 to take turns from.
    lone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4)
    rows = [(lone, 0, "user", "gone")]
    got = trie.grafted_trie(spark.createDataFrame(rows, ddl)).select(*NODE).collect()
    assert Counter(tuple(r) for r in got) == brute_trie(rows, True)
    assert (got[0].depth, got[0].n_leaves, got[0].parent_conv_id) == (0, 1, None)


def test_extents_equal_a_scan():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 33):
        lcp = rng.integers(-1, 4, n)
        at, depth = rng.integers(0, n, 50), rng.integers(0, 4, 50)
        left, right = trie.extents(trie.minima(lcp), at, depth)
        for i, d, a, b in zip(at.tolist(), depth.tolist(), left.tolist(), right.tolist()):
            low = i
            while low > 0 and lcp[low] >= d:
                low -= 1
            high = i
            while high + 1 < n and lcp[high + 1] >= d:
                high += 1
            assert (a, b) == (low, high)
        assert trie.least_of(trie.minima(lcp), left, right).tolist() == [int(lcp[a : b + 1].min()) for a, b in zip(left.tolist(), right.tolist())]


# --- SimHash ---------------------------------------------------------------------------------------------------------

def brute_fingerprint(text):
    words = re.findall(SPLIT, (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def texts(n=260):
    random.seed(12)
    words = ["the", "Über", "data", "X9", "of", "stream", "wörd", "join", "日本", "leaf", "nul\x00", "ß"]
    out = [None, "", " \n\t", "one", "ONE", "one two", "one two three", "a" * 4000]
    base = [[random.choice(words) + str(random.randrange(40)) for _ in range(150)] for _ in range(n // 6)]
    for w in base:
        for k in range(5):
            w = list(w)
            if k:
                w[random.randrange(len(w))] = "changed"
            out.append(" ".join(w))
    return [*out, out[10], out[10].upper()]


def brute_classes(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                up[root(i)] = root(j)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)].append(key)
    return Counter((key, f"{prints[i]:016x}", min(least[root(i)], default=None)) for i, (key, _) in enumerate(rows))


@pytest.mark.parametrize("block,sub,fine", [(4096, 128, 4_000_000), (4, 2, 4_000_000), (3, 2, 0)])
def test_simhash_classes_equal_brute_force(spark, monkeypatch, block, sub, fine):
    monkeypatch.setattr(simhash, "SUB", sub)
    monkeypatch.setattr(simhash, "FINE", fine)
    rows = [*enumerate(texts(260 if block > 100 else 60)), (None, "nobody's own text here"), (7, "one two three"), (7, "another text under seven")]
    table = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], "doc_id long, text string, fp string, id string, tile string").repartition(3)
    got = simhash.classes(table, block=block)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(tuple(r) for r in got.collect()) == brute_classes(rows)
    assert simhash.classes(table.where("false")).collect() == []


def test_forest_spans_each_component_once():
    rng = np.random.default_rng(5)
    for _ in range(30):
        link = rng.random((9, 12)) < 0.12
        (rows, r), (cols, c) = simhash.forest(link)
        label = {("r", int(i)): int(j) for i, j in zip(rows, r)} | {("c", int(i)): int(j) for i, j in zip(cols, c)}
        for i, j in np.argwhere(link).tolist():
            assert label["r", i] == label["c", j]
        for (kind, i), own in label.items():  # a label is the first row of what is connected with it
            seen, waiting = set(), [(kind, i)]
            while waiting:
                x = waiting.pop()
                if x not in seen:
                    seen.add(x)
                    waiting += [("c", j) for j in range(12) if x[0] == "r" and link[x[1], j]] + [("r", j) for j in range(9) if x[0] == "c" and link[j, x[1]]]
            assert own == min(j for side, j in seen if side == "r")


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(2000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "HASHES", 7)
    assert simhash.fingerprint(text.encode()) == whole == brute_fingerprint(text)


# --- ranked search ---------------------------------------------------------------------------------------------------

def brute_search(docs, items, k):
    terms = lambda t: re.findall(TERM, (t or "").translate(LOWER))
    held = [(key, Counter(terms(t))) for key, t in docs]
    held = [(key, c) for key, c in held if c]
    n, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for key, c in held:
            m = 75 + 25 * c.total() * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, key is None, key or 0, key))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("shard,block_terms", [(65_536, 1_000_000), (7, 15)])
def test_search_equals_brute_force(spark, monkeypatch, shard, block_terms):
    monkeypatch.setattr(lexical, "SHARD_DOCUMENTS", shard)
    monkeypatch.setattr(lexical, "STEP", 2)
    random.seed(13)
    words = [f"w{i}" for i in range(60)] + ["Über", "日本", "naïve", "X9"]
    some = lambda n: " ".join(random.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=n))
    docs = [(i, some(random.choice([1, 5, 20, 60]))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "..."), (None, "w1 w2"), (None, None), (5, docs[5][1]), *((300 + i, "tied w3 words") for i in range(30)), (400, "w0 " * 3000)]
    items = [(i, some(random.choice([1, 3, 12]))) for i in range(12)] + [(20, None), (21, ""), (22, "nowhere"), (23, "tied w3 w3"), (24, "X9 x9, ÜBER Über")]
    table = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, score string, query string").repartition(3)
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rank string")
    got = lexical.search(table, asked, k=20, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == brute_search(docs, items, 20)
    assert lexical.search(table.where(F.lit(False)), asked).collect() == []
    assert lexical.search(table, asked.where(F.lit(False))).collect() == []


def test_search_stops_before_the_end_of_its_lists():
    """Few documents hold the rare term; its list and the best positions end the search early, ties included."""
    rng = np.random.default_rng(7)
    count = 5000
    tf = rng.integers(1, 40, count).astype(np.int32)
    rare = np.arange(count) % 50 == 0
    terms = [np.array([0, 1] if r else [0], np.int32).tobytes() for r in rare]
    tfs = [np.array([x, 40] if r else [x], np.int32).tobytes() for x, r in zip(tf, rare)]
    shard = lexical.Shard(np.arange(count), list(range(count)), np.full(count, 50), terms, tfs, count, 50 * count)
    top, score, scored = lexical.best(shard, np.array([0, 1]), np.array([1, 5000]), 20)
    assert scored < count / 4
    impact = lambda x: 10**9 * x // (1000 * x + 12 * 100)
    full = np.array([impact(int(x)) + (5000 * impact(40) if r else 0) for x, r in zip(tf, rare)])
    order = np.lexsort((np.arange(count), -full))[:20]
    assert top.tolist() == order.tolist() and score.tolist() == full[order].tolist()

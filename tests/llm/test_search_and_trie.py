"""The prefix trie, ranked lexical search and nearest neighbours against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from millrace.llm import lexical, prefix_trie, vector_search
from pyspark.sql import functions as F

TURNS = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# --- trie


def plain_trie(rows):
    own = {}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", digest(r[3] or ""))
    for r in sorted((r for r in rows if r[0] is not None), key=order):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = (own.get(c - int(math.fmod(c, 20)), [])[:h]) + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[:-1] == n for m in below if len(m) == len(n) + 1)]
        saved = sum((len(members[n]) - 1) * len(WORD.findall(n[-1][1])) for n in below if n)
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(frame):
    return sorted(map(tuple, prefix_trie.prefix_trie(frame).collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_plain_one(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 70), 45):
        for t in range(rng.choice([1, 1, 2, 3, 5, 9, 17])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "d  e\tf"])))
    rows += [(200 + k, t, "user", f"same {t}") for k in range(30) for t in range(4)]  # many alike
    rows += [(500, k // 3, rng.choice(["", None, "user"]), rng.choice([None, "x"])) for k in range(40)]  # ties, nulls
    rows += [(500, 3, "user", "x")] * 3 + [(501, None, None, None), (None, 1, "user", "lost")]
    rows += [(601, 0, "user", "gone")]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, TURNS).withColumn("depth", F.lit("x")).withColumn("conv", F.lit(1))
    assert trie(frame) == plain_trie(rows)


def test_deep_conversation_and_blocks_of_ranges(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SPREAD", 4)
    monkeypatch.setattr(prefix_trie, "PIECE_CHARS", 5)
    rows = [(c, t, "user", f"w {t}" if c < 28 else f"{c} {t}") for c, n in ((20, 70), (25, 64), (28, 33)) for t in range(n)]
    rows += [(40 + k, t, "user", "ends") for k in range(50) for t in range(5)]
    assert trie(spark.createDataFrame(rows, TURNS)) == plain_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert trie(spark.createDataFrame([], TURNS)) == []
    lost = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(lost, 0, "user", "a"), (lost, 1, "user", "b")]
    assert trie(spark.createDataFrame(rows, TURNS)) == plain_trie(rows) == [
        (lost, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lost).encode()).hexdigest())
    ]


# --- ranked search


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_search(docs, items):
    terms = [(key, TERM.findall(lower(text or ""))) for key, text in docs]
    terms = [(key, found) for key, found in terms if found]
    n, total = len(terms), sum(len(found) for _, found in terms)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(TERM.findall(lower(text or "")))
    out = []
    for item, wanted in asked.items():
        scores = []
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in set(f) for _, f in terms) + 1))) for t in wanted}
        for key, found in terms:
            m = 100 - 90 + (90 * len(found) * n) // total
            score = sum(weight[t] * ((10**9 * found.count(t)) // (1000 * found.count(t) + 8 * m)) for t in wanted if t in found)
            if score > 0:
                scores.append((-score, key is None, key if key is not None else 0, key))
        out += [(item, k + 1, key, -s) for k, (s, _, _, key) in enumerate(sorted(scores)[:10])]
    return sorted(out, key=repr)


def searched(docs, items):
    return sorted(map(tuple, lexical.search(docs, items).collect()), key=repr)


@pytest.mark.parametrize("bits", [1 << 18, 64])
def test_search_equals_plain_scores(spark, monkeypatch, bits):
    """Also with signatures so full that they exclude nothing, and with several slices of items."""
    monkeypatch.setattr(lexical, "MOST_BITS", bits)
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 16)
    monkeypatch.setattr(lexical, "PAIRS_AT_ONCE", 30)
    if bits == 64:
        monkeypatch.setattr(lexical, "PAIRS", 60)
    rng = random.Random(bits)
    words = ["Zeta", "ÄRGER", "ärger", "x1", "日本", "don't", "K", "the"] + [f"w{k}" for k in range(60)]
    text = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", ".", "\n"]) for _ in range(n))
    docs = [(k, text(rng.choice([1, 3, 20, 80]))) for k in range(150)]
    docs += [(1000 + k, "zeta copied text w1 w2") for k in range(40)]  # ties
    docs += [(7, "zeta"), (7, "zeta"), (None, "zeta w1"), (500, None), (501, ""), (502, " .-\x7f"), (503, "the " * 40_000 + "w3 w4")]
    items = [(k, text(rng.randint(1, 15))) for k in range(12)] + [(50, "nowhere"), (51, None), (52, "..."), (3, "zeta"), (60, "zeta copied")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(1)).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("r"))
    assert searched(frame, asked) == plain_search(docs, items)


def test_search_of_nothing_and_text_keys(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "one")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "ONE")], "item_id string, text string")
    assert [r[:3] for r in searched(docs, items)] == [("q", 1, None), ("q", 2, "a"), ("q", 3, "b")]
    assert searched(docs.limit(0), items) == searched(docs, items.limit(0)) == []


def test_signatures_never_miss_a_term():
    rng = np.random.default_rng(1)
    docs = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 7, 300)]
    for bits in (64, 5000):
        rows = np.frombuffer(lexical.sliced(docs, bits), np.uint8).reshape(bits, -1)
        for k, own in enumerate(docs):
            held = np.unpackbits(np.bitwise_and.reduce(rows[lexical.slots(own, bits)], axis=1), axis=1)[:, k]
            assert held.all()


# --- nearest neighbours

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_nearest(vectors, queries, top=20):
    keys = sorted(vectors)
    matrix = np.array([vectors[k] for k in keys], np.float64)
    out = {}
    for q in queries:
        scores = np.zeros(len(keys))
        for j in range(matrix.shape[1]):
            scores += matrix[:, j] * matrix[keys.index(q), j]
        best = sorted((-s, k) for s, k in zip(scores, keys, strict=True) if k != q)[:top]
        out[q] = [(k, -s) for s, k in best]
    return out


def found(frame):
    out = {}
    asked = frame.filter(F.col("vec_id") % 20 == 0)
    for r in vector_search.nearest(frame, asked).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    hits = sum(len({k for k, _ in got[q]} & {k for k, _ in want[q]}) for q in want)
    return hits / sum(len(w) for w in want.values())


def test_recall_on_the_table_is_nine_tenths_at_least(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in frame.collect()}
    want = plain_nearest(vectors, [k for k in vectors if k % 20 == 0])
    got = found(frame)
    assert recall(got, want) >= 0.9
    exact = {q: dict(plain) for q, plain in plain_nearest(vectors, list(want)[:20], len(vectors)).items()}
    for q, scores in exact.items():
        assert all(scores[k] == s for k, s in got[q])
        assert got[q] == sorted(got[q], key=lambda p: (-p[1], p[0]))


def test_copies_norms_and_rows_that_take_no_part(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "CHUNK", 50)
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 12)).astype(np.float32) * rng.uniform(0.1, 4, (300, 1)).astype(np.float32)
    vectors = {k: base[k].tolist() for k in range(300)}
    vectors |= {1000 + k: base[5].tolist() for k in range(200)}  # one vector many times, queries among them
    odd = [(2000, None), (2020, []), (2040, [0.0] * 12), (2060, [math.nan] * 12), (2080, [math.inf] + [1.0] * 11)]
    odd += [(2100, [None] + [1.0] * 11), (2120, [1.0] * 5), (None, [1.0] * 12), (40, [9.0] * 12)]
    rows = [(k, v, 1) for k, v in [*vectors.items(), *odd]]
    vectors[40] = min(vectors[40], [9.0] * 12)
    frame = spark.createDataFrame(rows, VECTORS).withColumn("list", F.lit("x")).repartition(4)
    want, got = plain_nearest(vectors, [k for k in vectors if k % 20 == 0]), found(frame)
    assert set(got) == set(want)
    assert recall(got, want) >= 0.9
    assert got[1000][:19] == want[1000][:19]
    for q in got:
        assert all(k != q for k, _ in got[q]) and len(got[q]) == 20


def test_few_vectors_are_all_found(spark):
    frame = spark.createDataFrame([(k, [float(k), 1.0], 0) for k in range(9)], VECTORS)
    assert found(frame) == plain_nearest({k: [float(k), 1.0] for k in range(9)}, [0])
    assert found(frame.filter("vec_id = 0")) == found(frame.limit(0)) == {}


def test_abandoned_candidates_are_hardly_ever_near():
    rng = np.random.default_rng(9)
    points = rng.standard_normal((2000, 64)).astype(np.float32)
    queries = rng.standard_normal((20, 64)).astype(np.float32)
    full = ((points[None] - queries[:, None]) ** 2).sum(axis=2)
    limits = np.partition(full, 20, axis=1)[:, 20]
    q, v = vector_search.scan(np.ascontiguousarray(points.T), queries, limits.astype(np.float64), 21)
    near = {(a, b) for a, b in zip(*np.nonzero(full <= limits[:, None] * 0.9999), strict=True)}
    kept = set(zip(q.tolist(), v.tolist(), strict=True))
    assert len(near - kept) <= 0.02 * len(near)
    assert len(kept) < 0.2 * full.size

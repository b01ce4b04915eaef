"""Operators over several rows: the URL sweep, the Jaccard join, decontamination."""

from __future__ import annotations

import random

import numpy as np
import pytest

from millrace.llm import common, components, jaccard, templates, urls
from pyspark.sql import functions as F

DOCS = "doc_id long, text string"


# --- hashes


def test_word_hashes_do_not_depend_on_the_place(monkeypatch):
    text = "alpha beta\ngamma  alpha\x0b" + "z" * 200 + " beta é"
    words = text.encode().split()
    hashes = common.word_hashes(text.encode())
    assert len(hashes) == len(words)
    assert all((hashes[i] == hashes[j]) == (words[i] == words[j]) for i in range(len(words)) for j in range(len(words)))
    monkeypatch.setattr(common, "BLOCK", 7)
    assert (common.word_hashes(text.encode()) == hashes).all()


def test_shingles_are_those_of_the_words():
    rng = random.Random(2)
    for _ in range(300):
        words = [rng.choice("abcde") for _ in range(rng.randint(0, 20))]
        want = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
        assert len(common.shingles(" ".join(words))) == len(want)
    assert len(common.shingles(None)) == len(common.shingles(" \n")) == 0


# --- URLs


def plain_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, v in rules:
        if h is None or p is None:
            continue
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len(h + p), len(h), v == "block")
            best = max(best or (rank, h + p, v), (rank, h + p, v))
    return (host, path, best[1], best[2]) if best else (host, path, None, "allow")


@pytest.mark.parametrize("ranges", [1, 5, 16])
def test_urls_equal_all_rules_on_all_urls(spark, ranges):
    rng = random.Random(ranges)
    labels = ["com", "net", "a", "b", "example", "www", ""]
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))) for _ in range(30)]
    paths = ["", "/", "/en", "/en/", "/en/x", "/fr/é"]
    rules = [(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(25)]
    rules += [(None, "/", "block"), ("com", None, "block")]
    rows = [(k, f"{rng.choice(['http', 'x'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=://', '#f'])}") for k in range(400)]
    rows += [(1000 + k, "HTTP://WWW.Example.com/en/x") for k in range(300)]
    rows += [(2000, None), (2001, ""), (2002, "no scheme"), (2003, "a://"), (2004, "x://com/" + "y" * 50_000), (None, "a\nb://com\n/z")]
    frame = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit(7)).withColumn("key", F.lit("k"))
    known = spark.createDataFrame(rules, urls.RULE_SCHEMA)
    out = {r.page_id: r for r in urls.judge_urls(frame, known, ranges=ranges).collect()}
    assert len(out) == len(rows)
    for key, url in rows:
        r = out[key]
        assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(url, rules), (url, rules)
        assert r.key == "k"


def test_no_urls_and_no_rules(spark):
    rules = spark.createDataFrame([], urls.RULE_SCHEMA)
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert urls.judge_urls(pages, rules).first().verdict == "allow"
    assert urls.judge_urls(pages.limit(0), rules).count() == 0


# --- Jaccard join


def plain_components(rows):
    sets = [(k, set(common.shingles(t).tolist())) for k, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (k, _) in enumerate(sets):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted(((k, len(s), least.get(find(i), k)) for i, (k, s) in enumerate(sets)), key=repr)


def corpus(seed, groups, copies, words):
    """Groups of near copies of every degree, a passage that most documents share, and copies."""
    rng = random.Random(seed)
    shared = [f"s{k}" for k in range(30)]
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(10_000)}" for _ in range(rng.randint(3, words))]
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10_000)}"
            if g % 2:
                text = text[: len(text) // 2] + shared + text[len(text) // 2 :]
            rows.append((len(rows), " ".join(text)))
    return rows + [(10_000 + k, rows[k % 7][1].upper()) for k in range(20)]


@pytest.mark.parametrize("seed, frequent, block", [(1, 64, 4096), (2, 3, 8), (3, 3, 4096)])
def test_components_equal_all_pairs(spark, monkeypatch, seed, frequent, block):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    monkeypatch.setattr(jaccard, "CHUNK_ROWS", 5 * block)
    rows = corpus(seed, 30, 14, 120)
    rows += [(20_000, None), (20_001, ""), (20_002, " \n"), (20_003, "one"), (20_004, "ONE"), (None, "one")]
    out = jaccard.jaccard_join(spark.createDataFrame(rows, DOCS).withColumn("d", F.lit("clash")))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)
    want = plain_components(rows)
    assert [g for g in got if g[0] is not None] == [w for w in want if w[0] is not None]
    assert len(got) == len(rows)


def test_bounds_never_rule_out_a_link():
    rng = np.random.default_rng(1)
    for _ in range(400):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        drop = int(rng.integers(0, max(1, len(a) // 8)))
        b = np.unique(np.concatenate((a[drop:], rng.integers(0, 1 << 63, int(rng.integers(0, max(1, n // 8)))).astype(np.uint64))))
        if len(b) and jaccard.linked(a, b):
            for each in (jaccard.COARSE, jaccard.FINE):
                assert jaccard.may_link(jaccard.sketch(a, each), jaccard.sketch(b, each), len(a), len(b))
            pa, pb = a[: jaccard.prefix_length(len(a))], b[: jaccard.prefix_length(len(b))]
            assert len(np.intersect1d(pa, pb))


def test_join_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert jaccard.jaccard_join(empty).count() == 0
    lone = jaccard.jaccard_join(spark.createDataFrame([(3, None), (4, None)], DOCS)).collect()
    assert sorted(map(tuple, lone)) == [(3, 0, 3), (4, 0, 4)]


def test_components_of_long_paths(spark):
    path = [(k, k + 1) for k in range(100)] + [(500, 501), (501, 502), (500, 502), (7, 7)]
    edges = spark.createDataFrame(path, "a long, b long")
    out = {r.node: r.component for r in components.components(edges).collect()}
    assert out == {k: 0 for k in range(101)} | {k: 500 for k in (500, 501, 502)}


# --- decontamination

ITEM = "If Anna has 12 apples and buys 5 kg of pears at the old market, how many coins does she pay to the seller today?"
OTHER = "if Bob has 99 apples and buys 7 lb of pears at the old market, how many coins does she pay to the seller today?"


def test_questions_with_other_values_are_found(spark):
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "too short"), (5, ITEM.lower())], "item_id long, text string")
    docs = [
        (1, f"Some words. {ITEM} More words."), (2, f"Some words. {OTHER}"), (3, ITEM.upper()),
        (4, "nothing in common with any of the questions that are asked there"), (5, None), (6, ""),
        (7, " ".join(ITEM.split()[:8])), (8, f"{OTHER} {OTHER}"), (8, f"{OTHER} {OTHER}"), (9, "padding words " * 20_000 + ITEM),
    ]
    frame = spark.createDataFrame(docs, DOCS).withColumn("window", F.lit("clash"))
    out = [r for r in templates.contaminated(frame, items).collect() if r.item_id == 1]
    assert {r.doc_id for r in out} >= {1, 2, 8, 9}
    assert not {r.doc_id for r in out} & {4, 5, 6, 7}
    assert len(out) == len({r.doc_id for r in out})
    by_doc = {r.doc_id: r for r in out}
    assert by_doc[1].coverage == 1.0 and not by_doc[1].reparameterised
    assert by_doc[2].reparameterised


def test_one_value_has_to_stand_for_one(spark):
    item = "Say that Anna gave 4 coins to her friend and then Anna took 4 more coins from the big box over there"
    same = item.replace("Anna", "Carl").replace("4", "9")
    mixed = same.replace("Carl took 9", "Dora took 8")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = templates.contaminated(spark.createDataFrame([(1, same), (2, mixed)], DOCS), items)
    assert [r.doc_id for r in out.collect()] == [1]


def test_decontamination_of_nothing(spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    docs = spark.createDataFrame([(1, ITEM)], DOCS)
    assert templates.contaminated(docs.limit(0), items).count() == 0
    assert templates.contaminated(docs, items.limit(0)).count() == 0

"""Every link of the Jaccard join, against all pairs."""

from __future__ import annotations

import random

from millrace.llm import common, jaccard


def test_links_inside_a_component_are_listed_and_counted(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 7)
    rng = random.Random(12)
    rows, key = [], 0
    for size in (40, 3):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(150)]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"v{rng.randint(0, 10**6)}"
            rows += [(key + c, " ".join(words)) for c in range(rng.choice([1, 1, 3]))]
            key += 3
    rows += [(9000, None), (9001, ""), (None, rows[0][1]), (9002, "alone of its kind here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    documents, links = jaccard.jaccard_links(frame)

    sets = [set(common.shingles(t).tolist()) for _, t in rows]
    near = lambda x, y: bool(x) and bool(y) and 100 * len(x & y) >= 80 * len(x | y)
    want = {
        k: sum(near(x, y) for j, y in enumerate(sets) if j != i)
        for i, ((k, _), x) in enumerate(zip(rows, sets, strict=True))
    }
    out = documents.collect()
    assert len(out) == len(rows)
    assert {r.doc_id: r.n_links for r in out} == want
    distinct = {jaccard.digest(common.shingles(t)): x for (_, t), x in zip(rows, sets, strict=True) if x}
    pairs = {(a, b) for a in distinct for b in distinct if a < b and near(distinct[a], distinct[b])}
    got = [(r.set_a, r.set_b) for r in links.collect()]
    assert len(got) == len(set(got)) and set(got) == pairs
    assert len(pairs) > len(distinct)

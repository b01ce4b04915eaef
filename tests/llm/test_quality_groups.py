"""Estimates of groups with much junk, and of small groups."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest

from millrace.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string"


def clean(rng, length=(2, 9), size=(60, 400), letters="etaoin"):
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(*length)))
    return " ".join(word() for _ in range(rng.randint(*size)))


def judged(spark, rows):
    return {r.doc_id: r.kept for r in quality.judge_quality(spark.createDataFrame(rows, SCHEMA)).collect()}


@pytest.mark.parametrize("share, alike", [(0.26, False), (1 / 3, True), (0.4, True)])
def test_much_junk_of_one_source_goes(spark, share, alike):
    rng = random.Random(int(share * 100))
    n = 600
    rows = [(k, clean(rng), "en", "a") for k in range(n)]
    junk = round(n * share / (1 - share))
    copy = clean(rng, size=(100, 100)).replace(" ", "### ")
    rows += [(1000 + k, copy if alike else clean(rng).replace(" ", "### "), "en", "a") for k in range(junk)]
    out = judged(spark, rows)
    assert all(out[k] for k in range(n))
    assert not any(out[1000 + k] for k in range(junk))


def test_a_small_source_is_judged_by_itself(spark):
    rng = random.Random(3)
    rows = [(k, clean(rng, length=(2, 4)).replace(" ", "* "), "en", "a") for k in range(300)]
    rows += [(1000 + k, clean(rng, length=(14, 22)), "en", "b") for k in range(300)]
    rows += [(2000 + k, clean(rng), "en", "c") for k in range(150)]
    rows += [(3000 + k, clean(rng, length=(14, 22)), "en", "c") for k in range(15)]
    out = judged(spark, rows)
    assert all(kept for key, kept in out.items() if key < 3000)
    assert not any(kept for key, kept in out.items() if key >= 3000)


# --- the estimates against one machine


P = len(quality.STATISTICS)
FLOOR = np.diag(np.square(np.array(quality.FLOOR) * quality.STEP))


def moments_of(x, weights):
    mean = (x * weights[:, None]).sum(0) / weights.sum()
    return mean, (x * weights[:, None]).T @ x / weights.sum() - np.outer(mean, mean)


def distances(x, mean, inverse):
    gap = x - mean
    return ((gap @ inverse) * gap).sum(1)


def plain_least(x, starts):
    """Concentration of each start until its determinant stops falling; the least of all."""
    made = []
    for number, mean, inverse, logdet in starts:
        while True:
            level = np.floor(np.log2(distances(x, mean, inverse) + 2.0**-10) * quality.LEVELS)
            half = min(len(x), (len(x) + P + 1) // 2)
            weights = np.zeros(len(x))
            left = half
            for value in np.unique(level):
                own = level == value
                weights[own] = min(1.0, max(0, left) / own.sum())
                left -= own.sum()
            mean, cov = moments_of(x, weights)
            cov = cov * quality.consistency(half / len(x)) + FLOOR
            inverse, now = np.linalg.inv(cov), np.linalg.slogdet(cov)[1]
            made.append((now, number, mean.tolist(), inverse))
            if not now < logdet - quality.FALLEN:
                break
            logdet = now
    return min(made, key=lambda m: m[:3])


def test_estimates_equal_those_of_one_machine(spark):
    rng = np.random.default_rng(12)
    groups = {}
    for name, n, junk in (("a", 300, 0.0), ("b", 200, 0.3), ("c", 60, 0.4)):
        x = rng.normal(size=(n, P)) @ rng.normal(size=(P, P)) * 90
        x[: int(junk * n)] = x[: int(junk * n)] * 0.1 + 900
        groups[name] = np.round(x).astype(int)
    rows = [(name, *map(int, r)) for name, x in groups.items() for r in x]
    frame = spark.createDataFrame(rows, "grp string, " + ", ".join(f"{c} long" for c in quality.STATISTICS))
    starts = {}
    for r in quality._starts(frame, 3).collect():
        starts.setdefault(r.grp, []).append((r.start, np.array(r["mean"]), np.array(r.inverse).reshape(P, P), r.logdet))
    least = {r.grp: r for r in quality.least_determinant(frame, 3).collect()}
    final = {r.grp: r for r in quality.final_estimates(frame, 3).collect()}
    for name, x in groups.items():
        assert len(starts[name]) == 5
        _, _, mean, inverse = plain_least(x.astype(float), starts[name])
        assert np.allclose(least[name]["mean"], mean, rtol=1e-9)
        assert np.allclose(least[name].inverse, inverse.ravel(), rtol=1e-6)
        near = distances(x, np.array(mean), inverse) <= quality.INSIDE
        mean, cov = moments_of(x[near].astype(float), np.ones(near.sum()))
        inverse = np.linalg.inv(cov * quality.consistency(0.975) + FLOOR)
        assert np.allclose(final[name]["mean"], mean, rtol=1e-9)
        assert np.allclose(final[name].inverse, inverse.ravel(), rtol=1e-6)


def test_estimates_blend_without_a_jump(spark):
    rng = np.random.default_rng(3)
    made = {g: (rng.normal(size=P), rng.normal(size=P * P)) for g in ("all", "en", "en/a", "en/b", "en/c")}
    sizes = [("en/a", 25), ("en/b", 40), ("en/c", 4000)]
    frame = spark.createDataFrame([(g, "en", n, 4065) for g, n in sizes], "by_both string, by_language string, n long, n_language long")
    known = spark.createDataFrame(
        [(g, m.tolist(), i.tolist()) for g, (m, i) in made.items()], "grp string, mean array<double>, inverse array<double>"
    )
    out = {r.grp: r for r in quality.blended(frame, known).collect()}
    assert set(out) == {g for g, _ in sizes}
    for name, size in sizes:
        mean, inverse = made["all"]
        for group, n in (("en", 4065), (name, size)):
            if n > quality.LEAST:
                near, weight = min(1.0, n / quality.LEAST - 1), 1 - quality.LEAST / n
                mean = near * made[group][0] + (1 - near) * mean
                inverse = weight * made[group][1] + (1 - weight) * inverse
        assert np.allclose(out[name]["mean"], mean) and np.allclose(out[name].inverse, inverse)


def test_estimates_of_many_partitions_are_few_files(spark):
    """Every file that a task writes costs the executor processes and memory of their own."""
    rng = random.Random(11)
    rows = [(k, clean(rng, size=(55, 90)), "en", "abcdefghij"[k % 10]) for k in range(400)]
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    old = set(root.glob("quality-*"))
    coalesced = "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(coalesced)
    spark.conf.set(coalesced, "false")
    try:
        assert len(judged(spark, rows)) == 400
    finally:
        spark.conf.set(coalesced, was)
    made = [p for p in set(root.glob("quality-*")) - old if not p.name.startswith(("quality-counts", "quality-part", "quality-sizes"))]
    files = {p.name: len(list(p.glob("part-*"))) for p in made}
    # The starts are of two frames.
    assert len(files) > 10 and all(n <= 1 + k.startswith("quality-starts") for k, n in files.items()), files

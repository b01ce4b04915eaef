"""Quality rules by robust statistics: which documents are far from their language and source.

One pass over the texts gives counts, and of them a vector of transformed statistics in steps of
``1 / STEP``. For each language and source the minimum-covariance-determinant estimate is found
by concentration: from each of five robust starts, the nearest half of the rows, ``(n + p + 1) / 2``,
gives the next mean and covariance, until the determinant stops falling. Of all starts and rounds the
least determinant stays; rows within the 0.975 quantile of it give the final estimate.
A document is rejected when its squared Mahalanobis distance is over ``FAR``.

Distances are cut in levels of 1 / 16 octave. Rows of the level where the half ends count with
the share of them that still belongs to the half, so copies never come in or stay out all at once.

Moments are sums of whole numbers, so the order of rows never matters; they are aggregated for
each task before the shuffle, so a source that holds a third of all rows costs no more than
others. Every group of more than ``LEAST`` rows has its own estimate. Its inverse covariance counts
with weight ``1 - LEAST / n`` and that of its language with the rest; its mean goes from that of the
language at ``LEAST`` rows to the own one at twice as many. The language's are made in the same way
of its own and those of all rows. So nothing jumps with the number of rows, and only groups of
``LEAST`` rows or fewer are judged by their language alone. Null
language or source is a group of its own. A floor under each deviation
keeps statistics that are the same almost everywhere from rejecting by trifles.

A null or empty text has no words; it fails the base rules. Repeated rows count as often as
they occur. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from millrace.llm.common import arrow_map, batch_of, extended, ship, stored

STEP = 64
KEPT = 0.75
ROUNDS = 4
# Five rows for each statistic.
LEAST = 25
# Squared distance; for five normal statistics one clean document in 10 million is as far.
FAR = 42.0
MOST_BROADCAST = 50_000
# Groups whose estimates are written by one task.
IN_A_FILE = 1_000
LEVELS = 16
# A determinant that falls by less than 1 % has stopped falling.
FALLEN = 0.01
UNIT = 1 << 16

STATISTICS = ("x_length", "x_word", "x_symbols", "x_lines", "x_repeats")
# Least deviation of each statistic.
FLOOR = (0.35, 0.12, 0.3, 0.25, 0.2)
SPACES = " \t\n\v\f\r"

COUNTS = pa.schema(
    [
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("n_lines", pa.int64()),
    ]
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that are found twice or more."""
    runs = list(zip(words, words[1:], words[2:]))
    seen = Counter(runs)
    if len(seen) == len(runs):
        return 0
    total, covered = 0, 0
    for k, run in enumerate(runs):
        if seen[run] > 1:
            total += k + 3 - max(k, covered)
            covered = k + 3
    return total


def counts(text: str | None) -> tuple[int, int, int, int, int, int]:
    text = text or ""
    words = text.encode().split()  # bytes split at exactly space and U+0009 to U+000D
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, "#*$%&|<>")),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def add_counts(frame: DataFrame, text: str = "text") -> DataFrame:
    """The counts of each text beside the other columns; ``text`` itself is left out."""
    names = COUNTS.names
    kept = [c for c in frame.columns if c == text or c not in names]
    source = frame.select(*(F.col(f"`{c}`") for c in kept))
    at = kept.index(text)
    others = [k for k in range(len(kept)) if k != at]
    schema = extended(source.drop(text).schema, **dict.fromkeys(names, LongType()))

    def run(batches):
        for batch in batches:
            found = [counts(t) for t in batch.column(at).to_pylist()]
            made = batch_of(COUNTS, *(zip(*found, strict=True) if found else [[]] * len(names)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in others), *made.columns],
                names=[*(kept[k] for k in others), *names],
            )

    return arrow_map(source, run, schema)


def statistics() -> list[Column]:
    """The vector of a document, as whole numbers of steps."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    share = lambda n, of: F.col(n) / F.greatest(F.col(of), F.lit(1))
    values = (
        F.log1p("n_words"),
        F.log((F.col("word_chars") + 1) / words),
        F.log1p(100 * F.col("n_symbols") / words),
        F.sqrt(share("n_dup_lines", "n_lines")),
        F.sqrt(share("n_repeat_words", "n_words")),
    )
    return [F.round(v * STEP).cast("long").alias(x) for v, x in zip(values, STATISTICS, strict=True)]


def chi_square_cdf(x: float, k: float) -> float:
    """Series of the lower incomplete gamma function."""
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = a
    while abs(term) > 1e-15 * abs(total):
        n += 1
        term *= z / n
        total += term
    return total * math.exp(-z + a * math.log(z) - math.lgamma(a))


def chi_square_quantile(p: float, k: float) -> float:
    low, high = 1e-9, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, k) < p else (low, mid)
    return (low + high) / 2


@lru_cache(4096)
def consistency(share: float) -> float:
    """By how much the covariance of the nearest ``share`` of normal rows is too small."""
    p = len(STATISTICS)
    return share / chi_square_cdf(chi_square_quantile(share, p), p + 2)


INSIDE = chi_square_quantile(0.975, len(STATISTICS))
_PAIRS = [(i, j) for i in range(len(STATISTICS)) for j in range(i, len(STATISTICS))]


def _moments() -> list[Column]:
    x = [F.col(c) for c in STATISTICS]
    return [
        F.count("*").alias("n"),
        *(F.sum(c).cast("double").alias(f"s{i}") for i, c in enumerate(x)),
        *(F.sum(x[i] * x[j]).cast("double").alias(f"s{i}_{j}") for i, j in _PAIRS),
    ]


def _few(frame: DataFrame, groups: int) -> DataFrame:
    """``frame``, of a row or some for each group, in as few partitions as that takes.

    Hadoop sets the rights of every file and folder that a task writes by a process of its own. While
    one starts, the memory of the executor counts twice, and a file a group would start thousands.
    """
    return frame.repartition(groups // IN_A_FILE + 1)


def _mean_and_covariance(sums: dict) -> tuple[np.ndarray, np.ndarray]:
    p = len(STATISTICS)
    mean = np.array([sums[f"s{i}"] for i in range(p)]) / sums["n"]
    cov = np.zeros((p, p))
    for i, j in _PAIRS:
        cov[i, j] = cov[j, i] = sums[f"s{i}_{j}"] / sums["n"] - mean[i] * mean[j]
    return mean, cov


ESTIMATE = "grp string, mean array<double>, inverse array<double>"


def _estimate(grp: str, sums: dict, correction: float) -> tuple[str, list[float], list[float]]:
    mean, cov = _mean_and_covariance(sums)
    floor = np.diag(np.square(np.array(FLOOR) * STEP))
    return grp, mean.tolist(), np.linalg.inv(cov * correction + floor).ravel().tolist()


def _estimates(moments: DataFrame, correction: float) -> DataFrame:
    """Mean and inverse covariance of each group, in steps."""

    def invert(batches):
        for frame in batches:
            rows = [_estimate(row["grp"], row, correction) for row in frame.to_dict("records")]
            yield pd.DataFrame(rows, columns=["grp", "mean", "inverse"])

    ship(moments.sparkSession)
    return moments.mapInPandas(invert, ESTIMATE)


def _with_distance(rows: DataFrame, model: DataFrame, groups: int) -> DataFrame:
    """Squared Mahalanobis distance of each row from its group."""
    p = len(STATISTICS)
    gap = [F.col(c) - F.get("mean", F.lit(i)) for i, c in enumerate(STATISTICS)]
    terms = [
        gap[i] * gap[j] * F.get("inverse", F.lit(i * p + j)) * (1 if i == j else 2)
        for i, j in _PAIRS
    ]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    small = F.broadcast(model) if groups <= MOST_BROADCAST else model
    return rows.join(small, "grp").withColumn("distance", total).drop("mean", "inverse")


def _start(rows: DataFrame, groups: int) -> DataFrame:
    """Medians and median deviations. Steps are few, so exact percentiles need little memory."""
    medians = rows.groupBy("grp").agg(
        F.array(*(F.percentile(c, 0.5) for c in STATISTICS)).alias("mean")
    )
    medians = stored(_few(medians, groups), "quality-medians")
    small = F.broadcast(medians) if groups <= MOST_BROADCAST else medians
    off = [F.abs(F.col(c) - F.get("mean", F.lit(i))) for i, c in enumerate(STATISTICS)]
    p = len(STATISTICS)

    def inverse(k: int) -> Column:
        i, j = divmod(k, p)
        if i != j:
            return F.lit(0.0)
        deviation = 1.4826 * F.percentile(off[i], 0.5)
        return 1 / (deviation * deviation + (FLOOR[i] * STEP) ** 2)

    spread = rows.join(small, "grp").groupBy("grp", "mean").agg(
        F.array(*(inverse(k) for k in range(p * p))).alias("inverse")
    )
    return stored(_few(spread, groups), "quality-start")


_SUMS = ["n", *(f"s{i}" for i in range(len(STATISTICS))), *(f"s{i}_{j}" for i, j in _PAIRS)]


def _nearest(frame: pd.DataFrame) -> pd.DataFrame:
    """The estimate of a group from the levels up to the percentile ``KEPT``, of the sums of each level."""
    frame = frame.sort_values("level")
    level, upto = frame["level"].to_numpy(np.int64), frame["n"].to_numpy(np.int64).cumsum()
    place = KEPT * (upto[-1] - 1)
    before, after = math.floor(place), math.ceil(place)
    low, high = (int(level[np.searchsorted(upto, k, side="right")]) for k in (before, after))
    cut = low if low == high else math.ceil((after - place) * low + (place - before) * high)
    sums = frame.loc[frame["level"] <= cut, _SUMS].astype(np.float64).sum().to_dict()
    row = _estimate(frame["grp"].iloc[0], sums, consistency(KEPT))
    return pd.DataFrame([row], columns=["grp", "mean", "inverse"])


def robust_estimates(rows: DataFrame, groups: int) -> DataFrame:
    """(grp, mean, inverse) from rows of (grp, statistics)."""
    ship(rows.sparkSession)
    model = _start(rows, groups)
    # Distances in 1/8 octaves: the share is met by whole levels, the same at every run.
    level = F.floor(F.log2(F.col("distance") + 2.0**-10) * 8)
    for _ in range(ROUNDS):
        sums = _with_distance(rows, model, groups).withColumn("level", level).groupBy("grp", "level").agg(*_moments())
        model = stored(_few(sums.groupBy("grp").applyInPandas(_nearest, ESTIMATE), groups), "quality-round")
    return _inside(rows, model, groups)


def _inside(rows: DataFrame, model: DataFrame, groups: int) -> DataFrame:
    """(grp, mean, inverse) of the rows within the 0.975 quantile of ``model``."""
    inside = _with_distance(rows, model, groups).filter(F.col("distance") <= INSIDE)
    moments = _few(inside.groupBy("grp").agg(*_moments()), groups)
    return stored(_estimates(moments, consistency(0.975)), "quality-model")


MODEL = "grp string, start int, mean array<double>, inverse array<double>, logdet double"


def _shortest_half(values: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Middle and half width of the least interval of half of the rows. ``values`` are sorted."""
    total = counts.sum()
    before = np.concatenate(([0], np.cumsum(counts)))
    last = np.searchsorted(before[1:], before[:-1] + (total + 1) // 2)
    fits = last < len(values)
    width = np.where(fits, values[np.minimum(last, len(values) - 1)] - values, np.inf)
    k = int(np.argmin(width))
    return (values[k] + values[last[k]]) / 2, width[k] / 2


def _weighted_median(values: np.ndarray, counts: np.ndarray) -> float:
    order = np.argsort(values, kind="stable")
    return float(values[order][np.searchsorted(np.cumsum(counts[order]), (counts.sum() + 1) // 2)])


def _centres(rows: DataFrame, groups: int) -> DataFrame:
    """(grp, mid, wide, dense, narrow): medians and median deviations, and the shortest halves."""
    ship(rows.sparkSession)
    values = rows.select("grp", F.posexplode(F.array(*STATISTICS)).alias("place", "value"))
    counted = values.groupBy("grp", "place", "value").agg(F.count("*").alias("n"))

    def summed(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for k in range(len(STATISTICS)):
            part = frame[frame["place"] == k].sort_values("value")
            x, n = part["value"].to_numpy(np.float64), part["n"].to_numpy(np.int64)
            mid = _weighted_median(x, n)
            floor = FLOOR[k] * STEP
            middle, half = _shortest_half(x, n)
            # The half width of the shortest half of normal rows is 0.6745 deviations, as the median deviation.
            deviations = (1.4826 * _weighted_median(np.abs(x - mid), n), 1.4826 * half)
            out.append((mid, math.hypot(deviations[0], floor), middle, math.hypot(deviations[1], floor)))
        return pd.DataFrame([(frame["grp"].iloc[0], *map(list, zip(*out)))], columns=["grp", "mid", "wide", "dense", "narrow"])

    kinds = ", ".join(f"{c} array<double>" for c in ("mid", "wide", "dense", "narrow"))
    made = counted.groupBy("grp").applyInPandas(summed, f"grp string, {kinds}")
    return stored(_few(made, groups), "quality-centres")


def _starts(rows: DataFrame, groups: int) -> DataFrame:
    """Starts of each group: medians, shortest halves, spatial signs, tanh correlation, and the trimmed quarter."""
    p = len(STATISTICS)
    centres = _centres(rows, groups)
    small = F.broadcast(centres) if groups <= MOST_BROADCAST else centres
    z = [(F.col(c) - F.get("mid", F.lit(i))) / F.get("wide", F.lit(i)) for i, c in enumerate(STATISTICS)]
    scaled = rows.join(small, "grp").select("grp", *(v.alias(f"z{i}") for i, v in enumerate(z)))
    norm = F.sqrt(reduce(Column.__add__, (F.col(f"z{i}") * F.col(f"z{i}") for i in range(p))) + 1e-12)
    whole = lambda v: F.round(v * UNIT).cast("long")
    turned = scaled.select(
        "grp",
        *(whole(F.col(f"z{i}") / norm).alias(f"u{i}") for i in range(p)),
        *(whole(F.tanh(f"z{i}")).alias(f"t{i}") for i in range(p)),
    )
    sums = turned.groupBy("grp").agg(
        F.count("*").alias("n"),
        *(F.sum(F.col(f"u{i}") * F.col(f"u{j}")).cast("double").alias(f"u{i}_{j}") for i, j in _PAIRS),
        *(F.sum(F.col(f"t{i}") * F.col(f"t{j}")).cast("double").alias(f"t{i}_{j}") for i, j in _PAIRS),
        *(F.sum(f"t{i}").cast("double").alias(f"m{i}") for i in range(p)),
    )
    floor = np.diag(np.square(np.array(FLOOR) * STEP))

    def begin(batches):
        for frame in batches:
            out = []
            for row in frame.to_dict("records"):
                mid, wide, dense, narrow = (np.array(row[c], np.float64) for c in ("mid", "wide", "dense", "narrow"))
                sign, tanh = np.zeros((p, p)), np.zeros((p, p))
                means = np.array([row[f"m{i}"] for i in range(p)]) / row["n"] / UNIT
                for i, j in _PAIRS:
                    sign[i, j] = sign[j, i] = row[f"u{i}_{j}"] / row["n"] / UNIT**2 * p
                    tanh[i, j] = tanh[j, i] = row[f"t{i}_{j}"] / row["n"] / UNIT**2 - means[i] * means[j]
                spread = np.sqrt(np.diag(tanh) + 1e-6)
                shapes = (np.eye(p), None, sign, tanh / np.outer(spread, spread))
                for k, shape in enumerate(shapes):
                    centre, scale = (dense, narrow) if shape is None else (mid, wide)
                    cov = np.diag(scale**2) if shape is None else shape * np.outer(scale, scale)
                    out.append((row["grp"], k, centre.tolist(), np.linalg.inv(cov + floor).ravel().tolist(), 1e300))
            yield pd.DataFrame(out, columns=["grp", "start", "mean", "inverse", "logdet"])

    made = _few(sums.join(centres, "grp"), groups).mapInPandas(begin, MODEL)
    trimmed = robust_estimates(rows, groups).select(
        "grp", F.lit(4).alias("start"), "mean", "inverse", F.lit(1e300).alias("logdet")
    )
    return stored(made.unionByName(trimmed), "quality-starts")


def _concentrate(frame: pd.DataFrame) -> pd.DataFrame:
    """The next estimate of a group from one start, of the sums of each level of distance."""
    frame = frame.sort_values("level")
    n = frame["n"].to_numpy(np.float64)
    half = min(n.sum(), (n.sum() + len(STATISTICS) + 1) // 2)
    taken = np.clip(half - (np.cumsum(n) - n), 0, n) / n
    mean, cov = _mean_and_covariance({c: float((frame[c].to_numpy(np.float64) * taken).sum()) for c in _SUMS})
    floor = np.diag(np.square(np.array(FLOOR) * STEP))
    cov = cov * consistency(half / n.sum()) + floor
    logdet = float(np.linalg.slogdet(cov)[1])
    first = frame.iloc[0]
    row = (first["grp"], int(first["start"]), mean.tolist(), np.linalg.inv(cov).ravel().tolist(), logdet, bool(logdet < first["logdet"] - FALLEN))
    return pd.DataFrame([row], columns=["grp", "start", "mean", "inverse", "logdet", "falls"])


def least_determinant(rows: DataFrame, groups: int) -> DataFrame:
    """(grp, mean, inverse): the half of least determinant, found from several starts."""
    level = F.floor(F.log2(F.col("distance") + 2.0**-10) * LEVELS)
    active, found = _starts(rows, groups), []
    while not active.isEmpty():
        ranked = _with_distance(rows, active, groups).withColumn("level", level)
        sums = ranked.groupBy("grp", "start", "logdet", "level").agg(*_moments())
        nearer = sums.groupBy("grp", "start").applyInPandas(_concentrate, MODEL + ", falls boolean")
        made = stored(_few(nearer, groups), "quality-half")
        found.append(made)
        active = made.filter("falls").drop("falls")
    if not found:
        return active.select("grp", "mean", "inverse")
    every = reduce(DataFrame.unionByName, found)
    best = every.groupBy("grp").agg(F.min_by(F.struct("mean", "inverse"), F.struct("logdet", "start", "mean")).alias("best"))
    return stored(_few(best.select("grp", "best.*"), groups), "quality-least")


def final_estimates(rows: DataFrame, groups: int) -> DataFrame:
    """(grp, mean, inverse) of the rows near the half of least determinant."""
    return _inside(rows, least_determinant(rows, groups), groups)


def blended(sizes: DataFrame, estimates: DataFrame, groups: int = 1) -> DataFrame:
    """(grp, mean, inverse) of each language and source, from its own estimate and those above it."""

    def named(prefix: str, *columns: Column) -> DataFrame:
        return estimates.select(*columns, F.col("mean").alias(f"{prefix}_mean"), F.col("inverse").alias(f"{prefix}_inverse"))

    every = named("all", F.col("grp").alias("all_grp")).filter(F.col("all_grp") == "all").drop("all_grp")
    known = (
        sizes.select("by_both", "by_language", "n", "n_language")
        .join(named("own", F.col("grp").alias("by_both")), "by_both", "left")
        .join(named("language", F.col("grp").alias("by_language")), "by_language", "left")
        .crossJoin(F.broadcast(every))
    )

    def blend(batches):
        for frame in batches:
            out = []
            for row in frame.to_dict("records"):
                mean, inverse = np.array(row["all_mean"]), np.array(row["all_inverse"])
                for prefix, n in (("language", row["n_language"]), ("own", row["n"])):
                    if n > LEAST:
                        near, weight = min(1.0, n / LEAST - 1), 1 - LEAST / n
                        mean = near * np.array(row[f"{prefix}_mean"]) + (1 - near) * mean
                        inverse = weight * np.array(row[f"{prefix}_inverse"]) + (1 - weight) * inverse
                out.append((row["by_both"], mean.tolist(), inverse.tolist()))
            yield pd.DataFrame(out, columns=["grp", "mean", "inverse"])

    made = _few(known, groups).mapInPandas(blend, ESTIMATE)
    return stored(made, "quality-blended")


# Columns of the result; one of the input that is called like that is replaced.
MADE = (*COUNTS.names, "base_failed", "kept", "distance")


def judge_quality(frame: DataFrame, text: str = "text", language: str = "lang", source: str = "source") -> DataFrame:
    """Counts, ``base_failed``, ``distance`` and ``kept`` for each row, without its text."""
    hidden = {c: f"__{k}" for k, c in enumerate(frame.columns) if c not in (text, language, source)}
    own = frame.select(
        *(F.col(f"`{c}`").alias(h) for c, h in hidden.items()),
        F.col(f"`{text}`").alias("text"),
        F.to_json(F.struct(F.col(f"`{language}`").alias("l"))).alias("by_language"),
        F.to_json(
            F.struct(F.col(f"`{language}`").alias("l"), F.col(f"`{source}`").alias("s"))
        ).alias("by_both"),
    )
    rows = stored(add_counts(own).select("*", *statistics()), "quality-counts")
    sizes = rows.groupBy("by_language", "by_both").agg(F.count("*").alias("n"))
    sizes = stored(
        sizes.select(
            "by_language",
            "by_both",
            "n",
            F.sum("n").over(_by("by_language")).alias("n_language"),
        ),
        "quality-sizes",
    )
    groups = sizes.count()
    # A row takes part in the estimates of its own group, of its language and of all rows.
    part = rows.select(
        F.explode(F.array("by_both", "by_language", F.lit("all"))).alias("grp"), *STATISTICS
    )
    languages = sizes.select("by_language", "n_language").distinct()
    needed = (
        sizes.filter(F.col("n") > LEAST).select(F.col("by_both").alias("grp"))
        .unionByName(languages.filter(F.col("n_language") > LEAST).select(F.col("by_language").alias("grp")))
        .unionByName(frame.sparkSession.createDataFrame([("all",)], "grp string"))
    )
    part = part.join(F.broadcast(needed) if groups <= MOST_BROADCAST else needed, "grp")
    part = stored(part, "quality-part")
    model = blended(sizes, final_estimates(part, groups), groups)
    rows = rows.withColumnRenamed("by_both", "grp")
    judged = _with_distance(rows, model, groups)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        *(F.col(h).alias(c) for c, h in hidden.items() if c not in MADE),
        *COUNTS.names[:5],
        failed.alias("base_failed"),
        (~failed & (F.col("distance") <= FAR)).alias("kept"),
        "distance",
    )


def _by(column: str):
    from pyspark.sql import Window

    return Window.partitionBy(column)

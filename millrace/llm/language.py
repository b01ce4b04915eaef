"""Language identification in two steps: the family first, then one-versus-one within it.

Features are the shares of hashed byte trigrams of the lower-cased text, with everything that is
not a letter read as a space. A linear support vector machine for each family (one against the
rest) picks the family; within it each pair of languages has a machine of its own, and the
language with most wins (then largest sum of margins, then first by name) is predicted.

Training reads a sample of about ``SAMPLE`` labelled rows of each language, picked by a hash of a
key that is no feature; each machine is trained in a task of its own. Languages are few, so the
weights (128 KB a machine) pass through the driver to be broadcast; more than ``MOST_LABELS`` labels
are refused.

A text that is null or has no letter gives ``und`` and score 0. Rows with a null label are not
learned from. With a single learned language every text with a letter gets it, with score 0.5;
with none, ``und``. The score is the product of two logistic values: of the family's margin over
the next family, and of the least margin over a language of the family.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from millrace.llm.common import arrow_map, extended

BITS = 15
SAMPLE = 1_200
# With so many languages the machines of pairs would no longer be few.
MOST_LABELS = 256
EPOCHS = 12
PENALTY = 2e-4
SCALE = 40.0
SHARPNESS = 2.0
UNDETERMINED = "und"

# Families of common languages by ISO 639-1 code. Others are families of one.
FAMILIES = {
    "romance": "es fr it pt ro ca gl oc",
    "germanic": "en de nl sv da no nb nn is af",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "uralic": "fi et hu",
    "indic": "hi bn mr ne gu pa ur",
    "turkic": "tr az kk uz ky",
    "semitic": "ar he mt am",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

LETTER = re.compile(r"[^\W\d_]")
_TO_SPACE = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def family_of(language: str) -> str:
    return FAMILY_OF.get(language.lower().split("-")[0], language)


def trigrams(text: str) -> np.ndarray:
    """A feature for each byte of the text."""
    data = np.frombuffer(b" " + text.lower().encode().translate(_TO_SPACE) + b" ", np.uint8)
    codes = data.astype(np.uint32)
    codes = codes[:-2] | codes[1:-1] << np.uint32(8) | codes[2:] << np.uint32(16)
    codes = codes[codes != 0x202020]
    return (codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and their scaled shares."""
    found = trigrams(text or "")
    counts = np.bincount(found, minlength=1 << BITS)
    places = np.flatnonzero(counts)
    return places.astype(np.int32), (counts[places] * (SCALE / max(1, len(found)))).astype(np.float32)


def train(places: list[np.ndarray], shares: list[np.ndarray], signs: np.ndarray) -> np.ndarray:
    """Averaged sub-gradient steps on the hinge loss, each class with the same total weight.

    The last weight is the bias. Steps go in a fixed order, so equal rows give equal weights.
    """
    n = len(signs)
    positive = max(1, int((signs > 0).sum()))
    cost = np.where(signs > 0, n / (2 * positive), n / (2 * max(1, n - positive)))
    weights = np.zeros((1 << BITS) + 1)
    total = np.zeros_like(weights)
    order = np.random.default_rng(7)
    shrink, step, seen = 1.0, 0, 0
    for epoch in range(EPOCHS):
        for k in order.permutation(n):
            step += 1
            rate = 1 / (PENALTY * (step + 1 / PENALTY))
            at, x = places[k], shares[k]
            margin = signs[k] * (shrink * float(weights[at] @ x) + weights[-1])
            shrink *= 1 - rate * PENALTY
            if margin < 1:
                change = rate * signs[k] * min(cost[k], 10.0)
                weights[at] += change / shrink * x
                weights[-1] += 0.1 * change
            if shrink < 1e-6:
                weights[:-1] *= shrink
                shrink = 1.0
        if epoch >= EPOCHS // 2:
            total[:-1] += weights[:-1] * shrink
            total[-1] += weights[-1]
            seen += 1
    return (total / seen).astype(np.float32)


class Model:
    """Weights of all machines, by feature."""

    def __init__(self, languages: list[str], weights: dict[str, np.ndarray]) -> None:
        self.languages = sorted(languages)
        self.families = sorted({family_of(x) for x in self.languages})
        self.members = {
            f: [x for x in self.languages if family_of(x) == f] for f in self.families
        }
        self.names = sorted(weights)
        stacked = [weights[n] for n in self.names] or [np.zeros((1 << BITS) + 1, np.float32)]
        self.weights = np.ascontiguousarray(np.stack(stacked, axis=1))
        self.place = {name: k for k, name in enumerate(self.names)}

    def margins(self, text: str) -> np.ndarray:
        found = trigrams(text)
        counts = np.bincount(found, minlength=1 << BITS)
        places = np.flatnonzero(counts)
        share = counts[places].astype(np.float32) * np.float32(SCALE / max(1, len(found)))
        return share @ self.weights[places] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not LETTER.search(text):
            return UNDETERMINED, 0.0
        if len(self.languages) == 1:
            return self.languages[0], 0.5
        margins = self.margins(text)
        family, sure = self.families[0], 0.0
        if len(self.families) > 1:
            ranked = sorted(
                ((-float(margins[self.place[f"family:{f}"]]), f) for f in self.families)
            )
            family = ranked[0][1]
            sure = (ranked[1][0] - ranked[0][0]) / 2
        members = self.members[family]
        wins = dict.fromkeys(members, 0)
        sums = dict.fromkeys(members, 0.0)
        least = dict.fromkeys(members, np.inf)
        for a, b in itertools.combinations(members, 2):
            margin = float(margins[self.place[f"pair:{a}:{b}"]])
            wins[a if margin >= 0 else b] += 1
            for x, m in ((a, margin), (b, -margin)):
                sums[x] += m
                least[x] = min(least[x], m)
        best = min(members, key=lambda x: (-wins[x], -sums[x], x))
        score = logistic(sure) if len(self.families) > 1 else 1.0
        if len(members) > 1:
            score *= logistic(least[best])
        return best, score


def logistic(margin: float) -> float:
    return float(1 / (1 + np.exp(-SHARPNESS * np.clip(margin, -50, 50))))


def machines(languages: list[str]) -> pd.DataFrame:
    """Which machine learns from which language, and with which sign."""
    rows = []
    families = sorted({family_of(x) for x in languages})
    for x in languages:
        if len(families) > 1:
            rows += [(f"family:{f}", x, 1 if family_of(x) == f else -1) for f in families]
        for a, b in itertools.combinations(sorted(languages), 2):
            if family_of(a) == family_of(b) and x in (a, b):
                rows.append((f"pair:{a}:{b}", x, 1 if x == a else -1))
    return pd.DataFrame(rows, columns=["machine", "label", "sign"])


def fit(labelled: DataFrame, key: Column, text: str = "text", label: str = "lang") -> Model:
    """A model learned from rows with a label. ``key`` picks the sample and is not learned."""
    spark = labelled.sparkSession
    rows = labelled.select(
        F.col(f"`{label}`").alias("label"),
        F.col(f"`{text}`").alias("text"),
        F.pmod(F.xxhash64(key), F.lit(1 << 30)).alias("draw"),
    ).filter(F.col("label").isNotNull() & F.col("text").isNotNull())
    found = rows.groupBy("label").agg(F.count("*").alias("n")).limit(MOST_LABELS + 1).collect()
    if len(found) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} languages: this is no column of languages")
    counts = {r["label"]: r["n"] for r in found}
    languages = sorted(counts)
    todo = machines(languages)
    if todo.empty:
        return Model(languages, {})
    limits = spark.createDataFrame(
        [(x, min(1 << 30, round(SAMPLE / n * (1 << 30)))) for x, n in counts.items()],
        "label string, most long",
    )
    sample = rows.join(F.broadcast(limits), "label").filter(F.col("draw") < F.col("most"))

    def extract(batches):
        for batch in batches:
            pairs = [features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label"),
                    batch.column("draw"),
                    pa.array([p for p, _ in pairs], pa.list_(pa.int32())),
                    pa.array([s for _, s in pairs], pa.list_(pa.float32())),
                ],
                names=["label", "draw", "places", "shares"],
            )

    vectors = arrow_map(
        sample.select("label", "draw", "text"), extract, "label string, draw long, places array<int>, shares array<float>"
    )

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["draw", "label"], kind="stable")
        weights = train(list(group["places"]), list(group["shares"]), group["sign"].to_numpy(float))
        return pd.DataFrame({"machine": [group["machine"].iloc[0]], "weights": [weights.tobytes()]})

    learned = (
        vectors.join(F.broadcast(spark.createDataFrame(todo)), "label")
        .groupBy("machine")
        .applyInPandas(learn, "machine string, weights binary")
        .collect()
    )
    return Model(languages, {r["machine"]: np.frombuffer(r["weights"], np.float32) for r in learned})


def predict(frame: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``frame`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    shared = frame.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in frame.columns if c not in ("lang_pred", "score")]
    source = frame.select(*(F.col(f"`{c}`") for c in kept))
    at = kept.index(text)

    def run(batches):
        for batch in batches:
            got = [shared.value.predict(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([g[0] for g in got], pa.string()),
                    pa.array([g[1] for g in got], pa.float64()),
                ],
                names=[*kept, "lang_pred", "score"],
            )

    schema = extended(source.schema, lang_pred=StringType(), score=DoubleType())
    return arrow_map(source, run, schema)

"""Ranked lexical search over bit-sliced Bloom signatures, with exact results.

Every document with a term gets a Bloom signature of its terms, entered once more for each number of
occurrences in ``LEVELS`` that a term reaches. Documents of like size form blocks, and a block is
stored by slices: for each bit the documents that have it. The documents that may hold a term so and
so often are the slices of its bits, combined by AND, which can name too many documents but never
too few. Weighted sums of them bound the scores from above.

The documents with the greatest bounds are scored exactly first; the least of the best scores of an
item is its threshold. Then all documents whose bound reaches the threshold are scored, and only
they can be among the best. Scores come from the texts, so results are exact.

Bounds on memory: signatures of at most ``MOST_BITS`` (a document of very many terms has a fuller
signature and is scored more often, no more), blocks of at most ``BLOCK_BYTES``, items in slices of
about ``PAIRS`` terms, each a pass over the index. Bit arrays of terms and documents have a fixed size.

Awkward rows: a null text, an empty one and one of separators alone have no term and are not counted.
Each row is a document of its own, also when ids repeat; equal scores go by id, a null id last. Rows
of one item id are one item with the terms of all of them; an item without terms, or without a
document that shares one, has no rows. Ids keep their type. Other columns are not looked at.
"""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from millrace.llm.common import TERMS, Bitmap, arrow_map, lowered, mix, stored, tokens

TOP = 10
# The score of the contract. 1000 * tf / (tf + 0.008 * m), in whole numbers.
SCALE, TF_PART, LENGTH_PART, FLAT, STEEP = 1_000_000_000, 1000, 8, 100, 90

LEVELS = (1, 2, 3, 4, 6, 10)
HASHES = 4
BITS_PER_ENTRY = 12
MOST_BITS = 1 << 18
BLOCK_DOCS = 128
BLOCK_BYTES = 1 << 22
PAIRS = 500_000
PAIRS_AT_ONCE = 16_384
TERM_BITS = DOC_BITS = 22
SALTS = 64


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, term, hash): the terms of every item, once each."""

    def run(batches):
        for batch in batches:
            place, terms, hashes = [], [], []
            for k, t in enumerate(batch.column("text").to_pylist()):
                data = lowered(t)
                found, starts, ends = tokens(data, TERMS)
                if not len(found):
                    continue
                for at in np.unique(found, return_index=True)[1]:
                    place.append(k)
                    terms.append(data[starts[at] : ends[at]].decode())
                    hashes.append(found[at].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").take(pa.array(place, pa.int64())), pa.array(terms, pa.string()), pa.array(hashes, pa.int64())],
                names=["item", "term", "hash"],
            )

    source = items.select(F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = StructType([source.schema["item"], StructField("term", StringType()), StructField("hash", LongType())])
    return arrow_map(source, run, schema).distinct()


def _entries(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """What a document enters into its signature: its terms, and again for each level reached."""
    return np.concatenate([mix(hashes[counts >= t] + np.uint64(k)) for k, t in enumerate(LEVELS)])


def slots(entries: np.ndarray, bits: int) -> np.ndarray:
    """The places of entries in a signature, ``HASHES`` each, in a last axis."""
    low, high = entries & np.uint64(0xFFFFFFFF), (entries >> np.uint64(32)) | np.uint64(1)
    at = (low[..., None] + np.arange(HASHES, dtype=np.uint64) * high[..., None]) & np.uint64(0xFFFFFFFF)
    return ((at * np.uint64(bits)) >> np.uint64(32)).astype(np.int64)


def _blocks(sizes: list[int]):
    """Documents in order of size, cut into blocks that stay small: (members, bits)."""
    order, start = np.argsort(sizes, kind="stable"), 0
    while start < len(order):
        end = start + 1
        bits = width(sizes[order[start]])
        while end < len(order) and end - start < BLOCK_DOCS:
            more = width(sizes[order[end]])
            if more * ((end - start) // 8 + 1) > BLOCK_BYTES:
                break
            bits, end = more, end + 1
        yield order[start:end], bits
        start = end


def width(entries: int) -> int:
    return min(MOST_BITS, max(64, entries * BITS_PER_ENTRY))


def sliced(entries: list[np.ndarray], bits: int) -> bytes:
    """Signatures as slices: a row for each bit, a bit for each document."""
    matrix = np.zeros((bits, -(-len(entries) // 8) * 8), bool)
    for k, own in enumerate(entries):
        matrix[slots(own, bits).ravel(), k] = True
    return np.packbits(matrix, axis=1).tobytes()


def signature_index(documents: DataFrame, key: str, text: str, wanted: Bitmap) -> DataFrame:
    """A row for each block: ids, lengths, slices, and how many documents hold the terms asked for."""
    shared = documents.sparkSession.sparkContext.broadcast(wanted)
    source = documents.select(
        F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{key}`")).alias("mark"), F.col(f"`{text}`").cast("string").alias("text")
    )

    def run(batches):
        for batch in batches:
            rows, lengths, entries, asked = [], [], [], []
            for k, t in enumerate(batch.column("text").to_pylist()):
                data = lowered(t)
                found, starts, ends = tokens(data, TERMS)
                if not len(found):
                    continue
                own, at, counts = np.unique(found, return_index=True, return_counts=True)
                rows.append(k)
                lengths.append(len(found))
                entries.append(_entries(own, counts))
                held = at[shared.value.holds(own)]
                asked.append([data[starts[i] : ends[i]].decode() for i in held])
            for members, bits in _blocks([len(e) for e in entries]):
                counts = Counter(term for m in members for term in asked[m])
                at = pa.array([[rows[m] for m in members]], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(at.offsets, batch.column("key").take(at.values)),
                        pa.ListArray.from_arrays(at.offsets, batch.column("mark").take(at.values)),
                        pa.array([[lengths[m] for m in members]], pa.list_(pa.int64())),
                        pa.array([bits], pa.int64()),
                        pa.array([sliced([entries[m] for m in members], bits)], pa.binary()),
                        pa.array([list(counts)], pa.list_(pa.string())),
                        pa.array([list(counts.values())], pa.list_(pa.int64())),
                    ],
                    names=["keys", "marks", "lengths", "bits", "slices", "terms", "counts"],
                )

    kind = source.schema["key"].dataType.simpleString()
    return arrow_map(
        source, run,
        f"keys array<{kind}>, marks array<long>, lengths array<long>, bits long, slices binary, terms array<string>, counts array<long>",
    )


@dataclass
class Asked:
    """A slice of the items: their terms and weights, and what is known of their best scores."""

    items: list
    item_of: np.ndarray
    term_of: np.ndarray
    weights: np.ndarray
    terms: dict[str, int]
    hashes: np.ndarray
    least: np.ndarray
    last: list
    documents: int
    total: int

    @classmethod
    def of(cls, pairs, documents: int, total: int) -> Asked:
        """From (item, term, hash, w) rows, those of an item together."""
        items, starts = [], []
        for k, item in enumerate(pairs["item"]):
            if not items or item != items[-1]:
                items.append(item)
                starts.append(k)
        lengths = np.diff([*starts, len(pairs["item"])])
        terms: dict[str, int] = {}
        hashes = []
        for term, value in zip(pairs["term"], pairs["hash"], strict=True):
            if term not in terms:
                terms[term] = len(terms)
                hashes.append(value)
        return cls(
            items, np.repeat(np.arange(len(items)), lengths), np.array([terms[t] for t in pairs["term"]], np.int64),
            np.array(pairs["w"], np.int64), terms, np.array(hashes, np.int64).view(np.uint64),
            np.ones(len(items), np.int64), [None] * len(items), documents, total,
        )

    def part(self, tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What ``tf`` occurrences in a document of so many terms count for."""
        m = FLAT - STEEP + (STEEP * lengths * self.documents) // self.total
        return (SCALE * tf) // (TF_PART * tf + LENGTH_PART * m)

    def bounds(self, lengths: np.ndarray, bits: int, slices: bytes):
        """(items, upper bounds by item and document), some items at a time."""
        count = len(lengths)
        rows = np.frombuffer(slices, np.uint8).reshape(bits, -1)
        levels = np.array([t - 1 for t in LEVELS[1:]], np.int64)
        most = np.vstack([np.zeros_like(lengths)[None], np.broadcast_to(levels[:, None], (len(levels), count)), lengths[None]])
        parts = self.part(np.minimum(most, lengths), lengths)
        start = 0
        while start < len(self.item_of):
            # Whole items, some thousand terms at a time.
            end = np.searchsorted(self.item_of, self.item_of[min(start + PAIRS_AT_ONCE, len(self.item_of)) - 1], "right")
            terms, at = np.unique(self.term_of[start:end], return_inverse=True)
            reached = np.zeros((len(terms), count), np.int64)
            held = None
            for k in range(len(LEVELS)):
                own = np.bitwise_and.reduce(rows[slots(mix(self.hashes[terms] + np.uint64(k)), bits)], axis=1)
                held = own if held is None else held & own
                reached += np.unpackbits(held, axis=1, count=count)
            value = np.take_along_axis(parts, reached, axis=0)
            items, first = np.unique(self.item_of[start:end], return_index=True)
            yield items, np.add.reduceat(value[at] * self.weights[start:end, None], first, axis=0)
            start = end


def _slices(weights: DataFrame, documents: int, total: int):
    """The items, some at a time: about ``PAIRS`` terms on the driver, however many items there are."""
    number = max(1, math.ceil(weights.count() / PAIRS))
    part = F.pmod(F.xxhash64("item"), F.lit(number))
    for k in range(number):
        rows = weights.filter(part == k).select("item", "term", "hash", "w").orderBy("item", "term").toArrow()
        if rows.num_rows:
            yield Asked.of(rows.to_pydict(), documents, total)


def _promising(index: DataFrame, asked: Asked) -> DataFrame:
    """(item number, mark, bound) of the documents with the greatest bounds."""
    shared = index.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        asked = shared.value
        # By item: the best of this task so far.
        best, marks = np.zeros((len(asked.items), TOP), np.int64), np.zeros((len(asked.items), TOP), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                own = np.asarray(batch.column("marks")[k].values, np.int64)
                lengths = np.asarray(batch.column("lengths")[k].values, np.int64)
                for items, bounds in asked.bounds(lengths, batch.column("bits")[k].as_py(), batch.column("slices")[k].as_py()):
                    better = np.flatnonzero(bounds.max(axis=1) > best[items].min(axis=1))
                    items = items[better]
                    both = np.hstack([best[items], bounds[better]])
                    known = np.hstack([marks[items], np.broadcast_to(own, (len(items), len(own)))])
                    order = np.argsort(-both, axis=1, kind="stable")[:, :TOP]
                    best[items] = np.take_along_axis(both, order, axis=1)
                    marks[items] = np.take_along_axis(known, order, axis=1)
        item, place = np.nonzero(best)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(marks[item, place]), pa.array(best[item, place])], names=["item", "mark", "bound"]
        )

    found = arrow_map(index.select("marks", "lengths", "bits", "slices"), run, "item long, mark long, bound long")
    return _highest(found, [F.desc("bound"), F.col("mark")], F.col("mark")).select("mark")


def _open(index: DataFrame, asked: Asked) -> DataFrame:
    """Marks of all documents that may still belong to the best of an item."""
    shared = index.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        asked = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                lengths = np.asarray(batch.column("lengths")[k].values, np.int64)
                keys = batch.column("keys")[k].values
                chosen = np.zeros(len(lengths), bool)
                for items, bounds in asked.bounds(lengths, batch.column("bits")[k].as_py(), batch.column("slices")[k].as_py()):
                    least = asked.least[items, None]
                    chosen |= (bounds > least).any(axis=0)
                    for i in np.flatnonzero((bounds == least).any(axis=1)):
                        # As good as the last of the best: only a lower id can come before it.
                        level = bounds[i] == least[i]
                        last = asked.last[items[i]]
                        if last is not None:
                            lower = pc.fill_null(pc.less_equal(keys, pa.scalar(last, keys.type)), False)
                            level &= lower.to_numpy(zero_copy_only=False)
                        chosen |= level
                marks = np.asarray(batch.column("marks")[k].values, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(marks[chosen])], names=["mark"])

    return arrow_map(index.select("keys", "marks", "lengths", "bits", "slices"), run, "mark long")


def _scored(documents: DataFrame, key: str, text: str, wanted: Bitmap, asked: Asked) -> DataFrame:
    """(item number, key, score, length) of the best of the wanted documents, scored by their texts."""
    shared = documents.sparkSession.sparkContext.broadcast((wanted, asked))
    own = F.col(f"`{key}`")
    source = documents.select(own.alias("key"), F.xxhash64(own).alias("mark"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        wanted, asked = shared.value
        best: list[list] = [[] for _ in asked.items]
        kind = None
        for batch in batches:
            kind = batch.schema.field("key").type
            marks = batch.column("mark").to_numpy(zero_copy_only=False)
            for k in np.flatnonzero(wanted.holds(marks.view(np.uint64))):
                data = lowered(batch.column("text")[k].as_py())
                _, starts, ends = tokens(data, TERMS)
                if not len(starts):
                    continue
                found = Counter(data[a:b].decode() for a, b in zip(starts, ends, strict=True))
                tf = np.zeros(len(asked.terms), np.int64)
                for term, n in found.items():
                    if (at := asked.terms.get(term)) is not None:
                        tf[at] = n
                value = asked.part(tf, np.int64(len(starts)))
                scores = np.zeros(len(asked.items), np.int64)
                np.add.at(scores, asked.item_of, asked.weights * value[asked.term_of])
                name = batch.column("key")[k].as_py()
                for i in np.flatnonzero(scores):
                    row = (-int(scores[i]), name is None, name)
                    if len(best[i]) < TOP or row[:2] < best[i][-1][:2] or (row[:2] == best[i][-1][:2] and name is not None and name < best[i][-1][2]):
                        insort(best[i], row, key=lambda r: (r[0], r[1], r[2] if r[2] is not None else 0))
                        del best[i][TOP:]
        rows = [(i, name, -score) for i, known in enumerate(best) for score, _, name in known]
        if rows:
            item, name, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int64()), pa.array(name, kind), pa.array(score, pa.int64())], names=["item", "key", "score"]
            )

    schema = StructType([StructField("item", LongType()), source.schema["key"], StructField("score", LongType())])
    found = arrow_map(source, run, schema)
    return _highest(found, [F.desc("score"), F.col("key").asc_nulls_last()], F.col("key"))


def _highest(found: DataFrame, order: list, salt) -> DataFrame:
    """The first ``TOP`` rows of each item; parts of an item are cut first, each on its own."""
    parted = Window.partitionBy("item", "_part").orderBy(*order)
    whole = Window.partitionBy("item").orderBy(*order)
    part = F.pmod(F.xxhash64(salt), F.lit(SALTS))
    some = found.withColumn("_part", part).withColumn("rank", F.row_number().over(parted)).filter(F.col("rank") <= TOP)
    return some.drop("_part", "rank").withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= TOP)


def search(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(item, rank, key, score): the ten best documents of every item."""
    spark = documents.sparkSession
    wanted = stored(item_terms(items, item, item_text), "search-terms")
    vocabulary = Bitmap.build(wanted, "hash", TERM_BITS)
    index = stored(signature_index(documents, key, text, vocabulary), "search-index")
    size = index.select(F.sum(F.size("lengths")).alias("n"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("l")).first()
    n, total = size["n"] or 0, size["l"] or 0
    held = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    df = held.groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("df"))
    share = F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1)
    weighted = wanted.join(df, "term").withColumn("w", F.floor(1000 * F.ln(share)).cast("long"))
    weights = stored(weighted.select("item", "term", "hash", "w"), "search-weights")
    name = StructField("name", wanted.schema["item"].dataType)
    kind = documents.select(F.col(f"`{key}`").alias(key)).schema[0]
    results = spark.createDataFrame([], StructType([StructField(item, name.dataType), StructField("rank", IntegerType()), kind, StructField("score", LongType())]))
    for asked in _slices(weights, n, total):
        first = Bitmap.build(_promising(index, asked), "mark", DOC_BITS)
        # One row for each item of the slice at most.
        known = _scored(documents, key, text, first, asked).filter(F.col("rank") == TOP)
        for row in known.collect():
            asked.least[row["item"]], asked.last[row["item"]] = row["score"], row["key"]
        rest = Bitmap.build(_open(index, asked), "mark", DOC_BITS)
        best = _scored(documents, key, text, rest, asked)
        names = spark.createDataFrame(list(enumerate(asked.items)), StructType([StructField("item", LongType()), name]))
        part = best.join(names, "item").select(
            F.col("name").alias(item), F.col("rank").cast("int").alias("rank"), F.col("key").alias(key), "score"
        )
        results = results.unionByName(stored(part, "search-results"))
    return results

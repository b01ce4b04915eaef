"""Benchmark decontamination by templates.

Words lose outer punctuation and case; a number becomes ``<num>``, a name (a capital inside a
sentence) ``<name>``, a unit after a number ``<unit>``. In scripts without spaces every character is
a word. Windows of ``WINDOW`` placeholders and words are hashed and joined between benchmark items
and documents, so a question with other numbers or names still meets its item. Windows of one item
that lie in a document at one offset are put together, and the slots have to be consistent: one
value of the item stands for one value of the document, that of more than half of its mentions.
Windows with another value are left out, the rest counts for how much of the item is covered.

Windows with less than ``LITERALS`` of ordinary words would match by chance as templates, so they
are matched by their words as they are. So are items of fewer than ``LEAST`` words, which are one
window. An item of a single word is found only where it is the whole text.

A document is contaminated by an item when ``COVERED`` of the item's words are covered. Documents
only give the windows that may be of an item: bit arrays of fixed size, made from the benchmark,
tell them from the rest, and the hash join is exact. Null texts are empty. Keys keep their type.
Repeated rows give their results once. Other columns are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, StringType, StructType

from millrace.llm.common import Bitmap, arrow_map, extended, mix, stored, windows

WINDOW = 8
LEAST = 4
LITERALS = 0.6
COVERED = 0.5
EXACT = 1 << 32
BITS = 24
CACHE = 400_000

NUMBER = re.compile(r"(?a)[+-]?[$€£]?\d[\d.,:/]*(?:%|st|nd|rd|th)?")
ATTACHED = re.compile(r"(?a)([+-]?\d[\d.,]*)([a-zµ°%]{1,4})")
GLUED = re.compile(r"[0-9][.,]*[a-zµ°%]")
# Blocks of scripts that are written without spaces between words.
UNSPACED = re.compile(
    "([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3005-\u3007\u3021-\u30ff\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])"
)
# Units and their short forms.
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres "
    "kilometer kilometers kilometre kilometres mg g kg lb lbs oz ton tons tonne tonnes gram grams "
    "kilogram kilograms pound pounds ounce ounces ml l liter liters litre litres gallon gallons "
    "cup cups s sec second seconds min minute minutes h hr hour hours day days week weeks month "
    "months year years mph kph km/h m/s hz khz mhz ghz w kw v a j kj cal kcal pa kpa c f k "
    "dollar dollars euro euros cent cents usd eur % percent degree degrees".split()
)
OUTER = "\"'`.,;:!?()[]{}<>*_~|“”‘’«»¿¡…-–—"
SENTENCE_END = re.compile(r"[.!?:][\"')\]”’»]*$")
LITERAL, NUM, UNIT, CAPITAL = 0, 1, 2, 3
PLACEHOLDER = {NUM: "<num>", UNIT: "<unit>", CAPITAL: "<name>"}


def _hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode())


MARK = {kind: np.uint64(_hash(name)) for kind, name in PLACEHOLDER.items()}


class Words:
    """What is known of a spelling, in one number: hash, kind, whether it ends a sentence.

    Spellings are kept up to a bound.
    """

    def __init__(self) -> None:
        self.codes: dict[str, int] = {}

    def look(self, word: str) -> int:
        inner = word.rstrip(OUTER)
        if not inner.isalpha():
            inner = word.strip(OUTER)
        low = inner.lower()
        kind = LITERAL
        if low in UNITS or word == "%":
            kind = UNIT
        elif inner[:1].isupper():
            kind = CAPITAL if len(inner) == 1 or not inner.isupper() else LITERAL
        elif not inner.isalpha() and NUMBER.fullmatch(inner):
            kind = NUM
        ends = len(inner) < len(word) and SENTENCE_END.search(word) is not None
        code = _hash(low or word) >> 4 << 3 | kind << 1 | ends
        if len(self.codes) >= CACHE:
            self.codes.clear()
        self.codes[word] = code
        return code

    def arrays(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = list(map(self.codes.get, words))
        if None in codes:
            codes = [self.look(w) if c is None else c for w, c in zip(words, codes, strict=True)]
        found = np.array(codes, np.int64)
        return found.view(np.uint64) >> np.uint64(3), found >> 1 & 3, (found & 1).astype(bool)


def split(text: str) -> list[str]:
    """Words; a number and the unit written against it are two, and so are unspaced characters."""
    if not text.isascii() and UNSPACED.search(text):
        text = UNSPACED.sub(r" \1 ", text)
    words = text.split()
    if GLUED.search(text):
        out = []
        for w in words:
            m = ATTACHED.fullmatch(w.strip(OUTER)) if GLUED.search(w) else None
            if m and m[2] in UNITS:
                out += [m[1], m[2]]
            else:
                out.append(w)
        words = out
    return words


class Template:
    """A text: its words, their hashes as they are and as placeholders, and their kinds in place."""

    def __init__(self, text: str | None, known: Words) -> None:
        self.words = split(text) if text else []
        self.plain, kinds, ends = known.arrays(self.words)
        if len(self.words):
            first = np.concatenate(([True], ends[:-1]))
            after_number = np.concatenate(([False], kinds[:-1] == NUM))
            kinds = np.where((kinds == CAPITAL) & first, LITERAL, kinds)
            kinds = np.where((kinds == UNIT) & ~after_number, LITERAL, kinds)
        self.kinds = kinds
        self.typed = self.plain
        for kind, mark in MARK.items():
            self.typed = np.where(kinds == kind, mark, self.typed)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """A hash for each window of placeholders, and which of them have enough ordinary words."""
        found = windows(self.typed, size)
        if not len(found):
            return found, np.empty(0, bool)
        literals = np.concatenate(([0], np.cumsum(self.kinds == LITERAL)))
        return mix(found + np.uint64(size)), literals[size:] - literals[:-size] >= LITERALS * size

    def exact_windows(self, size: int) -> np.ndarray:
        """A hash for each window of the words as they are."""
        return mix(windows(self.plain, size) + np.uint64(EXACT + size))


def slots(words: list[str], kinds: np.ndarray, start: int, size: int) -> list[str]:
    """Values of the placeholders of a window, in order, with their kinds."""
    return [
        f"{kinds[k]}:{words[k].strip(OUTER).lower()}"
        for k in range(start, start + size)
        if kinds[k] != LITERAL
    ]


class _Rows:
    """Windows found in a batch of texts."""

    def __init__(self) -> None:
        self.texts, self.hashes, self.places, self.slots = [], [], [], []

    def add(self, text: int, found: np.ndarray, at: int, values: list[str]) -> None:
        self.texts.append(text)
        self.hashes.append(int(found[at].astype(np.int64)))
        self.places.append(at)
        self.slots.append(values)

    def batch(self, keys: pa.Array, **more: list) -> pa.RecordBatch:
        columns = {
            "key": keys.take(pa.array(self.texts, pa.int64())),
            "window": pa.array(self.hashes, pa.int64()),
            "place": pa.array(self.places, pa.int32()),
            "slots": pa.array(self.slots, pa.list_(pa.string())),
        }
        for name, values in more.items():
            columns[name] = pa.array(values, pa.list_(pa.int32()) if name == "slot_places" else pa.int32())
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _schema(frame: DataFrame, **more: DataType) -> StructType:
    kinds = {"window": LongType(), "place": IntegerType(), "slots": ArrayType(StringType())}
    return extended(StructType([frame.schema["key"]]), **kinds, **more)


def item_windows(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """Windows of every item, its number of words, and whether they hold the words as they are."""

    def run(batches):
        known = Words()
        for batch in batches:
            rows, sizes, counts, plain, places = _Rows(), [], [], [], []
            for k, t in enumerate(batch.column("text").to_pylist()):
                template = Template(t, known)
                n = len(template.words)
                if not n:
                    continue
                size = min(WINDOW, n)
                found, enough = template.windows(size)
                exact = template.exact_windows(size)
                for at in range(n - size + 1):
                    typed = bool(enough[at]) and n >= LEAST
                    values = slots(template.words, template.kinds, at, size) if typed else []
                    rows.add(k, found if typed else exact, at, values)
                    own = np.flatnonzero(template.kinds[at : at + size] != LITERAL) + at
                    places.append(own.tolist() if typed else [])
                    sizes.append(size)
                    counts.append(n)
                    plain.append(not typed)
            numbers = {"size": sizes, "words": counts, "plain": [int(p) for p in plain]}
            yield rows.batch(batch.column("key"), **numbers, slot_places=places)

    source = benchmark.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text")).distinct()
    whole = {name: IntegerType() for name in ("size", "words", "plain")}
    return arrow_map(source, run, _schema(source, **whole, slot_places=ArrayType(IntegerType())))


def document_windows(
    documents: DataFrame, key: str, text: str, typed: dict[int, Bitmap], exact: dict[int, Bitmap]
) -> DataFrame:
    """Windows of documents that may be those of an item, by the sizes that items have."""
    shared = documents.sparkSession.sparkContext.broadcast((typed, exact))

    def run(batches):
        typed, exact = shared.value
        known = Words()
        for batch in batches:
            rows = _Rows()
            for k, t in enumerate(batch.column("text").to_pylist()):
                template = Template(t, known)
                for size, wanted in typed.items():
                    found, enough = template.windows(size)
                    for at in np.flatnonzero(enough & wanted.holds(found)) if len(found) else ():
                        rows.add(k, found, at, slots(template.words, template.kinds, at, size))
                for size, wanted in exact.items():
                    if size == 1 and len(template.words) > 1:
                        continue
                    found = template.exact_windows(size)
                    for at in np.flatnonzero(wanted.holds(found)) if len(found) else ():
                        rows.add(k, found, at, [])
            yield rows.batch(batch.column("key"))

    source = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return arrow_map(source, run, _schema(source))


def _consistent(lined: DataFrame) -> DataFrame:
    """Of the windows of an alignment, those whose values are the ones that stand for the item's."""
    # A mention is in several windows; with its place it counts once.
    mentions = F.array_distinct(F.flatten(F.transform("windows", lambda w: w["pairs"])))

    def chosen(value: Column) -> Column:
        own = F.filter("mentions", lambda m: m["item_slots"] == value)
        told = F.filter(own, lambda m: 2 * F.size(F.filter(own, lambda o: o["slots"] == m["slots"])) > F.size(own))
        return F.struct(value.alias("item_slots"), F.get(told, 0)["slots"].alias("slots"))

    def stands(pair: Column) -> Column:
        return F.exists("chosen", lambda c: (c["item_slots"] == pair["item_slots"]) & (c["slots"] == pair["slots"]))

    values = F.array_distinct(F.transform("mentions", lambda m: m["item_slots"]))
    return (
        lined.withColumn("mentions", mentions)
        .withColumn("chosen", F.filter(F.transform(values, chosen), lambda c: c["slots"].isNotNull()))
        .withColumn("windows", F.filter("windows", lambda w: F.forall(w["pairs"], stands)))
        .filter(F.size("windows") > 0)
    )


def _bitmaps(items: DataFrame, plain: int) -> dict[int, Bitmap]:
    """A bit array for each window size; there are ``WINDOW`` sizes at most."""
    own = items.filter(F.col("plain") == plain)
    sizes = sorted(r["size"] for r in own.select("size").distinct().collect())
    return {size: Bitmap.build(own.filter(F.col("size") == size), "window", BITS) for size in sizes}


def contaminated(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(key, item, coverage, reparameterised) of every document and item that meet.

    ``reparameterised`` is true when a slot has another value than in the item.
    """
    items = stored(item_windows(benchmark, item, item_text), "template-items")
    found = document_windows(documents, key, text, _bitmaps(items, 0), _bitmaps(items, 1))
    own = items.select(
        F.col("key").alias("item"), "window", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"), "slot_places", "size", "words"
    )
    met = found.join(own, "window").select(
        F.col("key").alias("doc"), "item", "words", (F.col("place") - F.col("item_place")).alias("offset"),
        F.struct("item_place", "size", F.arrays_zip("item_slots", "slots", "slot_places").alias("pairs")).alias("window"),
    )
    # At most one row for each window of an item, so the lists are no longer than the item.
    lined = met.groupBy("doc", "item", "offset", "words").agg(F.collect_set("window").alias("windows"))
    consistent = _consistent(lined).select(
        "doc", "item", "words",
        F.array_distinct(
            F.flatten(F.transform("windows", lambda w: F.sequence(w["item_place"], w["item_place"] + w["size"] - 1)))
        ).alias("covered"),
        F.exists("chosen", lambda p: p["item_slots"] != p["slots"]).alias("changed"),
    )
    # Offsets of one document and item are merged word by word, so no list grows with repeats.
    words = consistent.select("doc", "item", "words", "changed", F.explode("covered").alias("word"))
    covered = words.groupBy("doc", "item", "words").agg(
        F.count_distinct("word").alias("n"), F.min("changed").alias("changed")
    )
    coverage = F.col("n") / F.col("words")
    return covered.filter(coverage >= COVERED).select(
        F.col("doc").alias(key), F.col("item").alias(item), coverage.alias("coverage"),
        F.col("changed").alias("reparameterised"),
    )

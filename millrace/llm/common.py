"""What several text operators share: stored steps, word and shingle hashes, fixed-size bitmaps.

Words are runs of bytes other than space and U+0009 to U+000D. All hashes are functions of the
bytes alone, so every executor and every repeated task gets the same ones.
"""

from __future__ import annotations

import hashlib
import re
import zipfile
from collections.abc import Callable
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

import millrace
from millrace.session import shared_folder

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
BLOCK = 1 << 20
BATCH_ROWS = 1_000
BATCH_BYTES = 1 << 22
LONG_WORD = 64

_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_BASE = np.uint64(_BASE)
_BYTES = np.random.default_rng(20250101).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


class Breaks(NamedTuple):
    """Bytes that end a word."""

    table: np.ndarray
    pattern: re.Pattern

    @classmethod
    def of(cls, pattern: bytes) -> Breaks:
        compiled = re.compile(pattern)
        return cls(np.array([bool(compiled.match(bytes([k]))) for k in range(256)]), compiled)


SPACES = Breaks.of(rb"[\t-\r ]")
# All ASCII but letters and digits; no byte of any other character.
TERMS = Breaks.of(rb"[\x00-/:-@\[-`{-\x7f]")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written once to the shared folder and read again: cuts lineage for good."""
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, once for each application."""
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    package = Path(millrace.__file__).resolve().parent
    bundle = Path(SparkFiles.getRootDirectory()) / "millrace-package.zip"
    with zipfile.ZipFile(bundle, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(bundle))
    context._millrace_shipped = True


_held: dict[tuple[str, str], object] = {}


def held[T](kind: str, name: str, make: Callable[[], T]) -> T:
    """An object that a worker process keeps for later tasks of its kind, until ``release``."""
    if (kind, name) not in _held:
        _held[kind, name] = make()
    return _held[kind, name]


def release(kind: str | None) -> None:
    """Let go of what this process holds for tasks of other kinds.

    Spark uses its worker processes again for later stages and jobs, so what one operator leaves
    in them would stand in the memory of all that come after it.
    """
    for key in [k for k in _held if k[0] != kind]:
        del _held[key]


def arrow_map(frame: DataFrame, function, schema, holds: str | None = None) -> DataFrame:
    """``mapInArrow`` in batches bounded by rows and by bytes, so that long texts come in small ones.

    Spark reads both from the session when the plan runs, so they are set there. ``holds`` is the
    kind of objects that the function asks ``held`` for.
    """
    ship(frame.sparkSession)

    def run(batches):
        release(holds)
        yield from function(batches)

    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return frame.mapInArrow(run, schema)


def extended(schema: StructType, **kinds: DataType) -> StructType:
    """``schema`` with further columns; ``StructType.add`` would change a frame's own schema."""
    return StructType([*schema.fields, *(StructField(n, k) for n, k in kinds.items())])


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n + 1:
        size = max(n + 1, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            _powers[k] = np.cumprod(powers, dtype=np.uint64)
    return _powers[0], _powers[1]


def _block_words(data: bytes, breaks: Breaks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(data, np.uint8)
    space = breaks.table[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends
    powers, inverses = _powers_to(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * powers[: len(raw)], dtype=np.uint64, out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    hashes = mix((sums[ends] - sums[starts]) * inverses[starts] + lengths)
    for k in np.flatnonzero(lengths > LONG_WORD):
        digest = hashlib.blake2b(data[starts[k] : ends[k]], digest_size=8).digest()
        hashes[k] = int.from_bytes(digest, "little")
    return hashes, starts, ends


def tokens(data: bytes, breaks: Breaks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash, the start and the end of each word, in order.

    Works in blocks, so memory stays in proportion.
    """
    if len(data) <= BLOCK:
        return _block_words(data, breaks)
    parts, at = [], 0
    while at < len(data):
        cut = breaks.pattern.search(data, at + BLOCK)
        end = cut.start() if cut else len(data)
        hashes, starts, ends = _block_words(data[at:end], breaks)
        parts.append((hashes, starts + at, ends + at))
        at = end
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash for each word, in order."""
    return tokens(data, SPACES)[0]


def lowered(text: str | None) -> bytes:
    """Text as bytes, A to Z in lower case; none, nothing."""
    return text.encode().translate(LOWER) if text else b""


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words, in order; none when there are fewer."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    count = len(hashes) - size + 1
    out = np.full(count, size, np.uint64)
    for k in range(size):
        out = out * _BASE + hashes[k : k + count]
    return mix(out)


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of lower-cased (A-Z) ``text``.

    Fewer words make one shingle of all; no word, none.
    """
    words = word_hashes(text.encode().translate(LOWER)) if text else np.empty(0, np.uint64)
    return np.unique(windows(words, min(size, len(words)))) if len(words) else words


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


class Bitmap:
    """A set of 64-bit values as a bit array of fixed size.

    It may hold more than was put in, never less. Its size does not depend on the data, so it
    may be sent to every task however large the tables are.
    """

    def __init__(self, bits: int, words: bytes) -> None:
        self.bits, self.words = bits, words

    @staticmethod
    def slot(value: Column, bits: int) -> Column:
        return F.shiftrightunsigned(value, 64 - bits)

    @classmethod
    def build(cls, frame: DataFrame, value: str, bits: int = 22) -> Bitmap:
        """From a column of longs. At most ``2 ** (bits - 6)`` rows reach the driver."""
        place = cls.slot(F.col(value), bits)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
        found = (
            frame.filter(F.col(value).isNotNull())
            .select(F.shiftright(place, 6).alias("word"), bit.alias("bit"))
            .groupBy("word")
            .agg(F.bit_or("bit").alias("bit"))
        )
        words = np.zeros(1 << (bits - 6), np.int64)
        got = found.toPandas()
        words[got["word"].to_numpy(np.int64)] = got["bit"].to_numpy(np.int64)
        return cls(bits, words.tobytes())

    def holds(self, values: np.ndarray) -> np.ndarray:
        words = np.frombuffer(self.words, np.uint64)
        place = values >> np.uint64(64 - self.bits)
        return (words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) > 0

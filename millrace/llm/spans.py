"""Spans in a text, and the digest columns that queries make of them.

A span is (kind, start, end, base, score): places count code points, the end is exclusive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_map, extended
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

Span = tuple[str, int, int, bool, float]

SPAN = StructType(
    [
        StructField("kind", StringType()),
        StructField("start", LongType()),
        StructField("end", LongType()),
        StructField("base", BooleanType()),
        StructField("score", DoubleType()),
    ]
)
_ARROW = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()),
            ("start", pa.int64()),
            ("end", pa.int64()),
            ("base", pa.bool_()),
            ("score", pa.float64()),
        ]
    )
)


def add_spans(
    frame: DataFrame,
    text: str,
    find: Callable[[str], Iterable[Span]],
    kinds: Sequence[str],
) -> DataFrame:
    """``frame`` with ``spans``: what ``find`` gives, by start, then kind as listed, then end.

    Null text counts as empty. A column of the input that is called ``spans`` is replaced.
    """
    order = {kind: k for k, kind in enumerate(kinds)}
    kept = [c for c in frame.columns if c != "spans"]
    source = frame.select(*(F.col(f"`{c}`") for c in kept))
    at = kept.index(text)
    names = ("kind", "start", "end", "base", "score")

    def run(batches):
        for batch in batches:
            found = []
            for value in batch.column(at).to_pylist():
                spans = sorted(find(value), key=lambda s: (s[1], order[s[0]], s[2])) if value else []
                found.append([dict(zip(names, s, strict=True)) for s in spans])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, type=_ARROW)], names=[*kept, "spans"]
            )

    return arrow_map(source, run, extended(source.schema, spans=ArrayType(SPAN)))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def digest_columns(kinds: Sequence[str]) -> list[Column]:
    """Counts of base spans by kind, their digest, and all spans as text."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return [
        *(count(kind).alias(f"n_{kind}") for kind in kinds),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    ]

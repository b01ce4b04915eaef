"""Keep messages from being stored twice, and unreadable ones from being lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.schemas import RECORD_ID, UNDECODED

# Most varied column first: sorting compares its prefix, and nearly always stops there.
IDENTITY = list(reversed(RECORD_ID))
SMALL_TABLE_ROWS = 10_000


def _few_rows(df: DataFrame, row_limit: int) -> DataFrame | None:
    """A local copy of ``df`` marked for broadcast, or None when it has more rows than that.

    Never more than the limit reaches the driver. For narrow tables only.
    """
    rows = df.limit(row_limit + 1).collect()
    if len(rows) > row_limit:
        return None
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def broadcast_if_small(df: DataFrame, row_limit: int = SMALL_TABLE_ROWS) -> DataFrame:
    """``df`` as a broadcast table when it is small, else ``df`` itself, joined by shuffle."""
    few = _few_rows(df, row_limit)
    return df if few is None else few


def drop_replayed(log: DataFrame, row_limit: int = SMALL_TABLE_ROWS) -> DataFrame:
    """Each message once, by its identity; never by content, which may rightly repeat.

    Repeated identities are looked for first, without the values. While they are few, only
    their own messages are shuffled; the others pass. Copies collapse in the tasks that read
    them, so a message sent many times does not make a large group.
    """
    repeated = (
        log.groupBy(*IDENTITY)
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
        .select(*IDENTITY)
    )
    few = _few_rows(repeated, row_limit)
    if few is None:
        return log.dropDuplicates(IDENTITY)
    once = log.join(few, IDENTITY, "left_anti").select(*log.columns)
    again = log.join(few, IDENTITY, "left_semi").select(*log.columns)
    return once.unionByName(again.dropDuplicates(IDENTITY))


def high_water_marks(stored: DataFrame) -> DataFrame:
    """Highest stored offset per topic and partition: one row per broker partition."""
    return stored.groupBy("topic", "partition").agg(F.max("offset").alias("high_water"))


def _above_mark() -> Column:
    return F.col("high_water").isNull() | (F.col("offset") > F.col("high_water"))


def beyond_high_water(batch: DataFrame, marks: DataFrame) -> DataFrame:
    """Messages above the stored marks; exact for a source that is read in offset order.

    The marks are broadcast when few, so the messages themselves are not shuffled.
    """
    marked = batch.join(broadcast_if_small(marks), ["topic", "partition"], "left")
    return marked.filter(_above_mark()).select(*batch.columns)


def new_records(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Messages of the batch that are not stored yet, whatever order they come in.

    Only identities at or below the marks can be stored already, so only those are looked up.
    A source read in order has none, and then the messages pass without a shuffle.
    """
    marks = broadcast_if_small(high_water_marks(stored))
    late = (
        batch.select(*IDENTITY)
        .join(marks, ["topic", "partition"], "left")
        .filter(~_above_mark())
        .select(*IDENTITY)
        .distinct()
    )
    known = late.join(stored.select(*IDENTITY), IDENTITY, "left_semi")
    unknown = batch.join(broadcast_if_small(known), IDENTITY, "left_anti")
    return unknown.select(*batch.columns)


def undecodable(bronze: DataFrame) -> DataFrame:
    """Stored messages whose bytes are not UTF-8."""
    return bronze.filter(F.col(UNDECODED).isNotNull()).select(*RECORD_ID, UNDECODED)

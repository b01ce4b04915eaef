"""The change log as a history of row versions, each with the time it was valid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.changes import CHANGE_ORDER, STATE_COLUMNS, STATE_KEY, live_rows, with_change_key
from millrace.schemas import Entity

# Bounds of all commit times in milliseconds; a change without one is older than any other.
FOREVER = (1 << 63) - 1
NEVER = -(1 << 63)
HISTORY_COLUMNS = (*STATE_KEY, "valid_from", "valid_to", "op", *CHANGE_ORDER, "after_json")
ENDED = "ended"


def change_history(events: DataFrame, entity: Entity) -> DataFrame:
    """A row for each change that was ever the newest of its key, with ``[valid_from, valid_to)``.

    ``ended`` is the month in which it was superseded, null while it is current: as a partition
    column it keeps a look at some time off all that had ended before. The changes of a key are
    sorted by one task, which spills; they are not held together.
    """
    own = events.filter(entity.matches(F.col("topic")))
    keyed = with_change_key(own, entity.key, entity.key_type).select(*STATE_COLUMNS)
    start = F.coalesce("change_ts", F.lit(NEVER))
    order = Window.partitionBy(*STATE_KEY).orderBy(*(F.col(name).asc_nulls_first() for name in CHANGE_ORDER))
    until = F.coalesce(F.lead("valid_from").over(order), F.lit(FOREVER))
    month = F.trunc(F.timestamp_millis("valid_to"), "month")
    return (
        keyed.withColumn("valid_from", start)
        .withColumn("valid_to", until)
        .filter(F.col("valid_from") < F.col("valid_to"))
        .select(*HISTORY_COLUMNS, F.when(F.col("valid_to") != FOREVER, month).alias(ENDED))
    )


def versions_at(history: DataFrame, ts_ms: int) -> DataFrame:
    """The state at a commit time, both ends included. Partitions that ended before are not read."""
    month = F.trunc(F.timestamp_millis(F.lit(ts_ms)), "month")
    open_then = F.col(ENDED).isNull() | (F.col(ENDED) >= month)
    within = (F.col("valid_from") <= ts_ms) & (F.col("valid_to") > ts_ms)
    return history.filter(open_then & within).select(*STATE_COLUMNS)


def rows_at(history: DataFrame, entity: Entity, ts_ms: int) -> DataFrame:
    """The mirror as it stood at a commit time."""
    return live_rows(versions_at(history, ts_ms), entity)

"""From a log of row changes to the current rows of each source table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import undecoded_bytes, utf8_text
from millrace.schemas import (
    BRONZE_CHANGE_SCHEMA,
    CUSTOMERS,
    DELETE_OP,
    ENVELOPE_SCHEMA,
    UNDECODED,
    Entity,
    column_names,
)

# The varied column first: sorting compares its prefix, and nearly always stops there.
STATE_KEY = ("primary_key", "topic")
# Commit time, then log position, then message position: a total order of changes.
CHANGE_ORDER = ("change_ts", "change_lsn", "partition", "offset")
STATE_COLUMNS = (*STATE_KEY, "op", *CHANGE_ORDER, "after_json")


def _unpack_envelope(log: DataFrame) -> DataFrame:
    """The envelope is parsed once. It is unpacked by a generator because Spark would push a
    later filter into a plain projection and parse the text again for each use.
    """
    envelope = F.from_json("value_str", ENVELOPE_SCHEMA)["payload"]
    return (
        log.withColumn("value_str", utf8_text(F.col("value")))
        .select("*", F.inline(F.array(envelope)))
        .withColumnsRenamed(
            {"timestamp": "kafka_timestamp", "before": "before_json", "after": "after_json"}
        )
        .withColumn("lsn", F.col("source.lsn"))
    )


def parse_change_events(log: DataFrame, keep_undecoded: bool = False) -> DataFrame:
    """Messages with their change envelope split into columns; the raw text stays.

    With ``keep_undecoded`` bytes that are not UTF-8 are kept in a column of their own.
    """
    kept = [undecoded_bytes(F.col("value")).alias(UNDECODED)] if keep_undecoded else []
    return _unpack_envelope(log).select(*column_names(BRONZE_CHANGE_SCHEMA), *kept)


def _with_key_text(events: DataFrame, key: str) -> DataFrame:
    """Adds ``key_text``: the key of the new row image, else of the old one."""
    old_image = F.when(F.col("_new_key").isNull(), F.col("before_json"))
    return (
        events.select("*", F.json_tuple("after_json", key).alias("_new_key"))
        .select("*", F.json_tuple(old_image, key).alias("_old_key"))
        .withColumn("key_text", F.coalesce("_new_key", "_old_key"))
        .drop("_new_key", "_old_key")
    )


def with_change_key(events: DataFrame, key: str = "id", key_type: str = "int") -> DataFrame:
    """Events that concern one row, with its ``primary_key`` and a numeric order."""
    return (
        _with_key_text(events, key)
        .withColumns(
            {
                "primary_key": F.col("key_text").try_cast(key_type),
                "change_ts": F.col("ts_ms").try_cast("bigint"),
                "change_lsn": F.col("lsn").try_cast("bigint"),
            }
        )
        .drop("key_text")
        .filter(F.col("primary_key").isNotNull())
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key.

    Spark keeps one row per key and task before the shuffle, so a key that holds a large part
    of the log reaches its reducer as a few rows.
    """
    newest_first = Window.partitionBy(*keys).orderBy(
        *(F.col(name).desc_nulls_last() for name in order)
    )
    return (
        df.withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def change_state(events: DataFrame, entity: Entity) -> DataFrame:
    """The newest change of each key, delete markers included.

    Only the columns the state needs go through the shuffle; row images are still text.
    """
    own = events.filter(entity.matches(F.col("topic")))
    keyed = with_change_key(own, entity.key, entity.key_type)
    return latest_per_key(keyed.select(*STATE_COLUMNS), STATE_KEY, CHANGE_ORDER)


def live_rows(state: DataFrame, entity: Entity) -> DataFrame:
    """Mirror rows of a state: deleted keys are left out, images become typed columns."""
    images = state.filter(F.col("op") != DELETE_OP).select(
        F.json_tuple("after_json", *entity.columns).alias(*entity.columns)
    )
    return images.select(
        *(
            (F.col(name) if kind == "string" else F.col(name).try_cast(kind)).alias(name)
            for name, kind in entity.fields
        )
    )


def current_state(events: DataFrame, entity: Entity = CUSTOMERS) -> DataFrame:
    """The mirror of one source table, from its whole change log."""
    return live_rows(change_state(events, entity), entity)


def state_as_of(events: DataFrame, entity: Entity, ts_ms: int) -> DataFrame:
    """The mirror as it stood at a commit time, both ends included.

    A change without a readable commit time is older than any other, here as in the mirror.
    """
    time = F.col("ts_ms").try_cast("bigint")
    seen = events.filter(time.isNull() | (time <= ts_ms))
    return current_state(seen, entity)


def merge_state(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Fold the state of a batch of changes into an older state.

    Both sides hold one row per key, so the join cannot fan out. When the stored state is
    bucketed by the key only the batch is shuffled. Delete markers must still be in ``state``,
    or a late older change would bring a deleted row back.
    """
    old = state.withColumn("_present", F.lit(True)).alias("old")
    new = batch.withColumn("_present", F.lit(True)).alias("new")

    def position(side: str) -> Column:
        return F.struct(*(F.col(f"{side}.{name}") for name in CHANGE_ORDER))

    take_new = F.col("old._present").isNull() | (
        F.col("new._present").isNotNull() & (position("new") >= position("old"))
    )
    return old.join(new, list(STATE_KEY), "full_outer").select(
        *STATE_KEY,
        *(
            F.when(take_new, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)
            for name in STATE_COLUMNS[len(STATE_KEY) :]
        ),
    )


def _change_reject_reason(entity: Entity) -> Column:
    images = F.coalesce("op", "ts_ms", "before_json", "after_json")
    return (
        F.when(F.col("value").isNull() & F.col("value_str").isNull(), "no_value")
        .when(F.col("value_str").isNull(), "not_utf8")
        .when(images.isNull(), "no_envelope")
        .when(F.col("key_text").isNull(), "no_key")
        .when(F.col("key_text").try_cast(entity.key_type).isNull(), "bad_key")
        .when(F.col("op").isNull(), "no_op")
    )


def _rejected(events: DataFrame, entity: Entity, kept: Sequence[str]) -> DataFrame:
    reason = _change_reject_reason(entity).alias("reason")
    keyed = _with_key_text(events, entity.key)
    return keyed.select("topic", "partition", "offset", "value", reason, *kept).filter(F.col("reason").isNotNull())


def change_rejects(log: DataFrame, entity: Entity) -> DataFrame:
    """Messages of the entity that cannot give a mirror row or a delete, each with its reason.

    The raw bytes go along, so a message can be repaired and sent again.
    """
    return _rejected(_unpack_envelope(log.filter(entity.matches(F.col("topic")))), entity, ())


def bronze_change_rejects(bronze: DataFrame, entity: Entity, *kept: str) -> DataFrame:
    """The same from stored events, whose envelope has been read already.

    Bytes that are not UTF-8 come from their own column, the others from the stored text. The
    columns ``kept`` go along.
    """
    own = bronze.filter(entity.matches(F.col("topic")))
    raw = F.coalesce(UNDECODED, F.col("value_str").cast("binary"))
    return _rejected(own.withColumn("value", raw), entity, kept)

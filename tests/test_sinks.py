from __future__ import annotations

import datetime as dt

import pytest
from helpers import change, image, log, rows
from pyspark.sql import functions as F

from millrace.operators import live_rows, parse_change_events
from millrace.schemas import CUSTOMERS, DRIVERS
from millrace.sinks import (
    append_table,
    commit_version,
    expire_versions,
    in_time,
    laid_out,
    overwrite_partitions,
    overwrite_table,
    read_version,
    roll_back,
    snapshot_sql,
    version_history,
    writing,
)
from millrace.sources import read_table, read_zones
from millrace.streaming import fold_batch


def test_append_creates_then_matches_columns_by_name(spark, database):
    table = f"{database}.t"
    first = spark.createDataFrame([(1, "a")], "k int, v string")
    assert append_table(first, table) == 1
    assert append_table(spark.createDataFrame([("b", 2)], "v string, k int"), table) == 1
    assert rows(read_table(spark, table, ["k", "v"])) == [(1, "a"), (2, "b")]


def test_overwrite_replaces_rows_and_schema(spark, database):
    table = f"{database}.t"
    overwrite_table(spark.range(5), table)
    assert overwrite_table(spark.createDataFrame([("x",)], "v string"), table) == 1
    assert rows(spark.table(table)) == [("x",)]


def test_only_partitions_in_the_data_are_replaced(spark, database):
    table = f"{database}.t"
    days = [dt.date(2026, 1, d) for d in (1, 2, 3)]
    old = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "day date, v int")
    assert overwrite_partitions(old, table, "day") == 3
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    new = old.filter(F.col("day") == days[1]).withColumn("v", F.lit(9))
    for _ in range(2):
        assert overwrite_partitions(new, table, "day") == 1
    assert rows(spark.table(table).select("day", "v")) == [
        (days[0], 0),
        (days[1], 9),
        (days[2], 2),
    ]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_rows_are_shuffled_for_a_write_only_where_files_would_be_small(spark, database):
    few = spark.range(0, 60_000, 1, 2).select((F.col("id") % 3).cast("int").alias("p"), "id")
    many = few.withColumn("p", (F.col("id") % 30_000).cast("int"))

    def shuffled(frame, like):
        return "RebalancePartitions" in laid_out(frame, ["p"], like)._jdf.queryExecution().optimizedPlan().toString()

    assert not shuffled(few, few)
    assert shuffled(few, None) and shuffled(many, many) and shuffled(few.limit(10), few.limit(10))
    near = few.sortWithinPartitions("p")
    assert laid_out(few, ["p"], few, near) is near and laid_out(many, ["p"], many, near) is not near
    table = f"{database}.t"
    assert overwrite_partitions(few, table, "p", like=few) == 60_000
    names = spark.table(table).inputFiles()
    assert len(names) == 6 and all(".zstd." in name for name in names)
    assert rows(spark.table(table).groupBy("p").agg(F.count("*"), F.sum("id"))) == rows(few.groupBy("p").agg(F.count("*"), F.sum("id")))


def test_messages_are_written_by_time_and_without_dictionaries(spark, tmp_path):
    import pyarrow.parquet as pq

    def parse(messages):
        return messages.withColumn("day", F.to_date("timestamp"))

    when = dt.datetime(2026, 1, 1)
    sent = [("t", 0, k, when + dt.timedelta(days=k % 3), bytearray(b"x")) for k in range(9)]
    messages = log(spark, sent).coalesce(1)
    near = in_time(messages, parse, ["day"])
    assert [r.offset for r in near.collect()] != sorted(r.offset for r in near.collect())
    assert [r.day for r in near.collect()] == sorted(r.day for r in near.collect())
    assert in_time(messages, parse, ["topic"]) is None
    with writing(spark):
        near.write.parquet(f"{tmp_path}/out")
    for name in spark.read.parquet(f"{tmp_path}/out").inputFiles():
        group = pq.ParquetFile(name.removeprefix("file://")).metadata.row_group(0)
        encodings = {e for k in range(group.num_columns) for e in group.column(k).encodings}
        assert not any("DICTIONARY" in e for e in encodings)


def test_versions_history_and_rollback(spark, database):
    table = f"{database}.mirror"
    assert commit_version(spark.range(5), table) == 1
    assert commit_version(read_version(spark, table).filter("id > 2"), table) == 2
    assert read_version(spark, table).count() == 2
    assert read_version(spark, table, 1).count() == 5
    assert roll_back(spark, table, 1) == 3
    assert read_version(spark, table).count() == 5
    history = version_history(spark, table)
    assert [(r.version, r.operation, r.row_count) for r in history.collect()] == [
        (3, "rollback", 5),
        (2, "overwrite", 2),
        (1, "overwrite", 5),
    ]


def test_a_failed_commit_leaves_the_old_version_current(spark, database):
    table = f"{database}.mirror"
    commit_version(spark.range(5), table)
    broken = spark.range(1).select(F.raise_error(F.lit("stop")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        commit_version(broken, table)
    assert read_version(spark, table).count() == 5
    assert version_history(spark, table).count() == 1


def test_expired_versions_are_dropped_but_stay_in_the_history(spark, database):
    table = f"{database}.mirror"
    for rows_written in (1, 2, 3):
        commit_version(spark.range(rows_written), table)
    roll_back(spark, table, 1)
    assert expire_versions(spark, table, keep=2) == 1
    assert expire_versions(spark, table, keep=2) == 0
    assert read_version(spark, table).count() == 1
    assert read_version(spark, table, 3).count() == 3
    assert version_history(spark, table).count() == 4
    with pytest.raises(Exception, match="cannot be found"):
        read_version(spark, table, 2).count()


def test_unknown_version(spark, database):
    with pytest.raises(ValueError):
        read_version(spark, f"{database}.mirror")
    commit_version(spark.range(1), f"{database}.mirror")
    with pytest.raises(ValueError):
        read_version(spark, f"{database}.mirror", 7)


def test_snapshot_sql_names_version_and_history():
    assert snapshot_sql("cdc.t", 12).endswith("VERSION AS OF 12")
    assert "cdc.t.snapshots" in snapshot_sql("cdc.t")


def test_folding_the_same_batch_twice_changes_nothing(spark, database):
    state = f"{database}.state"
    one = parse_change_events(
        log(spark, [change(0, "c", 1, 1, after=image(1)), change(1, "d", 3, 3, before=image(2))])
    )
    two = parse_change_events(
        log(spark, [change(2, "u", 2, 2, after=image(2)), change(3, "c", 2, 4, after=image(3))])
    )
    for events in (one, two, two, one):
        fold_batch(events, CUSTOMERS, state, buckets=4)
    live = live_rows(read_version(spark, state), CUSTOMERS)
    assert rows(live.select("id")) == [(1,), (3,)]


def test_events_of_others_do_not_rewrite_the_state(spark, database):
    state = f"{database}.state"
    own = parse_change_events(log(spark, [change(0, "c", 1, 1, after=image(1))]))
    other = parse_change_events(
        log(spark, [change(0, "c", 1, 1, after=image(1), topic=DRIVERS.topic)])
    )
    assert fold_batch(other, CUSTOMERS, state, buckets=2) == 1
    assert read_version(spark, state).count() == 0
    assert fold_batch(own, CUSTOMERS, state, buckets=2) == 2
    assert fold_batch(other, CUSTOMERS, state, buckets=2) == 2
    assert version_history(spark, state).count() == 2


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_zones_are_read_with_two_columns(spark, tmp_path, kind):
    path = str(tmp_path / "zones")
    spark.createDataFrame(
        [(1, "A", "x"), (2, "B", "y")], f"LocationID {kind}, Zone string, Borough string"
    ).write.parquet(path)
    zones = read_zones(spark, path)
    assert zones.dtypes == [("LocationID", "int"), ("Zone", "string")]
    assert rows(zones) == [(1, "A"), (2, "B")]

from __future__ import annotations

import datetime as dt

from helpers import rows
from pyspark.sql import functions as F

from millrace.operators import (
    beyond_high_water,
    drop_replayed,
    duplicate_keys,
    freshness,
    high_water_marks,
    multiset_difference,
    new_records,
    reconcile,
    reconcile_counts,
    table_counts,
)

ROW = "id int, name string, city string"
POSITION = "topic string, partition int, offset bigint, value string"


def test_reconcile_names_each_difference(spark):
    source = spark.createDataFrame(
        [(1, "a", "x"), (2, "b", None), (3, "c", "x"), (4, None, None)], ROW
    )
    mirror = spark.createDataFrame(
        [(1, "a", "x"), (2, "b", "y"), (4, None, None), (5, "e", "x")], ROW
    )
    assert rows(reconcile(mirror, source, ["id"])) == [
        (1, "ok"),
        (2, "changed"),
        (3, "missing"),
        (4, "ok"),
        (5, "extra"),
    ]
    assert rows(reconcile_counts(mirror, source, ["id"])) == [
        ("changed", 1),
        ("extra", 1),
        ("missing", 1),
        ("ok", 2),
    ]


def test_reconcile_matches_columns_by_name(spark):
    source = spark.createDataFrame([(1, "a", "x")], ROW)
    assert rows(reconcile(source.select("city", "name", "id"), source, ["id"])) == [(1, "ok")]


def test_multiset_difference_counts_copies_and_nulls(spark):
    first = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id int, name string")
    second = spark.createDataFrame([("a", 1), (None, 2), (None, 2)], "name string, id int")
    assert rows(multiset_difference(first, second)) == [(1, "a", 1), (2, None, -1)]
    assert multiset_difference(first, first).count() == 0


def test_freshness(spark):
    start = dt.datetime(2026, 1, 1, 12, 0, 0)
    log = spark.createDataFrame(
        [("a", start), ("a", start + dt.timedelta(minutes=5)), ("b", start)],
        "topic string, timestamp timestamp",
    )
    now = F.lit(dt.datetime(2026, 1, 1, 12, 15, 0))
    assert [(r.topic, r.lag_seconds, r.is_fresh) for r in freshness(log, now).collect()] == [
        ("a", 600, True),
        ("b", 900, False),
    ]


def test_duplicate_keys(spark):
    table = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(duplicate_keys(table, ["k"])) == [(1, 2)]


def test_table_counts(spark):
    assert rows(table_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]


def positions(spark, *found):
    return spark.createDataFrame([("t", p, o, f"{p}-{o}") for p, o in found], POSITION)


def test_replayed_messages_collapse_by_identity(spark):
    log = positions(spark, (0, 1), (0, 1), (0, 2), (1, 1))
    for limit in (100, 0):
        once = drop_replayed(log, limit)
        assert once.columns == log.columns
        assert rows(once.select("partition", "offset")) == [(0, 1), (0, 2), (1, 1)]


def test_new_records_fill_gaps_and_new_partitions(spark):
    stored = positions(spark, (0, 1), (0, 5))
    batch = positions(spark, (0, 1), (0, 3), (0, 5), (0, 6), (2, 0))
    assert rows(new_records(batch, stored).select("partition", "offset")) == [
        (0, 3),
        (0, 6),
        (2, 0),
    ]
    assert new_records(stored, stored).count() == 0
    assert new_records(batch, stored.limit(0)).count() == 5


def test_high_water_marks_pass_only_what_is_above(spark):
    stored = positions(spark, (0, 1), (0, 5))
    batch = positions(spark, (0, 3), (0, 5), (0, 6), (2, 0))
    above = beyond_high_water(batch, high_water_marks(stored))
    assert rows(above.select("partition", "offset")) == [(0, 6), (2, 0)]


def test_marks_too_many_to_broadcast_give_the_same_rows(spark, monkeypatch):
    from millrace.operators import ingest

    stored = positions(spark, (0, 1), (1, 5))
    batch = positions(spark, (0, 1), (0, 2), (1, 5), (2, 0))
    small = rows(new_records(batch, stored))
    monkeypatch.setattr(ingest.broadcast_if_small, "__defaults__", (0,))
    assert rows(new_records(batch, stored)) == small

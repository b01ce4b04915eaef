from __future__ import annotations

import datetime as dt
import json
import re

import pytest
from helpers import WHEN, change, image, log, raw, rows, trip
from pyspark.sql import functions as F

from millrace import schemas
from millrace.__main__ import main
from millrace.config import PipelineConfig
from millrace.operators import (
    clean_trips,
    current_state,
    enrich_zones,
    live_rows,
    multiset_difference,
    parse_change_events,
    parse_trips,
    undecodable,
    zone_stats,
)
from millrace.plans import (
    Folders,
    ValidationError,
    backfill,
    restore,
    run_incremental,
    run_pipeline,
)
from millrace.plans.batch import counts, stale_topics
from millrace.schemas import CUSTOMERS, CUSTOMERS_TOPIC, DRIVERS, DRIVERS_TOPIC, TRIPS_TOPIC
from millrace.sinks import append_table, version_history
from millrace.sources import LogSource
from millrace.workload import feeds

SF = "/root/testdata/sf0.001"
CONTRACT = {
    "bronze_cdc_events": schemas.BRONZE_CHANGE_SCHEMA,
    "silver_customers": "id int, name string, email string, country string",
    "silver_taxi_trips": schemas.SILVER_TRIP_SCHEMA,
    "gold_taxi_aggregates": schemas.GOLD_SCHEMA,
}


def same(first, second):
    return multiset_difference(first, second).count() == 0


def partition_filters(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text, re.S).group(1)


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    changes = feeds.customers_log(spark, SF).unionByName(feeds.drivers_log(spark, SF))
    changes.unionByName(changes).write.parquet(str(root / "changes"))
    feeds.trips_log(spark, SF).coalesce(2).write.parquet(str(root / "trips"))
    feeds.zones(spark, SF).write.parquet(str(root / "zones"))
    return root


def config(inputs, database, location):
    return PipelineConfig(
        changes=LogSource((CUSTOMERS_TOPIC, DRIVERS_TOPIC), path=str(inputs / "changes")),
        trips=LogSource((TRIPS_TOPIC,), path=str(inputs / "trips")),
        zones_path=str(inputs / "zones"),
        database=database,
        database_location=str(location),
        state_buckets=4,
        partition_grain="month",
    )


def expected(spark, inputs):
    events = parse_change_events(spark.read.parquet(str(inputs / "changes")))
    bronze = parse_trips(spark.read.parquet(str(inputs / "trips")))
    trips = enrich_zones(clean_trips(bronze), feeds.zones(spark, SF))
    return (
        current_state(events, CUSTOMERS),
        current_state(events, DRIVERS),
        zone_stats(trips),
    )


def test_two_runs_give_one_result_and_backfill_keeps_it(spark, inputs, database, tmp_path):
    cfg = config(inputs, database, tmp_path)
    customers, drivers, gold = expected(spark, inputs)
    sources = {"customers": customers, "drivers": drivers}
    first = run_pipeline(spark, cfg, sources)
    second = run_pipeline(spark, cfg, sources)
    assert first.rows["bronze_cdc_events"] == 2650
    assert first.rows["bronze_taxi_trips"] == spark.read.parquet(str(inputs / "trips")).count()
    assert second.rows["bronze_cdc_events"] == second.rows["bronze_taxi_trips"] == 0
    for name in ("customers", "drivers", "silver_taxi_trips", "gold_taxi_aggregates"):
        assert first.rows[name] == second.rows[name] > 0
    assert first.rows["silver_taxi_trips"] == 5747
    assert first.rows["gold_taxi_aggregates"] == 4894
    assert same(spark.table(f"{database}.gold_taxi_aggregates"), gold)
    for name, schema in CONTRACT.items():
        want = [tuple(part.split()) for part in schema.split(", ")]
        assert spark.table(f"{database}.{name}").dtypes == want
    assert rows(counts(spark, cfg)) == [
        ("customers", customers.count()),
        ("drivers", drivers.count()),
    ]

    changes = spark.table(f"{database}.bronze_cdc_events")
    assert "topic#" in partition_filters(current_state(changes, CUSTOMERS))
    march = F.col("pickup_date") == F.lit(dt.date(1997, 3, 1))
    trips = spark.table(cfg.data("bronze_taxi_trips")).filter(march)
    assert "pickup_date#" in partition_filters(clean_trips(trips))
    report = backfill(spark, cfg, dt.date(1997, 3, 1), dt.date(1997, 5, 1))
    assert 0 < report.rows["silver_taxi_trips"] < 5747
    assert spark.table(f"{database}.silver_taxi_trips").count() == 5747
    assert same(spark.table(f"{database}.gold_taxi_aggregates"), gold)
    assert version_history(spark, cfg.data("silver_customers")).count() == 2
    with pytest.raises(ValueError, match="first days"):
        backfill(spark, cfg, dt.date(1997, 3, 2), dt.date(1997, 5, 1))


def test_mirror_that_differs_from_its_source_stops_the_run(spark, inputs, database, tmp_path):
    cfg = config(inputs, database, tmp_path)
    customers, _, _ = expected(spark, inputs)
    wrong = customers.withColumn("name", F.lit("someone else"))
    with pytest.raises(ValidationError, match="changed"):
        run_pipeline(spark, cfg, {"customers": wrong})
    now = dt.datetime(2024, 1, 30, 23, 30, 0)
    assert {row.topic for row in stale_topics(spark, cfg, now).collect()} == {
        CUSTOMERS_TOPIC,
        TRIPS_TOPIC,
    }


def test_a_bad_rebuild_can_be_taken_back(spark, inputs, database, tmp_path):
    cfg = config(inputs, database, tmp_path)
    run_pipeline(spark, cfg)
    view = f"{database}.silver_customers"
    before = rows(spark.table(view))
    mistake = change(10**9, "d", 10**15, 1, before=image(before[0][0]))
    wrong = parse_change_events(log(spark, [mistake]), keep_undecoded=True)
    wrong = wrong.withColumn("load", F.lit(1).cast("bigint"))
    append_table(wrong, cfg.data("bronze_cdc_events"), partition_by=["load", "topic"])
    run_pipeline(spark, cfg)
    assert rows(spark.table(view)) == before[1:]
    restore(spark, cfg, "silver_customers", 1)
    assert rows(spark.table(view)) == before


def test_incremental_runs_equal_one_whole_run(spark, inputs, database, tmp_path):
    changes, trips = str(tmp_path / "changes"), str(tmp_path / "trips")
    cfg = PipelineConfig(
        changes=LogSource((CUSTOMERS_TOPIC, DRIVERS_TOPIC), path=changes),
        trips=LogSource((TRIPS_TOPIC,), path=trips),
        zones_path=str(inputs / "zones"),
        database=database,
        state_buckets=4,
        partition_grain="month",
    )
    folders = Folders(str(tmp_path / "run"))
    sent = spark.read.parquet(str(inputs / "changes"))
    all_changes = sent.dropDuplicates(["topic", "partition", "offset"])
    all_trips = spark.read.parquet(str(inputs / "trips"))
    late = F.col("timestamp") >= F.lit("1998-01-01").cast("timestamp")
    for part in (late, F.lit(True)):  # the second delivery holds all of the first again
        sent.filter(part).coalesce(1).write.mode("append").parquet(changes)
        all_trips.filter(part).coalesce(1).write.mode("append").parquet(trips)
        run_incremental(spark, cfg, folders)
        assert spark.table(cfg.table("gold_taxi_aggregates")).count() > 0
    run_incremental(spark, cfg, folders)

    customers, drivers, gold = expected(spark, inputs)
    for entity, want in ((CUSTOMERS, customers), (DRIVERS, drivers)):
        state = spark.table(cfg.table(f"{entity.name}_state"))
        assert same(live_rows(state, entity), want)
        assert same(spark.table(cfg.table(cfg.mirror(entity))), want)
    assert spark.table(cfg.table("bronze_cdc_events")).count() == all_changes.count()
    assert spark.table(cfg.table("bronze_taxi_trips")).count() == all_trips.count()
    trips = enrich_zones(clean_trips(parse_trips(all_trips)), feeds.zones(spark, SF))
    assert same(spark.table(cfg.table("silver_taxi_trips")), trips)
    stored = spark.table(f"{database}.gold_taxi_aggregates")
    zoned = spark.table(cfg.table("silver_taxi_trips")).filter(F.col("pickup_zone").isNotNull())
    assert stored.agg(F.sum("total_trips")).first()[0] == zoned.count()
    assert same(stored, gold)


def test_undecodable_messages_are_kept_as_bytes(spark, inputs, database, tmp_path):
    bad, none = raw(7, b"\xff\xfe", TRIPS_TOPIC), raw(8, None, TRIPS_TOPIC)
    good = trip(9)
    schema = spark.read.parquet(str(inputs / "trips")).schema
    spark.createDataFrame([bad, none, good], schema).write.parquet(str(tmp_path / "trips"))
    cfg = PipelineConfig(
        changes=LogSource((CUSTOMERS_TOPIC, DRIVERS_TOPIC), path=str(inputs / "changes")),
        trips=LogSource((TRIPS_TOPIC,), path=str(tmp_path / "trips")),
        zones_path=str(inputs / "zones"),
        database=database,
    )
    for _ in range(2):
        run_pipeline(spark, cfg)
    kept = undecodable(spark.table(cfg.data("bronze_taxi_trips")))
    assert [(row.offset, bytes(row.undecoded)) for row in kept.collect()] == [(7, b"\xff\xfe")]
    assert spark.table(f"{database}.silver_taxi_rejects").count() == 2
    assert spark.table(f"{database}.silver_taxi_trips").count() == 1
    assert WHEN == spark.table(f"{database}.bronze_taxi_trips").first().kafka_timestamp


def test_incremental_run_with_nothing_waiting(spark, inputs, database, tmp_path):
    empty = str(tmp_path / "empty")
    spark.read.parquet(str(inputs / "trips")).limit(0).write.parquet(empty)
    cfg = PipelineConfig(
        changes=LogSource((CUSTOMERS_TOPIC,), path=empty),
        trips=LogSource((TRIPS_TOPIC,), path=empty),
        zones_path=str(inputs / "zones"),
        database=database,
    )
    for _ in range(2):
        run_incremental(spark, cfg, Folders(str(tmp_path / "run")))
    assert spark.catalog.listTables(database) == []


def test_command_line_runs_stages_and_reports(spark, inputs, database, tmp_path, capsys):
    config_file = tmp_path / "config.json"
    config_file.write_text(
        json.dumps(
            {
                "changes": {
                    "topics": [CUSTOMERS_TOPIC, DRIVERS_TOPIC],
                    "path": str(inputs / "changes"),
                },
                "trips": {"topics": [TRIPS_TOPIC], "path": str(inputs / "trips")},
                "zones_path": str(inputs / "zones"),
                "database": database,
                "partition_grain": "month",
            }
        )
    )
    customers, _, _ = expected(spark, inputs)
    customers.write.parquet(str(tmp_path / "customers"))

    def run(*argv):
        status = main([str(config_file), *argv])
        return status, capsys.readouterr().out

    status, out = run("run", "ingest-changes", "mirrors", "--source", f"customers={tmp_path}/customers")
    assert status == 0
    assert f"customers: {customers.count()} rows" in out
    assert "silver_taxi_trips" not in out
    status, out = run("run")
    assert (status, "silver_taxi_trips: 5747 rows" in out) == (0, True)
    assert run("report")[1].count("\n|") == 1 + 10
    assert str(customers.count()) in run("counts")[1]
    assert run("backfill", "1997-03-01", "1997-04-01")[0] == 0
    assert run("restore", "silver_customers", "1")[0] == 0
    assert run("freshness", "1990-01-01T00:00:00")[0] == 0
    assert run("freshness", "2030-01-01T00:00:00")[0] == 1

"""The physical plans that the operators are meant to have."""

from __future__ import annotations

import re
from contextlib import contextmanager

from helpers import change, image, log
from pyspark.sql import functions as F

from millrace.operators import (
    DimensionFacts,
    change_state,
    clean_trips,
    current_state,
    enrich_zones,
    heavy_places,
    latest_hours,
    merge_state,
    multiset_difference,
    parse_change_events,
    parse_trips,
    trip_rejects,
    zone_stats,
)
from millrace.operators.changes import STATE_KEY
from millrace.operators.zones import MOST_HEAVY
from millrace.schemas import CUSTOMERS, CUSTOMERS_TOPIC
from millrace.sinks import commit_version, read_version
from millrace.workload import feeds

SF = "/root/testdata/sf0.001"
LARGE = DimensionFacts(rows=10**9, name_bytes=10**10, most_copies=1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def conf(spark, **settings):
    keys = {name.replace("__", "."): value for name, value in settings.items()}
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def stored_log(spark, frame, path):
    frame.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_newest_change_is_cut_to_one_row_per_task_before_the_shuffle(spark, tmp_path):
    stored = stored_log(spark, feeds.customers_log(spark, SF), tmp_path / "log")
    text = plan(current_state(parse_change_events(stored)))
    assert re.search(r"WindowGroupLimit.*Final.*Exchange hash.*WindowGroupLimit.*Partial", text, re.S)
    assert text.count("Exchange hash") == 1


def test_topic_filter_reaches_the_scan_below_the_parse(spark, tmp_path):
    stored = stored_log(spark, feeds.customers_log(spark, SF), tmp_path / "log")
    text = plan(current_state(parse_change_events(stored)))
    assert f"EqualTo(topic,{CUSTOMERS_TOPIC})" in text
    assert text.count("from_json") == 1


def test_bronze_read_prunes_columns(spark, tmp_path):
    events = parse_change_events(feeds.customers_log(spark, SF))
    stored = stored_log(spark, events, tmp_path / "bronze")
    read = re.search(r"ReadSchema: (\S+)", plan(current_state(stored))).group(1)
    assert "value_str" not in read and "kafka_timestamp" not in read


def test_trip_text_is_parsed_once_and_filtered_after(spark, tmp_path):
    stored = stored_log(spark, feeds.trips_log(spark, SF), tmp_path / "log")
    text = plan(clean_trips(parse_trips(stored)))
    assert text.count("Generate json_tuple") == 1
    assert "get_json_object" not in text and "from_json" not in text


def test_stored_trips_are_cleaned_without_their_raw_text(spark, tmp_path):
    stored = stored_log(spark, parse_trips(feeds.trips_log(spark, SF)), tmp_path / "bronze")
    for frame in (clean_trips(stored), trip_rejects(stored)):
        assert "value_str" not in re.search(r"ReadSchema: (\S+)", plan(frame)).group(1)


def test_small_dimension_is_broadcast_and_statistics_shuffle_once(spark, tmp_path):
    stored = stored_log(spark, feeds.trips_log(spark, SF), tmp_path / "log")
    trips = clean_trips(parse_trips(stored))
    enriched = enrich_zones(trips, feeds.zones(spark, SF))
    text = plan(zone_stats(enriched))
    assert text.count("BroadcastHashJoin") == 2
    assert text.count("Exchange hash") == 1
    assert "partial_count" in text


def test_large_dimension_is_not_broadcast_and_gives_the_same_rows(spark):
    trips = clean_trips(parse_trips(feeds.trips_log(spark, SF)))
    zones = feeds.zones(spark, SF)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        shuffled = enrich_zones(trips, zones, facts=LARGE)
        text = plan(shuffled)
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
        assert multiset_difference(shuffled, enrich_zones(trips, zones)).count() == 0


def test_hot_place_is_split_when_the_dimension_is_shuffled(spark, tmp_path):
    hot = F.when(F.col("l_linenumber") <= 3, F.lit(7)).otherwise(F.col("l_partkey"))
    frame = feeds.trips_log(spark, "/root/testdata/sf0.01", hot, F.col("l_suppkey"))
    stored = stored_log(spark, frame.repartition(16), tmp_path / "log")
    zones = feeds.part_zones(spark, "/root/testdata/sf0.01")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = enrich_zones(clean_trips(parse_trips(stored)), zones, ["pickup"], LARGE)
        assert joined.filter("pulocation_id = 7").count() > 0
        rows = joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(rows) == clean_trips(parse_trips(stored)).count()


def test_heavy_and_missing_places_are_dealt_to_many_tasks(spark, tmp_path):
    line = F.col("l_linenumber")
    place = F.when(line <= 2, F.lit(7).cast("bigint")).when(line > 3, F.col("l_partkey"))
    clean_trips(parse_trips(feeds.trips_log(spark, SF, place, F.col("l_suppkey")))).write.parquet(str(tmp_path / "t"))
    trips, zones = spark.read.parquet(str(tmp_path / "t")), feeds.part_zones(spark, SF)
    heavy = heavy_places(trips, ["pickup"])
    assert 7 in heavy["pickup"] and len(heavy["pickup"]) <= MOST_HEAVY

    def largest(frame):
        sizes = [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]
        return max(sizes) / (sum(sizes) / 8)

    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        plain = enrich_zones(trips, zones, ["pickup"], LARGE)
        dealt = enrich_zones(trips, zones, ["pickup"], LARGE, heavy)
        assert largest(plain) > 2.5 and largest(dealt) < 1.5
        assert multiset_difference(plain, dealt).count() == 0


def test_report_is_a_top_k_without_a_global_sort(spark):
    trips = clean_trips(parse_trips(feeds.trips_log(spark, SF)))
    text = plan(latest_hours(zone_stats(enrich_zones(trips, feeds.zones(spark, SF), ["pickup"]))))
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


def test_bucketed_state_is_not_shuffled_by_a_fold(spark, database):
    events = parse_change_events(log(spark, [change(0, "c", 1, 1, after=image(1))]))
    state = change_state(events, CUSTOMERS)
    table = f"{database}.state"
    commit_version(state.repartition(4, *STATE_KEY), table, bucket_by=(STATE_KEY, 4))
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        merged = merge_state(read_version(spark, table), state.repartition(4, *STATE_KEY))
        text = plan(merged)
    scan_side = text[: text.index("FileScan")]
    assert "Bucketed: true" in text
    assert "Exchange" not in scan_side.split("SortMergeJoin")[1]

"""The registered queries: every operator, run over whole tables turned into message logs."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.config import PARTITION, PipelineConfig
from millrace.operators import (
    DimensionFacts,
    beyond_high_water,
    change_history,
    change_rejects,
    change_state,
    clean_trips,
    current_state,
    drop_replayed,
    duplicate_keys,
    enrich_zones,
    fingerprint_difference,
    finished_stats,
    freshness,
    heavy_places,
    high_water_marks,
    latest_hours,
    live_rows,
    merge_state,
    multiset_difference,
    new_records,
    offset_intervals,
    parse_change_events,
    parse_trips,
    reconcile_by_buckets,
    reconcile_counts,
    rows_at,
    state_as_of,
    table_counts,
    table_fingerprint,
    trip_rejects,
    with_change_key,
    zone_stats,
)
from millrace.operators.zones import BROADCAST_ROW_LIMIT
from millrace.plans import Flow, Folders, backfill, run_incremental, run_pipeline, take_back
from millrace.plans.batch import stale_topics
from millrace.schemas import (
    BRONZE_CHANGES,
    BRONZE_TRIPS,
    CUSTOMERS_TOPIC,
    DRIVERS_TOPIC,
    GOLD_STATS,
    RECORD_ID,
    SILVER_CUSTOMERS,
    SILVER_DRIVERS,
    SILVER_TRIPS,
    TRIPS_TOPIC,
    Entity,
)
from millrace.session import shared_folder
from millrace.sinks import (
    LoadedFiles,
    LoadedMessages,
    append_table,
    commit_version,
    ensure_database,
    overwrite_partitions,
    read_version,
    roll_back,
    version_history,
    writing,
)
from millrace.sources import LogSource, stream_log
from millrace.streaming import (
    ClosedHours,
    fold_touched,
    run_append,
    run_ingest,
    run_mirror,
    run_stored_mirror,
)
from millrace.workload import feeds

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values shared with the SQL counterparts.
AS_OF_MS = 1_705_276_800_000  # 2024-01-15 00:00 UTC
NOW = "2024-01-31 00:00:00"
INTERVAL = (dt.datetime(1997, 3, 1), dt.datetime(1997, 4, 1))
SPOT_CHECK_NAME = "Customer#000000007"



def _typed(entity: Entity, **kinds: str) -> Entity:
    fields = tuple((name, kinds.get(name, kind)) for name, kind in entity.fields)
    return replace(entity, fields=fields)


# The tables have 64-bit keys.
CUSTOMERS = _typed(schemas.CUSTOMERS, id="bigint")
DRIVERS = _typed(schemas.DRIVERS, id="bigint")
TYPED_DRIVERS = _typed(DRIVERS, rating="double", active="boolean")


def _local(df: DataFrame, *columns: str) -> DataFrame:
    """Instants as zone-less timestamps, which is what the SQL side compares."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in columns})


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_change_events(feeds.customers_log(spark, sf_dir))


def _driver_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_change_events(feeds.drivers_log(spark, sf_dir))


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(parse_trips(feeds.trips_log(spark, sf_dir)))


def _pickup_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_zones(_trips(spark, sf_dir), feeds.zones(spark, sf_dir), ["pickup"])


def _scratch_database(spark: SparkSession) -> str:
    name = f"millrace_{uuid.uuid4().hex[:12]}"
    ensure_database(spark, name, shared_folder(spark, name))
    return name


# --- changes -------------------------------------------------------------------------------


def cdc_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _local(_changes(spark, sf_dir).drop("value_str"), "kafka_timestamp")


def cdc_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = with_change_key(_driver_changes(spark, sf_dir), key_type="bigint")
    return keyed.select("topic", "offset", "primary_key", "change_ts", "change_lsn")


def cdc_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_state(_changes(spark, sf_dir), CUSTOMERS).drop("after_json")


def cdc_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_state(_changes(spark, sf_dir), CUSTOMERS)


def cdc_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_state(_driver_changes(spark, sf_dir), TYPED_DRIVERS)


def cdc_two_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both topics in one log, as a comma list subscription gives them."""
    log = feeds.customers_log(spark, sf_dir).unionByName(feeds.drivers_log(spark, sf_dir))
    events = parse_change_events(log)
    mirrors = [current_state(events, entity).select("id", "name") for entity in (CUSTOMERS, DRIVERS)]
    return mirrors[0].unionByName(mirrors[1])


def cdc_topic_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic chosen by a word in its name instead of by the full name."""
    by_word = replace(CUSTOMERS, topic="customers", any_topic_containing=True)
    return current_state(_changes(spark, sf_dir), by_word)


def cdc_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _changes(spark, sf_dir)
    return current_state(events.unionByName(events), CUSTOMERS)


def cdc_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_as_of(_driver_changes(spark, sf_dir), TYPED_DRIVERS, AS_OF_MS)


def cdc_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four stretches of the log, folded out of order, third first."""
    events = _driver_changes(spark, sf_dir)
    time = F.col("kafka_timestamp")
    cuts = [F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp") for day in (8, 15, 22)]
    stretches = [
        events.filter(time < cuts[0]),
        events.filter((time >= cuts[0]) & (time < cuts[1])),
        events.filter((time >= cuts[1]) & (time < cuts[2])),
        events.filter(time >= cuts[2]),
    ]
    state = change_state(stretches[2], TYPED_DRIVERS)
    for number in (0, 3, 1):
        state = merge_state(state, change_state(stretches[number], TYPED_DRIVERS))
    return live_rows(state, TYPED_DRIVERS)


def cdc_hot_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log in which two kinds of event out of five, whoever caused them, change one driver."""
    driver = F.when(F.col("event_type").isin("click", "signup"), F.lit(7).cast("bigint"))
    log = feeds.drivers_log(spark, sf_dir, driver.otherwise(F.col("user_id")))
    return current_state(parse_change_events(log), TYPED_DRIVERS)


def cdc_op_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir).groupBy("op").agg(F.count("*").alias("events"))


def cdc_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose value is damaged by the event's own kind, then counted by reason."""
    kind, value = F.col("kind"), F.col("value")
    log = feeds.drivers_log(spark, sf_dir).withColumn(
        "kind", F.get_json_object(value.cast("string"), "$.payload.after.city")
    )
    spoiled = (
        F.when(kind == "click", F.unhex(F.lit("FF7B")))
        .when(kind == "view", F.lit(None))
        .when(kind == "purchase", F.lit('{"payload":{"op":"t"}}').cast("binary"))
        .otherwise(value)
    )
    rejects = change_rejects(log.withColumn("value", spoiled).drop("kind"), DRIVERS)
    return rejects.groupBy("reason").agg(F.count("*").alias("messages"))


def spot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc_customers(spark, sf_dir).filter(F.col("name") == SPOT_CHECK_NAME)


# --- trips ---------------------------------------------------------------------------------


def trip_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_trips(feeds.trips_log(spark, sf_dir)).drop(
        *RECORD_ID, "kafka_timestamp", "value_str"
    )
    texts = ("VendorID", "pickup_datetime", "dropoff_datetime")
    return parsed.select(
        *(
            F.col(name) if name in texts else F.col(name).try_cast("double").alias(name)
            for name in parsed.columns
        )
    )


def trip_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _local(_trips(spark, sf_dir), "pickup_datetime", "dropoff_datetime")


def trip_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = enrich_zones(_trips(spark, sf_dir), feeds.zones(spark, sf_dir))
    return _local(enriched, "pickup_datetime", "dropoff_datetime")


def trip_enrich_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension that grows with the trips: broadcast while small, shuffled beyond that."""
    log = feeds.trips_log(spark, sf_dir, F.col("l_partkey"), F.col("l_suppkey"))
    enriched = enrich_zones(clean_trips(parse_trips(log)), feeds.part_zones(spark, sf_dir))
    return enriched.select(
        "pulocation_id", "dolocation_id", "fare_amount", "pickup_zone", "dropoff_zone"
    )


def trip_zone_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    unmatched = _pickup_trips(spark, sf_dir).filter(F.col("pickup_zone").isNull())
    return unmatched.groupBy("pulocation_id").agg(F.count("*").alias("trips"))


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = parse_trips(feeds.trips_log(spark, sf_dir, spoil=True))
    return trip_rejects(bronze).groupBy("reject_reason").agg(F.count("*").alias("trips"))


def zone_key_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers taken as a zone dimension: their nation is not a unique key."""
    by_nation = feeds.table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("LocationID"), F.col("s_name").alias("Zone")
    )
    return duplicate_keys(by_nation, ["LocationID"])


def line_key_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.table(spark, sf_dir, "lineitem")
    return duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


# --- statistics ----------------------------------------------------------------------------


def gold_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _local(zone_stats(_pickup_trips(spark, sf_dir)), "pickup_hour")


def gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _local(zone_stats(_pickup_trips(spark, sf_dir), "day"), "pickup_day")


def gold_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _local(latest_hours(zone_stats(_pickup_trips(spark, sf_dir))), "pickup_hour")


def gold_hot_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of which the first three lines of every order start in one zone."""
    place = F.when(F.col("l_linenumber") <= 3, F.lit(7).cast("bigint"))
    log = feeds.trips_log(spark, sf_dir, place.otherwise(F.col("l_partkey") % 30))
    trips = enrich_zones(clean_trips(parse_trips(log)), feeds.zones(spark, sf_dir), ["pickup"])
    return _local(zone_stats(trips), "pickup_hour")


def backfill_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = (F.lit(edge).cast("timestamp") for edge in INTERVAL)
    time = F.col("pickup_datetime")
    trips = _pickup_trips(spark, sf_dir).filter((time >= start) & (time < end))
    return _local(zone_stats(trips), "pickup_hour")


# --- checks --------------------------------------------------------------------------------


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_counts(
        {"customers": cdc_customers(spark, sf_dir), "drivers": cdc_drivers(spark, sf_dir)}
    )


def _first_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that are not in debt, as the first snapshot had them."""
    return (
        feeds.table(spark, sf_dir, "customer")
        .filter(F.col("c_acctbal") >= 0)
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.concat(F.lower("c_mktsegment"), F.lit("@example.com")).alias("email"),
            F.concat(F.lit("NATION_"), F.col("c_nationkey")).alias("country"),
        )
    )


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mirror against the first snapshot of customers that are not in debt."""
    return reconcile_counts(cdc_customers(spark, sf_dir), _first_snapshot(spark, sf_dir), ["id"])


def repeat_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that differ between a mirror and the mirror of the log taken twice, and those compared."""
    first, second = cdc_customers(spark, sf_dir), cdc_replayed(spark, sf_dir)
    parts = fingerprint_difference(*(table_fingerprint(side, F.col("country")) for side in (first, second)))
    found = multiset_difference(first, second).agg(F.count("*").alias("differing_rows"))
    counted = first.agg(F.count("*").alias("compared_rows"))
    one = F.lit(1).alias("one")
    odd = parts.agg(F.count("*").alias("differing_parts"))
    return (
        found.select(one, "*").join(counted.select(one, "*"), "one").join(odd.select(one, "*"), "one").drop("one")
    )


def snapshot_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of orders against those of line items: each surplus with its sign."""
    orders = feeds.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"))
    lines = feeds.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    return multiset_difference(orders, lines)


def fresh_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit(NOW).cast("timestamp")
    return _local(freshness(feeds.event_times(spark, sf_dir), now), "newest")


# --- ingest, tables and streams ------------------------------------------------------------


def ingest_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log sent twice, each message kept once."""
    log = feeds.customers_log(spark, sf_dir)
    once = drop_replayed(log.unionByName(log))
    return once.groupBy("topic", "partition").agg(
        F.max("offset").alias("high_water"), F.count("*").alias("messages")
    )


def replayed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log sent twice, each message kept once, with what is in it."""
    log = feeds.drivers_log(spark, sf_dir)
    events = parse_change_events(drop_replayed(log.unionByName(log)))
    return _local(events.drop("value_str", "before_json", "after_json"), "kafka_timestamp")


def ingest_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half a log stored, then all of it offered again: only the rest is added."""
    table = f"{_scratch_database(spark)}.bronze"
    events = _changes(spark, sf_dir)
    append_table(events.filter(F.col("op") == "d"), table, partition_by=["topic"])
    for _ in range(2):
        append_table(new_records(events, spark.table(table)), table, partition_by=["topic"])
    return spark.table(table).select("topic", "partition", "offset", "op", "ts_ms", "lsn")


def ingest_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log stored up to a time, then continued from its highest offsets."""
    table = f"{_scratch_database(spark)}.bronze"
    events = _driver_changes(spark, sf_dir)
    early = F.col("kafka_timestamp") < F.lit("2024-01-15 00:00:00").cast("timestamp")
    append_table(events.filter(early), table)
    for _ in range(2):
        marks = high_water_marks(spark.table(table))
        append_table(beyond_high_water(events, marks), table)
    return spark.table(table).select("topic", "partition", "offset", "op", "ts_ms", "lsn")


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replayed log taken in by a stream that is started twice."""
    root = shared_folder(spark, "stream-bronze")
    feeds.customers_log(spark, sf_dir).write.parquet(f"{root}/log")
    source = LogSource((CUSTOMERS_TOPIC,), path=f"{root}/log")
    for _ in range(2):
        events = parse_change_events(stream_log(spark, source))
        run_append(events, f"{root}/bronze", f"{root}/checkpoint", ["topic"])
    bronze = spark.read.parquet(f"{root}/bronze")
    return bronze.select("topic", "partition", "offset", "op", "ts_ms", "lsn")


def stream_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mirror kept by folding micro-batches into a bucketed state."""
    root = shared_folder(spark, "stream-mirror")
    state = f"{_scratch_database(spark)}.drivers_state"
    feeds.drivers_log(spark, sf_dir).write.parquet(f"{root}/log")
    source = LogSource((DRIVERS_TOPIC,), path=f"{root}/log")
    for _ in range(2):
        events = parse_change_events(stream_log(spark, source))
        run_mirror(events, TYPED_DRIVERS, state, f"{root}/checkpoint")
    return live_rows(read_version(spark, state), TYPED_DRIVERS)


def time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mirror version read again after a later commit lost rows and was rolled back."""
    table = f"{_scratch_database(spark)}.silver_customers"
    good = commit_version(cdc_customers(spark, sf_dir), table)
    commit_version(read_version(spark, table).filter(F.col("country") < "NATION_2"), table)
    roll_back(spark, table, good)
    return read_version(spark, table)


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commit history behind ``time_travel``, without its commit times."""
    table = f"{_scratch_database(spark)}.silver_customers"
    good = commit_version(cdc_customers(spark, sf_dir), table)
    commit_version(read_version(spark, table).filter(F.col("country") < "NATION_2"), table)
    roll_back(spark, table, good)
    return version_history(spark, table).select("version", "operation", "row_count")


def backfill_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics spoiled for one month, then rebuilt for just that month."""
    table = f"{_scratch_database(spark)}.gold"
    month = F.trunc("pickup_hour", "month")
    stats = zone_stats(_pickup_trips(spark, sf_dir)).withColumn("pickup_month", month)
    in_month = F.col("pickup_month") == F.lit(INTERVAL[0].date())
    spoiled = F.when(in_month, F.lit(-1.0)).otherwise(F.col("avg_fare"))
    overwrite_partitions(stats.withColumn("avg_fare", spoiled), table, "pickup_month")
    overwrite_partitions(stats.filter(in_month), table, "pickup_month")
    return _local(spark.table(table).drop("pickup_month"), "pickup_hour")


def _send(log: DataFrame, path: str) -> None:
    """Add messages to a log of files."""
    with writing(log.sparkSession):
        log.write.mode("append").parquet(path)


def deployment(spark: SparkSession, sf_dir: str) -> tuple[PipelineConfig, str]:
    """Both logs and the zones as files, and settings that read them."""
    database = _scratch_database(spark)
    root = shared_folder(spark, "logs")
    changes = feeds.customers_log(spark, sf_dir).unionByName(feeds.drivers_log(spark, sf_dir))
    _send(changes, f"{root}/changes")
    _send(feeds.trips_log(spark, sf_dir), f"{root}/trips")
    feeds.zones(spark, sf_dir).write.parquet(f"{root}/zones")
    cfg = PipelineConfig(
        changes=LogSource((CUSTOMERS_TOPIC, DRIVERS_TOPIC), path=f"{root}/changes"),
        trips=LogSource((TRIPS_TOPIC,), path=f"{root}/trips"),
        zones_path=f"{root}/zones",
        database=database,
        entities=(CUSTOMERS, DRIVERS),
        partition_grain="month",
    )
    return cfg, root


def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from logs to tables, run twice; the sizes of the tables."""
    cfg, _ = deployment(spark, sf_dir)
    for _ in range(2):
        run_pipeline(spark, cfg)
    names = (BRONZE_CHANGES, BRONZE_TRIPS, SILVER_CUSTOMERS, SILVER_DRIVERS, SILVER_TRIPS, GOLD_STATS)
    return table_counts({name: spark.table(cfg.table(name)) for name in names})


def whole_run_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored statistics of a bounded run that was started twice."""
    cfg, _ = deployment(spark, sf_dir)
    for _ in range(2):
        run_pipeline(spark, cfg)
    return _local(spark.table(cfg.table(GOLD_STATS)), "pickup_hour")


def checkpointed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages driven by checkpoints, run twice; the stored statistics."""
    cfg, root = deployment(spark, sf_dir)
    for _ in range(2):
        run_incremental(spark, cfg, Folders(f"{root}/run"))
    return _local(spark.table(cfg.table(GOLD_STATS)), "pickup_hour")


def incremental_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries to a checkpointed run; the second, in other files, holds the first again."""
    cfg, root = deployment(spark, sf_dir)
    trips = spark.read.parquet(f"{root}/trips")
    cfg = replace(cfg, trips=LogSource((TRIPS_TOPIC,), path=f"{root}/sent"))
    for part in (F.col("timestamp") < F.lit(INTERVAL[0]).cast("timestamp"), F.lit(True)):
        _send(trips.filter(part), f"{root}/sent")
        run_incremental(spark, cfg, Folders(f"{root}/run"))
    return _local(spark.table(cfg.table(GOLD_STATS)), "pickup_hour")


def backfill_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics after the trips of one month have all become invalid and it was backfilled."""
    cfg, root = deployment(spark, sf_dir)
    run_pipeline(spark, cfg)
    table = cfg.data(BRONZE_TRIPS)
    month = F.col(PARTITION) == F.lit(INTERVAL[0].date())
    spoiled = spark.table(table).filter(month).withColumn("fare_amount", F.lit("0"))
    spoiled.write.parquet(f"{root}/spoiled")
    overwrite_partitions(spark.read.parquet(f"{root}/spoiled"), table, PARTITION)
    backfill(spark, cfg, INTERVAL[0].date(), INTERVAL[1].date())
    return _local(spark.table(cfg.table(GOLD_STATS)), "pickup_hour")


def silent_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics that are too old, one of which never had a message."""
    cfg, _ = deployment(spark, sf_dir)
    cfg = replace(cfg, trips=replace(cfg.trips, topics=(TRIPS_TOPIC, "silent")))
    run_pipeline(spark, cfg, stages=("ingest-changes", "ingest-trips"))
    return _local(stale_topics(spark, cfg, dt.datetime.fromisoformat(NOW)), "newest")


# --- loads ---------------------------------------------------------------------------------


def log_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offsets of the change log, which has gaps, as intervals."""
    return offset_intervals(feeds.customers_log(spark, sf_dir))


def ingest_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of which a part with gaps was stored, then later offsets, then all of it is sent again."""
    root = shared_folder(spark, "ingest-gaps")
    log = feeds.customers_log(spark, sf_dir)
    offset = F.col("offset")
    late = F.col("timestamp") >= F.lit("1996-01-01").cast("timestamp")
    schema = parse_change_events(log.limit(0), keep_undecoded=True).schema
    files = LoadedFiles(spark, f"{root}/bronze", schema, ["topic"])
    stored = LoadedMessages(files, f"{root}/offsets")
    for k, part in enumerate((late & (offset % 7 < 5), late | (offset % 3 == 0), F.lit(True))):
        log.filter(part).write.mode("append").parquet(f"{root}/log-{k}")
        sent = stream_log(spark, LogSource((CUSTOMERS_TOPIC,), path=f"{root}/log-{k}"))
        run_ingest(sent, lambda m: parse_change_events(m, keep_undecoded=True), stored, f"{root}/checkpoint-{k}")
    columns = ("topic", "partition", "offset", "op", "ts_ms", "lsn", "load")
    return files.between(0, stored.last_load()).select(*columns)


def statistics_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries, out of order and overlapping, each adding its partial sums."""
    cfg, root = deployment(spark, sf_dir)
    trips = spark.read.parquet(f"{root}/trips")
    cfg = replace(cfg, trips=LogSource((TRIPS_TOPIC,), path=f"{root}/sent"))
    folders, time = Folders(f"{root}/run"), F.col("timestamp")
    early, late = (F.lit(edge).cast("timestamp") for edge in INTERVAL)
    for k, part in enumerate((time >= late, time < late, time >= early)):
        _send(trips.filter(part), f"{root}/sent")
        run_incremental(spark, cfg, folders)
        if k == 1:
            Flow(spark, cfg, folders).sum_up()
    return _local(spark.table(cfg.table(GOLD_STATS)), "pickup_hour")


def touched_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stretches of the log, out of order, folded into the buckets they touch."""
    state = f"{_scratch_database(spark)}.drivers_state"
    events, time = _driver_changes(spark, sf_dir), F.col("kafka_timestamp")
    cuts = [F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp") for day in (10, 20)]
    for part in ((time >= cuts[0]) & (time < cuts[1]), time < cuts[0], time >= cuts[1]):
        fold_touched(events.filter(part), TYPED_DRIVERS, state, 16)
    return live_rows(spark.table(state), TYPED_DRIVERS)


def stored_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mirror whose newest changes Spark's state store keeps, over several micro-batches."""
    root = shared_folder(spark, "stored-mirror")
    state = f"{_scratch_database(spark)}.drivers_state"
    feeds.drivers_log(spark, sf_dir).repartitionByRange(4, F.col("offset").desc()).write.parquet(f"{root}/log")
    source = LogSource((DRIVERS_TOPIC,), path=f"{root}/log", options={"maxFilesPerTrigger": "1"})
    for _ in range(2):
        events = parse_change_events(stream_log(spark, source))
        run_stored_mirror(events, TYPED_DRIVERS, state, f"{root}/checkpoint")
    return live_rows(spark.table(state), TYPED_DRIVERS)


def _spoiled_logs(spark: SparkSession, sf_dir: str) -> tuple[PipelineConfig, str, DataFrame]:
    """A deployment whose logs are spoiled by the data's own values, and the logs as they should be."""
    cfg, root = deployment(spark, sf_dir)
    good = spark.read.parquet(f"{root}/changes").unionByName(spark.read.parquet(f"{root}/trips"))
    day = F.dayofmonth("timestamp")
    spoiled = (
        F.when(day == 11, F.unhex(F.lit("FF7B")))
        .when(day == 12, F.lit(None))
        .when(day == 13, F.lit('{"payload":{"op":"u"}}').cast("binary"))
        .otherwise(F.col("value"))
    )
    _send(good.withColumn("value", spoiled), f"{root}/spoiled")
    source = {name: replace(getattr(cfg, name), path=f"{root}/spoiled") for name in ("changes", "trips")}
    return replace(cfg, **source), root, good


def run_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of both logs by topic and reason: found, then left when some were sent repaired, twice."""
    cfg, root, good = _spoiled_logs(spark, sf_dir)
    folders = Folders(f"{root}/run")
    run_incremental(spark, cfg, folders)
    flow = Flow(spark, cfg, folders)
    by = ("topic", "reason")
    found = flow.open_rejects().groupBy(*by).agg(F.count("*").alias("found"))
    found.write.parquet(f"{root}/found")
    for _ in range(2):
        flow.redrive(good.filter(F.month("timestamp") % 2 == 0))
        run_incremental(spark, cfg, folders)
    left = flow.open_rejects().groupBy(*by).agg(F.count("*").alias("left"))
    both = spark.read.parquet(f"{root}/found").join(left, list(by), "left")
    return both.select(*by, "found", F.coalesce("left", F.lit(0).cast("bigint")).alias("left"))


def redriven_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics after all rejected messages were repaired and sent again."""
    cfg, root, good = _spoiled_logs(spark, sf_dir)
    folders = Folders(f"{root}/run")
    run_incremental(spark, cfg, folders)
    Flow(spark, cfg, folders).redrive(good)
    run_incremental(spark, cfg, folders)
    return _local(spark.table(cfg.table(GOLD_STATS)), "pickup_hour")


def backfill_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run by loads: one month spoiled and backfilled, taken back, then backfilled from good bronze."""
    cfg, root = deployment(spark, sf_dir)
    folders = Folders(f"{root}/run")
    run_incremental(spark, cfg, folders)
    flow, days = Flow(spark, cfg, folders), (INTERVAL[0].date(), INTERVAL[1].date())
    flow.sum_up()
    month = F.col(PARTITION) == F.lit(days[0])
    bronze = flow.trips.rows.files().filter(month)
    bronze.withColumn("fare_amount", F.lit("0")).write.parquet(f"{root}/spoiled")
    flow.trips.rows.replace_interval(spark.read.parquet(f"{root}/spoiled"), PARTITION, *days)
    flow.backfill(*days)
    none = spark.table(cfg.table(GOLD_STATS)).filter(F.trunc("pickup_hour", "month") == F.lit(days[0])).count()
    flow.take_back(*days)
    flow.trips.rows.put_back(PARTITION, *days)
    flow.backfill(*days)
    stats = _local(spark.table(cfg.table(GOLD_STATS)), "pickup_hour")
    return stats.withColumn("spoiled_rows", F.lit(none).cast("bigint"))


def backfill_taken_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded run: one month spoiled, backfilled, and taken back."""
    cfg, root = deployment(spark, sf_dir)
    run_pipeline(spark, cfg)
    table, days = cfg.data(BRONZE_TRIPS), (INTERVAL[0].date(), INTERVAL[1].date())
    month = F.col(PARTITION) == F.lit(days[0])
    spoiled = spark.table(table).filter(month).withColumn("fare_amount", F.lit("0"))
    spoiled.write.parquet(f"{root}/spoiled")
    overwrite_partitions(spark.read.parquet(f"{root}/spoiled"), table, ["load", PARTITION])
    backfill(spark, cfg, *days)
    take_back(spark, cfg, *days)
    return _local(spark.table(cfg.table(GOLD_STATS)), "pickup_hour")


def stream_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that repeats itself within a delivery, in the next one, and once all is forgotten."""
    root = shared_folder(spark, "stream-replayed")
    log = feeds.customers_log(spark, sf_dir)
    schema = parse_change_events(log.limit(0), keep_undecoded=True).schema
    files = LoadedFiles(spark, f"{root}/bronze", schema, ["topic"])
    stored = LoadedMessages(files, f"{root}/offsets")
    source = LogSource((CUSTOMERS_TOPIC,), path=f"{root}/log")
    half = log.filter(F.col("offset") % 2 == 0)
    for sent, checkpoint in ((half.unionByName(half), "a"), (log, "a"), (log, "b")):
        _send(sent, f"{root}/log")
        run_ingest(
            stream_log(spark, source),
            lambda m: parse_change_events(m, keep_undecoded=True),
            stored,
            f"{root}/checkpoint-{checkpoint}",
            remember="1 hour",
        )
    return files.between(0, stored.last_load()).select("topic", "partition", "offset", "op", "ts_ms", "lsn")


def closed_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics by event time: hours closed by a watermark, with the trips that came too late."""
    root = shared_folder(spark, "closed-hours")
    trips = _pickup_trips(spark, sf_dir)
    trips.write.parquet(f"{root}/all")
    stored = spark.read.parquet(f"{root}/all")
    start, end = (F.lit(edge).cast("timestamp") for edge in INTERVAL)
    time, places = F.col("pickup_datetime"), F.col("pulocation_id") % 5 == 0
    hours = ClosedHours(spark, f"{root}/hours")
    # The places with a number of five send the trips before the interval after it.
    for part in ((time < start) & ~places, (time >= start) & (time < end), (time >= end) | ((time < start) & places)):
        stored.filter(part).write.mode("append").parquet(f"{root}/sent")
        hours.run(spark.readStream.schema(stored.schema).parquet(f"{root}/sent"))
    late = hours.late().select("pickup_zone", "pickup_hour", F.col("total_trips").alias("late_trips"))
    stats = finished_stats(hours.corrected()).join(late, ["pickup_zone", "pickup_hour"], "left")
    done = stats.filter(F.col("pickup_hour") + F.expr("INTERVAL 1 HOUR") <= F.lit(hours.watermark()).cast("timestamp"))
    return _local(done.withColumn("late_trips", F.coalesce("late_trips", F.lit(0).cast("bigint"))), "pickup_hour")


def trip_enrich_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the trips at one place, a third at none, and a dimension too large to broadcast."""
    line = F.col("l_linenumber")
    place = F.when(line <= 2, F.lit(7).cast("bigint")).when(line > 3, F.col("l_partkey"))
    log = feeds.trips_log(spark, sf_dir, place, F.col("l_suppkey"))
    root = shared_folder(spark, "trips-hot")
    clean_trips(parse_trips(log)).write.parquet(f"{root}/trips")
    trips = spark.read.parquet(f"{root}/trips")
    large = DimensionFacts(BROADCAST_ROW_LIMIT + 1, 0, 1)
    enriched = enrich_zones(trips, feeds.part_zones(spark, sf_dir), facts=large, heavy=heavy_places(trips))
    return enriched.select("pulocation_id", "dolocation_id", "fare_amount", "pickup_zone", "dropoff_zone")


# --- history and agreement -----------------------------------------------------------------


def cdc_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of every driver, with the time it was valid."""
    history = change_history(_driver_changes(spark, sf_dir), TYPED_DRIVERS)
    return _local(history.drop("after_json", "ended"))


def cdc_history_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mirror at a time, from a stored history partitioned by the month a version ended in."""
    root = shared_folder(spark, "history")
    history = change_history(_driver_changes(spark, sf_dir), TYPED_DRIVERS)
    history.write.partitionBy("ended").parquet(f"{root}/drivers")
    stored = spark.read.schema(history.schema).parquet(f"{root}/drivers")
    return rows_at(stored, TYPED_DRIVERS, AS_OF_MS)


def reconcile_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``reconcile`` in two steps: only key buckets whose checksums differ are joined."""
    source = _first_snapshot(spark, sf_dir)
    return reconcile_by_buckets(cdc_customers(spark, sf_dir), source, ["id"])


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of the mirror, by country, whose checksums differ between it and its first snapshot."""
    sides = (cdc_customers(spark, sf_dir), _first_snapshot(spark, sf_dir))
    return fingerprint_difference(*(table_fingerprint(side, F.col("country")) for side in sides))


QUERIES: dict[str, Query] = {
    "incremental_replayed": incremental_replayed,
    "backfill_run": backfill_run,
    "silent_topics": silent_topics,
    "whole_run": whole_run,
    "checkpointed_run": checkpointed_run,
    "cdc_parse": cdc_parse,
    "cdc_key": cdc_key,
    "cdc_latest": cdc_latest,
    "cdc_customers": cdc_customers,
    "cdc_drivers": cdc_drivers,
    "cdc_two_topics": cdc_two_topics,
    "cdc_topic_word": cdc_topic_word,
    "cdc_replayed": cdc_replayed,
    "cdc_as_of": cdc_as_of,
    "cdc_incremental": cdc_incremental,
    "cdc_hot_driver": cdc_hot_driver,
    "cdc_op_counts": cdc_op_counts,
    "cdc_rejects": cdc_rejects,
    "spot_check": spot_check,
    "trip_parse": trip_parse,
    "trip_clean": trip_clean,
    "trip_enrich": trip_enrich,
    "trip_enrich_parts": trip_enrich_parts,
    "trip_zone_unmatched": trip_zone_unmatched,
    "rejects": rejects,
    "zone_key_dups": zone_key_dups,
    "line_key_dups": line_key_dups,
    "gold_hourly": gold_hourly,
    "gold_daily": gold_daily,
    "gold_top10": gold_top10,
    "gold_hot_zone": gold_hot_zone,
    "backfill_interval": backfill_interval,
    "backfill_month": backfill_month,
    "counts": counts,
    "reconcile": reconcile,
    "repeat_difference": repeat_difference,
    "snapshot_difference": snapshot_difference,
    "freshness": fresh_topics,
    "ingest_replayed": ingest_replayed,
    "ingest_twice": ingest_twice,
    "ingest_in_order": ingest_in_order,
    "stream_bronze": stream_bronze,
    "stream_mirror": stream_mirror,
    "time_travel": time_travel,
    "version_history": versions,
    "replayed_messages": replayed_messages,
    "whole_run_statistics": whole_run_statistics,
    "log_intervals": log_intervals,
    "stream_replayed": stream_replayed,
    "closed_hours": closed_hours,
    "trip_enrich_hot": trip_enrich_hot,
    "ingest_gaps": ingest_gaps,
    "statistics_by_load": statistics_by_load,
    "touched_buckets": touched_buckets,
    "stored_mirror": stored_mirror,
    "run_rejects": run_rejects,
    "redriven_tables": redriven_tables,
    "backfill_loads": backfill_loads,
    "backfill_taken_back": backfill_taken_back,
    "cdc_history": cdc_history,
    "cdc_history_as_of": cdc_history_as_of,
    "reconcile_buckets": reconcile_buckets,
    "fingerprints": fingerprints,
}

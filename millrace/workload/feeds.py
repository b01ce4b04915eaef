"""Kafka-shaped logs that Spark derives from the given tables.

Each feed is a plain projection of its table, so it grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import epoch_millis
from millrace.schemas import CUSTOMERS_TOPIC, DRIVERS_TOPIC, TRIPS_TOPIC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(frame: DataFrame, by: str) -> DataFrame:
    """``frame`` over all cores when its files have fewer splits than there are cores.

    Encoding is heavy for the CPU; a table of one row group would be encoded by one task. A
    table with enough splits is left as it is, without a shuffle. ``by`` is a unique column:
    hashing it is even, and needs no sort to be repeatable as a round robin does.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores, by) if frame.rdd.getNumPartitions() < cores else frame


def _message(*fields: Column) -> Column:
    text = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return text.cast("binary")


def _change(op: Column, ts_ms: Column, lsn: Column, before: Column, after: Column) -> Column:
    payload = F.struct(
        op.alias("op"),
        ts_ms.alias("ts_ms"),
        F.struct(lsn.alias("lsn")).alias("source"),
        before.alias("before"),
        after.alias("after"),
    )
    return _message(payload.alias("payload"))


def customers_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot record per customer, then an update (or delete) per order."""
    customer = table(spark, sf_dir, "customer")
    orders = spread(
        table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
        ),
        "o_orderkey",
    )
    domain = F.lit("@example.com")

    snapshot = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_mktsegment"), domain).alias("email"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey")).alias("country"),
    )
    initial = customer.select(
        F.lit(CUSTOMERS_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("c_custkey").alias("offset"),
        F.timestamp_millis(F.lit(0).cast("bigint")).alias("timestamp"),
        _change(
            F.lit("r"),
            F.lit(0).cast("bigint"),
            F.lit(0).cast("bigint"),
            F.lit(None).cast("string"),
            snapshot,
        ).alias("value"),
    )

    image = F.struct(
        F.col("o_custkey").alias("id"),
        F.format_string("Customer#%09d", "o_custkey").alias("name"),
        F.concat(F.lower(F.substr("o_orderpriority", F.lit(3))), domain).alias("email"),
        F.concat(F.lit("NATION_"), F.col("o_orderkey") % 25).alias("country"),
    )
    deleted = F.col("o_orderstatus") == "P"
    changed = orders.select(
        F.lit(CUSTOMERS_TOPIC).alias("topic"),
        F.lit(1).alias("partition"),
        F.col("o_orderkey").alias("offset"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        _change(
            F.when(deleted, "d").otherwise("u"),
            epoch_millis(F.col("o_orderdate")),
            F.col("o_orderkey") + 1,
            image,
            F.when(~deleted, image),
        ).alias("value"),
    )
    return initial.unionByName(changed)


def drivers_log(spark: SparkSession, sf_dir: str, driver: Column | None = None) -> DataFrame:
    """A change per event; the event's user is the driver, unless another column says so."""
    kind = F.col("event_type")
    driver = F.col("user_id") if driver is None else driver
    image = F.struct(
        driver.alias("id"),
        F.concat(F.lit("driver_"), driver).alias("name"),
        F.concat(F.lit("LIC"), F.col("event_id")).alias("license_number"),
        F.col("value").alias("rating"),
        kind.alias("city"),
        (F.col("value") > 10).alias("active"),
    )
    old = F.struct(driver.alias("id"))
    op = F.when(kind == "error", "d").when(kind == "signup", "c").otherwise("u")
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value"
    )
    return spread(events, "event_id").select(
        F.lit(DRIVERS_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        _change(
            op,
            epoch_millis(F.col("ts")),
            F.col("event_id"),
            F.when(kind != "signup", old),
            F.when(kind != "error", image),
        ).alias("value"),
    )


def trips_log(
    spark: SparkSession,
    sf_dir: str,
    pickup_place: Column | None = None,
    dropoff_place: Column | None = None,
    spoil: bool = False,
) -> DataFrame:
    """A trip per line item.

    ``spoil`` damages the pickup time and the fare of line items picked by their own values,
    so that the cleaning has something to refuse.
    """
    pickup = F.col("l_shipdate") + F.make_dt_interval(
        F.lit(0), (F.col("l_orderkey") % 24).cast("int"), F.col("l_linenumber") * 7
    )
    dropoff = pickup + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_quantity").cast("int"))
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    pickup_text = F.date_format(pickup, iso)
    fare = F.col("l_extendedprice") / 1000 - 5
    fare_value = fare
    if spoil:
        pickup_text = (
            F.when(F.col("l_linenumber") == 1, F.concat(F.lit("on "), pickup_text))
            .when(F.col("l_linenumber") == 2, F.lit(None))
            .otherwise(pickup_text)
        )
        fare_value = F.when(F.col("l_returnflag") == "R", F.lit("n/a")).otherwise(
            fare.cast("string")
        )
    value = _message(
        (F.col("l_suppkey") % 2 + 1).alias("VendorID"),
        pickup_text.alias("tpep_pickup_datetime"),
        F.date_format(dropoff, iso).alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").cast("double").alias("passenger_count"),
        (F.col("l_quantity") / 2).alias("trip_distance"),
        (F.col("l_partkey") % 30 if pickup_place is None else pickup_place)
        .cast("double")
        .alias("PULocationID"),
        (F.col("l_suppkey") % 30 if dropoff_place is None else dropoff_place)
        .cast("double")
        .alias("DOLocationID"),
        fare_value.alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (F.col("l_discount") * 100).alias("tip_amount"),
        (F.col("l_tax") * 100).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        (F.col("l_extendedprice") / 1000).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.lit(None).cast("double").alias("Airport_fee"),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_shipdate",
        F.monotonically_increasing_id().alias("offset"),
    )
    return spread(lines, "offset").select(
        F.lit(TRIPS_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        value.alias("value"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("LocationID"), F.col("n_name").alias("Zone")
    )


def part_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone dimension that grows with the data."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("LocationID"), F.col("p_name").alias("Zone")
    )


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic per event type, for freshness."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"), F.col("ts").cast("timestamp").alias("timestamp")
    )

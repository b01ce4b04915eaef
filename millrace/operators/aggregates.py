"""Trip statistics per pickup zone and time bucket, from partial sums that can be added up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Money and miles are added as decimals, so the order of rows never matters. Six decimals are kept.
EXACT = "decimal(28,6)"
# measure -> its column in the statistics, and whether that is a mean
MEASURES = {
    "fare_amount": ("avg_fare", True),
    "trip_distance": ("avg_distance", True),
    "total_amount": ("total_revenue", False),
}


def partial_sums() -> list[Column]:
    """Counts and sums of trips that can be added up over any parts of them.

    For each measure: the sum of its values, their number, and the sum of those that are no
    decimal of 22 digits before the point. These are NaN or infinite, and larger ones count as
    infinite, so their sum does not depend on order either; null when there is none.
    """
    infinite = F.lit(float("inf"))
    parts = [F.count("*").alias("total_trips")]
    for name in MEASURES:
        value = F.col(name)
        exact = value.try_cast(EXACT)
        odd = F.when(F.isnan(value), value).otherwise(F.signum(value) * infinite)
        parts += [
            F.try_sum(exact).alias(f"{name}_sum"),
            F.count(value).alias(f"{name}_count"),
            F.sum(F.when(exact.isNull() & value.isNotNull(), odd)).alias(f"{name}_odd"),
        ]
    return parts


def zone_partials(trips: DataFrame, grain: str = "hour", *by: str) -> DataFrame:
    """Partial sums per pickup zone and ``grain``. Further columns in ``by`` make parts of their own."""
    return (
        trips.filter(F.col("pickup_zone").isNotNull())
        .groupBy("pickup_zone", F.date_trunc(grain, "pickup_datetime").alias(f"pickup_{grain}"), *by)
        .agg(*partial_sums())
    )


def partial_columns() -> list[str]:
    """The columns of partial sums that are added up."""
    return ["total_trips", *(f"{name}_{part}" for name in MEASURES for part in ("sum", "count", "odd"))]


def added_partials(partials: DataFrame, grain: str = "hour") -> DataFrame:
    """Partial sums of several parts, added up: one row per zone and bucket again."""
    sums = (F.try_sum(c).alias(c) for c in partial_columns())
    return partials.groupBy("pickup_zone", f"pickup_{grain}").agg(*sums)


def _cents(name: str, mean: bool) -> str:
    """Sum or mean to the cent; NaN or infinite with a value that is, or a sum beyond 22 digits."""
    total, count = f"try_cast({name}_sum AS {EXACT})", f"{name}_count"
    value = f"{total} / nullif({count}, 0)" if mean else total
    return (
        f"CASE WHEN {name}_odd IS NOT NULL THEN {name}_odd "
        f"WHEN {count} > 0 AND {total} IS NULL THEN double('NaN') "
        f"ELSE CAST(round({value}, 2) AS DOUBLE) END"
    )


def finished_columns(grain: str = "hour") -> list[str]:
    """SQL of the statistics of added partial sums, for a query or a view."""
    stats = (f"{_cents(name, mean)} AS {column}" for name, (column, mean) in MEASURES.items())
    return ["pickup_zone", f"pickup_{grain}", "total_trips", *stats]


def finished_stats(partials: DataFrame, grain: str = "hour") -> DataFrame:
    """Statistics of added partial sums."""
    return partials.selectExpr(*finished_columns(grain))


def zone_stats(trips: DataFrame, grain: str = "hour") -> DataFrame:
    """Trips, mean fare, mean distance and revenue per pickup zone and ``grain``.

    Grouping is partial before the shuffle, so a busy zone costs one row per task and bucket.
    Values are taken to six decimals. The result is unordered; a stored table keeps no order anyway.
    """
    return finished_stats(zone_partials(trips, grain), grain)


def latest_hours(stats: DataFrame, rows: int = 10, grain: str = "hour") -> DataFrame:
    """The newest buckets, busiest zone first; the zone name settles ties."""
    return stats.orderBy(
        F.col(f"pickup_{grain}").desc(), F.col("total_trips").desc(), "pickup_zone"
    ).limit(rows)

"""Checks on tables: counts, agreement with the source, repeatability, freshness, keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [
        table.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def reconcile(mirror: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key with ``ok``, ``missing`` (source only), ``extra`` (mirror only) or ``changed``."""
    compared = [name for name in source.columns if name not in keys]
    left = mirror.withColumn("_present", F.lit(True)).alias("m")
    right = source.withColumn("_present", F.lit(True)).alias("s")
    differs = reduce(
        Column.__or__,
        (~F.col(f"m.{name}").eqNullSafe(F.col(f"s.{name}")) for name in compared),
        F.lit(False),
    )
    status = (
        F.when(F.col("m._present").isNull(), "missing")
        .when(F.col("s._present").isNull(), "extra")
        .when(differs, "changed")
        .otherwise("ok")
    )
    return left.join(right, list(keys), "full_outer").select(*keys, status.alias("status"))


def reconcile_counts(mirror: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys have each status."""
    return reconcile(mirror, source, keys).groupBy("status").agg(F.count("*").alias("key_count"))


def table_fingerprint(rows: DataFrame, group: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and order-free checksums per group: two tables with equal rows have equal ones.

    Each group has its number of rows, an XOR of row hashes and a sum of other hashes, cut to 32
    bits so that a long holds the sum. Partial before the shuffle: rows are not moved.
    """
    names = [F.col(f"`{name}`") for name in (columns or rows.columns)]
    return (
        rows.select(group.alias("part"), F.xxhash64(*names).alias("one"), F.xxhash64(F.lit(1), *names).alias("other"))
        .groupBy("part")
        .agg(
            F.count("*").alias("rows"),
            F.bit_xor("one").alias("row_xor"),
            F.sum(F.col("other").bitwiseAND(0xFFFFFFFF)).alias("row_sum"),
        )
    )


def fingerprint_difference(first: DataFrame, second: DataFrame) -> DataFrame:
    """Parts that differ between two fingerprints: the number of rows on either side."""
    one, two = (
        side.select("part", F.struct("rows", "row_xor", "row_sum").alias(name))
        for side, name in ((first, "first"), (second, "second"))
    )
    met = one.join(two, one["part"].eqNullSafe(two["part"]), "full_outer")
    return met.filter(~F.col("first").eqNullSafe(F.col("second"))).select(
        F.coalesce(one["part"], two["part"]).alias("part"),
        F.coalesce("first.rows", F.lit(0)).alias("first_rows"),
        F.coalesce("second.rows", F.lit(0)).alias("second_rows"),
    )


RECONCILE_BUCKETS = 4096


def reconcile_by_buckets(
    mirror: DataFrame, source: DataFrame, keys: Sequence[str], buckets: int = RECONCILE_BUCKETS
) -> DataFrame:
    """``reconcile_counts`` in two steps, for tables that nearly agree.

    Checksums of key buckets are compared first, without moving rows. Only the buckets that
    differ are joined row by row; the others count as ok. Key columns need one type on both sides.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    names = list(source.columns)
    sums = [table_fingerprint(side, bucket, names) for side in (mirror, source)]
    wrong = F.broadcast(fingerprint_difference(*sums).select(F.col("part").alias("_bucket")))  # ``buckets`` rows at most
    open_ = [
        side.select(*names).withColumn("_bucket", bucket).join(wrong, "_bucket", "left_semi").drop("_bucket")
        for side in (mirror, source)
    ]
    same = sums[0].join(wrong, F.col("part") == F.col("_bucket"), "left_anti")
    ok = same.select(F.lit("ok").alias("status"), F.col("rows").alias("key_count"))
    found = reconcile_counts(*open_, keys).unionByName(ok)
    return found.groupBy("status").agg(F.sum("key_count").alias("key_count"))


def multiset_difference(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows that do not occur equally often on both sides; ``surplus`` > 0 means more in first.

    Empty when two runs gave the same table. One shuffle of pre-counted rows covers both
    directions.
    """
    signed = first.withColumn("_sign", F.lit(1)).unionByName(
        second.select(*first.columns).withColumn("_sign", F.lit(-1))
    )
    return (
        signed.groupBy(*first.columns)
        .agg(F.sum("_sign").alias("surplus"))
        .filter(F.col("surplus") != 0)
    )


def freshness(log: DataFrame, now: Column, limit_minutes: int = 10) -> DataFrame:
    """Newest message per topic, its age at ``now`` and whether that is within the limit."""
    age = F.timestamp_diff("SECOND", F.col("newest"), now)
    return (
        log.groupBy("topic")
        .agg(F.max("timestamp").alias("newest"))
        .select(
            "topic",
            "newest",
            age.alias("lag_seconds"),
            (age <= limit_minutes * 60).alias("is_fresh"),
        )
    )


def duplicate_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    present = reduce(Column.__and__, (F.col(name).isNotNull() for name in keys))
    return (
        table.filter(present)
        .groupBy(*keys)
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
    )

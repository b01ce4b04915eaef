"""Writes to catalog tables. Each returns the rows written, counted by the write itself."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that rides along with its next action."""
    rows = Observation()
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of one write or stream."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


# So many files a task keeps open while it writes partitions; rows of more are sorted first.
MOST_OPEN = 100
# Rows that a file should have on average, if it is to be written without a shuffle before.
LEAST_ROWS = 5_000
CODEC = "zstd"


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """Settings of a write: dense files, and no sort while a task has few partitions to write.

    Without dictionaries, of which a task would fill one for each column of each open file; the
    codec finds repeated values as well.
    """
    with (
        setting(spark, "spark.sql.parquet.compression.codec", CODEC),
        setting(spark, "parquet.enable.dictionary", "false"),
        setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(MOST_OPEN)),
    ):
        yield


def laid_out(
    rows: DataFrame, columns: Sequence[str], like: DataFrame | None = None, near: DataFrame | None = None
) -> DataFrame:
    """``rows`` for a write by partition, rebalanced unless their tasks can write them as they are.

    Where every task has few partitions with many rows each, a shuffle would move all rows for
    nothing. That is counted on ``like``, rows with the same partition columns in the same tasks;
    without it rows are rebalanced: a small partition gives one file, a large one many tasks.
    ``near`` are the same rows in an order within their tasks that brings those of a partition
    near to each other, so that a task seldom changes from file to file; written where given.
    """
    if like is not None:
        by_task = like.select(*columns, F.spark_partition_id().alias("_task")).groupBy("_task", *columns)
        files = by_task.agg(F.count("*").alias("rows")).groupBy("_task")
        tasks = files.agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))
        found = tasks.agg(F.max("files").alias("most"), F.sum("files").alias("files"), F.sum("rows").alias("rows")).first()
        if found["rows"] and found["most"] <= MOST_OPEN and found["rows"] >= LEAST_ROWS * found["files"]:
            return rows if near is None else near
    return rows.hint("rebalance", *columns)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def append_table(
    df: DataFrame, table: str, table_format: str = "parquet", partition_by: Sequence[str] = ()
) -> int:
    """Add rows, creating the table when absent. Columns are matched by name."""
    observed, rows = counted(df)
    writer = observed.write.format(table_format).mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with writing(df.sparkSession):
        writer.saveAsTable(table)
    return rows.get["rows"]


def overwrite_table(
    df: DataFrame, table: str, table_format: str = "parquet", partition_by: Sequence[str] = ()
) -> int:
    """Replace rows and schema. The plan of ``df`` must not read the same table."""
    observed, rows = counted(df)
    writer = observed.write.format(table_format).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with writing(df.sparkSession):
        writer.saveAsTable(table)
    return rows.get["rows"]


def overwrite_partitions(
    df: DataFrame,
    table: str,
    columns: str | Sequence[str],
    table_format: str = "parquet",
    like: DataFrame | None = None,
    near: DataFrame | None = None,
) -> int:
    """Replace only the partitions of ``columns`` that occur in ``df``; others stay as they are.

    Rows are rebalanced by partition before the write, unless ``like`` shows that there is no
    need (see ``laid_out``).
    """
    spark = df.sparkSession
    columns = [columns] if isinstance(columns, str) else list(columns)
    balanced = laid_out(df, columns, like if table_format == "parquet" else None, near)
    if not spark.catalog.tableExists(table):
        return overwrite_table(balanced, table, table_format, columns)
    observed, rows = counted(balanced.select(*spark.table(table).columns))
    with writing(spark), setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        observed.write.insertInto(table, overwrite=True)
    return rows.get["rows"]


def replace_interval(df: DataFrame, table: str, column: str, inside: Column, set_aside: str) -> int:
    """Make ``df`` all that is left of the partitions of ``column`` for which ``inside`` holds.

    Only these partitions are read and written; one that is left without rows is dropped. What
    they held before is kept in the table ``set_aside``, for ``put_back``. ``df`` must not read
    the table.
    """
    spark = df.sparkSession
    old = spark.table(table).filter(inside)
    overwrite_table(old, set_aside, partition_by=[column])

    def values(frame: DataFrame) -> set:
        return {row[column] for row in frame.select(column).distinct().collect()}

    gone = values(spark.table(set_aside)) - values(df)
    rows = overwrite_partitions(df, table, column)
    for value in sorted(gone):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = '{value}')")
    return rows


def put_back(spark: SparkSession, table: str, column: str, inside: Column, set_aside: str) -> int:
    """Undo ``replace_interval``; what it had written is set aside in turn."""
    kept = spark.table(set_aside)
    return replace_interval(kept, table, column, inside, f"{set_aside}_undone")


def publish(
    spark: SparkSession, view: str, relation: str, columns: Sequence[str], where: str = "TRUE"
) -> None:
    """A catalog view with the contract columns of a stored relation.

    For a folder ``relation`` is ``files(path)``; ``where`` keeps readers off unfinished loads.
    """
    listed = ", ".join(f"`{name}`" for name in columns)
    condition = f" WHERE {where}" if where != "TRUE" else ""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {listed} FROM {relation}{condition}")


def files(path: str) -> str:
    return f"parquet.`{path}`"

"""Statistics by event time: hours are given out once, when no more trips are expected for them.

A watermark follows the newest pickup time. An hour that lies behind it by the delay is closed and
written once. A trip that comes for a closed hour changes nothing there; it is listed as late and
its partial sums are kept apart, so that adding both gives the full statistics again.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.operators.aggregates import MEASURES, added_partials, partial_sums, zone_partials
from millrace.sinks.loads import folder

BATCH = "batch"
EPOCH = dt.datetime(1970, 1, 1)


@dataclass(frozen=True)
class ClosedHours:
    """Files of closed hours, of late trips and of the watermark, below one folder.

    A run is one micro-batch of all trips that wait (and one more that closes hours), so all of it
    is judged by the watermark of the run before.
    """

    spark: SparkSession
    root: str
    delay: str = "2 hours"

    def watermark(self) -> dt.datetime:
        """All hours up to this time are closed."""
        marks = folder(self.spark, f"{self.root}/watermarks", StructType.fromDDL("reached timestamp"), [])
        return marks.agg(F.max("reached")).first()[0] or EPOCH

    def run(self, trips: DataFrame) -> None:
        """Take in the waiting trips of a stream: late ones first, by the hours closed so far."""
        closed = F.lit(self.watermark()).cast("timestamp")
        zoned = trips.filter(F.col("pickup_zone").isNotNull())
        behind = F.date_trunc("hour", "pickup_datetime") + F.expr("INTERVAL 1 HOUR") <= closed

        def keep_late(batch: DataFrame, batch_id: int) -> None:
            _write_batch(zone_partials(batch.filter(behind)), f"{self.root}/late", batch_id)

        def keep_closed(batch: DataFrame, batch_id: int) -> None:
            _write_batch(batch, f"{self.root}/closed", batch_id)

        columns = ("pickup_zone", "pickup_datetime", *MEASURES)
        self._drain(zoned.select(*columns), keep_late, "late")
        hourly = (
            zoned.select(*columns)
            .withWatermark("pickup_datetime", self.delay)
            .groupBy("pickup_zone", F.window("pickup_datetime", "1 hour").alias("hour"))
            .agg(*partial_sums())
            .withColumn("pickup_hour", F.col("hour.start"))
            .drop("hour")
        )
        progress = self._drain(hourly, keep_closed, "closed")
        if progress and (reached := progress.get("eventTime", {}).get("watermark")):
            mark = self.spark.createDataFrame([(reached,)], "reached string")
            mark = mark.select(F.to_timestamp("reached").alias("reached")).coalesce(1)
            mark.write.mode("append").parquet(f"{self.root}/watermarks")

    def _drain(self, stream: DataFrame, write, name: str) -> dict | None:
        query = (
            stream.writeStream.foreachBatch(write)
            .outputMode("append")
            .option("checkpointLocation", f"{self.root}/checkpoints/{name}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return query.lastProgress

    def _partials(self, name: str) -> DataFrame:
        empty = zone_partials(self.spark.createDataFrame([], TRIP_COLUMNS))
        schema = StructType([*empty.schema.fields, StructField(BATCH, LongType())])
        return folder(self.spark, f"{self.root}/{name}", schema, [BATCH]).drop(BATCH)

    def closed(self) -> DataFrame:
        """Partial sums of closed hours, as they were when they closed."""
        return self._partials("closed")

    def late(self) -> DataFrame:
        """Partial sums of the trips that came too late, by zone and hour."""
        return added_partials(self._partials("late"))

    def corrected(self) -> DataFrame:
        """Partial sums of closed hours with their late trips."""
        return added_partials(self.closed().unionByName(self.late()))


TRIP_COLUMNS = "pickup_zone string, pickup_datetime timestamp, " + ", ".join(f"{name} double" for name in MEASURES)


def _write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """A batch that is repeated replaces its own files."""
    (
        rows.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH)
        .parquet(path)
    )

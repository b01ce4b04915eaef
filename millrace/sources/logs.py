"""Message logs as DataFrames: a Kafka broker, or a replay of Kafka-shaped Parquet files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schemas import LOG_SCHEMA, column_names


@dataclass(frozen=True)
class LogSource:
    """Where messages come from. ``path`` means replay; otherwise ``servers`` names the broker.

    ``options`` go to the reader untouched, for example ``endingOffsets``, or ``minPartitions``
    to read one large broker partition with many tasks. ``partitions`` has the number of partitions
    of each topic; with it a bounded run starts at the stored offsets, as a broker wants all of them.
    """

    topics: tuple[str, ...]
    servers: str | None = None
    path: str | None = None
    starting_offsets: str = "earliest"
    options: Mapping[str, str] = field(default_factory=dict)
    partitions: Mapping[str, int] = field(default_factory=dict)

    @property
    def reader_options(self) -> dict[str, str]:
        if self.path:
            return dict(self.options)
        if not self.servers:
            raise ValueError("a log source needs either a path or broker servers")
        return {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": ",".join(self.topics),
            "startingOffsets": self.starting_offsets,
            **self.options,
        }


def _topics_only(log: DataFrame, source: LogSource) -> DataFrame:
    if source.path:
        log = log.filter(F.col("topic").isin(*source.topics))
    return log.select(*column_names(LOG_SCHEMA))


def read_log(spark: SparkSession, source: LogSource) -> DataFrame:
    """All messages of the topics that exist now, as a bounded table."""
    reader = spark.read.options(**source.reader_options)
    if source.path:
        log = reader.schema(LOG_SCHEMA).parquet(source.path)
    else:
        log = reader.format("kafka").load()
    return _topics_only(log, source)


def stream_log(spark: SparkSession, source: LogSource) -> DataFrame:
    """The same messages as an unbounded table; the checkpoint of the query keeps the position."""
    reader = spark.readStream.options(**source.reader_options)
    if source.path:
        log = reader.schema(LOG_SCHEMA).parquet(source.path)
    else:
        log = reader.format("kafka").load()
    return _topics_only(log, source)

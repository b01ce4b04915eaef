"""Names, columns and topics that readers of the tables rely on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column

# Topics, table names, field names and column order of the data contract.
CUSTOMERS_TOPIC = "dbserver1.public.customers"
DRIVERS_TOPIC = "dbserver1.public.drivers"
TRIPS_TOPIC = "taxi-trips"

DATABASE = "cdc"
BRONZE_CHANGES = "bronze_cdc_events"
BRONZE_TRIPS = "bronze_taxi_trips"
SILVER_CUSTOMERS = "silver_customers"
SILVER_DRIVERS = "silver_drivers"
SILVER_TRIPS = "silver_taxi_trips"
GOLD_STATS = "gold_taxi_aggregates"

LOG_SCHEMA = "topic string, partition int, offset bigint, timestamp timestamp, value binary"
RECORD_ID = ("topic", "partition", "offset")
UNDECODED = "undecoded"

ENVELOPE_SCHEMA = (
    "payload struct<op string, ts_ms string, source struct<lsn string>, before string, after string>"
)
BRONZE_CHANGE_SCHEMA = (
    "topic string, partition int, offset bigint, kafka_timestamp timestamp, value_str string, "
    "op string, ts_ms string, lsn string, before_json string, after_json string"
)
DELETE_OP = "d"

# wire name -> bronze column
TRIP_FIELDS = {
    "VendorID": "VendorID",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "PULocationID": "PULocationID",
    "DOLocationID": "DOLocationID",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
    "Airport_fee": "Airport_fee",
}
BRONZE_TRIP_COLUMNS = [*RECORD_ID, "kafka_timestamp", "value_str", *TRIP_FIELDS.values()]
SILVER_TRIP_SCHEMA = (
    "dolocation_id int, pulocation_id int, vendor_id string, pickup_datetime timestamp, "
    "dropoff_datetime timestamp, passenger_count int, trip_distance double, fare_amount double, "
    "extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "improvement_surcharge double, total_amount double, congestion_surcharge double, "
    "airport_fee double, pickup_zone string, dropoff_zone string"
)
GOLD_SCHEMA = (
    "pickup_zone string, pickup_hour timestamp, total_trips bigint, avg_fare double, "
    "avg_distance double, total_revenue double"
)
ZONE_SCHEMA = "LocationID int, Zone string"


def column_names(ddl: str) -> list[str]:
    """Top-level column names of a flat schema string."""
    return [part.split()[0] for part in ddl.split(", ")]


@dataclass(frozen=True)
class Entity:
    """One mirrored source table.

    ``fields`` maps each image field to the type of the mirror column. Strings are the
    default because the log carries no column types; a type other than string is opt-in. The
    key needs a whole-number type: ``bigint`` where ids outgrow ``int``.
    """

    name: str
    topic: str
    fields: tuple[tuple[str, str], ...]
    key: str = "id"
    any_topic_containing: bool = False

    def matches(self, topic: Column) -> Column:
        """True for this entity's topic, written on the plain column so that scans can prune."""
        return topic.contains(self.topic) if self.any_topic_containing else topic == self.topic

    @property
    def key_type(self) -> str:
        return dict(self.fields)[self.key]

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in self.fields]


CUSTOMERS = Entity(
    "customers",
    CUSTOMERS_TOPIC,
    (("id", "int"), ("name", "string"), ("email", "string"), ("country", "string")),
)
DRIVERS = Entity(
    "drivers",
    DRIVERS_TOPIC,
    (
        ("id", "int"),
        ("name", "string"),
        ("license_number", "string"),
        ("rating", "string"),
        ("city", "string"),
        ("active", "string"),
    ),
)

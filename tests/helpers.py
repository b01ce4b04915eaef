"""Hand-made messages."""

from __future__ import annotations

import datetime as dt
import json

from millrace.schemas import CUSTOMERS_TOPIC, LOG_SCHEMA, TRIPS_TOPIC

WHEN = dt.datetime(2026, 1, 1, 0, 0, 0)


def log(spark, rows):
    return spark.createDataFrame(rows, LOG_SCHEMA)


def change(offset, op, ts_ms, lsn, before=None, after=None, topic=CUSTOMERS_TOPIC, partition=0):
    payload = {
        "op": op,
        "ts_ms": ts_ms,
        "source": {"lsn": lsn},
        "before": before,
        "after": after,
    }
    text = json.dumps({"schema": {"type": "struct"}, "payload": payload})
    return (topic, partition, offset, WHEN, bytearray(text.encode()))


def image(key, name="n", email="e", country="c"):
    return {"id": key, "name": name, "email": email, "country": country}


def raw(offset, value, topic=CUSTOMERS_TOPIC, partition=0):
    return (topic, partition, offset, WHEN, None if value is None else bytearray(value))


TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": "2026-01-01T01:00:00",
    "tpep_dropoff_datetime": "2026-01-01T01:30:00",
    "passenger_count": 1.0,
    "trip_distance": 2.5,
    "PULocationID": 1.0,
    "DOLocationID": 2.0,
    "fare_amount": 10.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 1.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 13.0,
    "congestion_surcharge": 2.5,
    "Airport_fee": 1.25,
}


def trip(offset, **changes):
    text = json.dumps({**TRIP, **changes})
    return (TRIPS_TOPIC, 0, offset, WHEN, bytearray(text.encode()))


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)

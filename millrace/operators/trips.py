"""Trip messages: flat JSON to text columns, then to typed and checked trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import instant, undecoded_bytes, utf8_text, whole_number
from millrace.schemas import RECORD_ID, TRIP_FIELDS, UNDECODED

_WHOLE = {
    "passenger_count": "passenger_count",
    "PULocationID": "pulocation_id",
    "DOLocationID": "dolocation_id",
}
_INSTANTS = ("pickup_datetime", "dropoff_datetime")
_UNTYPED = {"VendorID": "vendor_id"}
_DECIDING = ("pickup_datetime", "dropoff_datetime", "fare_amount")


def parse_trips(log: DataFrame, keep_undecoded: bool = False) -> DataFrame:
    """Messages with the sixteen trip fields as text columns, read in one pass over the JSON.

    Field names match by case. The generator keeps later filters from parsing the text again.
    With ``keep_undecoded`` bytes that are not UTF-8 are kept in a column of their own.
    """
    kept = [undecoded_bytes(F.col("value")).alias(UNDECODED)] if keep_undecoded else []
    return log.select(
        *RECORD_ID,
        F.col("timestamp").alias("kafka_timestamp"),
        utf8_text(F.col("value")).alias("value_str"),
        *kept,
    ).select("*", F.json_tuple("value_str", *TRIP_FIELDS).alias(*TRIP_FIELDS.values()))


def _typed_columns() -> dict[str, Column]:
    typed = {}
    for name in TRIP_FIELDS.values():
        text = F.col(name)
        if name in _UNTYPED:
            typed[_UNTYPED[name]] = text
        elif name in _INSTANTS:
            typed[name] = instant(text)
        elif name in _WHOLE:
            typed[_WHOLE[name]] = whole_number(text)
        else:
            typed[name.lower()] = text.try_cast("double")
    return typed


def _unreadable(place: str) -> Column:
    return F.col(place).isNotNull() & whole_number(F.col(place)).isNull()


def _reject_reason() -> Column:
    """Why a trip is left out, by its text columns; null on trips worth keeping.

    Times, the fare and the places decide; an unreadable optional measure becomes null. A fare
    must be a number above zero, so NaN is refused although Spark orders it above every number.
    A place that is given but cannot be read would drop out of the statistics unseen, so it is
    refused; a place that is missing stays a trip without a zone.
    """
    pickup, dropoff, fare = (F.col(name) for name in _DECIDING)
    amount = fare.try_cast("double")
    return (
        F.when(F.coalesce(pickup, dropoff, fare).isNull(), "no_fields")
        .when(pickup.isNull(), "pickup_missing")
        .when(instant(pickup).isNull(), "pickup_unreadable")
        .when(dropoff.isNull(), "dropoff_missing")
        .when(instant(dropoff).isNull(), "dropoff_unreadable")
        .when(fare.isNull(), "fare_missing")
        .when(amount.isNull() | F.isnan(amount), "fare_unreadable")
        .when(amount <= 0, "fare_not_positive")
        .when(_unreadable("PULocationID"), "pickup_place_unreadable")
        .when(_unreadable("DOLocationID"), "dropoff_place_unreadable")
    )


def clean_trips(bronze: DataFrame, *kept: str) -> DataFrame:
    """Typed trips with both times and a fare above zero; the columns ``kept`` go along.

    Each text is read once: typed columns come out of a generator, and the filter is on them.
    Spark would push it into a plain projection and read the texts again.
    """
    typed = [column.alias(name) for name, column in _typed_columns().items()]
    places = {f"_{place}": _unreadable(place) for place in ("PULocationID", "DOLocationID")}
    row = F.struct(*typed, *(flag.alias(name) for name, flag in places.items()))
    fare = F.col("fare_amount")
    return (
        bronze.select(*kept, F.inline(F.array(row)))
        .filter(F.col("pickup_datetime").isNotNull() & F.col("dropoff_datetime").isNotNull())
        .filter((fare > 0) & ~F.isnan(fare) & ~F.col("_PULocationID") & ~F.col("_DOLocationID"))
        .drop(*places)
    )


def trip_rejects(bronze: DataFrame, *kept: str) -> DataFrame:
    """The messages ``clean_trips`` leaves out: identity, the deciding texts and the reason.

    The whole text is in bronze under the same identity, so it is not read here. The columns
    ``kept`` go along.
    """
    reason = _reject_reason().alias("reject_reason")
    return bronze.select(*RECORD_ID, *_DECIDING, reason, *kept).filter(F.col("reject_reason").isNotNull())

from __future__ import annotations

import datetime as dt

import pytest
from helpers import log, raw, rows, trip
from pyspark.sql import functions as F

from millrace.operators import (
    clean_trips,
    dimension_facts,
    enrich_zones,
    latest_hours,
    parse_trips,
    trip_rejects,
    undecodable,
    zone_stats,
)
from millrace.schemas import SILVER_TRIP_SCHEMA, TRIP_FIELDS, TRIPS_TOPIC, ZONE_SCHEMA

ONE = dt.datetime(2026, 1, 1, 1, 0, 0)


def clean(spark, *messages):
    return clean_trips(parse_trips(log(spark, list(messages))))


def zones(spark, *pairs):
    return spark.createDataFrame(pairs or [(1, "A"), (2, "B")], ZONE_SCHEMA)


def test_parse_keeps_every_field_as_text(spark):
    parsed = parse_trips(log(spark, [trip(0)]))
    assert parsed.columns[5:] == list(TRIP_FIELDS.values())
    assert {kind for name, kind in parsed.dtypes if name in TRIP_FIELDS.values()} == {"string"}
    row = parsed.first()
    assert (row.VendorID, row.passenger_count, row.Airport_fee) == ("1", "1.0", "1.25")


def test_field_names_match_by_case(spark):
    row = parse_trips(log(spark, [trip(0, Airport_fee=None, airport_fee=2.0)])).first()
    assert row.Airport_fee is None


@pytest.mark.parametrize(
    "text",
    [
        "2026-01-01T01:00:00",
        "2026-01-01T01:00:00.000",
        "2026-01-01T01:00:00Z",
        "2026-01-01 01:00:00",
        "2026-01-01T02:00:00+01:00",
    ],
)
def test_time_forms_name_one_instant(spark, text):
    got = clean(spark, trip(0, tpep_pickup_datetime=text)).first()
    assert got.pickup_datetime == ONE


@pytest.mark.parametrize("text", ["garbage", "", "01:00:00", "T01:00:00", "2026-13-01 00:00:00"])
def test_unreadable_times_are_rejected(spark, text):
    bronze = parse_trips(log(spark, [trip(0, tpep_dropoff_datetime=text)]))
    assert clean_trips(bronze).count() == 0
    assert trip_rejects(bronze).first().reject_reason == "dropoff_unreadable"


def test_only_fares_above_zero_are_kept(spark):
    fares = [0, -1, None, "NaN", "x", 2, "1e3"]
    bronze = parse_trips(log(spark, [trip(i, fare_amount=f) for i, f in enumerate(fares)]))
    assert rows(clean_trips(bronze).select("fare_amount")) == [(1000.0,), (2.0,)]
    assert {row.offset: row.reject_reason for row in trip_rejects(bronze).collect()} == {
        0: "fare_not_positive",
        1: "fare_not_positive",
        2: "fare_missing",
        3: "fare_unreadable",
        4: "fare_unreadable",
    }


@pytest.mark.parametrize(
    "value, want", [("1.0", 1), ("1.9", 1), ("-1.9", -1), ("", None), (None, None), ("NaN", None)]
)
def test_counts_are_cut_toward_zero(spark, value, want):
    assert clean(spark, trip(0, passenger_count=value)).first().passenger_count == want


def test_kept_and_rejected_make_up_the_log(spark):
    messages = [trip(0), trip(1, fare_amount=0), raw(2, None, TRIPS_TOPIC), raw(3, b"\xff", TRIPS_TOPIC)]
    source = log(spark, messages)
    bronze = parse_trips(source)
    assert clean_trips(bronze).count() == 1
    assert {row.offset: row.reject_reason for row in trip_rejects(bronze).collect()} == {
        1: "fare_not_positive",
        2: "no_fields",
        3: "no_fields",
    }
    kept = undecodable(parse_trips(source, keep_undecoded=True))
    assert [(row.offset, bytes(row.undecoded)) for row in kept.collect()] == [(3, b"\xff")]


def test_enriched_columns_follow_the_contract(spark):
    enriched = enrich_zones(clean(spark, trip(0)), zones(spark))
    want = [tuple(part.split()) for part in SILVER_TRIP_SCHEMA.split(", ")]
    assert enriched.dtypes == want
    assert (enriched.first().pickup_zone, enriched.first().dropoff_zone) == ("A", "B")


@pytest.mark.parametrize("place", [None, 29.0])
def test_unknown_place_keeps_the_trip_out_of_statistics_only(spark, place):
    enriched = enrich_zones(clean(spark, trip(0, PULocationID=place)), zones(spark))
    assert enriched.count() == 1
    assert enriched.first().pickup_zone is None
    assert zone_stats(enriched).count() == 0


def test_repeated_zone_key_is_refused(spark):
    with pytest.raises(ValueError, match="2 times"):
        enrich_zones(clean(spark, trip(0)), zones(spark, (1, "A"), (1, "B")))


def test_null_zone_keys_do_not_count_as_repeated(spark):
    facts = dimension_facts(zones(spark, (None, "x"), (None, "y"), (1, "A")))
    assert (facts.rows, facts.most_copies, facts.fits_broadcast) == (1, 1, True)


def test_empty_dimension(spark):
    empty = zones(spark).limit(0)
    assert enrich_zones(clean(spark, trip(0)), empty).first().pickup_zone is None


def test_statistics(spark):
    messages = [
        trip(0, fare_amount=10.0, trip_distance=1.0, total_amount=1.005),
        trip(1, fare_amount=10.01, trip_distance=None, total_amount=2.0),
        trip(2, fare_amount=5.0, tpep_pickup_datetime="2026-01-01T02:59:59", total_amount=None),
    ]
    stats = zone_stats(enrich_zones(clean(spark, *messages), zones(spark)))
    two = dt.datetime(2026, 1, 1, 2, 0, 0)
    assert rows(stats) == [("A", ONE, 2, 10.01, 1.0, 3.01), ("A", two, 1, 5.0, 2.5, None)]
    assert rows(zone_stats(enrich_zones(clean(spark, *messages), zones(spark)), "day")) == [
        ("A", dt.datetime(2026, 1, 1), 3, 8.34, 1.75, 3.01)
    ]


def test_values_without_decimal_form_survive_rounding(spark):
    messages = [trip(0, trip_distance="NaN", total_amount="Infinity")]
    row = zone_stats(enrich_zones(clean(spark, *messages), zones(spark))).first()
    assert row.avg_distance != row.avg_distance
    assert row.total_revenue == float("inf")


def test_ties_in_the_report_are_settled_by_zone(spark):
    messages = [trip(0, PULocationID=2.0), trip(1, PULocationID=1.0)]
    stats = zone_stats(enrich_zones(clean(spark, *messages), zones(spark)))
    assert [row.pickup_zone for row in latest_hours(stats).collect()] == ["A", "B"]
    assert latest_hours(stats, rows=1).first().pickup_zone == "A"


@pytest.mark.parametrize(
    "text",
    [
        '{"VendorID":{"x": 1,"y":[1, 2]}}',
        '{"VendorID":[1, 2]}',
        '{"VendorID":true}',
        '{"VendorID":null}',
        '{"VendorID":"q\\"\\u00e9\\n"}',
        '{"VendorID":12345678901234567890}',
        '{"VendorID":1.50}',
        '{"VendorID":1e3}',
        '{"VendorID":1}trailing',
        '{"VendorID":1',
        '{"VendorID":NaN}',
        '{"vendorid":1}',
        '[{"VendorID":1}]',
        '{"outer":{"VendorID":1}}',
        "{'VendorID':'x'}",
        "",
    ],
)
def test_one_pass_reads_the_same_text_as_a_json_path(spark, text):
    bronze = parse_trips(log(spark, [raw(0, text.encode(), TRIPS_TOPIC)]))
    row = bronze.select("VendorID", F.get_json_object("value_str", "$.VendorID").alias("p")).first()
    assert row.VendorID == row.p


def test_duplicated_trip_field_takes_the_last_value(spark):
    text = b'{"VendorID":"first","VendorID":"last"}'
    assert parse_trips(log(spark, [raw(0, text, TRIPS_TOPIC)])).first().VendorID == "last"

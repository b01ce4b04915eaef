"""Steps of the registered runs, over a few rows of their own."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.config import PARTITION
from millrace.workload import queries

DAYS = [dt.datetime(1997, 2, 11), dt.datetime(1997, 3, 5), dt.datetime(1997, 3, 12), dt.datetime(1997, 4, 2)]
TABLES = {
    "customer": (
        "c_custkey bigint, c_name string, c_mktsegment string, c_nationkey int",
        [(k, f"Customer#{k:09d}", "BUILDING", k % 3) for k in range(1, 4)],
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
        [(k, k % 3 + 1, "O", DAYS[k % 4], "1-URGENT") for k in range(1, 9)],
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
        [(k, dt.datetime(2024, 1, 10 + k), k % 2, "signup" if k < 2 else "click", 12.5) for k in range(6)],
    ),
    "nation": ("n_nationkey int, n_name string", [(k, f"zone {k}") for k in range(30)]),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
        [(k, k % 5, k % 3, 1, 2.0, 4000.0 + 1000 * k, 0.1, 0.05, "N", DAYS[k % 4]) for k in range(40)],
    ),
}


@pytest.fixture
def tables(spark, tmp_path):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_a_spoiled_month_is_backfilled_again_from_good_bronze(spark, tables, monkeypatch):
    spoiled = []

    class Seen(queries.Flow):
        def backfill(self, start, end):
            inside = (F.col(PARTITION) >= F.lit(start)) & (F.col(PARTITION) < F.lit(end))
            month = self.trips.rows.files().filter(inside)
            spoiled.append((month.count(), month.filter("fare_amount = '0'").count()))
            return super().backfill(start, end)

    monkeypatch.setattr(queries, "Flow", Seen)
    result = queries.backfill_loads(spark, tables)
    assert spoiled == [(20, 20), (20, 0)]
    assert result.filter("spoiled_rows <> 0").isEmpty()
    march = result.filter("pickup_hour >= '1997-03-01' AND pickup_hour < '1997-04-01'")
    expected = queries.gold_hourly(spark, tables)
    assert march.count() > 0
    assert queries.multiset_difference(result.drop("spoiled_rows"), expected).isEmpty()

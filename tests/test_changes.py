from __future__ import annotations

import random

import pytest
from helpers import change, image, log, raw, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import (
    change_rejects,
    change_state,
    current_state,
    latest_per_key,
    live_rows,
    merge_state,
    parse_change_events,
    state_as_of,
    with_change_key,
)
from millrace.schemas import BRONZE_CHANGE_SCHEMA, CUSTOMERS, DRIVERS, Entity, column_names


def mirror(spark, messages, entity=CUSTOMERS):
    return rows(current_state(parse_change_events(log(spark, messages)), entity))


def test_parse_has_contract_columns(spark):
    events = parse_change_events(log(spark, [change(0, "c", 5, 7, after=image(1))]))
    assert events.columns == column_names(BRONZE_CHANGE_SCHEMA)
    row = events.first()
    assert (row.op, row.ts_ms, row.lsn, row.before_json) == ("c", "5", "7", None)
    assert row.after_json == '{"id":1,"name":"n","email":"e","country":"c"}'
    assert row.value_str.startswith('{"schema"')


@pytest.mark.parametrize(
    "value", [None, b"", b"{", b"[]", b"5", b'{"payload":null}', b'{"payload":"text"}', b"\xff{"]
)
def test_unreadable_values_give_null_fields_not_errors(spark, value):
    row = parse_change_events(log(spark, [raw(0, value)])).first()
    assert (row.op, row.ts_ms, row.lsn, row.before_json, row.after_json) == (None,) * 5
    assert row.offset == 0


def test_order_is_numeric_not_by_text(spark):
    messages = [
        change(0, "u", 1000, 1, after=image(1, "new")),
        change(1, "u", 999, 2, after=image(1, "old")),
    ]
    assert mirror(spark, messages) == [(1, "new", "e", "c")]


def test_log_position_settles_equal_times(spark):
    messages = [
        change(0, "u", 5, 2, after=image(1, "second")),
        change(1, "u", 5, 1, after=image(1, "first")),
    ]
    assert mirror(spark, messages) == [(1, "second", "e", "c")]


def test_message_position_settles_equal_log_positions(spark):
    messages = [
        change(1, "u", 5, None, after=image(1, "later")),
        change(0, "u", 5, None, after=image(1, "earlier")),
    ]
    assert mirror(spark, messages) == [(1, "later", "e", "c")]


def test_missing_time_is_oldest(spark):
    messages = [
        change(0, "u", 5, 1, after=image(1, "timed")),
        change(1, "u", None, 9, after=image(1, "untimed")),
    ]
    assert mirror(spark, messages) == [(1, "timed", "e", "c")]


def test_create_delete_create_is_live(spark):
    messages = [
        change(0, "c", 1, 1, after=image(1, "a")),
        change(1, "d", 2, 2, before=image(1, "a")),
        change(2, "c", 3, 3, after=image(1, "b")),
    ]
    assert mirror(spark, messages) == [(1, "b", "e", "c")]
    assert mirror(spark, messages[:2]) == []


@pytest.mark.parametrize("op, live", [("r", 1), ("c", 1), ("u", 1), ("d", 0), (None, 0)])
def test_kinds_of_change(spark, op, live):
    assert len(mirror(spark, [change(0, op, 1, 1, after=image(1))])) == live


def test_records_without_value_or_key_do_not_reach_the_mirror(spark):
    messages = [
        raw(0, None),
        change(1, "t", 9, 9),
        change(2, "u", 1, 1, after=image("abc")),
        change(3, "u", 1, 1, after=image("1.0")),
        change(4, "u", 1, 1, after=image("7", "quoted key")),
        raw(5, b"\xff{"),
    ]
    assert mirror(spark, messages) == [(7, "quoted key", "e", "c")]


def test_new_image_key_wins_and_old_image_key_serves_deletes(spark):
    events = parse_change_events(
        log(
            spark,
            [
                change(0, "u", 1, 1, before=image(1), after=image(2)),
                change(1, "d", 1, 1, before=image(3)),
            ],
        )
    )
    keys = {row.offset: row.primary_key for row in with_change_key(events).collect()}
    assert keys == {0: 2, 1: 3}


def test_duplicated_json_key_takes_one_documented_value(spark):
    text = b'{"payload":{"op":"c","op":"u","ts_ms":1,"after":{"id":1}}}'
    row = parse_change_events(log(spark, [raw(0, text)])).first()
    assert row.op == "u"


def test_topics_are_told_apart_by_full_name(spark):
    messages = [
        change(0, "c", 1, 1, after=image(1)),
        change(0, "c", 1, 1, after=image(2), topic="other.public.customers"),
    ]
    assert [row[0] for row in mirror(spark, messages)] == [1]
    by_word = Entity("customers", "customers", CUSTOMERS.fields, any_topic_containing=True)
    assert [row[0] for row in mirror(spark, messages, by_word)] == [1, 2]


def test_driver_columns_are_text_unless_typed(spark):
    after = {
        "id": 4,
        "name": "x",
        "license_number": "L",
        "rating": 4.5,
        "city": "T",
        "active": True,
    }
    messages = [change(0, "c", 1, 1, after=after, topic=DRIVERS.topic)]
    assert mirror(spark, messages, DRIVERS) == [(4, "x", "L", "4.5", "T", "true")]
    typed = Entity(
        "drivers", DRIVERS.topic, (("id", "int"), ("rating", "double"), ("active", "boolean"))
    )
    assert mirror(spark, messages, typed) == [(4, 4.5, True)]


def test_keys_beyond_int_need_a_wider_type(spark):
    messages = [change(0, "c", 1, 1, after=image(2**40))]
    assert mirror(spark, messages) == []
    assert [r.reason for r in change_rejects(log(spark, messages), CUSTOMERS).collect()] == [
        "bad_key"
    ]
    wide = Entity("customers", CUSTOMERS.topic, (("id", "bigint"), ("name", "string")))
    assert mirror(spark, messages, wide) == [(2**40, "n")]


def test_as_of_includes_its_instant(spark):
    events = parse_change_events(
        log(
            spark,
            [
                change(0, "c", 10, 1, after=image(1, "a")),
                change(1, "u", 20, 2, after=image(1, "b")),
                change(2, "d", 30, 3, before=image(1, "b")),
            ],
        )
    )
    names = [[row[1] for row in rows(state_as_of(events, CUSTOMERS, t))] for t in (9, 10, 20, 30)]
    assert names == [[], ["a"], ["b"], []]


def test_late_older_change_does_not_revive_a_deleted_row(spark):
    delete = parse_change_events(log(spark, [change(5, "d", 50, 5, before=image(1))]))
    late = parse_change_events(log(spark, [change(6, "u", 40, 4, after=image(1, "late"))]))
    state = merge_state(change_state(delete, CUSTOMERS), change_state(late, CUSTOMERS))
    assert rows(live_rows(state, CUSTOMERS)) == []


def test_reject_reasons(spark):
    messages = [
        raw(0, None),
        raw(1, b"\xff{"),
        raw(2, b"not json"),
        change(3, "t", 1, 1),
        change(4, "u", 1, 1, after=image("abc")),
        change(5, None, 1, 1, after=image(1)),
        change(6, "u", 1, 1, after=image(1)),
        raw(7, None, topic=DRIVERS.topic),
    ]
    found = change_rejects(log(spark, messages), CUSTOMERS)
    assert {row.offset: row.reason for row in found.collect()} == {
        0: "no_value",
        1: "not_utf8",
        2: "no_envelope",
        3: "no_key",
        4: "bad_key",
        5: "no_op",
    }
    assert bytes(found.filter("offset = 1").first()["value"]) == b"\xff{"


event = st.tuples(
    st.integers(1, 4), st.sampled_from("cudr"), st.integers(0, 12), st.none() | st.integers(0, 5)
)


def brute_force(messages):
    newest = {}
    for offset, (key, op, ts, lsn) in enumerate(messages):
        position = (ts, -1 if lsn is None else lsn, offset)
        if key not in newest or position > newest[key][0]:
            newest[key] = (position, op, f"v{offset}")
    return sorted((key, name) for key, (_, op, name) in newest.items() if op != "d")


def encode(messages):
    return [
        change(
            offset,
            op,
            ts,
            lsn,
            before=image(key),
            after=None if op == "d" else image(key, f"v{offset}"),
        )
        for offset, (key, op, ts, lsn) in enumerate(messages)
    ]


@settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
    derandomize=True,
)
@given(st.lists(event, min_size=1, max_size=25), st.integers(0, 1000))
def test_any_fold_order_equals_the_whole_log(spark, messages, seed):
    encoded = encode(messages)
    events = parse_change_events(log(spark, encoded))
    want = brute_force(messages)
    assert rows(current_state(events).select("id", "name")) == want
    assert rows(current_state(events.unionByName(events)).select("id", "name")) == want

    parts = [encoded[i::3] for i in range(3)]
    random.Random(seed).shuffle(parts)
    state = change_state(parse_change_events(log(spark, parts[0])), CUSTOMERS)
    for part in parts[1:]:
        state = merge_state(state, change_state(parse_change_events(log(spark, part)), CUSTOMERS))
    assert rows(live_rows(state, CUSTOMERS).select("id", "name")) == want


def test_hot_key_leaves_each_task_as_one_row(spark):
    hot = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    latest = latest_per_key(hot, ["k"], ["t"])
    assert latest.count() == 20_001
    assert latest.filter("k = 0").first()["t"] == 29_997

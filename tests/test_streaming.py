from __future__ import annotations

from helpers import change, image, log, raw, rows

from millrace.operators import change_state, live_rows, parse_change_events
from millrace.schemas import CUSTOMERS, CUSTOMERS_TOPIC
from millrace.sinks import read_version, version_history
from millrace.sources import LogSource, read_log, stream_log
from millrace.streaming import run_append, run_mirror


def put(spark, path, *messages):
    log(spark, list(messages)).coalesce(1).write.mode("append").parquet(path)


def test_replay_reads_only_subscribed_topics(spark, tmp_path):
    path = str(tmp_path / "log")
    put(spark, path, raw(0, b"a", "x"), raw(1, b"b", "y"), raw(2, b"c", "z"))
    found = read_log(spark, LogSource(("x", "z"), path=path))
    assert found.columns == ["topic", "partition", "offset", "timestamp", "value"]
    assert rows(found.select("offset")) == [(0,), (2,)]


def test_broker_reader_options():
    source = LogSource(("a", "b"), servers="host:9092", options={"minPartitions": "64"})
    assert source.reader_options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "minPartitions": "64",
    }


def test_each_message_enters_once_over_several_runs(spark, tmp_path):
    path = str(tmp_path / "log")
    source = LogSource((CUSTOMERS_TOPIC,), path=path)

    def run():
        events = parse_change_events(stream_log(spark, source))
        run_append(events, str(tmp_path / "bronze"), str(tmp_path / "cp"), ["topic"])
        return spark.read.parquet(str(tmp_path / "bronze")).select("offset")

    put(spark, path, change(0, "c", 1, 1, after=image(1)), raw(1, None))
    assert rows(run()) == [(0,), (1,)]
    assert rows(run()) == [(0,), (1,)]
    put(spark, path, change(2, "c", 1, 1, after=image(2)))
    assert rows(run()) == [(0,), (1,), (2,)]


def test_mirror_follows_the_log_batch_by_batch(spark, tmp_path, database):
    path, table = str(tmp_path / "log"), f"{database}.state"
    batches = [
        [change(0, "d", 9, 9, before=image(1)), change(1, "c", 1, 1, after=image(2))],
        [change(2, "u", 5, 5, after=image(1, "late"))],
        [change(3, "u", 3, 3, after=image(2, "newer")), change(4, "c", 1, 2, after=image(3))],
    ]
    for batch in batches:
        put(spark, path, *batch)
    source = LogSource((CUSTOMERS_TOPIC,), path=path, options={"maxFilesPerTrigger": "1"})
    for _ in range(2):
        events = parse_change_events(stream_log(spark, source))
        view = f"{database}.customers"
        run_mirror(events, CUSTOMERS, table, str(tmp_path / "cp"), buckets=4, keep=1, view=view)

    assert version_history(spark, table).count() == 3
    got = live_rows(read_version(spark, table), CUSTOMERS)
    whole = change_state(parse_change_events(read_log(spark, source)), CUSTOMERS)
    assert rows(got) == rows(live_rows(whole, CUSTOMERS))
    assert rows(got.select("id", "name")) == [(2, "newer"), (3, "n")]
    assert rows(spark.table(f"{database}.customers")) == rows(got)

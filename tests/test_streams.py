"""Streams that are replayed, that come in several runs, and whose late and open rows are told."""

import datetime as dt
import os

from pyspark.sql import functions as F

from codesieve.streaming import streams

FILES = "file_id long, path string, code string"
EVENTS = "ts timestamp, event_type string"


def arrive(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def files_of(first, count):
    return [(k, f"f{k}.py", f"password = '{k}'\n") for k in range(first, first + count)]


def test_a_replayed_batch_is_written_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for k in range(3):
        arrive(spark, source, files_of(10 * k, 4), FILES)
    stream = lambda: streams.scan_new_files(streams.read_files(spark, source, FILES, per_batch=1))
    schema = stream().schema
    assert streams.written_batches(spark, out, schema).count() == 0
    streams.run_batches(stream(), out, state)
    once = sorted(r.file_id for r in streams.written_batches(spark, out, schema).collect())
    assert once == [10 * k + i for k in range(3) for i in range(4)]
    # The driver is lost after the last batch was written and before its commit was.
    last = max(os.listdir(f"{state}/commits"), key=lambda n: int(n) if n.isdigit() else -1)
    for name in (last, f".{last}.crc"):
        os.remove(f"{state}/commits/{name}")
    arrive(spark, source, files_of(30, 4), FILES)
    streams.run_batches(stream(), out, state)
    again = streams.written_batches(spark, out, schema)
    assert sorted(r.file_id for r in again.collect()) == sorted([*once, 30, 31, 32, 33])
    assert again.select("batch").distinct().count() == 4
    assert all(r.verdict in ("HIGH", "CRITICAL", "MEDIUM") for r in again.collect())


def at(hour, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute)


def test_open_and_late_windows_come_from_the_stream(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    stream = lambda: streams.read_files(spark, source, EVENTS)
    arrive(spark, source, [(at(1, 5), "a"), (at(1, 59), "a"), (at(2, 10), "b"), (at(4, 0), "a")], EVENTS)
    first = streams.run_windows(spark, stream(), out, state)
    rows = lambda df: sorted((r.window_start.hour, r.event_type, r.n) for r in df.collect())
    assert rows(first.closed) == [(1, "a", 2), (2, "b", 1)]
    assert rows(first.open) == [(4, "a", 1)]
    assert first.late == 0
    # Two rows come after their windows are closed, one in time; then the watermark moves on.
    arrive(spark, source, [(at(1, 30), "a"), (at(2, 30), "c"), (at(4, 30), "a"), (at(9, 0), "b")], EVENTS)
    second = streams.run_windows(spark, stream(), out, state)
    assert rows(second.closed) == [(1, "a", 2), (2, "b", 1), (4, "a", 2)]
    assert rows(second.open) == [(9, "b", 1)]
    assert second.late == 2
    told = {(r.state, r.n) for r in second.rows().where(F.col("state") != "closed").collect()}
    assert told == {("open", 1), ("late", 2)}
    assert streams.run_windows(spark, stream(), out, state).late == 2

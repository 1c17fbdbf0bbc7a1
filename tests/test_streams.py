"""Streams against a plain fold: any cut into files, late rows, closed windows."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparrowmill.plans import streams
from sparrowmill.session import scratch_path
from sparrowmill.streaming import reports as st

START = datetime(2024, 1, 1)
SCHEMA = "event_id bigint, user_id bigint, ts timestamp, value double"


def write_files(spark, files):
    """One file per list of rows, in this order of time of change."""
    path = scratch_path(spark, "arrivals")
    for n, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/part={n:04d}")
    return path


def stream_of(spark, path, per_batch=1):
    return st.event_stream(spark, f"{path}/*", spark.createDataFrame([], SCHEMA).schema, files_per_batch=per_batch)


def folded(rows, momentum):
    out = {}
    for event_id, user, ts, value in sorted(rows, key=lambda r: (r[2], r[0])):
        n, s = out.get(user, (0, 0.0))
        out[user] = n + 1, s if value is None else momentum * s + (1 - momentum) * value
    return out


@pytest.mark.parametrize("cuts", [(200,), (40, 41, 150, 200), tuple(range(25, 201, 25))])
def test_moving_mean_for_any_cut_into_files(spark, cuts):
    rng = np.random.default_rng(4)
    rows = [(i, int(rng.integers(0, 4)), START + timedelta(minutes=int(i // 3 * 5)), None if i % 17 == 0 else float(rng.normal(50, 9))) for i in range(200)]
    order = sorted(range(200), key=lambda i: i + rng.uniform(0, 20))  # rows come up to an hour late
    files = [[rows[i] for i in order[a:b]] for a, b in zip((0, *cuts), cuts)]
    home = scratch_path(spark, "stream")
    stream = stream_of(spark, write_files(spark, files))
    out = st.collect_batches(st.moving_mean(stream, "user_id", ["ts", "event_id"], "value", 0.9, "3 hours"), "update", home)
    got = {r.user_id: (r.n, r.moving) for r in st.latest(out, "user_id").collect()}
    want = folded(rows, 0.9)
    assert {u: n for u, (n, _) in got.items()} == {u: n for u, (n, _) in want.items()}
    assert all(math.isclose(got[u][1], want[u][1], rel_tol=1e-9) for u in want)


def test_silent_keys_are_closed_and_start_anew(spark):
    early = [(i, 1, START + timedelta(minutes=i), 10.0) for i in range(5)]
    others = [[(100 + n, 2, START + timedelta(hours=3 * n), 1.0)] for n in range(1, 5)]
    back = [(200, 1, START + timedelta(hours=14), 30.0)]
    stream = stream_of(spark, write_files(spark, [early, *others, back]))
    means = st.moving_mean(stream, "user_id", ["ts", "event_id"], "value", 0.5, "1 hour", expire="2 hours")
    rows = st.collect_batches(means, "update", scratch_path(spark, "stream")).filter("user_id = 1").orderBy("batch_id").collect()
    closed = [r for r in rows if r.closed]
    assert [(r.n, round(r.moving, 6)) for r in closed] == [(5, 10 * (1 - 0.5 ** 5))]
    assert (rows[-1].n, rows[-1].moving) == (1, 15.0)


@pytest.mark.parametrize("expire", [None, "1 day"])
def test_moving_mean_of_many_keys_in_few_groups(spark, expire):
    """Keys that share a group, one of them null, some silent for whole micro-batches."""
    rng = np.random.default_rng(8)
    rows = [(i, None if i % 11 == 0 else int(rng.integers(0, 30)), START + timedelta(minutes=i), float(rng.normal(50, 9))) for i in range(600)]
    stream = stream_of(spark, write_files(spark, [rows[a:a + 100] for a in range(0, 600, 100)]))
    means = st.moving_mean(stream, "user_id", ["ts", "event_id"], "value", 0.9, "1 hour", expire, shares=2)
    out = st.collect_batches(means, "update", scratch_path(spark, "stream"))
    assert out.groupBy("user_id", "batch_id").count().filter("count > 1").isEmpty()
    got = {r.user_id: (r.n, r.moving) for r in st.latest(out, "user_id").collect()}
    want = folded(rows, 0.9)
    assert {u: n for u, (n, _) in got.items()} == {u: n for u, (n, _) in want.items()}
    assert all(math.isclose(got[u][1], want[u][1], rel_tol=1e-9) for u in want)


def test_silent_keys_of_one_group_are_closed_apart(spark):
    early = [(i, 1 + i % 2, START + timedelta(minutes=i), 10.0) for i in range(10)]
    on = [[(100 + n, 2, START + timedelta(hours=n), 1.0)] for n in range(1, 9)]
    stream = stream_of(spark, write_files(spark, [early, *on]))
    means = st.moving_mean(stream, "user_id", ["ts", "event_id"], "value", 0.5, "1 hour", expire="2 hours", shares=1)
    rows = st.collect_batches(means, "update", scratch_path(spark, "stream")).collect()
    assert [(r.user_id, r.n) for r in rows if r.closed] == [(1, 5)]
    assert max(r.n for r in rows if r.user_id == 2) == 13


def test_late_rows_of_many_batches_are_counted(spark):
    """More micro-batches than progress reports are kept, and repeated event ids."""
    files, total, late = [], 0, 0
    for n in range(104):
        rows = [(n % 7, 1, START + timedelta(hours=n, minutes=m), 1.0) for m in (0, 0, 20)]
        if n % 5 == 4:
            rows.append((n % 7, 1, START, 1.0))
            late += 1
        files.append(rows)
        total += len(rows)
    stream = stream_of(spark, write_files(spark, files))
    windows, both = st.late_rows(stream, "1 hour", "2 hours", scratch_path(spark, "stream"), shares=2)
    assert tuple(both.first()) == (total - late, late)
    assert windows.agg(F.sum("n")).first()[0] == total - late


def test_windows_are_emitted_once_when_closed(spark):
    rows = [(i, 1, START + timedelta(minutes=10 * i), float(i)) for i in range(60)]
    stream = stream_of(spark, write_files(spark, [rows[a:a + 12] for a in range(0, 60, 12)]))
    got = st.collect_batches(st.tumbling_throughput(stream, "1 hour", "1 hour"), "append", scratch_path(spark, "stream")).collect()
    starts = [r.start for r in got]
    assert len(starts) == len(set(starts)) and sorted(starts) == [START + timedelta(hours=h) for h in range(8)]
    assert all(r.n == 6 for r in got)


def open_windows_case(spark):
    rows = [(i, 1, START + timedelta(minutes=10 * i), float(i)) for i in range(60)]
    return rows, stream_of(spark, write_files(spark, [rows[a:a + 11] for a in range(0, 60, 11)]))


def test_tumbling_windows_that_are_still_open_are_reported(spark):
    rows, stream = open_windows_case(spark)
    out = st.collect_batches(st.tumbling_throughput(stream, "1 hour", "1 hour"), "update", scratch_path(spark, "stream"))
    got = {r.start: (r.n, r.total) for r in st.latest(out, "start").collect()}
    assert got == {START + timedelta(hours=h): (6, float(sum(range(6 * h, 6 * h + 6)))) for h in range(10)}


def test_n02_reports_every_window(spark):
    sf = "/root/testdata/sf0.001"
    rows = streams.n02(spark, sf).agg(F.sum("n"), F.max("start")).first()
    events = spark.read.parquet(f"{sf}/events.parquet").agg(F.count("*"), F.date_format(F.date_trunc("hour", F.max("ts")), streams.HOUR))
    assert tuple(rows) == tuple(events.first())


def test_sliding_windows_that_are_still_open_are_reported(spark):
    rows, stream = open_windows_case(spark)
    out = st.collect_batches(st.sliding_mean(stream, "1 hour", "30 minutes", "1 hour"), "update", scratch_path(spark, "stream"))
    got = {r.start: (r.n, r.mean) for r in st.latest(out, "start").collect()}
    want = {}
    for _, _, ts, value in rows:
        for start in (START + timedelta(minutes=30 * k) for k in range(-1, 20)):
            if start <= ts < start + timedelta(hours=1):
                want.setdefault(start, []).append(value)
    assert got == {start: (len(v), sum(v) / len(v)) for start, v in want.items()}


def test_n03_reports_every_window(spark):
    sf = "/root/testdata/sf0.001"
    rows = streams.n03(spark, sf).agg(F.sum("n"), F.max("start")).first()
    events = spark.read.parquet(f"{sf}/events.parquet").agg((F.count("*") * 4).alias("n"), F.max(F.col("ts").cast("timestamp")).alias("ts"))
    last = F.date_format(F.window("ts", "15 minutes")["start"], streams.HOUR)
    assert tuple(rows) == tuple(events.select("n", last).first())


def test_ingest_reads_a_batch_once(spark):
    rows = [(i, 1 if i % 3 else None, START, None if i % 4 == 0 else 1.0) for i in range(24)]
    home = scratch_path(spark, "stream")
    good, bad = st.ingest(stream_of(spark, write_files(spark, [rows[:12], rows[12:]])), ["user_id", "value"], home)
    assert good.count() == 12 and bad.count() == 12 and "lacking" not in good.columns
    assert sorted(map(tuple, bad.filter("event_id < 12").select("event_id", F.array_join("lacking", ",")).collect())) == [
        (0, "user_id,value"), (3, "user_id"), (4, "value"), (6, "user_id"), (8, "value"), (9, "user_id")]

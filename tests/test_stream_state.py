"""Keyed state over micro-batches: watched runs, box changes, once-only consumption. Streams equal the batch result
however the events are landed, and go on from their checkpoint."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeops.streaming import once, polling, verdict_log
from lakeops.streaming import status as st

DAY = dt.datetime(2025, 1, 1)
SCHEMA = "job long, ts timestamp, seq long, status string"


def watched(rows, limit, delay):
    """The definition of the watched runs, on all rows at once."""
    passed = max(r[1] for r in rows) - dt.timedelta(seconds=delay)
    limit = dt.timedelta(seconds=limit)
    out = []
    for job in sorted({r[0] for r in rows}):
        run = None
        for _, ts, _, status in sorted(r for r in rows if r[0] == job and r[1] <= passed):
            if run and not run[2] and ts > run[0] + limit:
                out.append((job, run[0], run[0] + limit, "stuck", None, run[1]))
                run[2] = True
            if status == "1":
                run = run or [ts, 0, False]
                run[1] += not run[2]
            else:
                if run and not run[2]:
                    out.append((job, run[0], ts, "finished", status, run[1]))
                run = None
        if run and not run[2] and passed >= run[0] + limit:
            out.append((job, run[0], run[0] + limit, "stuck", None, run[1]))
    return sorted(out)


def land(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def poll_rows(seed, count=300, jobs=7):
    rng = random.Random(seed)
    at = sorted(rng.randint(0, 40_000) for _ in range(count))
    return [(rng.randint(1, jobs), DAY + dt.timedelta(seconds=s), i, rng.choice("1114456")) for i, s in enumerate(at)]


@pytest.mark.parametrize("parts", [1, 4])
def test_watched_runs_equal_their_definition(spark, tmp_path, parts):
    """Also when polls come in other orders than their times (within the delay), over runs of the query."""
    rows, limit, delay = poll_rows(parts), 900, 1200
    rows += [(99, DAY + dt.timedelta(seconds=5), 9_000, "1"), (98, DAY + dt.timedelta(seconds=40_000), 9_001, "1")]  # silent since; just begun
    rng = random.Random(1)
    rng.shuffle(rows)
    rows.sort(key=lambda r: r[1] + dt.timedelta(seconds=rng.randint(0, 600)))
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(parts):
        land(spark, rows[i * len(rows) // parts:(i + 1) * len(rows) // parts], landing)
        polls = st.read_event_stream(spark, landing, spark.createDataFrame([], SCHEMA).schema, watermark=f"{delay} seconds", files_per_trigger=1)
        with polling.state_store(spark):
            st.run_available(polling.watch_runs(polls, "job", "ts", "seq", "status", limit), str(tmp_path / "ckpt"), f"watch{parts}{i}", "append", st.per_batch_writer(out))
    got = sorted(((r.job, r.run_start, r.run_end, r.outcome, r.end_status, r.n_polls) for r in spark.read.parquet(out).collect()), key=str)
    assert got == sorted(watched(rows, limit, delay), key=str)
    assert {"stuck", "finished"} == {g[3] for g in got} and any(g[0] == 99 for g in got)


def test_watch_arguments(spark, tmp_path):
    for bad in (0, -1, 1.5):
        with pytest.raises(ValueError):
            polling.watch_runs(spark.createDataFrame([], SCHEMA), "job", "ts", "seq", "status", bad)
    before = spark.conf.get(polling.STATE_STORE)
    with polling.state_store(spark):
        assert spark.conf.get(polling.STATE_STORE) == polling.ROCKSDB
    assert spark.conf.get(polling.STATE_STORE) == before


def verdicts(spark, rows):
    latest = spark.createDataFrame(rows, SCHEMA).groupBy("job").agg(F.max_by("status", F.struct("ts", -F.col("seq"))).alias("latest_status"))
    return sorted(map(tuple, st.polled_verdicts(latest, "job", F.expr("job div 10"), F.col("job") % 10 == 0).select("box", "box_status", "n_children", "verdict").collect()))


def test_box_changes_equal_the_batch_verdicts(spark, tmp_path):
    """Over batches with compactions; a batch writes only the boxes that it changed."""
    rng = random.Random(5)
    rows = [(rng.randint(0, 79), DAY + dt.timedelta(seconds=i // 2), i, rng.choice("146")) for i in range(400)]
    rows += [(5, DAY + dt.timedelta(days=1), 1000, "6")]
    landing, log = str(tmp_path / "in"), str(tmp_path / "log")
    writer = verdict_log.change_writer(log, compact_every=2)
    done = []
    for i, part in enumerate((rows[:200], rows[200:300], rows[300:400], rows[400:], rows[400:])):
        done += part
        land(spark, part, landing)
        polls = st.read_event_stream(spark, landing, spark.createDataFrame([], SCHEMA).schema)
        changes = verdict_log.box_changes(polls, "job", "ts", "seq", F.col("status"), F.expr("job div 10"), F.col("job") % 10 == 0)
        with polling.state_store(spark):
            st.run_available(changes, str(tmp_path / "ckpt"), f"box{i}", "update", writer)
        got = verdict_log.read_verdicts(spark, log).select("box", "box_status", "n_children", "verdict")
        assert sorted(map(tuple, got.collect())) == verdicts(spark, done)
    assert verdict_log._parts(spark, log, "base") == [1, 3]
    assert [r.box for r in spark.read.parquet(f"{log}/batch=3").collect()] == [0]
    assert spark.read.parquet(f"{log}/batch=4").count() == 0
    total = verdict_log._summed(spark.read.parquet(f"{log}/batch=2"))
    writer(total.withColumn("box", F.col("box")), 2)  # a batch that runs again
    assert sorted(map(tuple, verdict_log.read_verdicts(spark, log).select("box", "box_status", "n_children", "verdict").collect())) == verdicts(spark, done)
    with pytest.raises(ValueError):
        verdict_log.change_writer(log, 0)


def test_once(spark, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    at = lambda s: DAY + dt.timedelta(seconds=s)
    batches = [[(1, at(0)), (2, at(100)), (2, at(100)), (3, at(1000))],
               [(3, at(1000)), (4, at(990)), (5, at(10)), (1, at(0)), (6, at(901)), (7, at(900))],
               [(8, at(2000)), (6, at(901))], [(9, at(1950)), (10, at(1800)), (8, at(2000))]]
    schema = "event_id long, ts timestamp"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        raw = spark.readStream.schema(schema).parquet(landing)
        st.run_available(once.once(raw, "event_id", "ts", 100), str(tmp_path / "ckpt"), f"once{i}", "append", once.once_writer(out, "ts", 100))
    part = lambda what: sorted(r.event_id for r in once.read_part(spark, out, what, schema).collect())
    assert part("accepted") == [1, 2, 3, 4, 6, 8, 9]
    assert part("late") == [1, 5, 7, 10]
    report = once.read_part(spark, out, "report", once.REPORT).where("n_seen > 0").orderBy("batch_id").collect()
    assert [(r.n_seen, r.n_accepted, r.n_late, r.n_repeated) for r in report] == [(4, 3, 0, 1), (6, 2, 3, 1), (2, 1, 0, 1), (3, 1, 1, 1)]

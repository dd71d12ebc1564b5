"""Streaming jobs over landed event files: latest status, box verdicts, consumption, alerts. Each
query lands the events, runs its stream to the end of the landed files, and reads the sink back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.plans.registry import query
from lakeops.session import scratch_path
from lakeops.streaming import once, polling, verdict_log
from lakeops.streaming import status as st
from lakeops.tables import Tables

# Parameters of the registered queries.
BOX_FANOUT = 3  # job 3 b is the run of box b itself, 3 b + 1 and 3 b + 2 are its children
POLL_LIMIT = 6 * 3600  # seconds that a run is polled
POLL_DELAY = 3600  # seconds that a poll may come late
ONCE_DELAY = 86_400  # seconds that a message may come late


def _landed(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, str]:
    events = Tables(spark, sf_dir).events
    landing = scratch_path(spark, f"landing-{name}")
    st.land_files(events, landing, ["ts", "event_id"])
    return st.read_event_stream(spark, landing, events.schema), scratch_path(spark, f"ckpt-{name}")


@query("stream_latest_status", "T1", """SELECT user_id, max(ts) AS latest_ts, arg_max(event_type, ts) AS latest_status,
    count(*) AS n_events FROM events GROUP BY user_id""")
def stream_latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, ckpt = _landed(spark, sf_dir, "latest")
    out = scratch_path(spark, "sink-latest")
    latest = st.latest_status(stream, "user_id", "ts", "event_type", "event_id")
    st.run_available(latest, ckpt, f"latest_{ckpt[-12:]}", "complete", st.snapshot_writer(out))
    return st.read_snapshot(spark, out)


@query("stream_box_verdict", "T2 G9", f"""WITH latest AS (
    SELECT user_id AS job, arg_max(CASE WHEN event_type = 'error' THEN '6'
      WHEN event_type IN ('click', 'view') THEN '1' ELSE '4' END, ts) AS status FROM events GROUP BY user_id)
  SELECT job // {BOX_FANOUT} AS box, max(status) FILTER (WHERE job % {BOX_FANOUT} = 0) AS box_status,
    count(*) FILTER (WHERE job % {BOX_FANOUT} <> 0) AS n_children,
    CASE WHEN bool_or(job % {BOX_FANOUT} <> 0 AND status = '6') THEN 'failed'
         WHEN bool_or(job % {BOX_FANOUT} <> 0 AND status = '1') THEN 'open'
         WHEN max(status) FILTER (WHERE job % {BOX_FANOUT} = 0) = '4' THEN 'success' ELSE 'not success' END AS verdict
  FROM latest GROUP BY job // {BOX_FANOUT}""")
def stream_box_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, ckpt = _landed(spark, sf_dir, "verdict")
    out = scratch_path(spark, "sink-verdict")
    latest = st.latest_status(stream.withColumnRenamed("user_id", "job"), "job", "ts",
                              st.event_status_code(F.col("event_type")), "event_id")
    writer = st.verdict_writer(out, "job", F.expr(f"job div {BOX_FANOUT}"), F.col("job") % BOX_FANOUT == 0)
    st.run_available(latest, ckpt, f"verdict_{ckpt[-12:]}", "complete", writer)
    return st.read_snapshot(spark, out)


@query("stream_consume", "T3", """SELECT event_id, user_id, ts, value, 'job_' || CAST(user_id AS VARCHAR) AS triggered_job
  FROM events WHERE event_type = 'purchase'""")
def stream_consume(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, ckpt = _landed(spark, sf_dir, "consume")
    out = scratch_path(spark, "sink-consume")
    picked = stream.where(F.col("event_type") == "purchase").select(
        "event_id", "user_id", "ts", "value",
        F.concat(F.lit("job_"), F.col("user_id").cast("string")).alias("triggered_job"))
    st.run_available(picked, ckpt, f"consume_{ckpt[-12:]}", "append", st.per_batch_writer(out))
    return spark.read.parquet(out).drop("batch_id")


@query("stream_alerts", "T4", """SELECT event_id, user_id AS job, ts, 'Job Failure: ' || CAST(user_id AS VARCHAR) AS subject,
    'Job ' || CAST(user_id AS VARCHAR) || ' failed at event ' || CAST(event_id AS VARCHAR) AS body
  FROM events WHERE event_type = 'error'""")
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, ckpt = _landed(spark, sf_dir, "alerts")
    out = scratch_path(spark, "sink-alerts")
    rows = st.alerts(stream, F.col("event_type") == "error", "user_id", "event_id", "ts")
    st.run_available(rows, ckpt, f"alerts_{ckpt[-12:]}", "append", sink_path=out)
    return spark.read.parquet(out)


@query("stream_runs", "T1", f"""WITH e AS (SELECT user_id AS job, ts, event_id, CASE WHEN event_type = 'error' THEN '6'
      WHEN event_type IN ('click', 'view') THEN '1' ELSE '4' END AS status,
      (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL {POLL_DELAY} SECOND FROM events) AS passed FROM events),
  p AS (SELECT *, status = '1' AS runs, lag(status) OVER (PARTITION BY job ORDER BY ts, event_id) AS before FROM e WHERE ts <= passed),
  n AS (SELECT *, sum(CASE WHEN runs AND before IS DISTINCT FROM '1' THEN 1 ELSE 0 END) OVER (PARTITION BY job ORDER BY ts, event_id) AS run FROM p),
  r AS (SELECT job, run, any_value(passed) AS passed, min(ts) FILTER (runs) AS run_start, min(ts) FILTER (NOT runs) AS ended,
      arg_min(status, ts) FILTER (NOT runs) AS end_status FROM n WHERE run > 0 GROUP BY job, run),
  k AS (SELECT *, run_start + INTERVAL {POLL_LIMIT} SECOND AS until FROM r),
  o AS (SELECT *, CASE WHEN ended <= until THEN 'finished' WHEN ended > until OR passed >= until THEN 'stuck' END AS outcome FROM k)
  SELECT o.job, run_start, CASE outcome WHEN 'finished' THEN ended ELSE until END AS run_end, outcome,
    CASE outcome WHEN 'finished' THEN end_status END AS end_status, count(*) FILTER (runs AND ts <= until) AS n_polls
  FROM o JOIN n ON n.job = o.job AND n.run = o.run WHERE outcome IS NOT NULL GROUP BY ALL""")
def stream_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run of every job polled until it leaves "running" or its limit has passed."""
    events = Tables(spark, sf_dir).events
    landing, out, ckpt = (scratch_path(spark, f"{what}-runs") for what in ("landing", "sink", "ckpt"))
    st.land_files(events, landing, ["ts", "event_id"])
    polls = st.read_event_stream(spark, landing, events.schema, watermark=f"{POLL_DELAY} seconds")
    rows = polling.watch_runs(polls, "user_id", "ts", "event_id", st.event_status_code(F.col("event_type")), POLL_LIMIT)
    with polling.state_store(spark):
        st.run_available(rows, ckpt, f"runs_{ckpt[-12:]}", "append", st.per_batch_writer(out))
    done = spark.read.parquet(out).drop("batch_id")
    return done.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("run_start", "run_end")})


@query("stream_box_changes", "T2 G9", f"""WITH latest AS (
    SELECT user_id AS job, arg_max(CASE WHEN event_type = 'error' THEN '6'
      WHEN event_type IN ('click', 'view') THEN '1' ELSE '4' END, ts) AS status FROM events GROUP BY user_id)
  SELECT job // {BOX_FANOUT} AS box, max(status) FILTER (WHERE job % {BOX_FANOUT} = 0) AS box_status,
    count(*) FILTER (WHERE job % {BOX_FANOUT} <> 0) AS n_children,
    CASE WHEN bool_or(job % {BOX_FANOUT} <> 0 AND status = '6') THEN 'failed'
         WHEN bool_or(job % {BOX_FANOUT} <> 0 AND status = '1') THEN 'open'
         WHEN max(status) FILTER (WHERE job % {BOX_FANOUT} = 0) = '4' THEN 'success' ELSE 'not success' END AS verdict
  FROM latest GROUP BY job // {BOX_FANOUT}""")
def stream_box_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box verdicts from a log of changes, over several micro-batches with compactions between them."""
    events = Tables(spark, sf_dir).events
    landing, out, ckpt = (scratch_path(spark, f"{what}-changes") for what in ("landing", "log", "ckpt"))
    st.land_files(events, landing, ["ts", "event_id"])
    polls = st.read_event_stream(spark, landing, events.schema, files_per_trigger=2)
    rows = verdict_log.box_changes(polls, "user_id", "ts", "event_id", st.event_status_code(F.col("event_type")),
                                   F.expr(f"user_id div {BOX_FANOUT}"), F.col("user_id") % BOX_FANOUT == 0)
    with polling.state_store(spark):
        st.run_available(rows, ckpt, f"changes_{ckpt[-12:]}", "update", verdict_log.change_writer(out, compact_every=3))
    return verdict_log.read_verdicts(spark, out)


@query("stream_consume_once", "T3", f"""WITH w AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL {ONCE_DELAY} SECOND AS passed
    FROM events WHERE event_id % 5 <> 0)
  SELECT event_id, user_id, ts, value, 'accepted' AS fate FROM events, w WHERE event_id % 5 <> 0 OR ts > passed
  UNION ALL SELECT event_id, user_id, ts, value, 'late' FROM events, w WHERE (event_id % 5 = 0 OR event_id % 3 = 0) AND ts <= passed""")
def stream_consume_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that come twice or late: four in five come first; in a second run the others come, and with them a
    third of the messages once more."""
    events = Tables(spark, sf_dir).events
    landing, out, ckpt = (scratch_path(spark, f"{what}-once") for what in ("landing", "sink", "ckpt"))
    for part in (F.col("event_id") % 5 != 0, (F.col("event_id") % 5 == 0) | (F.col("event_id") % 3 == 0)):
        st.land_files(events.where(part), landing)
        raw = st.read_event_stream(spark, landing, events.schema).withColumn("ts", F.col("ts").cast("timestamp"))
        rows = once.once(raw.select("event_id", "user_id", "ts", "value"), "event_id", "ts", ONCE_DELAY)
        st.run_available(rows, ckpt, f"once_{ckpt[-12:]}", "append", once.once_writer(out, "ts", ONCE_DELAY))
    schema = rows.drop("_kind").schema
    accepted, late = (once.read_part(spark, out, what, schema).withColumn("fate", F.lit(what)) for what in ("accepted", "late"))
    return accepted.unionByName(late).withColumn("ts", F.col("ts").cast("timestamp_ntz"))

"""Job status from an event stream (Structured Streaming).

Events land as files in a folder; a stream reads them with a fixed schema, a bounded number of bytes
per micro-batch, and a checkpoint folder, so a restarted query continues where it stopped. Every run
uses ``trigger(availableNow=True)``: it processes what has landed and ends.

* latest status per job: a streaming aggregate whose state holds one row per job (bounded by the number
  of jobs, not by time), written in complete mode as a double-buffered snapshot that readers never see
  half written;
* box verdict: each micro-batch's complete table of latest child statuses is turned into verdicts;
* consume: each micro-batch of matching events is written once per batch id (a replayed batch
  overwrites its own output, so the sink is exactly-once);
* alerts: failed runs become alert rows in an append-only file sink.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.predicates import STATUS_RUNNING, STATUS_SUCCESS, STATUS_TERMINATED
from lakeops.operators.runs import verdict_from_flags

DEFAULT_BYTES_PER_TRIGGER = 1 << 30
# Fixed value: the subject line of a failure alert.
ALERT_SUBJECT_PREFIX = "Job Failure: "


def land_files(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """Publish rows as parquet files into a landing folder (the producer side of a stream), with the input's own
    parallelism, or sorted by ``order`` (end it with a unique column, so that one hot time is many files)."""
    out = df.sort(*order) if order else df
    out.write.mode("append").parquet(path)


def read_event_stream(spark: SparkSession, path: str, schema: T.StructType, ts: str = "ts",
                      files_per_trigger: int | None = None, watermark: str | None = None,
                      bytes_per_trigger: int = DEFAULT_BYTES_PER_TRIGGER) -> DataFrame:
    """A stream over landed parquet files, with about ``bytes_per_trigger`` (or ``files_per_trigger`` files, if
    given) per micro-batch. With a ``watermark`` delay (e.g. "10 minutes") a zone-less ``ts`` is first read as
    a timestamp in the session zone (watermarks refuse zone-less values); without one, values stay as they are."""
    limit = ("maxBytesPerTrigger", bytes_per_trigger) if files_per_trigger is None else ("maxFilesPerTrigger", files_per_trigger)
    stream = spark.readStream.schema(schema).option(*limit).parquet(path)
    if watermark is not None:
        if isinstance(schema[ts].dataType, T.TimestampNTZType):
            stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
        stream = stream.withWatermark(ts, watermark)
    return stream


def latest_status(stream: DataFrame, key: str, ts: str, status: Column | str,
                  seq: str | None = None) -> DataFrame:
    """Latest status per key: ``max(struct(ts, -seq, status))``. The state is one row per key."""
    st = F.col(status) if isinstance(status, str) else status
    parts = [F.col(ts).alias("t")] + ([F.bitwise_not(F.col(seq)).alias("s")] if seq else []) + [st.alias("st")]
    agg = stream.groupBy(key).agg(F.max(F.struct(*parts)).alias("_l"), F.count(F.lit(1)).alias("n_events"))
    return agg.select(key, F.col("_l.t").alias("latest_ts"), F.col("_l.st").alias("latest_status"), "n_events")


def run_available(df: DataFrame, checkpoint: str, name: str, mode: str,
                  batch_fn: Callable[[DataFrame, int], None] | None = None, sink_path: str | None = None) -> None:
    """Run a stream over everything that has landed, then stop."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).queryName(name)
    if batch_fn is not None:
        writer = writer.foreachBatch(batch_fn)
    else:
        writer = writer.format("parquet").option("path", sink_path)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def write_snapshot(df: DataFrame, path: str, batch_id: int) -> None:
    """Double-buffered snapshot: batch N replaces data slot ``N % 2`` and then marker slot ``N % 2`` (which
    holds N). A reader (:func:`read_snapshot`) takes the highest batch among the two markers and reads its
    data slot: while batch N+2 rewrites slot ``N % 2``, the marker of N+1 is the highest and points to the
    other slot. A failed batch leaves the previous slot and marker whole, a replayed batch rewrites the
    same ones, and the folder never holds more than two versions."""
    slot = batch_id % 2
    df.write.mode("overwrite").parquet(f"{path}/slot={slot}")
    marker = df.sparkSession.range(1).select(F.lit(batch_id).cast("long").alias("batch_id"))
    marker.write.mode("overwrite").parquet(f"{path}/_batches/slot={slot}")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete snapshot written by :func:`write_snapshot`."""
    latest = spark.read.parquet(f"{path}/_batches").agg(F.max("batch_id")).first()[0]
    if latest is None:
        raise FileNotFoundError(f"no snapshot under {path}")
    return spark.read.parquet(f"{path}/slot={latest % 2}")


def snapshot_writer(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function keeping the latest complete-mode table as a double-buffered snapshot."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_snapshot(batch, path, batch_id)
    return write


def per_batch_writer(path: str, transform: Callable[[DataFrame], DataFrame] | None = None
                     ) -> Callable[[DataFrame, int], None]:
    """foreachBatch function writing each batch to its own ``batch_id=N`` folder (overwrite, so a
    replayed batch does not add rows twice)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def event_status_code(event_type: Column) -> Column:
    """Run status of a child job from its event: error terminated, click/view running, else success."""
    return (F.when(event_type == "error", F.lit(STATUS_TERMINATED))
            .when(event_type.isin("click", "view"), F.lit(STATUS_RUNNING))
            .otherwise(F.lit(STATUS_SUCCESS)))


def polled_verdicts(latest: DataFrame, job: str, box_of: Column, is_box: Column, status: str = "latest_status") -> DataFrame:
    """Box verdicts from the latest status of every polled job: rows with ``is_box`` are the boxes' own runs, the
    others their children. One aggregate per box; a box that was not polled itself has a null status."""
    rows = latest.select(box_of.alias("box"), is_box.alias("own"), F.col(status).alias("status"))
    child = ~F.col("own")
    flags = rows.groupBy("box").agg(
        F.max(F.when(F.col("own"), F.col("status"))).alias("box_status"),
        F.bool_or(child & (F.col("status") == STATUS_RUNNING)).alias("any_running"),
        F.bool_or(child & (F.col("status") == STATUS_TERMINATED)).alias("any_terminated"),
        F.count_if(child).alias("n_children"))
    return verdict_from_flags(flags, "box", "box_status")


def verdict_writer(path: str, job: str, box_of: Column, is_box: Column) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: the complete table of latest statuses -> box verdicts, as a snapshot."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_snapshot(polled_verdicts(batch, job, box_of, is_box), path, batch_id)
    return write


def alerts(stream: DataFrame, failed: Column, job: str, event_id: str, ts: str) -> DataFrame:
    """One alert row per failed run (sending is left to the consumer of the alert table)."""
    return stream.where(failed).select(
        F.col(event_id).alias("event_id"), F.col(job).alias("job"), F.col(ts).alias("ts"),
        F.concat(F.lit(ALERT_SUBJECT_PREFIX), F.col(job).cast("string")).alias("subject"),
        F.concat(F.lit("Job "), F.col(job).cast("string"), F.lit(" failed at event "),
                 F.col(event_id).cast("string")).alias("body"),
    )

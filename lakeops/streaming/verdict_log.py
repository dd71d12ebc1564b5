"""Box verdicts kept up to date by change: a log of differences per box, compacted now and then.

Keyed state holds the latest status of every job. A poll that changes it becomes a difference of its box: how many more
children run, how many more are terminated, how many more there are, and the box's own new status. A micro-batch adds
its differences up per box and writes these boxes only; what a batch writes follows the changes and not the number of
boxes. The verdicts are the sum over the compacted base and the batches after it. Every ``compact_every`` batches
the sum becomes the next base, and what the base before it had replaced is deleted (a reader may still be at the
last base). A batch that is run again overwrites its own folder, so a failed one changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lakeops.functions.predicates import STATUS_RUNNING, STATUS_TERMINATED
from lakeops.operators.runs import verdict_from_flags
from lakeops.session import release_paths

CHANGES = "box long, running long, terminated long, children long, own_at long, own_seq long, own_status string"


class LatestStatus(StatefulProcessor):
    """Emits what a job's new latest status changes in its box."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "at long, seq long, status string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = tuple(self.latest.get()) if self.latest.exists() else None
        box = own = None
        best = before
        for r in rows:
            box, own = r["_box"], r["_own"]
            now = (r["_at"], r["_seq"], r["_status"])
            # Of equal times the smallest sequence number is the latest, as in the batch operators.
            if best is None or (now[0], -now[1]) > (best[0], -best[1]):
                best = now
        if best != before:
            self.latest.update(best)
            old = before[2] if before else None
            if own:
                yield Row(box=box, running=0, terminated=0, children=0, own_at=best[0], own_seq=-best[1], own_status=best[2])
            elif old != best[2]:
                yield Row(box=box, running=(best[2] == STATUS_RUNNING) - (old == STATUS_RUNNING),
                          terminated=(best[2] == STATUS_TERMINATED) - (old == STATUS_TERMINATED),
                          children=int(before is None), own_at=None, own_seq=None, own_status=None)

    def close(self) -> None:
        pass


def box_changes(polls: DataFrame, job: str, ts: str, seq: str, status: Column, box_of: Column, is_box: Column) -> DataFrame:
    """A stream of differences per box (several rows of a box in one micro-batch); start it under
    :class:`lakeops.streaming.polling.state_store`."""
    rows = polls.where(F.col(job).isNotNull()).select(
        F.col(job).alias("job"), F.unix_micros(F.col(ts).cast("timestamp")).alias("_at"), F.col(seq).cast("long").alias("_seq"),
        status.alias("_status"), box_of.cast("long").alias("_box"), is_box.alias("_own"))
    return rows.groupBy("job").transformWithState(LatestStatus(), CHANGES, "update", "none")


def _summed(changes: DataFrame) -> DataFrame:
    own = F.struct("own_at", "own_seq", "own_status")
    total = changes.groupBy("box").agg(F.sum("running").alias("running"), F.sum("terminated").alias("terminated"), F.sum("children").alias("children"),
                                       F.max(F.when(F.col("own_at").isNotNull(), own)).alias("_own"))
    return total.select("box", "running", "terminated", "children", *[F.col("_own")[c].alias(c) for c in ("own_at", "own_seq", "own_status")])


def _parts(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the complete folders ``kind=N`` below ``path`` (one per batch since the last base, or per base)."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith(f"{kind}=")]
    return sorted(int(p.getName().split("=")[1]) for p in names if fs.exists(p.suffix("/_SUCCESS")))


def _current(spark: SparkSession, path: str, upto: int | None = None) -> tuple[DataFrame, int]:
    """Sum of the newest base and the batches after it, and the number of the base (-1: none)."""
    base = [n for n in _parts(spark, path, "base") if upto is None or n < upto]
    last = max(base, default=-1)
    batches = [n for n in _parts(spark, path, "batch") if n > last and (upto is None or n <= upto)]
    folders = [f"{path}/base={last}"] * (last >= 0) + [f"{path}/batch={n}" for n in batches]
    rows = spark.read.schema(CHANGES).parquet(*folders) if folders else spark.createDataFrame([], CHANGES)
    return _summed(rows), last


def change_writer(path: str, compact_every: int = 20) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that logs a batch's differences and compacts the log every ``compact_every`` batches."""
    if compact_every < 1:
        raise ValueError("compact_every must be positive")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _summed(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if batch_id % compact_every == compact_every - 1:
            total, last = _current(spark, path, batch_id)
            total.write.mode("overwrite").parquet(f"{path}/base={batch_id}")
            if last >= 0:  # superseded by the base before this one
                old = [f"{path}/batch={n}" for n in _parts(spark, path, "batch") if n <= last]
                release_paths(spark, old + [f"{path}/base={n}" for n in _parts(spark, path, "base") if n < last])
    return write


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """(box, box_status, n_children, verdict) of all boxes."""
    total, _ = _current(spark, path)
    flags = total.select("box", F.col("own_status").alias("box_status"), (F.col("running") > 0).alias("any_running"),
                         (F.col("terminated") > 0).alias("any_terminated"), F.col("children").alias("n_children"))
    return verdict_from_flags(flags, "box", "box_status")

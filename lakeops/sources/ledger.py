"""Batches of rows committed or rolled back one by one, in a folder of files with a ledger.

A run stages all rows of the batches that the ledger does not have as committed (an anti join, so a restart goes on
where the last run stopped), in files of its own. Then it reads the staged files back: count, digest and first error of
each batch. One write of ledger rows ends the run: a batch without errors becomes ``committed``, any other ``rolled
back`` as a whole, and the other batches stay. Rows are visible once their run is in the ledger, unless their batch was
rolled back; a run that dies before leaves staged files that nobody sees (:func:`discard_unfinished` deletes them).

A batch is any set of columns whose values name it; batches of a size come from a row number
(:func:`lakeops.operators.ordering.with_group_row_number`). Nothing here is one task or one file per batch, so a batch
may be 1,000 rows or a third of the table: the verdicts are one aggregate with partial sums before the shuffle.
Writers of one folder must take turns.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.sizing import broadcast_if_small
from lakeops.session import release_paths
from lakeops.sources.lake import fingerprint_aggs

COMMITTED, ROLLED_BACK = "committed", "rolled back"
_ERROR, _RUN = "_batch_error", "_batch_run"


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def _runs(spark: SparkSession, path: str, what: str) -> list[str]:
    """Runs with a complete folder below ``path/what``."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{what}")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith(f"{_RUN}=")]
    return sorted(p.getName().split("=", 1)[1] for p in found if fs.exists(p.suffix("/_SUCCESS")) or what == "staged")


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """One row per batch and run that ended: the batch columns, ``n_rows``, ``digest``, ``status``, ``error``, ``run``."""
    runs = _runs(spark, path, "ledger")
    if not runs:
        return None
    return spark.read.option("basePath", f"{path}/ledger").parquet(*[f"{path}/ledger/{_RUN}={r}" for r in runs]).withColumnRenamed(_RUN, "run")


def stage(rows: DataFrame, batch: Sequence[str], path: str, error: Column | None = None) -> str:
    """Write the rows of all batches that are not committed yet to files of a new run; returns its name."""
    if not batch or {_ERROR, _RUN} & set(rows.columns):
        raise ValueError("a batch needs columns, and none may be named like the helpers")
    spark = rows.sparkSession
    run = uuid.uuid4().hex
    todo = rows.withColumn(_ERROR, error if error is not None else F.lit(None).cast("string"))
    done = read_ledger(spark, path)
    if done is not None:
        done = broadcast_if_small(done.where(F.col("status") == COMMITTED).select(*batch).distinct())
        todo = todo.join(done, _same(todo, done, batch), "left_anti")
    seen = Observation(f"lakeops_stage_{run[:8]}")
    todo.observe(seen, *fingerprint_aggs(rows)).write.parquet(f"{path}/staged/{_RUN}={run}")
    staged = _staged(spark, path, [run])
    out = staged.agg(*fingerprint_aggs(rows)).first()
    if (out["n"], out["h"]) != (seen.get["n"], seen.get["h"]):
        raise RuntimeError(f"run {run}: staged files do not hold what was written")
    return run


def _staged(spark: SparkSession, path: str, runs: Sequence[str]) -> DataFrame:
    return spark.read.option("basePath", f"{path}/staged").parquet(*[f"{path}/staged/{_RUN}={r}" for r in runs])


def commit(spark: SparkSession, path: str, run: str, batch: Sequence[str]) -> None:
    """End a staged run: one ledger row per batch, committed if none of its rows has an error."""
    rows = _staged(spark, path, [run])
    n, h = fingerprint_aggs(rows.drop(_ERROR, _RUN))
    verdicts = rows.groupBy(*batch).agg(n.alias("n_rows"), h.alias("digest"), F.min(_ERROR).alias("error"))
    verdicts.withColumn("status", F.when(F.col("error").isNull(), F.lit(COMMITTED)).otherwise(F.lit(ROLLED_BACK))).write.parquet(f"{path}/ledger/{_RUN}={run}")


def write_in_batches(rows: DataFrame, batch: Sequence[str], path: str, error: Column | None = None) -> str:
    """Stage and commit ``rows``; ``error`` is null for a good row. Returns the run's name."""
    run = stage(rows, batch, path, error)
    commit(rows.sparkSession, path, run, batch)
    return run


def committed_rows(spark: SparkSession, path: str, batch: Sequence[str]) -> DataFrame:
    """The rows of all committed batches. Only the rolled-back batches are looked up, so rows are not shuffled
    unless these are many."""
    runs = _runs(spark, path, "ledger")
    if not runs:
        raise FileNotFoundError(f"no run has ended under {path}")
    rows = _staged(spark, path, runs)
    gone = read_ledger(spark, path).where(F.col("status") == ROLLED_BACK).select(*batch, F.col("run").alias(_RUN))
    gone = broadcast_if_small(gone)
    return rows.join(gone, _same(rows, gone, [*batch, _RUN]), "left_anti").drop(_ERROR, _RUN)


def audit(spark: SparkSession, path: str, batch: Sequence[str]) -> DataFrame:
    """Committed batches whose files no longer hold what the ledger says (none, if all is well)."""
    rows = committed_rows(spark, path, batch)
    n, h = fingerprint_aggs(rows)
    held = rows.groupBy(*batch).agg(n.alias("_n"), h.alias("_h"))
    told = read_ledger(spark, path).where(F.col("status") == COMMITTED)
    joined = told.join(held, _same(told, held, batch), "left").select(*[told[c] for c in batch], "n_rows", "digest", "_n", "_h")
    return joined.where(~(F.col("n_rows").eqNullSafe(F.col("_n")) & F.col("digest").eqNullSafe(F.col("_h")))).drop("_n", "_h")


def discard_unfinished(spark: SparkSession, path: str) -> list[str]:
    """Delete the staged files of runs that never ended; returns these runs."""
    lost = sorted(set(_runs(spark, path, "staged")) - set(_runs(spark, path, "ledger")))
    release_paths(spark, [f"{path}/staged/{_RUN}={r}" for r in lost])
    return lost

"""Job runs: latest run per job, run history, child flags, box verdict, all-of-N gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.predicates import STATUS_RUNNING, STATUS_SUCCESS, STATUS_TERMINATED
from lakeops.operators.ordering import with_group_row_number

# Verdict names.
VERDICT_FAILED = "failed"
VERDICT_OPEN = "open"
VERDICT_SUCCESS = "success"
VERDICT_NOT_SUCCESS = "not success"
START_REFUSED = "refused"
START_ALLOWED = "may start"
GATE_PASSED = "passed"
GATE_FAILED = "failed"
GATE_MISSING = "missing"


def newest_per_group(df: DataFrame, group: Sequence[str], newest: str, seq: str) -> DataFrame:
    """The newest row of every group (largest ``newest``; on a tie the smallest ``seq``, i.e. the first
    in input order). An aggregate over ``max(struct)``: partial on every mapper, so a hot group costs no
    more than a cold one. Every column is carried once in the struct."""
    group = list(group)
    rest = [c for c in df.columns if c not in group and c not in (newest, seq)]
    best = F.max(F.struct(F.col(newest).alias("_k1"), F.bitwise_not(F.col(seq)).alias("_k2"),
                          *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)])).alias("_b")
    where = {newest: F.col("_b._k1"), seq: F.bitwise_not(F.col("_b._k2"))} | {c: F.col(f"_b._r{i}") for i, c in enumerate(rest)}
    return df.groupBy(*group).agg(best).select(*group, *[where[c].alias(c) for c in df.columns if c not in group])


def latest_run(runs: DataFrame, job: str = "job_name", date: str = "run_date", status: str = "status",
               seq: str = "seq", since: Column | None = None) -> DataFrame:
    """Per job: latest date and its status, and the number of runs. ``since`` optionally limits the runs
    (a "last n days" view); by default all runs count."""
    if since is not None:
        runs = runs.where(F.col(date) >= since)
    latest = F.max(F.struct(F.col(date).alias("d"), F.bitwise_not(F.col(seq)).alias("s"), F.col(status).alias("st")))
    return (runs.groupBy(job)
            .agg(latest.alias("_l"), F.count(F.lit(1)).alias("n_runs"))
            .select(job, F.col("_l.d").alias("latest_date"), F.col("_l.st").alias("latest_status"), "n_runs"))


def run_history(runs: DataFrame, job: str = "job_name", date: str = "run_date", seq: str = "seq",
                name: str = "run_rank") -> DataFrame:
    """Every run with its place in the job's history, newest first (the nested history, flattened)."""
    return with_group_row_number(runs, [job], [F.col(date).desc(), F.col(seq).asc()], name)


def child_flags(children: DataFrame, parent: str = "parent", status: str = "status") -> DataFrame:
    s = F.col(status)
    return children.groupBy(parent).agg(
        F.bool_or(s == STATUS_RUNNING).alias("any_running"),
        F.every(s != STATUS_RUNNING).alias("none_running"),
        F.bool_or(s == STATUS_TERMINATED).alias("any_terminated"),
        F.count(F.lit(1)).alias("n_children"),
    )


def box_verdict(boxes: DataFrame, children: DataFrame, box: str = "box", box_status: str = "box_status",
                parent: str = "parent", status: str = "status") -> DataFrame:
    """A box fails when any child terminated, is open while any child runs, and otherwise succeeds when
    its own status is success. A box without children is decided by its own status."""
    flags = child_flags(children, parent, status)
    joined = boxes.join(flags, boxes[box] == flags[parent], "left").drop(parent)
    return verdict_from_flags(joined, box, box_status)


def verdict_from_flags(flags: DataFrame, box: str, box_status: str) -> DataFrame:
    """Verdict rows from per-box child flags (missing flags: a box without children)."""
    verdict = (F.when(F.coalesce(F.col("any_terminated"), F.lit(False)), F.lit(VERDICT_FAILED))
               .when(F.coalesce(F.col("any_running"), F.lit(False)), F.lit(VERDICT_OPEN))
               .when(F.col(box_status) == STATUS_SUCCESS, F.lit(VERDICT_SUCCESS))
               .otherwise(F.lit(VERDICT_NOT_SUCCESS)))
    return flags.select(box, box_status, F.coalesce(F.col("n_children"), F.lit(0)).alias("n_children"),
                        verdict.alias("verdict"))


def start_check(boxes: DataFrame, children: DataFrame, box: str = "box", box_status: str = "box_status",
                parent: str = "parent", status: str = "status") -> DataFrame:
    """Which boxes may start: a box is refused while it, or any child, is running."""
    flags = child_flags(children, parent, status).select(F.col(parent).alias("_p"), "any_running")
    busy = (F.col(box_status) == STATUS_RUNNING) | F.coalesce("any_running", F.lit(False))
    return (boxes.join(flags, F.col(box) == F.col("_p"), "left")
            .select(box, box_status, F.when(busy, F.lit(START_REFUSED)).otherwise(F.lit(START_ALLOWED)).alias("decision")))


def all_of_n_gate(children: DataFrame, parent: str, ok: Column, failed: Column, n: int) -> DataFrame:
    """All of ``n`` workers must succeed: any failure fails the gate, fewer than ``n`` successes is
    missing, ``n`` or more successes passes."""
    if isinstance(n, bool) or not isinstance(n, int) or n < 1:
        raise ValueError("n must be a positive integer")
    agg = children.groupBy(parent).agg(F.count_if(ok).alias("n_ok"), F.bool_or(failed).alias("any_failed"))
    verdict = (F.when(F.col("any_failed"), F.lit(GATE_FAILED))
               .when(F.col("n_ok") >= F.lit(n), F.lit(GATE_PASSED))
               .otherwise(F.lit(GATE_MISSING)))
    return agg.select(parent, "n_ok", verdict.alias("gate"))

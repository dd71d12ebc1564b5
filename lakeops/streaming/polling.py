"""Polling with a limit: one row for every run that ended, and one for every run that was polled too long.

A poll is an event (job, time, sequence, status). A run begins with the first poll that finds its job running and ends
with the first later poll that does not. A run that is still running when ``limit`` has passed is reported as stuck at
that moment, once; the poller has then given up, and the polls that follow belong to no run until the job has been
seen in another state.

The state of a job is kept in the state store: the polls that the watermark has not passed yet, and its open run. Polls
are only looked at once the watermark has passed them, in the order of (time, sequence), so the rows do not depend on
how polls were spread over files and micro-batches, as long as none comes later than the watermark's delay. Event-time
timers wake a job for its next waiting poll and for the end of its limit, so a job that falls silent is reported too.

A job's polls of one micro-batch meet in one task, as in any keyed state; ``bytes_per_trigger`` of the stream bounds
them, also for a job with a third of all polls, and its waiting polls are those of one delay.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lakeops.functions.predicates import STATUS_RUNNING

FINISHED, STUCK = "finished", "stuck"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RESULT = "job {key}, run_start timestamp, run_end timestamp, outcome string, end_status string, n_polls long"
_MS = 1000


class RunWatch(StatefulProcessor):
    """Times are microseconds since the epoch."""

    def __init__(self, limit_us: int):
        self.limit = limit_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, seq long, status string")
        self.run = handle.getValueState("run", "start long, polls long, stuck boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        self.waiting.appendList([(r["_at"], r["_seq"], r["_status"]) for r in rows])
        yield from self._advance(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key, timerValues)

    def close(self) -> None:
        pass

    def _advance(self, key, timer_values) -> Iterator[Row]:
        """Everything that the watermark has passed, and the next timer."""
        passed = timer_values.getCurrentWatermarkInMs() * _MS
        polls = sorted(self.waiting.get(), key=lambda p: (p[0], p[1]))
        later = [p for p in polls if p[0] > passed]
        run = tuple(self.run.get()) if self.run.exists() else None
        for at, _, status in polls[:len(polls) - len(later)]:
            if run is not None and not run[2] and at > run[0] + self.limit:
                yield self._row(key, run, run[0] + self.limit, STUCK, None)
                run = (run[0], run[1], True)
            if status == STATUS_RUNNING:
                run = (at, 1, False) if run is None else (run[0], run[1] + (not run[2]), run[2])
            elif run is not None:
                if not run[2]:
                    yield self._row(key, run, at, FINISHED, status)
                run = None
        if run is not None and not run[2] and passed >= run[0] + self.limit:
            yield self._row(key, run, run[0] + self.limit, STUCK, None)
            run = (run[0], run[1], True)

        if later:
            self.waiting.put(later)
        elif polls:
            self.waiting.clear()
        if run is not None:
            self.run.update(run)
        elif self.run.exists():
            self.run.clear()
        wake = [p[0] for p in later[:1]] + ([run[0] + self.limit] if run is not None and not run[2] else [])
        if wake:
            self.handle.registerTimer(-(-min(wake) // _MS))

    def _row(self, key, run, end: int, outcome: str, status) -> Row:
        return Row(job=key[0], run_start=run[0], run_end=end, outcome=outcome, end_status=status, n_polls=run[1])


def watch_runs(polls: DataFrame, job: str, ts: str, seq: str, status: Column | str, limit_seconds: int) -> DataFrame:
    """(job, run_start, run_end, outcome, end_status, n_polls) of every run that ended or is stuck; ``polls`` is a stream
    with a watermark on ``ts``. ``n_polls`` counts the polls that found it running, up to its end or limit. Start the
    query under :func:`state_store`."""
    if not isinstance(limit_seconds, int) or limit_seconds < 1:
        raise ValueError(f"limit_seconds must be a positive integer, got {limit_seconds!r}")
    st = F.col(status) if isinstance(status, str) else status
    rows = polls.where(F.col(job).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(job).alias("job"), F.col(ts), F.unix_micros(ts).alias("_at"), F.col(seq).cast("long").alias("_seq"), st.alias("_status"))
    kind = rows.schema["job"].dataType.simpleString()
    times = RESULT.format(key=kind).replace("timestamp", "long")
    out = rows.groupBy("job").transformWithState(RunWatch(limit_seconds * 1_000_000), times, "append", "eventTime")
    return out.withColumns({c: F.timestamp_micros(c) for c in ("run_start", "run_end")})


class state_store:
    """The state store that keyed state with timers needs, for the streaming queries started inside."""

    def __init__(self, spark):
        self.conf = spark.conf

    def __enter__(self):
        self.before = self.conf.get(STATE_STORE)
        self.conf.set(STATE_STORE, ROCKSDB)

    def __exit__(self, *error):
        self.conf.set(STATE_STORE, self.before)

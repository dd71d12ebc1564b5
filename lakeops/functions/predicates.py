"""Row predicates and classifications. All are Column expressions, so Catalyst can push the simple ones
into the scan and keep the rest inside generated code."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Status codes of a job run, and the look-back of the key-driven job.
STATUS_RUNNING = "1"
STATUS_SUCCESS = "4"
STATUS_TERMINATED = "6"
LOOKBACK_DAYS = int(1.5 * 365)  # 547


def _ts_literal(value: str | dt.date | dt.datetime, like: str) -> Column:
    text = value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else str(value)
    return F.lit(text).cast(like)


def date_window(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Half-open range ``start <= column < end`` on the raw column, typed like the column so the
    comparison reaches the parquet reader as a pushed filter."""
    dtype = df.schema[column].dataType.simpleString()
    out = df
    if start is not None:
        out = out.where(F.col(column) >= _ts_literal(start, dtype))
    if end is not None:
        out = out.where(F.col(column) < _ts_literal(end, dtype))
    return out


def lookback_window(df: DataFrame, column: str, end, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows in the ``days`` before ``end`` (half-open, end excluded)."""
    end_date = dt.date.fromisoformat(str(end)) if not isinstance(end, dt.date) else end
    return date_window(df, column, end_date - dt.timedelta(days=days), end_date)


def key_equals(values: dict[str, object]) -> Column:
    """Composite key equality ``a = ? AND b = ?``."""
    return reduce(lambda x, y: x & y, [F.col(k) == F.lit(v) for k, v in values.items()])


def ci_contains(column: str | Column, search: str) -> Column:
    """Case-insensitive substring test; ``%`` and ``_`` are plain characters; an empty search keeps all."""
    c = F.col(column) if isinstance(column, str) else column
    if search == "":
        return F.lit(True)
    return F.contains(F.lower(c), F.lit(search.lower()))


def ci_equals(column: str | Column, value: str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.lower(c) == F.lit(value.lower())


def status_class(code: str | Column) -> Column:
    """Name of a run status code: running, success, terminated, or other."""
    c = F.col(code) if isinstance(code, str) else code
    return (F.when(c == STATUS_RUNNING, F.lit("running"))
            .when(c == STATUS_SUCCESS, F.lit("success"))
            .when(c == STATUS_TERMINATED, F.lit("terminated"))
            .otherwise(F.lit("other")))


def retryable(code: str | Column, message: str | Column, wanted_code: int = 503,
              words: Sequence[str] = ("503", "unavailable")) -> Column:
    """A retryable failure: when a code is present it alone decides (``code == wanted``); otherwise the
    lower-cased message must contain one of ``words``."""
    c = F.col(code) if isinstance(code, str) else code
    m = F.lower(F.col(message) if isinstance(message, str) else message)
    by_words = reduce(lambda a, b: a | b, [F.contains(m, F.lit(w.lower())) for w in words])
    return F.when(c.isNotNull(), c == F.lit(wanted_code)).otherwise(F.coalesce(by_words, F.lit(False)))

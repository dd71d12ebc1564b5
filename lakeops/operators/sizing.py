"""Measured sizes, so that a side is only broadcast when its size is known to be small."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes per value of fixed-width types in Spark's row format; variable-width values are measured.
_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
}

_MIN_ROW_BYTES = 16  # a row without columns, as row_bytes counts it
DEFAULT_BROADCAST_LIMIT = 10 * 1024 * 1024  # Spark's own default threshold


def _value_bytes(c: Column, dtype: T.DataType) -> Column:
    for kind, width in _FIXED_WIDTH.items():
        if isinstance(dtype, kind):
            return F.lit(width + 8)
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(16)
    if isinstance(dtype, T.DecimalType):
        return F.lit(24)
    # Nested values: measured through their JSON text, an upper bound of the binary size.
    return F.coalesce(F.octet_length(F.to_json(F.struct(c.alias("v")))), F.lit(0)) + F.lit(16)


def row_bytes(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Size of one row of ``df`` (of ``columns`` only, when given) in Spark's row format."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    total = F.lit(16)
    for f in fields:
        total = total + _value_bytes(F.col(f"`{f.name}`"), f.dataType)
    return total.cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Exact in-memory payload size of ``df`` (one aggregate pass, no rows to the driver)."""
    row = df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()
    return int(row["b"])


_UNITS = {"": 1, "b": 1, "k": 1024, "kb": 1024, "m": 1024 ** 2, "mb": 1024 ** 2, "g": 1024 ** 3, "gb": 1024 ** 3}


def parse_bytes(text: str) -> int:
    """Spark size text ("10485760", "10m", "64MB", "-1") to bytes."""
    m = re.fullmatch(r"(-?\d+(?:\.\d+)?)\s*([kmg]?b?)", text.strip().lower())
    if m is None:
        raise ValueError(f"not a size: {text!r}")
    return int(float(m.group(1)) * _UNITS[m.group(2)])


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes (0 when broadcasts are switched off with -1)."""
    conf = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    value = DEFAULT_BROADCAST_LIMIT if conf is None else parse_bytes(str(conf))
    return max(value, 0)


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """True when the measured size of ``df`` is within ``limit``. Only a sum leaves the executors; counting
    stops early, by a row limit, when even the smallest rows would exceed it."""
    limit = broadcast_limit(df) if limit is None else limit
    if limit <= 0:
        return False
    most = limit // _MIN_ROW_BYTES + 1
    return measured_bytes(df.limit(most)) <= limit if most < 2**31 else measured_bytes(df) <= limit


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Return ``broadcast(df)`` when its measured size is within ``limit``; otherwise ``df`` unchanged,
    so the planner shuffles both sides (and AQE may still switch at run time)."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df

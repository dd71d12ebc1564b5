"""Counts, sums and run totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SUCCESS = "Success"
NO_DATA = "No data"
ERROR_PREFIX = "Error"


def check_positive_int(label: str, value) -> int:
    """Refuse anything but a positive integer before a plan is built."""
    if isinstance(value, bool) or not isinstance(value, int) or value < 1:
        raise ValueError(f"{label} must be a positive integer, got {value!r}")
    return value


def number_range(spark: SparkSession, n: int, name: str = "number", partitions: int | None = None) -> DataFrame:
    """Numbers ``0 .. n-1`` in one column (``spark.range`` renamed by position)."""
    if n < 0:
        raise ValueError("n must not be negative")
    return spark.range(0, n, 1, partitions).toDF(name)


def column_sum(df: DataFrame, column: str, name: str = "total") -> DataFrame:
    return df.agg(F.sum(column).alias(name))


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def hit_ratio(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Share of points inside the unit quarter circle, times four (an estimate of pi)."""
    inside = F.col(x) * F.col(x) + F.col(y) * F.col(y) <= F.lit(1.0)
    agg = points.agg(F.count_if(inside).alias("hits"), F.count(F.lit(1)).alias("total"))
    return agg.withColumn("estimate", F.lit(4.0) * F.col("hits").cast("double") / F.col("total").cast("double"))


def even_split(total: Column, parts: int) -> Column:
    """An array of ``parts`` sizes summing to ``total``; the remainder goes to the first parts."""
    check_positive_int("parts", parts)
    return F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)),
        lambda i: F.floor(total / F.lit(parts)).cast("long")
        + F.when(i.cast("long") < total % F.lit(parts), F.lit(1)).otherwise(F.lit(0)),
    )


def status_totals(df: DataFrame, group: Sequence[str], status: str = "status", extra: Sequence[Column] = ()
                  ) -> DataFrame:
    """Per group: ids, processed (status Success), no data, and errors (status starting with Error), plus
    any ``extra`` aggregates, all in one aggregation."""
    s = F.col(status)
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total_ids"),
        F.count_if(s == F.lit(SUCCESS)).alias("processed_records"),
        F.count_if(s == F.lit(NO_DATA)).alias("no_data"),
        F.count_if(s.startswith(ERROR_PREFIX)).alias("errors"),
        *extra,
    )


def overall_totals(daily: DataFrame, date_col: str) -> DataFrame:
    """Totals over the per-date totals: one row."""
    return daily.agg(
        F.count(F.col(date_col)).alias("n_dates"),
        F.sum("total_ids").alias("total_ids"),
        F.sum("processed_records").alias("processed_records"),
        F.sum("no_data").alias("no_data"),
        F.sum("errors").alias("errors"),
    )


def measure_summary(df: DataFrame, measure: str, group: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Count, mean, max, min and sum of a measure; an empty input gives nulls, not an error."""
    m = F.col(measure)
    aggs = [
        F.count(m).alias("n"),
        F.round(F.avg(m), digits).alias("avg_value"),
        F.max(m).alias("max_value"),
        F.min(m).alias("min_value"),
        F.round(F.sum(m), digits).alias("sum_value"),
    ]
    return df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)

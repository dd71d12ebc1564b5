"""Relational databases over JDBC.

Reads are split into ``num_partitions`` range queries on a numeric or date column, so executors read in
parallel instead of one task pulling the whole table; filters and column lists given as DataFrame
operations are pushed into the SQL sent to the database. Writes go in batches, one transaction per
partition. No database runs on this machine, so these functions are exercised only against a database
the caller names.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_BATCH_SIZE = 1000
DEFAULT_FETCH_SIZE = 10000


def jdbc_read_options(url: str, table: str | None = None, query: str | None = None,
                      partition_column: str | None = None, lower_bound=None, upper_bound=None,
                      num_partitions: int | None = None, fetch_size: int = DEFAULT_FETCH_SIZE,
                      properties: dict[str, str] | None = None) -> dict[str, str]:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    bounds = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(b is not None for b in bounds):
        if any(b is None for b in bounds):
            raise ValueError("a partitioned read needs column, lower and upper bound and partition count")
        if query is not None:
            raise ValueError("a partitioned read needs a table, not a query")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound), upperBound=str(upper_bound),
                    numPartitions=str(num_partitions))
    return opts


def read_table(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """A table, read in parallel ranges when partition arguments are given."""
    return spark.read.format("jdbc").options(**jdbc_read_options(url, table=table, **kwargs)).load()


def read_query(spark: SparkSession, url: str, query: str, **kwargs) -> DataFrame:
    """The result of a SQL query run by the database (e.g. a warehouse view with its own LIMIT)."""
    return spark.read.format("jdbc").options(**jdbc_read_options(url, query=query, **kwargs)).load()


def date_range_predicates(column: str, start: dt.date, end: dt.date, parts: int) -> list[str]:
    """``parts`` half-open date ranges tiling ``[start, end)``, as SQL predicates for a parallel read:
    each becomes one task's query, and together they read every row in the range exactly once."""
    if parts < 1 or end <= start:
        raise ValueError("need parts >= 1 and end after start")
    days = (end - start).days
    cuts = sorted({start + dt.timedelta(days=days * i // parts) for i in range(parts)} | {end})
    return [f"{column} >= DATE '{a.isoformat()}' AND {column} < DATE '{b.isoformat()}'"
            for a, b in zip(cuts, cuts[1:])]


def read_date_ranges(spark: SparkSession, url: str, table: str, column: str, start: dt.date, end: dt.date,
                     parts: int, properties: dict[str, str] | None = None) -> DataFrame:
    """The rows of ``table`` with ``start <= column < end``, read by ``parts`` parallel range queries."""
    props = {"fetchsize": str(DEFAULT_FETCH_SIZE), **(properties or {})}
    return spark.read.jdbc(url, table, predicates=date_range_predicates(column, start, end, parts), properties=props)


def range_scan(df: DataFrame, column: str, start, end, order: Sequence[str] = ()) -> DataFrame:
    """Half-open ``start <= column < end``; on a JDBC DataFrame the predicate reaches the database."""
    out = df.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end)))
    return out.orderBy(*order) if order else out


def jdbc_write_options(url: str, table: str, batch_size: int = DEFAULT_BATCH_SIZE,
                       isolation_level: str = "READ_COMMITTED",
                       properties: dict[str, str] | None = None) -> dict[str, str]:
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), "isolationLevel": isolation_level,
            **(properties or {})}


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", num_partitions: int | None = None,
                **kwargs) -> None:
    """Batched insert; each partition commits as one transaction, so a failed task rolls back its rows
    and is retried whole. ``num_partitions`` caps the number of concurrent connections."""
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.format("jdbc").mode(mode).options(**jdbc_write_options(url, table, **kwargs)).save()

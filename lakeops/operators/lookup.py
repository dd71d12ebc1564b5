"""Key-driven lookups: one join instead of a query per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.sizing import broadcast_if_small

NO_DATA = "No data"
FOUND = "Found"


def first_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The first row of every key in a stated order (default: all columns, which is total when rows are
    distinct). Written as ``min(struct(order..., rest...))`` grouped by key: an aggregate with a map-side
    partial step (sort based, as the buffer is a struct), so a key holding a third of the rows is reduced
    on every mapper before the shuffle and no task holds a whole group."""
    keys = list(keys)
    # Key columns are constant inside a group, so they are left out of the comparison; every other
    # column is carried once, as an order field or after them.
    order = [c for c in (order if order is not None else df.columns) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = [F.col(c).alias(f"o{i}") for i, c in enumerate(order)] + [F.col(c).alias(f"r{i}") for i, c in enumerate(rest)]
    first = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_first"))
    where = {c: f"_first.o{i}" for i, c in enumerate(order)} | {c: f"_first.r{i}" for i, c in enumerate(rest)}
    return first.select(*keys, *[F.col(where[c]).alias(c) for c in df.columns if c not in keys])


def key_payload_join(
    keys: DataFrame,
    payload: DataFrame,
    key_cols: Sequence[str],
    payload_key_cols: Sequence[str],
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Every key with the first payload row found for it, or nulls and status ``No data``."""
    first = first_row_per_key(payload, payload_key_cols, order).withColumn("_found", F.lit(True))
    cond = [keys[k] == first[p] for k, p in zip(key_cols, payload_key_cols)]
    joined = keys.join(first, cond, "left")
    status = F.when(F.col("_found").isNull(), F.lit(NO_DATA)).otherwise(F.lit(FOUND))
    return joined.withColumn("lookup_status", status).drop(*payload_key_cols, "_found")


def split_payload_join(keys, payload, key_cols: Sequence[str], payload_key_cols: Sequence[str],
                       order: Sequence[str] | None = None) -> DataFrame:
    """:func:`key_payload_join` of two tables that are stored split at the same hot keys
    (:class:`lakeops.sources.lake.SplitTable`). The rest is joined bucket by bucket, without an exchange. Of the hot keys
    (a few hundred at most) the payload's first rows are reduced on every mapper, and that small table is broadcast to
    the hot key rows, wherever they lie."""
    if keys.hashes != payload.hashes:
        raise ValueError("both tables must be split at the same hot keys")
    rest = key_payload_join(keys.rest, payload.rest, key_cols, payload_key_cols, order)
    if not keys.hashes:
        return rest
    first = broadcast_if_small(first_row_per_key(payload.hot, payload_key_cols, order).withColumn("_found", F.lit(True)))
    joined = keys.hot.join(first, [keys.hot[k] == first[p] for k, p in zip(key_cols, payload_key_cols)], "left")
    status = F.when(F.col("_found").isNull(), F.lit(NO_DATA)).otherwise(F.lit(FOUND))
    return rest.unionByName(joined.withColumn("lookup_status", status).drop(*payload_key_cols, "_found"))


def keys_without_payload(keys: DataFrame, payload: DataFrame, key_cols: Sequence[str],
                         payload_key_cols: Sequence[str]) -> DataFrame:
    """Keys that no payload row has. The payload's keys are made distinct first (reduced on every mapper), so a
    key that a third of the payload has is one row in the join."""
    right = payload.select(*payload_key_cols).distinct()
    cond = [keys[k] == right[p] for k, p in zip(key_cols, payload_key_cols)]
    return keys.join(right, cond, "left_anti")


def lookup_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column, how: str = "inner",
                limit: int | None = None) -> DataFrame:
    """Join a fact table to a lookup table, broadcasting the lookup side only when its measured size is
    within ``limit``; a larger side falls back to a shuffle join."""
    return fact.join(broadcast_if_small(dim, limit), on, how)


def members_of(df: DataFrame, batch: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``batch`` (a semi join on the batch's distinct keys)."""
    return df.join(batch.select(*on).distinct(), list(on), "left_semi")

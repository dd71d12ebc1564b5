"""The key-driven vector job: for every key, the first payload row; its vector columns checked for
length, the first ``n_added`` added and the rest subtracted element-wise; the sum and max of the result;
a status per key ("No data", "Error: ...", "Success"); and totals per date.

One join replaces a query per key, and every step is a column expression, so the job is one DAG: a partial
aggregate and a shuffle for the first payload row, the vectors of each of these parsed and summed once, one join of
the small results to the keys, one aggregate for the totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.vectors import OK, length_status, signed_sum, vector_max, vector_sum
from lakeops.operators.lookup import NO_DATA, first_row_per_key
from lakeops.operators.totals import SUCCESS, check_positive_int, overall_totals, status_totals


def vector_results(keys: DataFrame, payload: DataFrame, key_cols: Sequence[str], payload_key_cols: Sequence[str],
                   vectors: Sequence[Column], n: int, n_added: int, order: Sequence[str] | None = None) -> DataFrame:
    """Per key (all columns of ``keys`` kept): ``status``, ``result_sum`` and ``result_max``.

    ``vectors`` are array expressions over payload columns (for stored text or bytes, see
    :func:`lakeops.functions.vectors.vector_parser`); each must have ``n`` elements, the first wrong
    one gives the key's error status. ``order`` states which payload row is first. Without it the first
    row is fixed but arbitrary: rows are compared by a 64-bit hash first, so wide payloads (blobs) are
    only compared when two hashes tie."""
    check_positive_int("n", n)
    if not 1 <= n_added <= len(vectors):
        raise ValueError("n_added must be between 1 and the number of vectors")
    if order is None:
        rest = [c for c in payload.columns if c not in payload_key_cols]
        payload = payload.withColumn("_row_hash", F.xxhash64(*[F.col(f"`{c}`") for c in rest]))
        order = ["_row_hash", *rest]
    first = first_row_per_key(payload, payload_key_cols, order)
    # Everything a payload row yields is worked out once per row, before the join: parsed vectors in columns of their
    # own (each is used several times, so the optimizer keeps them apart), then three small columns per payload key.
    parsed = first.select(*payload_key_cols, *[v.alias(f"_v{i}") for i, v in enumerate(vectors)])
    columns = [F.col(f"_v{i}") for i in range(len(vectors))]
    checks = [length_status(v, n, F.lit(f"column {i + 1}")) for i, v in enumerate(columns)]
    checked = parsed.withColumn("_error", F.coalesce(*[F.when(c != OK, c) for c in checks]))
    sound = checked.withColumn("_result", F.when(F.col("_error").isNull(), signed_sum(columns, n_added)))
    result = sound.select(*payload_key_cols, "_error", vector_sum("_result").alias("result_sum"), vector_max("_result").alias("result_max"))
    found = keys.join(result.withColumn("_found", F.lit(True)), [keys[k] == result[p] for k, p in zip(key_cols, payload_key_cols)], "left")
    status = (F.when(F.col("_found").isNull(), F.lit(NO_DATA))
              .when(F.col("_error").isNotNull(), F.col("_error"))
              .otherwise(F.lit(SUCCESS)))
    return found.select(*[keys[c] for c in keys.columns], status.alias("status"), "result_sum", "result_max")


def vector_totals(results: DataFrame, date_col: str, digits: int | None = None) -> DataFrame:
    """Per date: ids, processed, no data, errors, and the total and max of the key results."""
    total = F.sum("result_sum")
    return status_totals(results, [date_col], extra=[
        (F.round(total, digits) if digits is not None else total).alias("result_total"),
        F.max("result_max").alias("result_max")])


def run_totals(daily: DataFrame, date_col: str) -> DataFrame:
    """Totals over the dates (one row)."""
    return overall_totals(daily, date_col)

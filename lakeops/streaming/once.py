"""Consuming each message once although it may come twice or late.

The watermark follows the event times; messages with an id that was accepted within the watermark's delay are dropped
by the state store (``dropDuplicatesWithinWatermark``), and so are messages behind the watermark. One streaming query
carries the accepted messages and, beside them, everything that came in, so that each micro-batch can tell what became
of each message: the accepted ones go to the table, those behind the watermark to a side table, and a report counts
seen, accepted, late and repeated messages per batch. All three are written per batch id with overwrite, so that a batch
that runs again leaves the same rows. The watermark of a batch is kept with its report, so that late is the same rule
(at or before the largest time of earlier batches less the delay) in the side table as in the state store.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ACCEPTED, SEEN = "accepted", "seen"
REPORT = "batch_id long, n_seen long, n_accepted long, n_late long, n_repeated long, watermark_ms long, last_ms long"


def once(raw: DataFrame, event_id: str, ts: str, delay_seconds: int) -> DataFrame:
    """The rows of the stream ``raw`` twice: accepted ones, and all that were seen (column ``_kind``)."""
    accepted = raw.withWatermark(ts, f"{delay_seconds} seconds").dropDuplicatesWithinWatermark([event_id])
    return accepted.withColumn("_kind", F.lit(ACCEPTED)).unionByName(raw.withColumn("_kind", F.lit(SEEN)))


def _folder(path: str, what: str, batch_id: int) -> str:
    return f"{path}/{what}/batch_id={batch_id}"


def read_part(spark: SparkSession, path: str, what: str, schema) -> DataFrame:
    """``accepted``, ``late`` or ``report`` of all batches so far."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path}/{what}")


def once_writer(path: str, ts: str, delay_seconds: int) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for :func:`once`."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.createDataFrame([], REPORT).write.mode("ignore").parquet(f"{path}/report/empty")
        before = read_part(spark, path, "report", REPORT).where(F.col("batch_id") < batch_id).agg(F.max("last_ms")).first()[0]
        watermark = max(0, before - 1000 * delay_seconds) if before is not None else 0
        rows = batch.persist()  # two writes and a count; a lost executor's part is computed again
        ms = F.floor(F.unix_micros(ts) / 1000)
        try:
            seen = rows.where(F.col("_kind") == SEEN)
            late = seen.where(ms <= watermark) if watermark else seen.limit(0)
            rows.where(F.col("_kind") == ACCEPTED).drop("_kind").write.mode("overwrite").parquet(_folder(path, "accepted", batch_id))
            late.drop("_kind").write.mode("overwrite").parquet(_folder(path, "late", batch_id))
            is_late = F.lit(False) if not watermark else ms <= watermark
            count = lambda c: F.count_if(c)
            counts = rows.agg(count(F.col("_kind") == SEEN).alias("n_seen"), count(F.col("_kind") == ACCEPTED).alias("n_accepted"),
                              count((F.col("_kind") == SEEN) & is_late).alias("n_late"), F.max(ms).cast("long").alias("_last"))
            counts.select(F.lit(batch_id).cast("long").alias("batch_id"), "n_seen", "n_accepted", "n_late",
                          (F.col("n_seen") - F.col("n_accepted") - F.col("n_late")).alias("n_repeated"), F.lit(watermark).cast("long").alias("watermark_ms"),
                          F.greatest(F.col("_last"), F.lit(before).cast("long")).alias("last_ms")
                          ).write.mode("overwrite").parquet(_folder(path, "report", batch_id))
        finally:
            rows.unpersist()
    return write

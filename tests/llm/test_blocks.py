import pyarrow as pa
import pytest

from lakeops.llm import blocks, hmm, langid, repeats
from lakeops.session import _SCRATCH


def _batch_bytes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["nbytes"])


def test_steps_send_small_batches(spark):
    """Rows of 1 MB reach Python a few at a time while a step is stored; the session keeps its own settings."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
    try:
        store = blocks.Store(spark)
        rows = spark.range(24, numPartitions=1).selectExpr("id", "cast(repeat(chr(97 + id), 1000000) as binary) as payload")
        sizes = [r.nbytes for r in store.keep(rows.mapInArrow(_batch_bytes, "nbytes long")).collect()]
        assert sum(sizes) >= 24_000_000 and max(sizes) <= 6_000_000
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "64m"
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


@pytest.mark.parametrize("job,steps", [
    (lambda df: repeats.remove_repeats(df, 50), 2), (lambda df: hmm.score(df, langid.fold(folds=10) > 0, langid.fold(folds=10) == 0, states=2, rounds=2), 2)])
def test_only_what_the_result_reads_stays_stored(spark, hostile, job, steps):
    """Blocks and messages of earlier steps are deleted, not kept until the driver collects garbage."""
    before = set(_SCRATCH)
    out = job(hostile.select("doc_id", "text"))
    assert len(set(_SCRATCH) - before) == steps
    assert out.count() == hostile.count()

"""Lake tables: namespaces, partitioned tables, appends, read-back checks and file inventories.

The session catalog is used here (no table-format jar on this machine). With a v2 catalog configured
(see ``lakeops.session.lake_catalog_settings``) the same calls use ``writeTo`` instead of
``insertInto``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.sizing import measured_bytes
from lakeops.session import ensure_checkpoint_dir


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> DataFrame:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{loc}")
    return spark.sql("SHOW NAMESPACES")


def create_table(spark: SparkSession, table: str, columns_ddl: str, partition_by: Sequence[str] = (),
                 location: str | None = None, using: str = "parquet") -> None:
    """``CREATE TABLE IF NOT EXISTS`` with a fixed schema and an optional identity partition."""
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns_ddl}) USING {using}{parts}{loc}")


def _is_v2(spark: SparkSession, table: str) -> bool:
    catalog = table.split(".")[0]
    return spark.conf.get(f"spark.sql.catalog.{catalog}", None) is not None


def append(df: DataFrame, table: str) -> None:
    """Append rows (not idempotent: a rerun adds them again; see :func:`overwrite_partitions`)."""
    spark = df.sparkSession
    if _is_v2(spark, table):
        df.writeTo(table).append()
    else:
        target = spark.table(table).columns
        df.select(*target).write.insertInto(table)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace only the partitions present in ``df`` (idempotent rerun)."""
    spark = df.sparkSession
    if _is_v2(spark, table):
        df.writeTo(table).overwritePartitions()
        return
    # The writer's own option, so that no session setting changes; the catalog then learns of new partitions.
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    (df.select(*spark.table(table).columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .format(about["Provider"]).partitionBy(*partitions).save(about["Location"]))
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)


def fingerprint_aggs(df: DataFrame) -> list:
    """Row count and an order-free multiset digest (sum of 64-bit row hashes, in a decimal that cannot
    overflow)."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)")).alias("h")]


def _fingerprint(df: DataFrame) -> DataFrame:
    """The fingerprint in one aggregate pass; nothing but two numbers leaves the executors."""
    return df.agg(*fingerprint_aggs(df))


def readback_check(source: DataFrame, written: DataFrame) -> DataFrame:
    """Compare what was meant to be written with what reads back: counts in and out and whether the
    row multisets agree."""
    a = _fingerprint(source).withColumn("side", F.lit("in"))
    b = _fingerprint(written.select(*source.columns)).withColumn("side", F.lit("out"))
    side_in, side_out = F.col("side") == "in", F.col("side") == "out"
    both = a.unionByName(b).agg(
        F.sum(F.when(side_in, F.col("n"))).alias("rows_in"), F.sum(F.when(side_out, F.col("n"))).alias("rows_out"),
        F.sum(F.when(side_in, F.col("h"))).alias("_h_in"), F.sum(F.when(side_out, F.col("h"))).alias("_h_out"))
    return both.select("rows_in", "rows_out",
                       ((F.col("rows_in") == F.col("rows_out")) & (F.col("_h_in") == F.col("_h_out"))).alias("matches"))


def columns_ddl(df: DataFrame, exclude: Sequence[str] = ()) -> str:
    """``name type, ...`` for a CREATE TABLE from a DataFrame's schema."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in exclude)


def table_files(spark: SparkSession, table: str) -> DataFrame:
    """(file_path, length) of a table's data files, from the folder listing (a v2 catalog: its ``files`` table, not
    tested here); no file is opened."""
    if _is_v2(spark, table):
        return spark.table(f"{table}.files").select("file_path", F.col("file_size_in_bytes").alias("length"))
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(about["Location"])
    return listing.select(F.col("path").alias("file_path"), "length")


def files_added(spark: SparkSession, table: str, before: DataFrame | None) -> list[str]:
    """Paths of the table's files that the listing ``before`` (stored before the write) does not have. The list
    is as long as one write has tasks and partitions, not as the table."""
    now = table_files(spark, table).select("file_path")
    return [r.file_path for r in (now if before is None else now.join(before.select("file_path"), "file_path", "left_anti")).collect()]


def read_files(spark: SparkSession, table: str, paths: Sequence[str]) -> DataFrame:
    """The rows of some of a table's files, with the table's columns."""
    held = spark.table(table)
    if not paths:
        return held.limit(0)
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    reader = spark.read.format("parquet" if _is_v2(spark, table) else about["Provider"]).schema(held.schema)
    return (reader if _is_v2(spark, table) else reader.option("basePath", about["Location"])).load(list(paths)).select(*held.columns)


def append_files(df: DataFrame, table: str) -> list[str]:
    """Append ``df`` and return the paths of the files that this added (writers of one table must take turns)."""
    ensure_checkpoint_dir(df.sparkSession)
    before = table_files(df.sparkSession, table).checkpoint()
    append(df, table)
    return files_added(df.sparkSession, table, before)


def copy_to_lake(source: DataFrame, table: str, location: str | None = None, partition_by: Sequence[str] = (),
                 replace_partitions: bool = False, namespace_location: str | None = None,
                 using: str = "parquet") -> DataFrame:
    """Relational table to lake table: create the namespace and the table (from the source schema, with
    an optional identity partition) if missing, write the rows, and return the read-back check.

    The source is read once: its count and digest are observed while the rows are written, and only the files
    that the write added (the table's listing after it, less the one before) are read for the check, so an append
    costs what it appends. ``replace_partitions`` makes a rerun idempotent (the partitions present are
    replaced); by default the rows are appended, as in the reference. ``using`` is the table format
    (``iceberg`` in a v2 catalog). Writers of one table must take turns."""
    spark = source.sparkSession
    namespace = table.rsplit(".", 1)[0]
    if namespace != table:
        create_namespace(spark, namespace, namespace_location)
    cols = [c for c in source.columns if c not in partition_by] + list(partition_by)
    ordered = source.select(*cols)
    before = None
    if not spark.catalog.tableExists(table):
        ddl = ", ".join(filter(None, [columns_ddl(ordered, partition_by),
                                      columns_ddl(ordered.select(*partition_by)) if partition_by else ""]))
        create_table(spark, table, ddl, partition_by, location, using)
    else:
        ensure_checkpoint_dir(spark)
        before = table_files(spark, table).checkpoint()
    seen = Observation(f"lakeops_copy_{uuid.uuid4().hex[:8]}")
    observed = ordered.observe(seen, *fingerprint_aggs(ordered))
    (overwrite_partitions if replace_partitions and partition_by else append)(observed, table)
    rows_in, h_in = seen.get["n"], seen.get["h"]
    out = _fingerprint(read_files(spark, table, files_added(spark, table, before)).select(*cols))
    return out.select(F.lit(rows_in).cast("long").alias("rows_in"), F.col("n").alias("rows_out"),
                      ((F.col("n") == F.lit(rows_in)) & (F.col("h") == F.lit(h_in).cast("decimal(38,0)"))).alias("matches"))


BUCKET_BYTES = 128 << 20


def bucket_count(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for storing ``df``: by its measured size, and enough to keep every core busy."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-measured_bytes(df) // bucket_bytes))


def save_bucketed(df: DataFrame, table: str, by: Sequence[str], buckets: int, location: str | None = None,
                  sort_by: Sequence[str] = ()) -> DataFrame:
    """Store ``df`` as a table hashed into ``buckets`` files per task by ``by`` (sorted within a bucket
    by ``sort_by``). Two tables bucketed the same way on a join key are joined, and grouped by that key,
    without a shuffle on either side; a table read every day pays its shuffle once, here. Rows are not
    repartitioned by the key first: each task writes its own share of every bucket, so a key holding a
    third of the rows is written by all tasks in parallel (more, smaller files instead of one hot task)."""
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *by)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


#: Items that the sketch of key frequencies follows, and the keys that may be called hot.
SKETCH_ITEMS, MOST_HOT = 4096, 256


def hot_keys(df: DataFrame, by: Sequence[str], share: float) -> list[int]:
    """64-bit hashes of the keys that hold at least ``share`` of the rows, from one mergeable sketch of frequent items
    (reduced on every mapper); the sketch errs by far less than ``share`` unless that is below about 1 in 1,000."""
    if not 1 / MOST_HOT <= share < 1:
        raise ValueError(f"share must be at least 1/{MOST_HOT} and below 1")
    key = F.xxhash64(*by)
    found = df.agg(F.count(F.lit(1)).alias("n"), F.call_function("approx_top_k", key, F.lit(MOST_HOT), F.lit(SKETCH_ITEMS)).alias("top")).first()
    return sorted(r["item"] for r in found["top"] if r["count"] >= share * found["n"])


@dataclass(frozen=True)
class SplitTable:
    """A table stored in two: ``rest`` bucketed by its key, ``hot`` with the rows of the hot keys in even files."""

    rest: DataFrame
    hot: DataFrame
    hashes: tuple[int, ...]


def save_split(df: DataFrame, table: str, by: Sequence[str], buckets: int, hashes: Sequence[int], location: str,
               sort_by: Sequence[str] = ()) -> SplitTable:
    """Store ``df`` bucketed by ``by``, with the rows of hot keys (see :func:`hot_keys`) apart. A bucket is one task to
    read, so a key with a third of all rows must not be in one; its rows lie in files that any number of tasks
    read."""
    is_hot = F.xxhash64(*by).isin(list(hashes)) if hashes else F.lit(False)
    hot_path = f"{location}-hot"
    df.where(is_hot).write.mode("overwrite").parquet(hot_path)
    rest = save_bucketed(df.where(~is_hot), table, by, buckets, location, sort_by)
    return SplitTable(rest, df.sparkSession.read.schema(df.schema).parquet(hot_path), tuple(hashes))


def file_inventory(df: DataFrame, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Data files of a table or folder: path, partition values, record count."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path"), *partition_cols).agg(
        F.count(F.lit(1)).alias("record_count"))

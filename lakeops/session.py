"""Session settings and the shared scratch area.

Every setting lives in one dictionary that is handed to the session builder. Nothing secret is kept
here: object-store credentials come from the provider chain of the cluster, and catalog endpoints are
parameters.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library expects. Adaptive execution re-plans joins and partition counts at
# run time from real shuffle sizes, and splits skewed join partitions.
BASE_SETTINGS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_settings(shuffle_partitions: int = 2000, max_partition_bytes: str = "256m") -> dict[str, str]:
    """Settings for a large cluster: many initial shuffle partitions that AQE coalesces to the real
    size, large scan splits, and a broadcast threshold that only fires on measured small sides."""
    return {
        **BASE_SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": max_partition_bytes,
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        # Streaming state (one row per job) kept off-heap, with incremental checkpoints.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def lake_catalog_settings(
    name: str,
    uri: str,
    warehouse: str,
    ref: str | None = None,
    catalog_impl: str = "org.apache.iceberg.rest.RESTCatalog",
) -> dict[str, str]:
    """Settings for a table-format catalog named ``name`` (optionally on branch ``ref`` for a versioned
    catalog). The catalog jar is not on this machine; these are configuration strings only."""
    prefix = f"spark.sql.catalog.{name}"
    out = {
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.catalog-impl": catalog_impl,
        f"{prefix}.uri": uri,
        f"{prefix}.warehouse": warehouse,
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
    }
    if ref is not None:
        out[f"{prefix}.ref"] = ref
    return out


def object_store_settings(endpoint: str, path_style: bool = True) -> dict[str, str]:
    """s3a settings for an S3-compatible store; credentials come from the environment provider chain."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https")).lower(),
    }


def get_session(master: str | None = None, app_name: str = "lakeops", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints (``spark.checkpoint.dir``). Without one, a local master
    gets a temporary folder; any other master is refused, as its executors would write to their own disks."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not is_local(sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="lakeops-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def is_local(master: str) -> bool:
    """True if driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return checkpoint_root(spark)


#: What jobs of this process have made in shared storage and catalogs, until it is released.
_SCRATCH: list[str] = []
_NAMESPACES: list[str] = []
_VIEWS: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint root for data a job writes and reads back. It is deleted by
    :func:`release_scratch`, when the job's result has been used."""
    path = f"{checkpoint_root(spark)}/lakeops-scratch/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def scratch_namespace(name: str) -> str:
    """A new namespace name, dropped by :func:`release_scratch`."""
    _NAMESPACES.append(f"lakeops_{name}_{uuid.uuid4().hex[:8]}")
    return _NAMESPACES[-1]


def scratch_view(name: str) -> str:
    """A new temporary view name, dropped by :func:`release_scratch`."""
    _VIEWS.append(f"lakeops_{name}_{uuid.uuid4().hex[:8]}")
    return _VIEWS[-1]


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders, namespaces and views of this process. Call it when no result that reads them
    is needed any more; returns how many things were released."""
    n = len(_SCRATCH) + len(_NAMESPACES) + len(_VIEWS)
    while _VIEWS:
        spark.catalog.dropTempView(_VIEWS.pop())
    while _NAMESPACES:
        spark.sql(f"DROP NAMESPACE IF EXISTS {_NAMESPACES.pop()} CASCADE")
    release_paths(spark, list(_SCRATCH))
    return n


def release_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete some of the scratch folders, when what reads them has been written elsewhere."""
    for name in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        if name in _SCRATCH:
            _SCRATCH.remove(name)

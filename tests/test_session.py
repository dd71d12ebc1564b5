"""Session settings and the shared scratch folder."""

import pytest

from lakeops import session
from lakeops.operators.sizing import parse_bytes


def test_settings_hold_no_secrets():
    conf = {**session.cluster_settings(), **session.object_store_settings("https://store:9000"),
            **session.lake_catalog_settings("lake", "https://catalog", "s3a://warehouse/")}
    assert not any("secret" in k.lower() or "password" in k.lower() or "access.key" in k.lower() for k in conf)
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert "spark.sql.catalog.lake.ref" not in conf
    assert session.lake_catalog_settings("lake", "u", "w", ref="main")["spark.sql.catalog.lake.ref"] == "main"
    assert parse_bytes(conf["spark.sql.autoBroadcastJoinThreshold"]) == 64 * 1024 ** 2
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_scratch_is_under_the_checkpoint_root(spark):
    root = session.checkpoint_root(spark)
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a.startswith(root) and b.startswith(root) and a != b
    assert spark.sparkContext.getCheckpointDir() is not None


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    """Without spark.checkpoint.dir only a master inside this process gets a temporary folder."""
    assert session.is_local("local") and session.is_local("local[8]")
    assert not any(map(session.is_local, ("local-cluster[2,1,1024]", "yarn", "spark://host:7077", "k8s://x")))

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"
        getConf = staticmethod(Conf)
        getCheckpointDir = staticmethod(lambda: None)

    class Spark:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Spark())


def test_nothing_is_left_after_a_query(spark):
    import os

    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL

    session.release_scratch(spark)
    root = session.checkpoint_root(spark).removeprefix("file:")
    before = {r.namespace for r in spark.sql("SHOW NAMESPACES").collect()}
    os.makedirs(f"{root}/lakeops-scratch", exist_ok=True)
    held = set(os.listdir(f"{root}/lakeops-scratch"))
    for name in ("readback_check", "csv_scan", "warehouse_sql", "bucketed_payload_join", "stream_alerts"):
        entry.queries()[name](spark, SF_SMALL).count()
    assert session.release_scratch(spark) > 5
    assert {r.namespace for r in spark.sql("SHOW NAMESPACES").collect()} == before
    assert set(os.listdir(f"{root}/lakeops-scratch")) <= held and not [t for t in spark.catalog.listTables() if t.name.startswith("lakeops")]

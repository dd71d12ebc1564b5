"""Hierarchy expansion over an edge table (parent -> child), safe on cycles, by delta iteration.

Breadth first: the frontier joins the edges, and children not seen before are the new result rows and (apart from the
root) the next frontier. What has been found is stored in files partitioned by a hash of the node; a level reads only
the partitions that its own children fall in, and four stores of equal length are merged into one (so there are at most
three for each power of four in the number of levels). So neither the plan nor the reads of a level grow with the levels before it:
a chain costs the same at every level. Levels are stored in the shared folder, so a lost executor recomputes one
level, not all. The loop ends when the frontier is empty, which always happens: the set of nodes found only grows.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.sizing import broadcast_limit, measured_bytes, row_bytes
from lakeops.session import ensure_checkpoint_dir, release_paths, scratch_path

BUCKETS, MERGED = 16, 4
_BUCKET = "_bucket"


class _Found:
    """Nodes found so far, in folders of one or more levels each."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.stores: list[tuple[str, int]] = []  # path and number of levels, the longest first

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(path)

    def read(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [self._read(path) for path, _ in self.stores])

    def of_buckets(self, buckets: list[int]) -> DataFrame:
        """Nodes found before in some hash partitions; the other partitions are not read."""
        return self.read().where(F.col(_BUCKET).isin(buckets)).select("node")

    def add(self, rows: DataFrame) -> DataFrame:
        """Store a level and return it; four stores of equal length become one."""
        path = scratch_path(self.spark, "hierarchy")
        rows.write.partitionBy(_BUCKET).parquet(path)
        self.schema = rows.schema
        self.stores.append((path, 1))
        while len(self.stores) >= MERGED and len({n for _, n in self.stores[-MERGED:]}) == 1:
            last = self.stores[-MERGED:]
            merged = scratch_path(self.spark, "hierarchy")
            reduce(DataFrame.unionByName, [self._read(p) for p, _ in last]).repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(merged)
            release_paths(self.spark, [p for p, _ in last if p != path])  # the newest level is still the frontier
            self.stores[-MERGED:] = [(merged, sum(n for _, n in last))]
        return self._read(path)


def expand_hierarchy(edges: DataFrame, root, parent: str = "parent", child: str = "child",
                     max_levels: int | None = None, expandable: str | None = None) -> DataFrame:
    """All nodes below ``root`` with the level at which each is first found.

    As in the reference walk, a child is recorded before the visited test, so a cycle that leads back to
    the root records the root too; each node is recorded once. With ``expandable`` (a boolean column of
    the edges, e.g. "the child is a box"), only such children are expanded further; the others are
    recorded but their own children are not read. Edges without a child name nothing and are left out."""
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    key_type = edges.schema[parent].dataType
    # Edges are materialised once but not partitioned by parent: a parent with a third of all children
    # would make one hot task. A small frontier is broadcast and the edges stream through their own
    # balanced partitions; a large one is joined with a shuffle on both sides, where AQE splits skew.
    flag = F.col(expandable).cast("boolean") if expandable else F.lit(True)
    e = (edges.where(F.col(child).isNotNull()).select(F.col(parent).alias("_parent"), F.col(child).alias("node"), flag.alias("_x"))
         .distinct().checkpoint())
    root_lit = F.lit(root).cast(key_type)
    frontier = spark.range(1).select(root_lit.alias("node"))
    found = _Found(spark)
    frontier_bytes = measured_bytes(frontier)
    level = 0
    limit = broadcast_limit(edges)
    while frontier_bytes > 0:
        level += 1
        if max_levels is not None and level > max_levels:
            raise RuntimeError(f"hierarchy deeper than {max_levels} levels")
        side = F.broadcast(frontier) if frontier_bytes <= limit else frontier
        children = (e.join(side.select(F.col("node").alias("_parent")), "_parent")
                    .groupBy("node").agg(F.coalesce(F.bool_or("_x"), F.lit(False)).alias("_x"))
                    .withColumn(_BUCKET, F.pmod(F.hash("node"), F.lit(BUCKETS))).withColumn("depth", F.lit(level)))
        if found.stores:
            seen = Observation(f"lakeops_children_{level}_{uuid.uuid4().hex[:8]}")
            children = children.observe(seen, F.collect_set(_BUCKET).alias("buckets")).checkpoint()
            children = children.join(found.of_buckets([int(b) for b in seen.get["buckets"]]), "node", "left_anti")
        # Visited = root + everything found, so the next frontier is this level's new expandable nodes
        # minus the root. Its exact size is observed while the level is stored (no extra job).
        next_up = F.col("_x") & (F.col("node") != root_lit)
        size = Observation(f"lakeops_level_{level}_{uuid.uuid4().hex[:8]}")
        size_of = F.coalesce(F.sum(F.when(next_up, row_bytes(children, ["node"]))), F.lit(0)).alias("b")
        stored = found.add(children.select("node", "_x", "depth", _BUCKET).repartition(_BUCKET).observe(size, size_of))
        frontier = stored.where(next_up).select("node")
        frontier_bytes = int(size.get["b"])
    return found.read().drop("_x", _BUCKET)

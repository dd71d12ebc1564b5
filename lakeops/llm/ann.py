"""Approximate nearest neighbours by learned partitions (largest inner product).

Fitting uses at most about ``fitting_rows`` vectors, chosen by a hash of their id: their exact neighbour graph is
cut into partitions of nearly equal size, moving vectors to the partition that holds most of their
neighbours while sizes stay balanced; then a small classifier (one hidden layer) learns from each vector
the shares of its neighbours' partitions. The number of partitions a query is routed to is the smallest that
finds ``recall`` of the fitting rows' own neighbours (a margin above the 0.9 that is asked for; all rows are
denser than these, so their neighbours lie nearer). There are 16 partitions, and with more than 65,536 rows as many as
the square root of the rows over 16, as a power of two and at most one for 16 fitting rows. Every vector is then indexed under its most
probable partition, and a query is compared, exactly and in double precision, with all vectors of its most
probable partitions.

Rows and queries of a partition are dealt in blocks of about ``block_rows`` by a hash of the id, so a partition (or
one vector held by a third of all rows) is many tasks of bounded size. A pair of blocks returns its best rows per
query; those are merged.

Defined cases: vectors that are null, zero, of another than the commonest dimension (ties: the larger), or hold null
or non-finite components take no part, nor do rows without an id; of rows with one id the smallest vector
counts; equal scores are ordered by id; fewer candidates give fewer rows; empty tables and tables without
queries give empty results; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import ensure_checkpoint_dir

NEIGHBOURS = 20


def _usable(batches):
    for batch in batches:
        ids, out = [], []
        for i, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if i is None or not vector or any(x is None for x in vector):
                continue
            v = np.asarray(vector, np.float64)
            if np.isfinite(v).all() and v.any():
                ids.append(i)
                out.append(v.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["vec_id", "v"])


def _matrix(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of every row."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for lo in range(0, len(x), 512):
        s = x[lo:lo + 512] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        out[lo:lo + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_partitions(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 8, slack: float = 1.1) -> np.ndarray:
    """Partition of the neighbour graph: halves by main direction first, then moves that keep sizes balanced."""
    part = np.zeros(len(x), np.int64)
    have = 1
    while have < parts:
        for p in range(have):
            rows = np.flatnonzero(part == p)
            if len(rows) > 1:
                centred = x[rows] - x[rows].mean(axis=0)
                side = centred @ np.linalg.eigh(centred.T @ centred)[1][:, -1]
                part[rows[np.argsort(side, kind="stable")[len(rows) // 2:]]] = p + have
        have *= 2
    size = np.bincount(part, minlength=have)
    limit = int(np.ceil(slack * len(x) / have))
    back = [[] for _ in range(len(x))]
    for i, row in enumerate(graph.tolist()):
        for j in row:
            back[j].append(i)
    for _ in range(rounds):
        moved = 0
        for i in range(len(x)):
            votes = np.bincount(part[graph[i]], minlength=have) + np.bincount(part[back[i]], minlength=have) if back[i] else np.bincount(part[graph[i]], minlength=have)
            best = int(np.where((size < limit) | (np.arange(have) == part[i]), votes, -1).argmax())
            if best != part[i] and votes[best] > votes[part[i]]:
                size[part[i]] -= 1
                size[best] += 1
                part[i] = best
                moved += 1
        if not moved:
            break
    return part


class Router:
    """One hidden layer with soft-max output over the partitions."""

    def __init__(self, x: np.ndarray, target: np.ndarray, hidden: int = 96, epochs: int = 60, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.scale = 1.0 / max(float(np.sqrt((x * x).mean())), 1e-300)
        w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
             rng.normal(0, 1 / np.sqrt(hidden), (hidden, target.shape[1])), np.zeros(target.shape[1])]
        m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
                step += 1
                a = x[rows] * self.scale
                h = np.maximum(a @ w[0] + w[1], 0)
                d = (self._soft(h @ w[2] + w[3]) - target[rows]) / len(rows)
                e = (d @ w[2].T) * (h > 0)
                for i, g in enumerate((a.T @ e, e.sum(0), h.T @ d, d.sum(0))):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    w[i] -= 0.003 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
        self.w = w

    @staticmethod
    def _soft(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def order(self, x: np.ndarray) -> np.ndarray:
        """Partitions of each row, most probable first."""
        h = np.maximum((x * self.scale) @ self.w[0] + self.w[1], 0)
        return np.argsort(-(h @ self.w[2] + self.w[3]), axis=1, kind="stable")


def fit(x: np.ndarray, parts: int, recall: float, k: int = NEIGHBOURS) -> tuple[Router, int]:
    """The classifier and the number of partitions to search, from the fitting rows."""
    graph = neighbour_graph(x, k)
    part = balanced_partitions(x, graph, parts)
    parts = int(part.max()) + 1
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1.0)
    target[np.arange(len(x)), part] += 1.0
    # Even rows teach, odd rows tell how many partitions are needed; then all rows teach.
    half = Router(x[::2], target[::2] / target[::2].sum(1, keepdims=True))
    probes = _probes(half, x, graph, recall, np.arange(1, len(x), 2))
    return Router(x, target / target.sum(1, keepdims=True)), probes


def _probes(router: Router, x, graph, recall, rows) -> int:
    order = router.order(x)
    rank = np.empty_like(order)
    rank[np.arange(len(order))[:, None], order] = np.arange(order.shape[1])
    home = order[:, 0]
    found = rank[rows[:, None], home[graph[rows]]]
    share = np.cumsum(np.bincount(found.ravel(), minlength=order.shape[1])) / found.size
    return int(min(np.searchsorted(share, recall) + 1, order.shape[1]))


def _best(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The k best rows of one block for every query sent to it."""
    out = {"query_id": [], "vec_id": [], "score": []}
    if queries.num_rows and rows.num_rows:
        q, qid = _matrix(queries.column("v")), queries.column("vec_id").to_numpy()
        x, xid = _matrix(rows.column("v")), rows.column("vec_id").to_numpy()
        for lo in range(0, len(q), 256):
            s = q[lo:lo + 256] @ x.T
            s[qid[lo:lo + 256, None] == xid[None, :]] = -np.inf
            top = min(k, len(x))
            cut = np.partition(s, len(x) - top, axis=1)[:, len(x) - top]
            for i in range(len(s)):
                near = np.flatnonzero((s[i] >= cut[i] - 1e-9 * max(1.0, abs(cut[i]))) & (s[i] > -np.inf)) if cut[i] > -np.inf else np.flatnonzero(s[i] > -np.inf)
                exact = (x[near] * q[lo + i]).sum(axis=1)  # one order of additions, so equal vectors score equally
                keep = np.lexsort((xid[near], -exact))[:k]
                out["query_id"].append(np.full(len(keep), qid[lo + i]))
                out["vec_id"].append(xid[near[keep]])
                out["score"].append(exact[keep])
    flat = [np.concatenate(c) if c else np.empty(0) for c in out.values()]
    return pa.table([pa.array(flat[0].astype(np.int64)), pa.array(flat[1].astype(np.int64)), pa.array(flat[2].astype(np.float64))], names=list(out))


def partition_count(rows: int, fitting_rows: int) -> int:
    """Partitions of the index: they grow with the square root of the rows, within what the fitting rows can teach."""
    wanted = 1 << max(4, round(math.log2(max(1.0, math.sqrt(rows) / 16))))
    return min(wanted, max(16, 1 << int(math.log2(max(1, fitting_rows // 16)))))


def search(vectors: DataFrame, is_query, k: int = NEIGHBOURS, vec_id: str = "vec_id", vector: str = "embedding",
           fitting_rows: int = 4096, partitions: int | None = None, recall: float = 0.96, block_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows where ``is_query`` (a condition on vec_id), the k nearest found."""
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    usable = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
              .mapInArrow(_usable, "vec_id long, v binary")
              .groupBy("vec_id").agg(F.min("v").alias("v")).checkpoint())
    size = F.octet_length("v")
    common = usable.groupBy(size.alias("width")).count().orderBy(F.col("count").desc(), F.col("width").desc()).first()
    result = "query_id long, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable, width, n = usable.where(size == common["width"]), common["width"], common["count"]
    partitions = partitions or partition_count(n, fitting_rows)
    chance = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / (1 << 30)
    taught = usable.where(chance * n < fitting_rows).toArrow()
    x = _matrix(taught.column("v"))[np.argsort(taught.column("vec_id").to_numpy())] if taught.num_rows else np.empty((0, width // 8))
    router, probes = fit(x, partitions, recall, k) if len(x) > 4 * partitions else (None, 1)
    shared = spark.sparkContext.broadcast(router)

    def route(batches, count):
        for batch in batches:
            if not batch.num_rows:
                continue
            found = shared.value.order(_matrix(batch.column(1)))[:, :count] if shared.value else np.zeros((batch.num_rows, 1), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.tolist(), pa.list_(pa.int64()))], ["vec_id", "v", "parts"])

    schema = "vec_id long, v binary, parts array<long>"
    asked = usable.where(is_query)
    parts = partitions if router else 1
    blocks = max(1, -(-n // (block_rows * parts)))
    query_blocks = max(1, -(-asked.count() * probes // (block_rows * parts)))
    dealt = lambda seed, count: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(count))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    rows = (usable.mapInArrow(lambda b: route(b, 1), schema)
            .select("vec_id", "v", F.col("parts")[0].alias("part"), dealt(3, blocks).alias("block"))
            .withColumn("query_block", every(query_blocks)))
    queries = (asked.mapInArrow(lambda b: route(b, probes), schema)
               .select("vec_id", "v", F.explode("parts").alias("part"), dealt(5, query_blocks).alias("query_block"))
               .withColumn("block", every(blocks)))
    keys = ["part", "block", "query_block"]
    best = (queries.groupBy(*keys).cogroup(rows.select("vec_id", "v", *keys).groupBy(*keys))
            .applyInArrow(lambda a, b: _best(a, b, k), result))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

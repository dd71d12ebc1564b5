"""Whitening of vectors from exact integer cross-products.

Every entry c becomes the integer x = floor(scale * c) + offset. Cross-products of all pairs of dimensions are counted
in bit slices: the values of a dimension, less its smallest, are cut into bit planes, and a plane's bits of 64 rows
are packed in one word. The sum of y_i * y_j over rows is then the sum, over pairs of planes, of 2^(a + b) times the
number of bits that both planes set (AND and popcount), so it is exact whatever the number of rows. The partial
results of tasks are exact integers in four limbs, added by Spark; only dimensions^2 / 2 rows reach the driver, which
centres them as integers, n * sum(x_i x_j) - sum(x_i) * sum(x_j), before the one division and the eigenvectors.

A second pass sums the products of the whitened values themselves, so ``identity_error`` is measured and not derived.
The vectors are read four times (widths, ranges, bit slices, products of the result) besides the result itself, each
time in one pass without a shuffle of vectors, so one vector held by a third of all rows is no group.

Defined cases: vectors that are null, empty, or hold null or non-finite entries, or an entry whose integer would be
beyond 2^62, take no part; of several widths the commonest counts (ties: the larger) and other vectors take no part;
rows with a null or repeated id are rows like others; a component whose eigenvalue is zero to double precision has no
whitened value and is not returned (so equal vectors, or a single one, give empty arrays, and ``identity_error`` is
then 0); a ``deviation`` above 38 digits is null; other columns are not read; empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Entries beyond this have no 64-bit integer.
LARGEST = float(1 << 62)
BLOCK_ROWS = 1 << 15
LIMB = 40
RESULT = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"


@dataclass
class Fit:
    """Exact statistics of the fit list and what follows from them; ``low`` is taken off every dimension first."""

    n: int
    low: np.ndarray       # smallest integer per dimension
    sums: list[int]       # of x - low
    spread: int           # largest x - low
    values: np.ndarray    # eigenvalues that are kept, falling
    vectors: np.ndarray   # their unit eigenvectors, in columns
    trace: float

    def centred(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n * x - S per entry as integers (64-bit while they fit), and the sum of their squares per row."""
        width = max(1, y.shape[1])
        small = width * (self.n * (self.spread + 1)) ** 2 < 1 << 63
        z = y if small else y.astype(object)
        z = z * (np.int64(self.n) if small else self.n) - np.array(self.sums, np.int64 if small else object)
        return z, (z * z).sum(axis=1)

    def project(self, z: np.ndarray) -> np.ndarray:
        return (z / self.n).astype(np.float64) @ (self.vectors / np.sqrt(self.values))


def _integers(column, width: int, scale: int, offset: int) -> np.ndarray:
    """Integer matrix of an Arrow column of double lists."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return (np.floor(flat.reshape(len(column), width) * scale)).astype(np.int64) + offset


def _blocks(batches, width: int, scale: int, offset: int):
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(lo, BLOCK_ROWS)
            yield part, _integers(part.column(part.schema.names.index("v")), width, scale, offset)


def pack_planes(y: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """(plane, word): the bit planes of every column of ``y``, 64 rows to a word."""
    rows = -(-len(y) // 64) * 8
    out = np.zeros((int(bits.sum()), rows), np.uint8)
    at = 0
    for d, count in enumerate(bits.tolist()):
        column = np.ascontiguousarray(y[:, d])
        for b in range(count):
            packed = np.packbits((column >> b & 1).astype(bool))
            out[at, :len(packed)] = packed
            at += 1
    return out.view(np.uint64)


def plane_counts(planes: np.ndarray) -> np.ndarray:
    """Rows set in both planes, for every pair with the first not after the second."""
    out = np.zeros((len(planes), len(planes)), np.int64)
    for i in range(len(planes)):
        out[i, i:] = np.bitwise_count(planes[i] & planes[i:]).sum(axis=1, dtype=np.int64)
    return out


def weigh(counts: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Exact sums of y_i * y_j (Python integers) from the counts of their planes."""
    power = np.array([1 << b for count in bits.tolist() for b in range(count)], object)
    both = counts + np.triu(counts, 1).T
    edges = np.r_[0, np.cumsum(bits)]
    out = np.zeros((len(bits), len(bits)), object)
    for i in range(len(bits)):
        a = slice(edges[i], edges[i + 1])
        row = (both[a].astype(object) * power[a, None]).sum(axis=0) * power if bits[i] else None
        for j in range(i, len(bits)):
            out[i, j] = int(row[edges[j]:edges[j + 1]].sum()) if bits[i] and bits[j] else 0
    return out


def _limbs(value: int) -> list[int]:
    """Four numbers with value = sum of limb * 2^(LIMB * k), the first three below 2^LIMB."""
    mask = (1 << LIMB) - 1
    return [value & mask, value >> LIMB & mask, value >> 2 * LIMB & mask, value >> 3 * LIMB]


def _cross_products(batches, low: np.ndarray, bits: np.ndarray, scale: int, offset: int):
    """(i, j, four limbs) of one task: sums of y_i * y_j, and of y_i at j = -1."""
    counts = np.zeros((int(bits.sum()), int(bits.sum())), np.int64)
    for _, x in _blocks(batches, len(low), scale, offset):
        counts += plane_counts(pack_planes(x - low, bits))
    if not counts.any():
        return
    total = weigh(counts, bits)
    ones, at = np.diagonal(counts).tolist(), 0
    rows = []
    for i, count in enumerate(bits.tolist()):
        rows.append((i, -1, sum(ones[at + b] << b for b in range(count))))
        rows += [(i, j, total[i, j]) for j in range(i, len(bits)) if total[i, j]]
        at += count
    parts = np.array([_limbs(v) for _, _, v in rows], np.int64)
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                      *[pa.array(parts[:, k]) for k in range(4)]], ["i", "j", "l0", "l1", "l2", "l3"])


def _decompose(n: int, low: np.ndarray, spread: int, sums: list[int], products: dict[tuple[int, int], int], components: int) -> Fit:
    width = len(low)
    cov = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            cov[i, j] = cov[j, i] = (n * products.get((i, j), 0) - sums[i] * sums[j]) / (n * n)
    value, vector = np.linalg.eigh(cov)
    order = np.argsort(-value, kind="stable")[:components]
    order = order[value[order] > width * np.finfo(float).eps * max(value.max(), 0.0)]
    return Fit(n, low, sums, spread, value[order], vector[:, order], float(np.trace(cov)))


def _products_of_result(batches, fit: Fit, scale: int, offset: int):
    """(i, j, sum) of one task: sums of w_i * w_j, and of w_i at j = -1."""
    k = len(fit.values)
    total, once, seen = np.zeros((k, k)), np.zeros(k), 0
    for _, x in _blocks(batches, len(fit.low), scale, offset):
        w = fit.project(fit.centred(x - fit.low)[0])
        total += w.T @ w
        once += w.sum(axis=0)
        seen += len(w)
    if seen and k:
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[i, np.arange(k)].astype(np.int32)), pa.array(np.r_[j, np.full(k, -1)].astype(np.int32)),
                                          pa.array(np.r_[total[i, j], once])], ["i", "j", "total"])


def usable(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, v): vectors as doubles, without those that take no part whatever their width."""
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST / scale)
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda c: F.coalesce(fits(c), F.lit(False))))


def learn(rows: DataFrame, width: int, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Fit:
    """Exact fit over rows (vec_id, v) that all have ``width`` entries."""
    def ranges(batches):
        low, high, n = None, None, 0
        for _, x in _blocks(batches, width, scale, offset):
            if len(x):
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(low), pa.array(high), pa.array(np.full(width, n))],
                                             ["i", "low", "high", "n"])

    found = (rows.mapInArrow(ranges, "i int, low long, high long, n long").groupBy("i")
             .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).collect())
    found.sort(key=lambda r: r.i)
    low = np.array([r.low for r in found], np.int64)
    bits = np.array([(r.high - r.low).bit_length() for r in found], np.int64)
    parts = rows.mapInArrow(lambda b: _cross_products(b, low, bits, scale, offset), "i int, j int, l0 long, l1 long, l2 long, l3 long")
    sums, products = [0] * width, {}
    for r in parts.groupBy("i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(4)]).collect():
        value = sum(r[f"l{k}"] << LIMB * k for k in range(4))
        if r.j < 0:
            sums[r.i] = value
        else:
            products[r.i, r.j] = value
    return _decompose(found[0].n, low, max(r.high - r.low for r in found), sums, products, components)


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """One row per vector that takes part: ``vec_id``, ``n`` (fit list), ``deviation`` (sum of (n * x - S)^2, exact),
    ``whitened`` and ``explained`` (one entry per component, by falling eigenvalue) and ``identity_error``."""
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, vector, scale)
    common = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.col("count").desc(), F.col("width").desc()).first()
    if common is None:
        return spark.createDataFrame([], RESULT)
    rows = rows.where(F.size("v") == common.width)
    fit = learn(rows, common.width, components, scale, offset)
    shared = spark.sparkContext.broadcast(fit)

    sums = (rows.mapInArrow(lambda b: _products_of_result(b, shared.value, scale, offset), "i int, j int, total double")
            .groupBy("i", "j").agg(F.sum("total").alias("total")).collect())
    mean = {r.i: r.total / fit.n for r in sums if r.j < 0}
    error = max((abs(r.total / fit.n - mean[r.i] * mean[r.j] - (r.i == r.j)) for r in sums if r.j >= 0), default=0.0)

    def results(batches):
        for part, x in _blocks(batches, common.width, scale, offset):
            z, deviation = shared.value.centred(x - shared.value.low)
            if deviation.dtype == object:
                deviation = pa.array([int(v) if v < 10 ** 38 else None for v in deviation.tolist()], pa.decimal128(38, 0))
            else:
                deviation = pa.array(deviation, pa.int64()).cast(pa.decimal128(38, 0))
            w = shared.value.project(z)
            ends = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
            yield pa.RecordBatch.from_arrays([part.column(0), deviation, pa.ListArray.from_arrays(ends, pa.array(w.ravel()))],
                                             ["vec_id", "deviation", "whitened"])

    share = [float(v) / fit.trace for v in fit.values]
    out = rows.mapInArrow(results, "vec_id long, deviation decimal(38,0), whitened array<double>")
    explained = F.array(*[F.lit(s) for s in share]) if share else F.array().cast("array<double>")
    return out.select("vec_id", F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"),
                      F.lit(float(error)).alias("identity_error"))

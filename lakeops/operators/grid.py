"""Flat risk grids: assets x factors x tenors.

The grid is never materialised. For a value that is a product of an asset term, a factor term and a
tenor term, the sum over the grid is (sum of asset terms) x factor term x (sum of tenor terms), so the
asset table is reduced to two numbers in one aggregate, and only factors x tenors rows are generated.
Work is linear in the inputs; no cross join and no pairs are produced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TENORS = 72


def grid_totals(assets: DataFrame, asset_value: Column, factors: DataFrame, factor_keys: Sequence[str],
                factor_weight: Column, tenors: int = TENORS) -> DataFrame:
    """Per factor: the number of grid cells and the sum of ``asset_value * factor_weight / tenor`` over
    every asset and every tenor ``1..tenors``."""
    if isinstance(tenors, bool) or not isinstance(tenors, int) or tenors < 1:
        raise ValueError("tenors must be a positive integer")
    # One scalar subquery: the asset table reduced to its count and sum.
    stats = assets.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(asset_value).alias("s")).alias("st")).scalar()
    n_assets, asset_sum = stats.getField("n"), stats.getField("s")
    cells = factors.select(*factor_keys, factor_weight.alias("_w"),
                           F.explode(F.sequence(F.lit(1), F.lit(tenors))).alias("_tenor"))
    return cells.groupBy(*factor_keys).agg(
        (F.count(F.lit(1)) * n_assets).alias("n_cells"),
        F.sum(F.col("_w") * asset_sum / F.col("_tenor")).alias("total_value"),
    )

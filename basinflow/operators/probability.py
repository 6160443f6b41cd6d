"""Category probabilities of an ensemble against the quantiles of its hindcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basinflow.grid import CELL

TERCILES = (1 / 3.0, 2 / 3.0)


def quantile_edges(hindcast: DataFrame, quantiles: Sequence[float] = TERCILES, cell: Sequence[str] = CELL) -> DataFrame:
    """Exact, linearly interpolated quantiles of each cell's values over all members and times, as array ``edges``.

    One aggregation gives all quantiles.  A cell without values has NULL.
    """
    return hindcast.groupBy(*cell).agg(F.percentile("value", F.array(*[F.lit(float(q)) for q in quantiles])).alias("edges"))


def bounds(category: int, count: int) -> tuple[Column, Column]:
    """Open lower and closed upper bound of a category among ``count`` quantiles; the outer ones are infinite."""
    low = F.lit(float("-inf")) if category == 0 else F.element_at("edges", category)
    high = F.lit(float("inf")) if category == count else F.element_at("edges", category + 1)
    return low, high


def category_thresholds(hindcast: DataFrame, category: int, quantiles: Sequence[float] = TERCILES, cell: Sequence[str] = CELL) -> DataFrame:
    """The pair (low, high) of one category in each cell."""
    if not 0 <= category <= len(quantiles):
        raise ValueError(f"category {category} is not in 0..{len(quantiles)}")
    low, high = bounds(category, len(quantiles))
    return quantile_edges(hindcast, quantiles, cell).select(*cell, low.alias("low"), high.alias("high"))


def category_probability(hindcast: DataFrame, forecast: DataFrame, quantiles: Sequence[float] = TERCILES, cell: Sequence[str] = CELL, keys: Sequence[str] = ("time",), members: int | None = None) -> DataFrame:
    """The share of members in each category: keys, cell, category, prob (0 to 1).

    A forecast of exactly 0 is missing; hindcast zeros count.  The denominator is the size of the
    ensemble (all members of the forecast, or ``members``), so shares need not sum to 1, and a cell
    without values has 0 in each category.  Cells without a hindcast drop out.
    """
    edges = quantile_edges(hindcast, quantiles, cell)
    value = F.nullif(F.col("value"), F.lit(0.0))
    n = len(quantiles)
    # a NULL edge makes its comparison NULL, which counts nothing
    conditions = [
        (value <= F.col("edges")[0]) if k == 0 else (value > F.col("edges")[n - 1]) if k == n else (value > F.col("edges")[k - 1]) & (value <= F.col("edges")[k])
        for k in range(n + 1)
    ]
    joined = forecast.join(edges, list(cell))
    counts = joined.groupBy(*keys, *cell).agg(*[F.count_if(c).alias(f"n{k}") for k, c in enumerate(conditions)])
    if members is None:
        size = forecast.agg(F.count_distinct("ensemble").alias("members"))  # one row
        counts = counts.crossJoin(F.broadcast(size))
    else:
        counts = counts.withColumn("members", F.lit(members))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("category"), F.col(f"n{k}").alias("n")) for k in range(n + 1)]))
    return counts.select(*keys, *cell, "members", each.alias("c")).select(*keys, *cell, "c.category", (F.col("c.n") / F.col("members")).alias("prob"))


def percent(prob: DataFrame) -> DataFrame:
    """Shares as percent, in column ``value``."""
    return prob.withColumn("value", F.col("prob") * 100).drop("prob")


def dominant_category(cube: DataFrame, keys: Sequence[str] = ("time", *CELL), keep_shape: bool = True) -> DataFrame:
    """Values of the category that is largest in its cell; the others are missing, or dropped without ``keep_shape``.

    All of several equal largest ones stay.
    """
    top = F.max("value").over(Window.partitionBy(*keys))
    marked = cube.withColumn("_top", top)
    if keep_shape:
        return marked.withColumn("value", F.when(F.col("value") == F.col("_top"), F.col("value"))).drop("_top")
    return marked.where(F.col("value") == F.col("_top")).drop("_top")

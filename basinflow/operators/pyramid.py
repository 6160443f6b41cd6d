"""Multi-resolution pyramids by block means."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basinflow.grid import CELL

#: Metres of a degree, the Earth's radius in metres, the pixels of a tile, the least share of valid cells.
DEGREE, RADIUS, TILE, LEAST_VALID = 111000, 6371e3, 256, 0.25
PRODUCTION_ZOOMS = (4, 5, 6, 7, 8, 9)


def common_factors(spark: SparkSession, nlat: int, nlon: int) -> DataFrame:
    """The common factors of both axis lengths in ascending order: column grain."""
    g = math.gcd(nlat, nlon)
    return spark.range(1, g + 1).where(F.lit(g) % F.col("id") == 0).select(F.col("id").cast("int").alias("grain")).orderBy("grain")


def grain_by_zoom(spark: SparkSession, zooms: Sequence[int], nlat: int, nlon: int, dlon: float, resolution: int = TILE, factor: float = 1.0) -> DataFrame:
    """zoom, grain: the first common factor whose cells are at least as wide as the zoom's pixels, else the largest."""
    wanted = spark.createDataFrame([(int(z),) for z in zooms], "zoom int")
    target = F.lit(RADIUS * 2 * math.pi) / F.pow(F.lit(2.0), F.col("zoom")) / resolution * F.lit(float(factor))
    available = common_factors(spark, nlat, nlon).agg(F.sort_array(F.collect_list("grain")).alias("grains"))  # one short row
    enough = F.filter("grains", lambda g: g * F.lit(DEGREE * float(dlon)) >= target)
    return wanted.crossJoin(F.broadcast(available)).select("zoom", F.coalesce(F.get(enough, F.lit(0)), F.element_at("grains", -1)).alias("grain"))


def offset(grain: int) -> int:
    """Rows and columns left out before the first block."""
    return math.ceil(grain / 2) - 1


def block_mean(grid: DataFrame, grain: int, nlat: int, nlon: int, keys: Sequence[str] = ()) -> DataFrame:
    """Means of grain x grain blocks: keys, lat_idx, lon_idx (of the block), lat_src, lon_src (its first cell), value.

    The first ``offset(grain)`` rows and columns and incomplete blocks at the end are left out.  A
    block with less than a quarter of valid cells is missing.
    """
    if grain == 1:
        return grid.select(*keys, *CELL, F.col("lat_idx").alias("lat_src"), F.col("lon_idx").alias("lon_src"), "value")
    s = offset(grain)
    number = lambda c: F.floor((F.col(c) - s) / grain).cast("int")
    inside = (F.col("lat_idx") >= s) & (F.col("lon_idx") >= s) & (number("lat_idx") < (nlat - s) // grain) & (number("lon_idx") < (nlon - s) // grain)
    blocks = grid.where(inside).select(*keys, number("lat_idx").alias("lat_idx"), number("lon_idx").alias("lon_idx"), "value")
    mean = F.when(F.count("value") >= grain * grain * LEAST_VALID, F.avg("value"))
    source = lambda c: (F.col(c) * grain + s).alias(c.replace("idx", "src"))
    return blocks.groupBy(*keys, *CELL).agg(mean.alias("value")).select(*keys, *CELL, source("lat_idx"), source("lon_idx"), "value")


def strided_pick(grid: DataFrame, grain: int, keys: Sequence[str] = ()) -> DataFrame:
    """Every grain-th cell from ``offset(grain)`` on."""
    s = offset(grain)
    hit = lambda c: (F.col(c) >= s) & ((F.col(c) - s) % grain == 0)
    number = lambda c: ((F.col(c) - s) / grain).cast("int").alias(c)
    return grid.where(hit("lat_idx") & hit("lon_idx")).select(*keys, number("lat_idx"), number("lon_idx"), "value")


def window_mean(grid: DataFrame, grain: int, nlat: int, nlon: int, keys: Sequence[str] = ()) -> DataFrame:
    """Means of windows that reach grain // 2 cells around every grain-th cell, cut off at the edges.

    A window with valid cells fewer than a quarter of grain * grain is missing.  Each cell is sent
    to the few windows that hold it, so one aggregation does it.
    """
    if grain == 1:
        return grid.select(*keys, *CELL, "value")
    s, half = offset(grain), grain // 2

    def windows(c: str, n: int) -> Column:
        last = (n - 1 - s) // grain
        low = F.greatest(F.lit(0), F.ceil((F.col(c) - half - s) / grain).cast("int"))
        high = F.least(F.lit(last), F.floor((F.col(c) + half - s) / grain).cast("int"))
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    sent = grid.select(*keys, F.explode(windows("lat_idx", nlat)).alias("_i"), "lon_idx", "value")
    sent = sent.select(*keys, F.col("_i").alias("lat_idx"), F.explode(windows("lon_idx", nlon)).alias("lon_idx"), "value")
    mean = F.when((F.count("value") > 0) & (F.count("value") >= grain * grain * LEAST_VALID), F.avg("value"))
    return sent.groupBy(*keys, *CELL).agg(mean.alias("value"))


def pyramid(grid: DataFrame, grains: Sequence[int], nlat: int, nlon: int, keys: Sequence[str] = ()) -> DataFrame:
    """Block means of each distinct grain in one table with column grain; zooms with equal grain share rows."""
    out = None
    for g in sorted(set(grains)):
        level = block_mean(grid, g, nlat, nlon, keys).withColumn("grain", F.lit(int(g)))
        out = level if out is None else out.unionByName(level)
    if out is None:
        raise ValueError("no grain is asked for")
    return out


def at_zoom(levels: DataFrame, zoom_grain: DataFrame, zoom: int) -> DataFrame:
    """The rows of a pyramid for one zoom; grain 1 where the map lacks the zoom."""
    one = zoom_grain.where(F.col("zoom") == zoom).agg(F.coalesce(F.max("grain"), F.lit(1)).alias("grain"))
    return levels.join(F.broadcast(one), "grain")


def layer(rows: DataFrame, **at: int) -> DataFrame:
    """lat_idx, lon_idx, value of the cells with the given index in each named column; filters reach the scan."""
    for name, index in at.items():
        rows = rows.where(F.col(name) == F.lit(index))
    return rows.select(*CELL, F.col("value").cast("double").alias("value"))


def block_axis(axis: DataFrame, grain: int, size: int) -> DataFrame:
    """The axis (idx, coord) of a grain's blocks: the coordinate of each block's first cell."""
    if grain == 1:
        return axis.select("idx", "coord")
    s = offset(grain)
    number = ((F.col("idx") - s) / grain).cast("int")
    inside = (F.col("idx") >= s) & ((F.col("idx") - s) % grain == 0) & (number < (size - s) // grain)
    return axis.where(inside).select(number.alias("idx"), "coord")


def profile_mean(levels: DataFrame, keys: Sequence[str] = ("time", "category", "profile", "grain")) -> DataFrame:
    """The mean over all cells of each time, category, depth and grain."""
    return levels.groupBy(*keys).agg(F.avg("value").alias("value"))


def nearest_zoom(zooms: DataFrame, requested: int | Column) -> DataFrame:
    """The zoom itself if it is there, else the nearest one, the lower of two; KeyError is the caller's for none."""
    wanted = F.lit(requested) if isinstance(requested, int) else requested
    order = Window.orderBy(F.abs(F.col("zoom") - wanted), "zoom")
    return zooms.select("zoom", F.row_number().over(order).alias("_r")).where("_r = 1").drop("_r")

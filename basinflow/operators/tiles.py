"""Map tiles: bounds, pixels, resampling, thickening and colours."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.grid import CELL, DATA_BOUNDS

BOUNDS = ("lon_min", "lon_max", "lat_min", "lat_max")
#: The neighbours that fill a missing pixel, as (row, column) of the source, first come first.
NEIGHBOURS = ((1, 1), (1, 0), (1, -1), (0, 1), (0, -1), (-1, 1), (-1, 0), (-1, -1))


def mercator_latitude(y: Column, tiles: Column) -> Column:
    n = F.lit(math.pi) - F.lit(2 * math.pi) * y / tiles
    return F.degrees(F.atan(F.lit(0.5) * (F.exp(n) - F.exp(-n))))


def mercator_bounds(tiles: DataFrame) -> DataFrame:
    """``tiles(z, x, y)`` with the bounds of Web Mercator tiles; y = 0 is the northern row."""
    n = F.pow(F.lit(2.0), F.col("z"))
    x, y = F.col("x"), F.col("y")
    return tiles.withColumns({
        "lon_min": x / n * 360 - 180, "lon_max": (x + 1) / n * 360 - 180,
        "lat_min": mercator_latitude(y + 1, n), "lat_max": mercator_latitude(y, n),
    })


def regional_bounds(tiles: DataFrame, bounds: dict[str, float] = DATA_BOUNDS) -> DataFrame:
    """``tiles(z, x, y)`` with the bounds of the data split into 2**z by 2**z; y = 0 is the southern row."""
    n = F.pow(F.lit(2.0), F.col("z"))
    out = {}
    for axis, at in (("lon", "x"), ("lat", "y")):
        low, high = F.lit(bounds[f"{axis}_min"]), F.lit(bounds[f"{axis}_max"])
        step = (high - low) / n
        out |= {f"{axis}_min": low + F.col(at) * step, f"{axis}_max": low + (F.col(at) + 1) * step}
    return tiles.withColumns(out)


def flipped(tiles: DataFrame, mode: str, tms: bool) -> DataFrame:
    """Rows counted from the other end for global tiles that are not asked for as TMS."""
    if mode == "global" and not tms:
        return tiles.withColumn("y", (F.pow(F.lit(2.0), F.col("z")) - 1 - F.col("y")).cast("long"))
    return tiles


def touches(bounds: dict[str, float] = DATA_BOUNDS) -> Column:
    """Whether a tile with bounds meets the data; touching counts."""
    return ~((F.col("lon_max") < bounds["lon_min"]) | (F.col("lon_min") > bounds["lon_max"]) | (F.col("lat_max") < bounds["lat_min"]) | (F.col("lat_min") > bounds["lat_max"]))


def all_tiles(spark: SparkSession, z: int) -> DataFrame:
    """Every tile (z, x, y) of a zoom."""
    n = 1 << z
    return spark.range(n * n).select(F.lit(z).alias("z"), (F.col("id") % n).alias("x"), F.floor(F.col("id") / n).alias("y"))


def evenly(low: Column, high: Column, i: Column, size: int) -> Column:
    """The i-th of ``size`` even steps from low to high, both ends included."""
    return low + i * (high - low) / (size - 1) if size > 1 else low + i * 0


def tile_axes(tiles: DataFrame, resolution: int = 256, keys: Sequence[str] = ("z", "x", "y")) -> DataFrame:
    """Pixel centres along both sides: keys, side ('row' or 'col'), at, coord; row 0 is the northern edge."""
    i = F.col("at")
    coord = F.when(F.col("side") == "row", evenly(F.col("lat_max"), F.col("lat_min"), i, resolution)).otherwise(evenly(F.col("lon_min"), F.col("lon_max"), i, resolution))
    sides = tiles.withColumn("side", F.explode(F.array(F.lit("row"), F.lit("col")))).withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(resolution - 1))))
    return sides.select(*keys, "side", "at", coord.alias("coord"))


def pixel_grid(tiles: DataFrame, resolution: int = 256, keys: Sequence[str] = ("z", "x", "y")) -> DataFrame:
    """Every pixel of the tiles: keys, row, col, lon, lat."""
    steps = F.sequence(F.lit(0), F.lit(resolution - 1))
    pixels = tiles.withColumn("row", F.explode(steps)).withColumn("col", F.explode(steps))
    return pixels.select(*keys, "row", "col", evenly(F.col("lon_min"), F.col("lon_max"), F.col("col"), resolution).alias("lon"), evenly(F.col("lat_max"), F.col("lat_min"), F.col("row"), resolution).alias("lat"))


def axis_row(axis: DataFrame) -> DataFrame:
    """An axis as one row: array ``axis`` of (coord, idx) in ascending order.  Axes are short (thousands)."""
    return axis.agg(F.sort_array(F.collect_list(F.struct("coord", "idx"))).alias("axis"))


def nearest_index(targets: DataFrame, axis: DataFrame, coord: str = "coord") -> DataFrame:
    """``targets`` with idx, the nearest point of the axis (ascending or not), the smaller coordinate of two.

    The axis is one small array that goes to every task, so no pairs are joined.  idx is NULL for an empty axis.
    """
    best = F.array_min(F.transform("axis", lambda a: F.struct(F.abs(a["coord"] - F.col(coord)).alias("d"), a["coord"].alias("c"), a["idx"].alias("i"))))
    return targets.crossJoin(F.broadcast(axis_row(axis))).withColumn("idx", best["i"]).drop("axis")


def sample_nearest(grid: DataFrame, lat_axis: DataFrame, lon_axis: DataFrame, tiles: DataFrame, resolution: int = 256, keys: Sequence[str] = ("z", "x", "y"), layers: Sequence[str] = ()) -> DataFrame:
    """Every pixel of the tiles with the value of the nearest cell: keys, layers, row, col, value.

    Pixels outside the axes' extent (ends included) are missing.  The lookup runs once for each row
    and each column of a tile, not for each pixel.
    """
    points = tile_axes(tiles, resolution, keys)

    def side(name: str, axis: DataFrame, out: str) -> DataFrame:
        ends = axis.agg(F.min("coord").alias("_lo"), F.max("coord").alias("_hi"))
        inside = points.where(F.col("side") == name).crossJoin(F.broadcast(ends)).where(F.col("coord").between(F.col("_lo"), F.col("_hi")))
        return nearest_index(inside, axis).select(*keys, F.col("at").alias("row" if name == "row" else "col"), F.col("idx").alias(out))

    rows, cols = side("row", lat_axis, "lat_idx"), side("col", lon_axis, "lon_idx")
    inside = rows.join(cols, list(keys)).join(grid.select(*layers, *CELL, "value"), list(CELL)).select(*keys, *layers, "row", "col", "value")
    if layers:
        return inside
    return pixel_grid(tiles, resolution, keys).select(*keys, "row", "col").join(inside, [*keys, "row", "col"], "left")


def sample_bilinear(grid: DataFrame, lat_axis: DataFrame, lon_axis: DataFrame, points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``points(keys, lon, lat)`` with the bilinear interpolation of the four cells around them.

    A missing neighbour that has weight, or a point outside the axes, gives a missing value.
    """
    def around(df: DataFrame, axis: DataFrame, coord: str, name: str) -> DataFrame:
        below = F.array_max(F.filter("axis", lambda a: a["coord"] <= F.col(coord)))
        above = F.array_min(F.filter("axis", lambda a: a["coord"] >= F.col(coord)))
        df = df.crossJoin(F.broadcast(axis_row(axis))).withColumns({"_b": below, "_a": above}).drop("axis")
        share = F.when(F.col("_a.coord") == F.col("_b.coord"), F.lit(0.0)).otherwise((F.col(coord) - F.col("_b.coord")) / (F.col("_a.coord") - F.col("_b.coord")))
        return df.withColumns({f"{name}0": F.col("_b.idx"), f"{name}1": F.col("_a.idx"), f"{name}f": share}).drop("_a", "_b")

    placed = around(around(points, lat_axis, "lat", "i"), lon_axis, "lon", "j")
    corners = [
        F.struct(F.col(f"i{a}").alias("lat_idx"), F.col(f"j{b}").alias("lon_idx"), ((F.col("if") if a else 1 - F.col("if")) * (F.col("jf") if b else 1 - F.col("jf"))).alias("w"))
        for a in (0, 1) for b in (0, 1)
    ]
    needed = placed.select(*keys, F.explode(F.array(*corners)).alias("c")).select(*keys, "c.*").where("w IS NULL OR w > 0")
    got = needed.join(grid.select(*CELL, "value"), list(CELL), "left").groupBy(*keys)
    value = F.when(F.count_if(F.col("value").isNull() | F.col("w").isNull()) == 0, F.sum(F.col("value") * F.col("w")))
    return points.join(got.agg(value.alias("value")), list(keys), "left")


def scatter_max(grid: DataFrame, lat_axis: DataFrame, lon_axis: DataFrame, tile: dict[str, float], height: int = 256, width: int = 256) -> DataFrame:
    """Valid cells put into the pixels of one tile; the largest value of a pixel stays: row, col, value.

    Cells within half a spacing of the tile count as inside; half pixels round to even.
    """
    def padded(axis: DataFrame, low: float, high: float, name: str) -> DataFrame:
        pad = axis.agg(((F.max("coord") - F.min("coord")) / F.greatest(F.count("*") - 1, F.lit(1)) * 0.5).alias("_pad"))
        near = F.col("coord").between(F.lit(low) - F.col("_pad"), F.lit(high) + F.col("_pad"))
        return axis.crossJoin(F.broadcast(pad)).where(near).select(F.col("idx").alias(f"{name}_idx"), F.col("coord").alias(name))

    lats, lons = padded(lat_axis, tile["lat_min"], tile["lat_max"], "lat"), padded(lon_axis, tile["lon_min"], tile["lon_max"], "lon")
    col = F.rint((F.col("lon") - tile["lon_min"]) / (tile["lon_max"] - tile["lon_min"]) * (width - 1)).cast("int")
    row = F.rint((F.lit(tile["lat_max"]) - F.col("lat")) / (tile["lat_max"] - tile["lat_min"]) * (height - 1)).cast("int")
    cells = grid.where("value IS NOT NULL").join(F.broadcast(lats), "lat_idx").join(F.broadcast(lons), "lon_idx")
    return cells.select(row.alias("row"), col.alias("col"), "value").where(F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1)).groupBy("row", "col").agg(F.max("value").alias("value"))


def thicken(pixels: DataFrame, height: int, width: int, passes: int = 1, keys: Sequence[str] = ()) -> DataFrame:
    """Valid pixels (keys, row, col, value) grown into missing neighbours; each pass looks at the last one's result.

    A missing pixel takes the value of the first of its valid neighbours in their fixed order, found
    by a minimum over (order, value), which is combined before the shuffle.
    """
    out = pixels.where("value IS NOT NULL").select(*keys, "row", "col", "value")
    offsets = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(-di).alias("di"), F.lit(-dj).alias("dj")) for p, (di, dj) in enumerate(NEIGHBOURS)])
    for _ in range(max(1, passes)):
        grown = out.select(*keys, "row", "col", "value", F.explode(offsets).alias("o")).select(*keys, (F.col("row") + F.col("o.di")).alias("row"), (F.col("col") + F.col("o.dj")).alias("col"), F.col("o.p").alias("p"), "value")
        grown = grown.where(F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1))
        both = out.withColumn("p", F.lit(-1)).unionByName(grown)
        out = both.groupBy(*keys, "row", "col").agg(F.min(F.struct("p", "value"))["value"].alias("value"))
    return out


def stretch(pixels: DataFrame, keys: Sequence[str] = (), vmin: float | None = None, vmax: float | None = None) -> DataFrame:
    """keys, vmin, vmax: given, or the 2nd and 98th percentiles of valid pixels; equal ones are moved apart by 1."""
    ends = pixels.groupBy(*keys).agg(F.percentile("value", F.array(F.lit(0.02), F.lit(0.98))).alias("p"))
    low = F.lit(float(vmin)) if vmin is not None else F.col("p")[0]
    high = F.lit(float(vmax)) if vmax is not None else F.col("p")[1]
    return ends.select(*keys, low.alias("vmin"), high.alias("high")).select(*keys, "vmin", F.when(F.col("vmin") == F.col("high"), F.col("vmin") + 1).otherwise(F.col("high")).alias("vmax"))


def colour_index(pixels: DataFrame, limits: DataFrame, keys: Sequence[str] = (), levels: int = 256) -> DataFrame:
    """Pixels with ``share`` (clipped to 0..1 between the limits) and ``level``, its colour number; missing stay NULL."""
    joined = pixels.join(F.broadcast(limits), list(keys)) if keys else pixels.crossJoin(F.broadcast(limits))
    share = F.least(F.greatest((F.col("value") - F.col("vmin")) / (F.col("vmax") - F.col("vmin")), F.lit(0.0)), F.lit(1.0))
    valid = F.col("value").isNotNull()
    out = joined.withColumn("share", F.when(valid, share))
    return out.withColumn("level", F.when(valid, F.least(F.floor(F.col("share") * levels), F.lit(levels - 1)).cast("int"))).drop("vmin", "vmax")

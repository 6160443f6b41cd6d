"""The raster data model: long tables of cells, and small tables of axes.

A grid is a DataFrame with one row for each cell of each layer: any of ``variable``, ``init_date``,
``time``, ``ensemble``, ``profile``, ``category`` as keys, then ``lat_idx``, ``lon_idx`` and ``value``.
A missing value is NULL, never NaN, so the built-in aggregates skip it.  Axes are tables of ``idx`` and
``coord``.  Joins are on integer indices.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The names under which files hold a coordinate, in order of preference.
COORDINATE_NAMES = {
    "lon": ("east_west", "lon", "longitude"),
    "lat": ("north_south", "lat", "latitude"),
    "time": ("time", "month", "date"),
}
#: The variables of a forecast, those with depth levels, and those reduced by their maximum.
VARIABLES = ("Rainf_tavg", "Qair_f_tavg", "Qs_tavg", "Evap_tavg", "Tair_f_tavg", "SoilMoist_inst", "SoilTemp_inst", "Streamflow_tavg")
LEVELLED = {"SoilMoist_inst": 4, "SoilTemp_inst": 4}
MAX_VARIABLES = ("Streamflow_tavg",)
#: The bounds of the regional grid in degrees.
DATA_BOUNDS = {"lon_min": -81.975, "lon_max": -49.025, "lat_min": -20.975, "lat_max": 5.975}

CELL = ("lat_idx", "lon_idx")


def find_coordinate(columns: Iterable[str], kind: str) -> str:
    """The column that holds the ``lon``, ``lat`` or ``time`` coordinate; AttributeError if there is none."""
    there = set(columns)
    for name in COORDINATE_NAMES[kind]:
        if name in there:
            return name
    raise AttributeError(f"no {kind} coordinate among {sorted(there)}")


def standard_coordinates(df: DataFrame) -> DataFrame:
    """``df`` with its coordinate columns named lon, lat and time, where it has them."""
    for kind in COORDINATE_NAMES:
        try:
            name = find_coordinate(df.columns, kind)
        except AttributeError:
            continue
        df = df.withColumnRenamed(name, kind)
    return df


def find_profile(columns: Iterable[str]) -> str | None:
    """The first column whose name speaks of a profile (depth), in lower case or not."""
    return next((c for c in columns if "profile" in c.lower()), None)


def output_columns(variables: Sequence[str] = VARIABLES, levels: dict[str, int] | None = None) -> list[str]:
    """Value columns of the wide tables: one for a variable, or one for each of its levels."""
    levels = LEVELLED if levels is None else levels
    return [c for v in variables for c in ([f"{v}_lvl_{k}" for k in range(levels[v])] if v in levels else [v])]


def value_column(variable: str = "variable", profile: str = "profile") -> Column:
    """The name of the wide column that a row of a long table belongs to."""
    return F.when(F.col(profile).isNull(), F.col(variable)).otherwise(F.concat_ws("_lvl_", F.col(variable), F.col(profile).cast("string")))


def clean(df: DataFrame, *columns: str) -> DataFrame:
    """NaN as NULL in the given columns (``value`` by default), as doubles: the rule at every scan."""
    return df.withColumns({c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns or ("value",)})


def axis(spark: SparkSession, coords: Sequence[float]) -> DataFrame:
    """An axis table (idx, coord)."""
    return spark.createDataFrame(list(enumerate(map(float, coords))), "idx int, coord double")


def regular_axis(spark: SparkSession, start: float, step: float, size: int) -> DataFrame:
    """The axis start, start + step, ...; generated, not collected."""
    return spark.range(size).select(F.col("id").cast("int").alias("idx"), (F.lit(float(start)) + F.col("id") * F.lit(float(step))).alias("coord"))


def axis_extent(axes: DataFrame, *keys: str) -> DataFrame:
    """Smallest and largest coordinate, and the number of points."""
    return axes.groupBy(*keys).agg(F.min("coord").alias("lo"), F.max("coord").alias("hi"), F.count("*").alias("size"))


def grid_spacing(axes: DataFrame, *keys: str) -> DataFrame:
    """Mean distance of neighbouring coordinates, without sign; NULL for a single point."""
    step = F.col("coord") - F.lag("coord").over(Window.partitionBy(*keys).orderBy("idx"))
    return axes.select(*keys, step.alias("step")).groupBy(*keys).agg(F.abs(F.avg("step")).alias("spacing"))


def valid_share(grid: DataFrame, *keys: str) -> DataFrame:
    """How many cells there are, how many are missing, and their share."""
    missing = F.count_if(F.col("value").isNull())
    return grid.groupBy(*keys).agg(F.count("*").alias("cells"), missing.alias("missing"), (missing / F.count("*")).alias("missing_share"))


def combine(grids: Sequence[DataFrame]) -> DataFrame:
    """Several files as one grid: the outer union of their coordinates and columns."""
    out = grids[0]
    for g in grids[1:]:
        out = out.unionByName(g, allowMissingColumns=True)
    return out


def masked(grid: DataFrame, mask: DataFrame, flag: str = "mask") -> DataFrame:
    """``grid`` with values outside the mask missing; cells stay.  ``mask`` has lat_idx, lon_idx and a flag."""
    inside = mask.where(F.col(flag).cast("boolean")).select(*CELL, F.lit(True).alias("_inside"))
    return grid.join(inside, list(CELL), "left").withColumn("value", F.when(F.col("_inside"), F.col("value"))).drop("_inside")

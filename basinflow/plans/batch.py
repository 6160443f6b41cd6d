"""A forecast run from grids to published tables, as lazy plans over all variables at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.grid import CELL, MAX_VARIABLES, masked, output_columns, value_column
from basinflow.operators import probability, pyramid, zonal
from basinflow.sinks import write_grid, write_index, write_text
from basinflow.sources.documents import meta_document


@dataclass
class Run:
    """The lazy results of a run."""

    probability: DataFrame
    dominant: DataFrame
    levels: DataFrame
    forecast: DataFrame
    climatology: DataFrame


def probabilities(hindcast: DataFrame, forecast: DataFrame, river: DataFrame | None = None, quantiles: Sequence[float] = probability.TERCILES, members: int | None = None) -> DataFrame:
    """Percent of members in each category of every variable; stream flow only where there are rivers."""
    cell = ("variable", "profile", *CELL)
    fill = lambda df: df.withColumn("profile", F.coalesce("profile", F.lit(-1)))
    prob = probability.percent(probability.category_probability(fill(hindcast), fill(forecast), quantiles, cell, ("time",), members))
    prob = prob.withColumn("profile", F.nullif(F.col("profile"), F.lit(-1)))
    if river is None:
        return prob
    on_river = F.col("variable").isin(*MAX_VARIABLES)
    return prob.where(~on_river).unionByName(masked(prob.where(on_river), river))


def run(hindcast: DataFrame, forecast: DataFrame, membership: DataFrame, grains: Sequence[int], nlat: int, nlon: int, river: DataFrame | None = None) -> Run:
    """Everything of a run; nothing is computed before a result is written."""
    prob = probabilities(hindcast, forecast, river)
    dominant = probability.dominant_category(prob, ("variable", "profile", "time", *CELL))
    levels = pyramid.pyramid(dominant, grains, nlat, nlon, ("variable", "profile", "time", "category"))
    named = forecast.withColumn("column", value_column())
    reduced = zonal.zonal_statistics(named.withColumn("variable", F.col("column")), membership)
    table = zonal.wide(reduced, output_columns(), ("time", "ensemble", "pfaf_id"))
    monthly = zonal.monthly_climatology(hindcast.withColumn("variable", value_column()), F.month("time"), ("variable", "ensemble", *CELL))
    normal = zonal.wide(zonal.zonal_climatology(monthly, membership), output_columns(), ("month", "pfaf_id"))
    return Run(prob, dominant, levels, table, normal)


def publish_pyramids(spark: SparkSession, levels: DataFrame, zooms: dict[int, int], lat: DataFrame, lon: DataFrame, root: str, tag: str) -> list[str]:
    """Write the pyramids of a run to where :class:`basinflow.plans.service.TileEngine` reads them; their stems.

    ``levels`` (variable, profile, time, category, grain, lat_idx, lon_idx, value) are those of :func:`run`, ``zooms``
    gives each zoom's grain, ``lat`` and ``lon`` are the axes (idx, coord) of the finest grid.  Each variable gets a
    folder with levels, axes, times and its metadata; the index that names the run is written last.
    """
    sizes = {name: axis.agg(F.count("*"), F.min("coord"), F.max("coord")).first() for name, axis in (("lat", lat), ("lon", lon))}
    bounds = {f"{name}_{end}": size[i] for name, size in sizes.items() for i, end in ((1, "min"), (2, "max"))}
    axes = None
    for grain in sorted(set(zooms.values())):
        for name, axis in (("lat", lat), ("lon", lon)):
            one = pyramid.block_axis(axis, grain, sizes[name][0]).select(F.lit(grain).alias("grain"), F.lit(name).alias("name"), "idx", "coord")
            axes = one if axes is None else axes.unionByName(one)
    written = []
    for (variable,) in sorted(levels.select("variable").distinct().collect()):  # a run has a few variables
        stem = f"{tag}_tercile_prob_max_{variable}"
        own = levels.where(F.col("variable") == variable)
        moments = sorted(r.time for r in own.select("time").distinct().collect())
        times = spark.createDataFrame(list(enumerate(moments)), f"time_idx int, time {levels.schema['time'].dataType.simpleString()}")
        shape = own.agg((F.max("category") + 1).alias("categories"), F.count_distinct("profile").alias("depths")).first()
        rows = own.join(F.broadcast(times), "time").select("time_idx", "category", "profile", "grain", "lat_idx", "lon_idx", "value")
        write_grid(rows, f"{root}/{stem}/levels", ("grain",))
        axes.coalesce(1).write.mode("overwrite").parquet(f"{root}/{stem}/axes")
        times.coalesce(1).write.mode("overwrite").parquet(f"{root}/{stem}/times")
        depth = ("SoilMoist_profiles" if "Moist" in variable else "SoilTemp_profiles", shape.depths) if shape.depths else (None, None)
        write_text(spark, meta_document(stem, list(zooms), zooms, bounds, len(moments), shape.categories, *depth), f"{root}/{stem}/{stem}_meta.json")
        written.append(stem)
    write_index(spark, tag, f"{root}/index.json")
    return written

"""Zonal statistics, climatology and point-in-polygon membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinflow.grid import CELL, MAX_VARIABLES


def polygon_edges(zones: DataFrame, zone: str = "pfaf_id", ring: str = "ring") -> DataFrame:
    """Edges (zone, x1, y1, x2, y2) of ``ring``, an array of structs x, y; an open ring is closed."""
    points = F.posexplode(ring)
    size, at = F.size("_ring"), F.col("_i")
    following = F.element_at("_ring", F.when(at + 2 <= size, at + 2).otherwise(1))
    return (
        zones.select(F.col(zone), F.col(ring).alias("_ring"), points.alias("_i", "_p"))
        .select(zone, F.col("_p.x").alias("x1"), F.col("_p.y").alias("y1"), following["x"].alias("x2"), following["y"].alias("y2"))
        .where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))
    )


def basin_membership(cells: DataFrame, edges: DataFrame, zone: str = "pfaf_id", bucket: float = 1.0) -> DataFrame:
    """Which cells (lat_idx, lon_idx, lon, lat) lie in which zones: by the parity of crossings of a ray.

    Buckets of ``bucket`` degrees in latitude turn the range condition between cells and edges into
    an equi-join: a horizontal ray only meets edges whose latitudes it lies between.  Zones of
    several polygons are their union as long as these do not overlap.
    """
    slot = lambda c: F.floor(c / F.lit(float(bucket))).cast("int")
    span = F.sequence(slot(F.least("y1", "y2")), slot(F.greatest("y1", "y2")))
    slotted = edges.where("y1 != y2").withColumn("_slot", F.explode(span))
    extent = edges.groupBy(zone).agg(F.min("x1").alias("_x0"), F.max("x1").alias("_x1"))
    crossing = F.col("lon") < (F.col("x2") - F.col("x1")) * (F.col("lat") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    hits = (
        cells.select(*CELL, "lon", "lat", slot(F.col("lat")).alias("_slot"))
        .join(slotted.join(extent, zone), "_slot")
        .where(F.col("lon").between(F.col("_x0"), F.col("_x1")) & ((F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat"))) & crossing)
    )
    return hits.groupBy(zone, *CELL).agg(F.count("*").alias("crossings")).where("crossings % 2 = 1").select(zone, *CELL)


def reduced(variable: str, max_variables: Sequence[str] = MAX_VARIABLES) -> Column:
    """The zonal reduction of a variable's values, a grouping column: the maximum for some, the plain mean otherwise."""
    return F.when(F.col(variable).isin(*max_variables), F.max("value")).otherwise(F.avg("value"))


def zonal_statistics(grid: DataFrame, membership: DataFrame, zone: str = "pfaf_id", keys: Sequence[str] = ("time", "ensemble"), max_variables: Sequence[str] = MAX_VARIABLES) -> DataFrame:
    """zone, keys, variable, value: every zone, time, member and variable by one join and one aggregation."""
    return grid.join(membership, list(CELL)).groupBy(zone, *keys, "variable").agg(reduced("variable", max_variables).alias("value"))


def wide(statistics: DataFrame, columns: Sequence[str], keys: Sequence[str], name: str = "variable") -> DataFrame:
    """One row for each key with the given columns in that order; a column without rows is NULL."""
    return statistics.groupBy(*keys).pivot(name, list(columns)).agg(F.first("value"))


def zonal_by_time(grid: DataFrame, time: str = "time", maximum: bool = False) -> DataFrame:
    """One value for each time: the mean over all cells, or the maximum."""
    return grid.groupBy(time).agg((F.max("value") if maximum else F.avg("value")).alias("value"))


def monthly_climatology(hindcast: DataFrame, month: Column, keys: Sequence[str] = ("ensemble", *CELL)) -> DataFrame:
    """Mean over the times of each calendar month, for every member and cell."""
    return hindcast.withColumn("month", month).groupBy("month", *keys).agg(F.avg("value").alias("value"))


def zonal_climatology(climatology: DataFrame, membership: DataFrame, zone: str = "pfaf_id", keys: Sequence[str] = (), max_variables: Sequence[str] = MAX_VARIABLES) -> DataFrame:
    """zone, month, variable, value from a monthly climatology: the mean over members, then over the zone.

    The means are staged: with missing values, one mean over everything would differ.
    """
    over_members = climatology.groupBy("month", "variable", *keys, *CELL).agg(F.avg("value").alias("value"))
    return over_members.join(membership, list(CELL)).groupBy(zone, "month", "variable", *keys).agg(reduced("variable", max_variables).alias("value"))


def upserted(existing: DataFrame | None, new: DataFrame, key: str = "time") -> DataFrame:
    """The outer merge of two wide tables on their key; on shared columns the new table's values win where it has some."""
    if existing is None:
        return new
    shared = [c for c in new.columns if c in existing.columns and c != key]
    fresh = new.select(key, *[F.col(c).alias(f"_new_{c}") if c in shared else F.col(c) for c in new.columns if c != key])
    merged = existing.join(fresh, key, "full_outer")
    return merged.withColumns({c: F.coalesce(f"_new_{c}", c) for c in shared}).drop(*[f"_new_{c}" for c in shared]) if shared else merged


def anomaly(forecast: DataFrame, climatology: DataFrame, zone: str = "pfaf_id") -> DataFrame:
    """Extension: zonal forecast (zone, time, ensemble, variable, value) less the climatology of its month."""
    base = climatology.select(zone, "month", "variable", F.col("value").alias("normal"))
    return forecast.withColumn("month", F.month("time")).join(base, [zone, "month", "variable"]).withColumn("anomaly", F.col("value") - F.col("normal"))

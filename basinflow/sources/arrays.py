"""Array files as long tables: NPZ bundles with numpy; NetCDF and Zarr where their libraries are installed."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.grid import clean, find_coordinate, find_profile

LONG = "path string, zoom int, time timestamp, category int, profile int, lat_idx int, lon_idx int, lat double, lon double, value double"


def layers(values: np.ndarray, times: int, categories: int, levels: int | None) -> np.ndarray:
    """Values with axes (time, category, level, lat, lon), whichever of the first two comes first; ValueError otherwise."""
    inner = () if levels is None else (levels,)
    if values.shape[: 2 + len(inner)] == (times, categories, *inner):
        ordered = values
    elif values.shape[: 2 + len(inner)] == (categories, times, *inner):
        ordered = values.swapaxes(0, 1)
    else:
        raise ValueError(f"shape {values.shape} does not fit {times} times and {categories} categories")
    return ordered if levels is not None else ordered[:, :, None]


def bundle_rows(content: bytes, path: str, zooms: list[int] | None = None) -> Iterator[pd.DataFrame]:
    """The rows of one bundle, a layer at a time; only the members of the wanted zooms are unpacked."""
    with np.load(io.BytesIO(content), allow_pickle=False) as bundle:
        there = sorted(int(n[1:-7]) for n in bundle.files if n.startswith("z") and n.endswith("_values"))
        times, categories = pd.to_datetime(bundle["time"]), bundle["category"]
        levels = len(bundle["profile_depth"]) if "profile_depth" in bundle.files else None
        for zoom in there if zooms is None else [z for z in zooms if z in there]:
            values = layers(bundle[f"z{zoom}_values"], len(times), len(categories), levels)
            lat, lon = bundle[f"z{zoom}_lat"].astype(float), bundle[f"z{zoom}_lon"].astype(float)
            i, j = np.indices((len(lat), len(lon)))
            for t in range(values.shape[0]):
                for c in range(values.shape[1]):
                    for p in range(values.shape[2]):
                        layer = values[t, c, p].astype(float).ravel()
                        yield pd.DataFrame({
                            "path": path, "zoom": zoom, "time": times[t], "category": int(categories[c]), "profile": pd.array([p if levels is not None else None] * layer.size, "Int32"),
                            "lat_idx": i.ravel().astype(np.int32), "lon_idx": j.ravel().astype(np.int32), "lat": lat[i.ravel()], "lon": lon[j.ravel()], "value": layer,
                        })


def read_bundles(spark: SparkSession, path: str, zooms: list[int] | None = None) -> DataFrame:
    """NPZ pyramid bundles as a long table; files are read by Spark, so any store will do."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"]):
                yield from bundle_rows(content, name, zooms)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path).select("path", "content")
    return clean(files.mapInPandas(run, LONG))


def bundle_bytes(rows: pd.DataFrame, grains: dict[int, int]) -> bytes:
    """One bundle from the long rows (zoom, time, category, profile, lat_idx, lon_idx, lat, lon, value) of a stem."""
    times, categories = np.sort(rows["time"].unique()), np.sort(rows["category"].unique())
    profiled = rows["profile"].notna().any()
    arrays: dict[str, np.ndarray] = {"time": times.astype("datetime64[ns]"), "category": categories}
    depths = np.sort(rows["profile"].dropna().unique()).astype(np.float32) if profiled else np.zeros(1, np.float32)
    if profiled:
        arrays["profile_depth"] = depths
    for zoom, part in rows.groupby("zoom"):
        lat = part.drop_duplicates("lat_idx").sort_values("lat_idx")["lat"].to_numpy()
        lon = part.drop_duplicates("lon_idx").sort_values("lon_idx")["lon"].to_numpy()
        values = np.full((len(times), len(categories), len(depths), len(lat), len(lon)), np.nan, np.float32)
        level = np.searchsorted(depths, part["profile"].to_numpy(float)) if profiled else 0
        values[np.searchsorted(times, part["time"].to_numpy()), np.searchsorted(categories, part["category"].to_numpy()), level, part["lat_idx"], part["lon_idx"]] = part["value"]
        arrays |= {f"z{zoom}_values": values if profiled else values[:, :, 0], f"z{zoom}_lat": lat.astype(np.float32), f"z{zoom}_lon": lon.astype(np.float32), f"z{zoom}_grain": np.array([grains[int(zoom)]], np.int16)}
        if profiled:
            with np.errstate(invalid="ignore"):
                count = np.isfinite(values).sum((-2, -1))
                arrays[f"z{zoom}_profile_mean"] = np.where(count, np.nansum(values, (-2, -1)) / np.maximum(count, 1), np.nan).astype(np.float32)
    out = io.BytesIO()
    np.savez_compressed(out, **arrays)
    return out.getvalue()


def open_arrays(path: str, variable: str, engine: str):
    """A labelled array of a NetCDF or Zarr file; ImportError where the library is missing, KeyError for a missing variable."""
    import xarray

    opened = xarray.open_dataset(path, engine=engine)
    if variable not in opened:
        raise KeyError(f"{variable} is not in {path}: {sorted(opened.data_vars)}")
    return opened[variable]


def read_rasters(spark: SparkSession, paths: list[str], variable: str, engine: str = "netcdf4") -> DataFrame:
    """One variable of several files as a long grid (path, time, ensemble, profile, lat_idx, lon_idx, value), a task for each file.

    Needs xarray and the engine's library on the executors, and a path that they can open.
    """
    schema = "path string, time timestamp, ensemble int, profile int, lat_idx int, lon_idx int, value double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path in b["path"]:
                data = open_arrays(path, variable, engine)
                lat, lon, time = (find_coordinate(data.dims, k) for k in ("lat", "lon", "time"))
                depth = find_profile(data.dims)
                data = data.assign_coords({lat: range(data.sizes[lat]), lon: range(data.sizes[lon])})
                for t in data[time].values:
                    frame = data.sel({time: t}).to_dataframe(name="value").reset_index().rename(columns={lat: "lat_idx", lon: "lon_idx", **({depth: "profile"} if depth else {})})
                    for name in ("ensemble", "profile"):
                        if name not in frame:
                            frame[name] = pd.array([None] * len(frame), "Int32")
                    yield frame.assign(path=path, time=pd.Timestamp(t))[["path", "time", "ensemble", "profile", "lat_idx", "lon_idx", "value"]]

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    return clean(files.mapInPandas(run, schema))


def read_grid(spark: SparkSession, paths: list[str] | str, variable: str | None = None) -> DataFrame:
    """Grids kept as Parquet, partitioned by variable; KeyError for a variable that is not there."""
    paths = [paths] if isinstance(paths, str) else paths
    grid = spark.read.option("mergeSchema", "true").parquet(*paths)
    if variable is not None:
        grid = grid.where(F.col("variable") == variable)
        if grid.isEmpty():
            raise KeyError(f"{variable} is not in {paths}")
    return clean(grid)

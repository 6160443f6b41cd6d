"""Zarr (format 2) arrays as long tables: every chunk file is decoded by the task that reads it.

Compressors: none, zlib, gzip and zstd; others need numcodecs on the executors.  A chunk that is not
stored holds fill values only and gives no rows.
"""

from __future__ import annotations

import gzip
import json
import zlib
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from basinflow.grid import clean, combine

#: Index columns of the dimensions that grids name otherwise.
INDEX_NAMES = {"lat": "lat_idx", "lon": "lon_idx", "north_south": "lat_idx", "east_west": "lon_idx"}


def decompressed(data: bytes, compressor: dict | None) -> bytes:
    kind = compressor and compressor["id"]
    if kind is None:
        return data
    if kind == "zlib":
        return zlib.decompress(data)
    if kind == "gzip":
        return gzip.decompress(data)
    if kind == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    import numcodecs

    return bytes(numcodecs.get_codec(compressor).decode(data))


def small_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file (Spark's readers skip names that begin with a dot); None if there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def array_meta(spark: SparkSession, path: str) -> dict:
    """Shape, chunks, type, compressor and dimension names of an array; KeyError if it is not there."""
    text = small_file(spark, f"{path}/.zarray")
    if text is None:
        raise KeyError(f"no array at {path}")
    meta = json.loads(text)
    attributes = json.loads(small_file(spark, f"{path}/.zattrs") or "{}")
    if meta.get("filters"):
        raise ValueError(f"filters are not supported: {meta['filters']}")
    return meta | {"attributes": attributes, "dimensions": attributes.get("_ARRAY_DIMENSIONS") or [f"dim_{k}" for k in range(len(meta["shape"]))]}


def chunk_values(data: bytes, key: str, meta: dict) -> tuple[np.ndarray, list[np.ndarray]]:
    """Values of a chunk inside the array's bounds, and their indices along each dimension."""
    values = np.frombuffer(decompressed(data, meta["compressor"]), np.dtype(meta["dtype"])).reshape(meta["chunks"], order=meta.get("order", "C"))
    starts = [int(k) * c for k, c in zip(key.split("."), meta["chunks"])] if meta["shape"] else []
    sizes = [min(c, n - s) for c, n, s in zip(meta["chunks"], meta["shape"], starts)]
    inside = values[tuple(slice(0, n) for n in sizes)]
    return inside, [(np.indices(inside.shape)[k] + s).ravel() for k, s in enumerate(starts)]


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """An array as rows of its indices and its value; fill values and NaN are NULL.

    Dimensions lat and lon (and their other names) become lat_idx and lon_idx, others ``{name}_idx``.
    """
    meta = array_meta(spark, path)
    columns = [INDEX_NAMES.get(d, f"{d}_idx") for d in meta["dimensions"]]
    separator, depth = meta.get("dimension_separator", "."), len(meta["shape"])
    fill = meta["fill_value"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"]):
                key = ".".join(name.split("/")[-depth:]) if separator == "/" else name.split("/")[-1]
                values, indices = chunk_values(content, key, meta)
                flat = values.ravel().astype(float)
                if isinstance(fill, (int, float)) and not isinstance(fill, bool):
                    flat[flat == fill] = np.nan
                yield pd.DataFrame({**{c: i.astype(np.int32) for c, i in zip(columns, indices)}, "value": flat})

    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(separator == "/").lower())
    return clean(reader.load(path).select("path", "content").mapInPandas(run, ", ".join(f"{c} int" for c in columns) + ", value double"))


def decoded_times(numbers: list[float], units: str) -> list[datetime]:
    """Times from numbers in ``days since ...``, ``hours since ...`` and so on."""
    unit, _, origin = units.partition(" since ")
    step = {"days": 86400, "hours": 3600, "minutes": 60, "seconds": 1}[unit.strip().lower()]
    start = datetime.fromisoformat(origin.strip().replace("Z", ""))
    return [start + timedelta(seconds=float(n) * step) for n in numbers]


def read_coordinate(spark: SparkSession, path: str) -> DataFrame:
    """A one-dimensional coordinate array as an axis (idx, coord), with time where its attributes give units."""
    meta = array_meta(spark, path)
    column = INDEX_NAMES.get(meta["dimensions"][0], f"{meta['dimensions'][0]}_idx")
    rows = sorted(read_array(spark, path).select(column, "value").collect())  # an axis is short
    units = meta["attributes"].get("units", "")
    if " since " in units:
        times = decoded_times([r[1] for r in rows], units)
        return spark.createDataFrame([(r[0], r[1], t) for r, t in zip(rows, times)], "idx int, coord double, time timestamp")
    return spark.createDataFrame([(r[0], r[1]) for r in rows], "idx int, coord double")


def read_variable(spark: SparkSession, root: str, variable: str) -> DataFrame:
    """One variable of a group as a grid: time from its coordinate array where there is one, other indices as they are."""
    grid = read_array(spark, f"{root}/{variable}")
    if "time_idx" in grid.columns and small_file(spark, f"{root}/time/.zarray") is not None:
        times = read_coordinate(spark, f"{root}/time")
        if "time" in times.columns:
            grid = grid.join(times.withColumnRenamed("idx", "time_idx").select("time_idx", "time"), "time_idx").drop("time_idx")
    return grid


def read_stores(spark: SparkSession, roots: Sequence[str], variable: str) -> DataFrame:
    """One variable of several groups as one grid: the outer union of what they hold; KeyError for a group without it."""
    return combine([read_variable(spark, root, variable) for root in roots])

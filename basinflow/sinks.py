"""Writers: grids, pyramids, basin tables, the run index, retention."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.functions.names import stale
from basinflow.operators.zonal import upserted
from basinflow.sources.arrays import bundle_bytes


def write_grid(grid: DataFrame, path: str, by: Sequence[str] = ("variable", "init_date"), mode: str = "overwrite") -> None:
    """Values as float, partitioned; rows sorted by cell so that windows of cells skip row groups.

    Ranges of (partition, cell) go to tasks, so a large layer is written by many and a small one by one.
    """
    out = grid.withColumn("value", F.col("value").cast("float"))
    out = out.repartitionByRange(*by, "lat_idx", "lon_idx").sortWithinPartitions(*by, "lat_idx", "lon_idx") if by else out
    writer = out.write.mode(mode).option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_pyramid(levels: DataFrame, path: str) -> None:
    """A pyramid, partitioned by variable and grain: a request for one zoom reads one partition."""
    write_grid(levels, path, ("variable", "grain"))


def write_basin_csv(table: DataFrame, path: str, zone: str = "pfaf_id", order: Sequence[str] = ("time", "ensemble")) -> None:
    """A wide table as CSV with a header, one file for each basin in a folder of its own; the basin also stays a column."""
    out = table.withColumn("basin", F.col(zone)).repartition("basin").sortWithinPartitions("basin", *order)
    out.write.mode("overwrite").partitionBy("basin").option("header", True).csv(path)


def read_basin_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def upsert_table(spark: SparkSession, new: DataFrame, path: str, key: str = "time") -> None:
    """Merge a wide table into the one at ``path``.

    The merged table is written beside it, as it is read meanwhile; then the old one is renamed away, the new one takes
    its place, and only then the old one goes.  After a failure between the renames the old table is beside its place,
    and the next call puts it back first.
    """
    Path = spark._jvm.org.apache.hadoop.fs.Path
    at, beside, old = (Path(path.rstrip("/") + end) for end in ("", ".new", ".old"))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())

    def rename(a, b) -> None:
        if not fs.rename(a, b):
            raise OSError(f"{a} could not be renamed to {b}")

    if fs.exists(old) and not fs.exists(at):
        rename(old, at)
    fs.delete(old, True)
    existing = spark.read.parquet(path) if fs.exists(at) else None
    upserted(existing, new, key).write.mode("overwrite").parquet(beside.toString())
    if existing is not None:
        rename(at, old)
    rename(beside, at)
    fs.delete(old, True)


def write_index(spark: SparkSession, tag: str, path: str) -> None:
    """The run index: which run is the latest."""
    write_text(spark, json.dumps({"initialization_date": tag}, indent=2), path)


def write_bytes(spark: SparkSession, data: bytes, path: str) -> None:
    """One small file through the file system that the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(data)
    finally:
        out.close()


def write_text(spark: SparkSession, text: str, path: str) -> None:
    write_bytes(spark, text.encode(), path)


def bundles(levels: DataFrame, grains: dict[int, int]) -> DataFrame:
    """stem and content of an NPZ bundle for each stem of ``levels(stem, zoom, time, category, profile, lat_idx, lon_idx, lat, lon, value)``.

    A bundle is one file by its format, so a stem is built in one task; Parquet pyramids have no such bound.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"stem": [rows["stem"].iloc[0]], "content": [bundle_bytes(rows, grains)]})

    return levels.groupBy("stem").applyInPandas(run, "stem string, content binary")


def folder_entries(spark: SparkSession, folder: str) -> DataFrame:
    """name and path of the entries of a folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return spark.createDataFrame([(f.getPath().getName(), f.getPath().toString()) for f in found], "name string, path string")


def purge_list(entries: DataFrame, tag: str) -> DataFrame:
    """Entries of other runs than ``tag``, JSON files aside."""
    return entries.where(stale(F.col("name"), F.lit(tag)))


def purge(spark: SparkSession, folder: str, tag: str) -> list[str]:
    """Delete the entries of other runs; their names."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = purge_list(folder_entries(spark, folder), tag).collect()
    for row in gone:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(row.path), True)
    return sorted(r.name for r in gone)


def publish(spark: SparkSession, grid: DataFrame, root: str, tag: str) -> None:
    """A run's table in a folder of its own, then the index that names it, then the retention of that run alone."""
    write_grid(grid, f"{root}/runs/{tag}", ("variable",))
    write_index(spark, tag, f"{root}/index.json")
    purge(spark, f"{root}/runs", tag)

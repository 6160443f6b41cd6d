"""The catalogue of forecast files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.functions.names import PREFIX, init_date


def list_files(spark: SparkSession, folder: str, pattern: str = "*.nc", recursive: bool = False) -> DataFrame:
    """path, name, mtime, length of the files of a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    return reader.load(folder).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("modificationTime").alias("mtime"), "length")


def forecast_files(files: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """Files (name, mtime, ...) whose names hold a date, with init."""
    named = files.where(F.startswith("name", F.lit(prefix)) & F.endswith("name", F.lit(".nc")))
    return named.withColumn("init", init_date(F.col("name"))).where("init IS NOT NULL")


def latest_file(files: DataFrame) -> DataFrame:
    """The one file with the largest (init, mtime, name)."""
    columns = files.columns
    return files.agg(F.max_by(F.struct(*columns), F.struct("init", "mtime", "name")).alias("f")).where("f IS NOT NULL").select("f.*")


def hindcast_files(files: DataFrame, before_year: int = 2021) -> DataFrame:
    """Files of the first day of the latest file's month in years before ``before_year``, oldest first."""
    month = latest_file(files).select(F.month("init").alias("_month"))
    hit = (F.year("init") < before_year) & (F.month("init") == F.col("_month")) & (F.dayofmonth("init") == 1)
    return files.crossJoin(F.broadcast(month)).where(hit).drop("_month").orderBy("init", "name")


def numbered_paths(spark: SparkSession, template: str, first: int, last: int) -> DataFrame:
    """Paths for every year of a range, from a format string."""
    return spark.range(first, last + 1).select(F.format_string(template, "id").alias("path"))

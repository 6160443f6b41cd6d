"""New files as they come: cleaned grids, and zonal tables that are merged batch by batch.

An extension: runs are monthly, so a stream is started with ``availableNow`` and ends by itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basinflow.grid import clean


def grid_stream(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet") -> DataFrame:
    """Parquet grids that arrive in a folder, with missing values as NULL."""
    raw = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    return clean(raw) if "value" in raw.columns else raw


def table_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table as a stream, a single file or a folder of part files of any names; a path that is absent raises."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    single = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isFile()
    # a stream takes a single file only by a glob; this one matches nothing else
    return grid_stream(spark, f"{path[:-1]}[{path[-1]}]" if single else path, schema, "*")


def windowed_means(stream: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    """Means of time windows with a watermark: rows later than ``late`` are left out and state is dropped."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.avg("value").alias("mean"))


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Hand all files there are to ``each`` in batches, exactly once over restarts by the checkpoint, and end."""
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each).trigger(availableNow=True).start()

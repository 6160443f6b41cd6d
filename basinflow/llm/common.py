"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import threading
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.session import importable, shared_base

#: Arrow batches are bounded in rows and in bytes, so that a few very long texts do not fill a worker.
BATCH_ROWS = 1024
BATCH_BYTES = 4 << 20
#: Rows that a scan decodes at once, and bytes that a writer gathers: with texts of many KB the defaults are arrays of tens of MB.
SCAN_ROWS = 256
WRITE_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers receive, and let workers import this package."""
    importable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(SCAN_ROWS))


def release() -> None:
    """Give freed memory back: Python workers live on between tasks, and their memory is the executor's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function of a mapInArrow, followed by :func:`release`."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return wrapped


_own = threading.local()


def folders() -> list[str]:
    """Folders of intermediate tables that this thread has written, in order."""
    if not hasattr(_own, "folders"):
        _own.folders = []
    return _own.folders


def shared_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share; it goes when the application ends."""
    own = f"{shared_base(spark)}/basinflow/{spark.sparkContext.applicationId}"
    fs, where = file_system(spark, own)
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return f"{own}/{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """(Hadoop's file system of a path, the path)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def cut(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, executors may go."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.option("compression", "zstd").option("parquet.block.size", str(WRITE_BYTES)).parquet(path)
    folders().append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, since: int, keep: int = 1) -> None:
    """Delete the intermediate tables written from number ``since`` of :func:`folders` on, but for the last ``keep``."""
    written = folders()
    end = len(written) - keep
    for path in written[since:end]:
        fs, where = file_system(spark, path.rpartition("/")[0])
        fs.delete(where, True)
    del written[since:end]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that the text operators read, null texts as empty ones."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

"""Shared-folder staging and row slicing for the operators of this package."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from lodestar.session import ensure_checkpoint_dir

#: Text bytes that one vectorised step works on; bounds the memory of a task.
SLICE_BYTES = 1 << 20


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers with the job, once an application.

    Workers then need no installation and no shared folder for the code.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="lodestar-code-"), "lodestar-code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


class Scratch:
    """Intermediate tables of one operator run, under ``spark.checkpoint.dir``.

    ``put`` writes a frame as Parquet through Spark's committer and returns a
    frame that reads it back, which cuts the lineage and survives lost
    executors.  ``keep`` holds a short-lived table as blocks on the executors'
    disks: no file for each task, and lost blocks are computed again; the
    lineage goes on, so every few steps one table is ``put``.  ``drop`` removes
    tables that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        ship_code(spark)
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self.kept: dict[str, DataFrame] = {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.kept[name] = df.persist(StorageLevel.DISK_ONLY)
        df.count()
        return df

    def settle(self) -> None:
        """Let go of the shuffle files of finished steps.

        Spark deletes them when the driver's garbage collection finds that no
        frame refers to them; without asking, that may be long after.  The
        first collection frees what held on to the last step's shuffles, the
        second, a moment later, the shuffles.
        """
        for _ in range(2):
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            time.sleep(0.5)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            if name in self.kept:
                self.kept.pop(name).unpersist()
                continue
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partitions, the cluster's own measure of its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; a null row is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """(first, end) row ranges of at most ``limit`` bytes each, one row at least."""
    n, first = len(offsets) - 1, 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end
        first = end

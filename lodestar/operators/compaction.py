"""Compaction: small files of a stored table are merged, large ones stay as they are.

1. Files are listed with their sizes by Spark; the small ones of each folder
   are packed, in the order of their names (which is the clustering order of a
   written table), into bins of about the target size; the last one of a folder
   goes with the one before it.
2. The rows of each bin are written by one task, in the order of files and
   rows, into a hidden folder inside the table, which readers skip.  Spark
   prunes all large files from that scan by their size.
3. Plan and new files are committed by Spark's writer; only then the packed
   files go and the new ones move into their places.  A run that ends in between
   is completed by the next call (or by ``finish``): the plan tells what is
   left to do, and each step may be repeated.  Without a committed plan nothing
   has changed.

Between the first removal and the last move, readers of the folder would miss
rows: compact a table that nobody reads meanwhile, such as a release before it
is published.

Results for edge cases: an empty table, or one without two small files in one
folder, is left alone; files may differ in columns; partition folders keep
their names; nulls and repeated rows are rows like others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.operators.layout import TARGET_BYTES
from lodestar.sources import store

_WORK = "_compaction"
#: Files below this share of the target are small.
SMALL = 0.75


@dataclass
class Compacted:
    files_before: int
    files_after: int
    rewritten: int


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(file, size) of the Parquet files below ``path``, without opening them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))


def bins(files: DataFrame, target: int) -> DataFrame:
    """(file, folder, bin): the small files that share a bin with another, bins numbered from 0 over all folders."""
    small = files.where(F.col("size") < int(SMALL * target)).withColumn("folder", F.regexp_extract("file", "^(.*)/", 1))
    by_name = Window.partitionBy("folder").orderBy("file")
    placed = small.withColumn("nth", F.floor((F.sum("size").over(by_name) - F.col("size")) / target))
    # The last file of a folder goes with the one before it, so that it is not left over alone.
    last = F.lead("file").over(by_name).isNull()
    placed = placed.withColumn("nth", F.when(last, F.coalesce(F.lag("nth").over(by_name), F.col("nth"))).otherwise(F.col("nth")))
    shared = placed.withColumn("many", F.count(F.lit(1)).over(Window.partitionBy("folder", "nth"))).where("many > 1")
    # A row a bin: their numbers are ranked in one task.
    numbered = shared.select("folder", "nth").distinct().withColumn("bin", F.row_number().over(Window.orderBy("folder", "nth")) - 1)
    return shared.join(numbered, ["folder", "nth"]).select("file", "folder", "bin")


def compact(spark: SparkSession, path: str, target: int = TARGET_BYTES) -> Compacted:
    """Merge the small files of the table stored under ``path``."""
    finish(spark, path)
    work, files = f"{path}/{_WORK}", listed(spark, path)
    before = files.count()
    bins(files, target).write.parquet(f"{work}/plan")
    plan = spark.read.parquet(f"{work}/plan")
    many, rewritten = plan.agg(F.count_distinct("bin"), F.count(F.lit(1))).first()
    if many:
        rows = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").option("pathGlobFilter", "*.parquet").parquet(path)
        place = {"__file": F.col("_metadata.file_path"), "__row": F.col("_metadata.row_index")}
        small = rows.where(F.col("_metadata.file_size") < int(SMALL * target)).withColumns(place)
        own = plan.select(F.col("file").alias("__file"), F.col("bin").alias("__bin"))
        dealt = small.join(own, "__file").repartitionById(many, F.col("__bin")).sortWithinPartitions("__bin", "__file", "__row")
        dealt.drop("__file", "__row").write.partitionBy("__bin").parquet(f"{work}/files")
    finish(spark, path)
    return Compacted(before, listed(spark, path).count(), rewritten)


def finish(spark: SparkSession, path: str) -> None:
    """Complete a compaction whose new files are committed, or undo one whose are not."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = lambda text: jvm.org.apache.hadoop.fs.Path(text)
    work = f"{path}/{_WORK}"
    fs = place(work).getFileSystem(conf)
    if fs.exists(place(f"{work}/files/_SUCCESS")):
        plan = spark.read.parquet(f"{work}/plan")
        folders = {r.bin: r.folder for r in plan.select("bin", "folder").distinct().toLocalIterator()}  # a row a new file
        for r in plan.select("file").toLocalIterator():  # names of small files: file operations, no data
            fs.delete(_path(jvm, r.file), False)
        for folder in fs.listStatus(place(f"{work}/files")):
            number = folder.getPath().getName().partition("__bin=")[2]
            if number:
                for file in fs.listStatus(folder.getPath()):
                    fs.rename(file.getPath(), _path(jvm, f"{folders[int(number)]}/{file.getPath().getName()}"))
    if fs.exists(place(work)):
        store.remove(spark, work)


def _path(jvm, uri: str):
    """The place of a file that Spark names by a URI, in which odd characters are escaped."""
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))

"""CSV ingest (bronze): columns by each file's own header, declared types, rejected cells, load stamp, manifest loop."""

from __future__ import annotations

import csv
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lodestar.operators.stamps import stamp_value
from lodestar.sources.schemas import MANIFEST
from lodestar.sources.sinks import overwrite_evolving

#: Text of a row with more or fewer cells than its header, and the file a row comes from.
BROKEN, FILE = "_broken_row", "_source_file"


class MissingColumnError(ValueError):
    """A declared column is not in a file's header."""


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Header -> the files below ``path`` that have it; files without a line are left out.

    The first line of a file is the first row of its first split, so only the
    first splits are read; the driver gets a row a file.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("n"),
                                         F.col("_metadata.file_block_start").alias("start")).where("start = 0")
    first = lines.groupBy("file").agg(F.min_by("value", "n").alias("header"))
    found: dict[tuple[str, ...], list[str]] = {}
    for r in first.orderBy("file").toLocalIterator():
        names = tuple(next(csv.reader([r.header.removeprefix("\ufeff")])))
        if len(set(names)) < len(names):
            raise ValueError(f"{r.file}: header names a column twice: {names}")
        found.setdefault(names, []).append(unquote(r.file))  # the column holds a URI
    return found


def read_cells(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """All cells as text, by column name, whatever the order of columns in each file; ``BROKEN`` and ``FILE`` besides.

    ``whole``: all cells of a row are parsed whichever are used, so that no broken row is missed.

    One scan for each distinct header; a column that a file lacks is null in its rows.
    """
    every = None
    for names, files in headers(spark, path).items():
        kinds = StructType([StructField(c, StringType()) for c in (*names, BROKEN)])
        part = spark.read.option("header", "true").option("columnNameOfCorruptRecord", BROKEN).option("columnPruning", not whole).schema(kinds).csv(files)
        part = part.withColumn(FILE, F.col("_metadata.file_path"))
        every = part if every is None else every.unionByName(part, allowMissingColumns=True)
    if every is None:
        raise MissingColumnError(f"{path}: no file has a header")
    return every.select(*[f"`{c}`" for c in every.columns if c not in (BROKEN, FILE)], BROKEN, FILE)


def _checked(spark: SparkSession, path: str, schema: StructType) -> None:
    for names, files in headers(spark, path).items():
        missing = [f.name for f in schema.fields if f.name not in names]
        if missing:
            raise MissingColumnError(f"{files[0]}: header lacks {missing}")


def _typed(cells: DataFrame, schema: StructType | None) -> list[Column]:
    kinds = {f.name: f.dataType for f in schema.fields} if schema else {}
    names = [c for c in cells.columns if c not in (BROKEN, FILE)]
    return [(F.col(f"`{c}`").try_cast(kinds[c]) if c in kinds else F.col(f"`{c}`")).alias(c) for c in names]


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             infer: bool = False) -> DataFrame:
    """Headered CSV, columns found by the header of each file, in any order.

    Declared columns get their type (text that does not parse is null, see
    ``rejected``); columns that are not declared stay as text, so a file that
    grows brings its new columns along; a declared column that a header lacks
    raises.  ``infer=True`` reproduces type inference, by the first header.
    """
    if infer:
        return spark.read.option("header", "true").option("inferSchema", "true").csv(path)
    if schema is not None:
        _checked(spark, path, schema)
    cells = read_cells(spark, path)
    return cells.select(*_typed(cells, schema))


def rejected(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """(source_file, column_name, cell): cells whose text does not parse as the declared type, and, without a column
    name, the text of rows with more or fewer cells than their header."""
    cells = read_cells(spark, path, whole=True)
    kinds = {f.name: f.dataType for f in schema.fields if f.name in cells.columns}
    bad = [F.when(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(kind).isNull(),
                  F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("cell"))) for c, kind in kinds.items()]
    bad.append(F.when(F.col(BROKEN).isNotNull(), F.struct(F.lit(None).cast("string").alias("column_name"), F.col(BROKEN).alias("cell"))))
    found = cells.select(F.col(FILE).alias("source_file"), F.explode(F.array_compact(F.array(*bad))).alias("bad"))
    return found.select("source_file", "bad.column_name", "bad.cell")


def ingest_csv(spark: SparkSession, path: str, schema: StructType | None = None,
               infer: bool = False, as_of=None) -> DataFrame:
    return read_csv(spark, path, schema, infer).withColumn("_load_timestamp", stamp_value(as_of))


def ingest_manifest(spark: SparkSession, source_dir: str, prefix: str = "", manifest: dict | None = None,
                    infer: bool = False, as_of=None, path: str | None = None) -> list[str]:
    """Ingest every file of the manifest into a stored table ``<prefix><table>``; returns the names.

    Cells and rows that do not fit the declared columns go to the stored table
    ``<prefix>rejected_cells`` of this load.
    """
    names, refused = [], None
    for file_name, (table, schema) in (manifest or MANIFEST).items():
        df = ingest_csv(spark, f"{source_dir.rstrip('/')}/{file_name}", schema, infer, as_of)
        overwrite_evolving(df, prefix + table, path)
        names.append(prefix + table)
        if schema is not None and not infer:
            bad = rejected(spark, f"{source_dir.rstrip('/')}/{file_name}", schema).select(F.lit(table).alias("table_name"), "*")
            refused = bad if refused is None else refused.unionByName(bad)
    if refused is not None:
        overwrite_evolving(refused.withColumn("_load_timestamp", stamp_value(as_of)), f"{prefix}rejected_cells", path)
    return names

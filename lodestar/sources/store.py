"""Stored tables: Spark's own catalog tables, versions and releases.

A table ``name`` is a view over its newest physical table ``name__v<n>``:
each save writes a new physical table and then switches the view, so readers
see the old rows or the new ones.  A release is a set of tables saved under
one number and made current together by one switch.  A partitioned table can
take over partitions of the one before: its catalog entry points at their files,
which are neither read nor written.  Catalog, files, commit protocol and
partitions are Spark's.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Collection, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.keys import pack_keys, unpack_keys
from lodestar.session import scratch_root

#: Stored keys are hexadecimal digits, of which zstd leaves half.
CODEC = "zstd"


#: Spark's switch for removing the shuffle files of a job when the job ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settled(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go when each of them ends, and not when the driver's garbage collection happens
    to find them: for a step whose result is stored or fetched, so that its plan is not run again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def _write_staged(df: DataFrame, path: str) -> DataFrame:
    with settled(df.sparkSession):
        df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, label: str = "staged") -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: later
    steps all read the same rows and none computes them again."""
    return _write_staged(df, f"{scratch_root(df.sparkSession)}/{label}-{uuid.uuid4().hex}")


class Staging:
    """Staged copies of one run, removed together when it ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        return _write_staged(df, f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        """Remove a copy that nothing reads any more, before the run ends."""
        remove(self.spark, f"{self.root}/{name}")

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.root)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of a store that Spark reaches."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def numbers(spark: SparkSession, prefix: str) -> list[int]:
    """The numbers n of the catalog tables named ``<prefix><n>``."""
    found = spark.sql(f"SHOW TABLES LIKE '{prefix}*'").select("tableName").collect()
    return [int(m[1]) for r in found if (m := re.fullmatch(re.escape(prefix.lower()) + r"(\d+)", r[0].lower()))]


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def write_table(df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = (),
                bucket_by: Sequence[str] = (), buckets: int = 0, sort_by: Sequence[str] = (), clustered: bool = False) -> None:
    """Save ``df`` as a new catalog table.

    Rows are dealt by the partition or bucket columns first, so the number of
    files follows the data and not the number of writing tasks; AQE splits a
    large partition over several of them.  ``clustered`` rows are dealt already.
    """
    if partition_by and not clustered:
        df = unpack_keys(pack_keys(df).hint("rebalance", *[F.col(c) for c in partition_by]), df)
    elif bucket_by:
        df = df.repartition(buckets, *[F.col(c) for c in bucket_by])
    writer = df.write.mode("errorifexists").format("parquet").option("compression", CODEC)
    if path:
        writer = writer.option("path", f"{path.rstrip('/')}/{name}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*(sort_by or bucket_by))
    with settled(df.sparkSession):
        writer.saveAsTable(name)


def checked(spark: SparkSession, table: str, check: Callable[[DataFrame], None]) -> None:
    """Hold a written table against ``check``; when that raises, table and files go."""
    try:
        check(spark.table(table))
    except Exception:
        place = location(spark, table)
        spark.sql(f"DROP TABLE {table}")
        remove(spark, place)
        raise


def location(spark: SparkSession, table: str) -> str:
    """The folder of a stored table."""
    return next(r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r[0] == "Location")


def _spec(column: str, value: str | None) -> str:
    text = "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"(`{column}` = {text})"


def _partitions(spark: SparkSession, table: str, column: str) -> dict[str | None, str]:
    """Value, as text, of a table's one partition column -> place of its files: one call of the catalog, no file is opened."""
    state, jvm = spark._jsparkSession.sessionState(), spark.sparkContext._jvm
    found = state.catalog().listPartitions(state.sqlParser().parseTableIdentifier(table), jvm.scala.Option.empty())
    out = {}
    for i in range(found.size()):
        value = found.apply(i).spec().apply(column)
        place = jvm.org.apache.spark.sql.catalyst.catalog.CatalogUtils.URIToString(found.apply(i).location())
        out[None if value in (None, "__HIVE_DEFAULT_PARTITION__") else value] = place
    return out


def partition_locations(spark: SparkSession, table: str, column: str,
                        without: Collection[str | None] = ()) -> dict[str | None, str]:
    """Partition value -> place of its files, of the partitions that are not ``without``."""
    return {v: place for v, place in _partitions(spark, table, column).items() if v not in without}


def write_next(changed: DataFrame, name: str, base: str, column: str, replaced: Collection[str | None],
               path: str | None = None, clustered: bool = False) -> int:
    """Save the table ``name``: the rows of ``changed``, and all partitions of ``base`` whose value is not ``replaced``.

    Only ``changed`` is written.  The other partitions point at the files of
    ``base``.  A replaced partition without rows in ``changed`` is gone.
    Returns the number of partitions taken over.
    """
    spark = changed.sparkSession
    kept = partition_locations(spark, base, column, replaced)
    write_table(changed, name, path or location(spark, base).rpartition("/")[0], partition_by=[column], clustered=clustered)
    values = list(kept)
    for i in range(0, len(values), 500):  # partitions of one statement
        added = " ".join(f"PARTITION {_spec(column, v)} LOCATION '{kept[v]}'" for v in values[i:i + 500])
        spark.sql(f"ALTER TABLE {name} ADD {added}")
    return len(values)


def swap(spark: SparkSession, name: str, following: str, column: str, replaced: Collection[str | None]) -> None:
    """Make ``following`` the table ``name``; the replaced partitions' files of the one before go.

    The catalog renames two whole tables: whoever reads ``name`` meets all old
    rows or all new ones, and after a crash between the two ``restore`` finds
    the old table.
    """
    old = f"{name}__before"
    gone = {v: place for v, place in _partitions(spark, name, column).items() if v in replaced}
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {name}")
    spark.sql(f"DROP TABLE {old}")
    for place in gone.values():
        remove(spark, place)


def restore(spark: SparkSession, name: str) -> None:
    """Undo a ``swap`` that a crash cut in two."""
    if exists(spark, f"{name}__before"):
        if exists(spark, name):
            spark.sql(f"DROP TABLE {name}__before")
        else:
            spark.sql(f"ALTER TABLE {name}__before RENAME TO {name}")


def save_version(df: DataFrame, name: str, path: str | None = None, check: Callable[[DataFrame], None] | None = None, **layout) -> str:
    """Save ``df`` as the next version of ``name`` and switch the view to it, unless ``check`` of the written rows raises."""
    spark = df.sparkSession
    physical = f"{name}__v{1 + max(numbers(spark, f'{name}__v'), default=0)}"
    write_table(df, physical, path, **layout)
    if check:
        checked(spark, physical, check)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {physical}")
    return physical


class Releases:
    """Tables saved together under one number; one switch makes a number current."""

    def __init__(self, spark: SparkSession, name: str, path: str | None = None):
        self.spark, self.name, self.path = spark, name, path

    def _table(self, table: str, number: int) -> str:
        return f"{self.name}__{table}__r{number}"

    def current(self) -> int | None:
        if not exists(self.spark, f"{self.name}__release"):
            return None
        return self.spark.table(f"{self.name}__release").first()[0]

    def begin(self) -> int:
        """A number that no table of this name has yet."""
        used = self.spark.sql(f"SHOW TABLES LIKE '{self.name}__*__r*'").select("tableName").collect()
        return 1 + max((int(r[0].rpartition("__r")[2]) for r in used if r[0].rpartition("__r")[2].isdigit()), default=0)

    def save(self, df: DataFrame, table: str, number: int) -> DataFrame:
        write_table(df, self._table(table, number), self.path)
        return self.read(table, number)

    def save_partitioned(self, df: DataFrame, table: str, number: int, column: str, before: int | None = None,
                         replaced: Collection[str | None] = (), clustered: bool = False) -> DataFrame:
        """Save ``df`` partitioned by ``column``; with ``before``, take over that release's other partitions."""
        name = self._table(table, number)
        if before is None:
            write_table(df, name, self.path or warehouse(self.spark), partition_by=[column], clustered=clustered)
        else:
            write_next(df, name, self._table(table, before), column, replaced, clustered=clustered)
        return self.read(table, number)

    def read(self, table: str, number: int | None = None) -> DataFrame:
        number = self.current() if number is None else number
        if number is None:
            raise LookupError(f"nothing published as {self.name}")
        return self.spark.table(self._table(table, number))

    def publish(self, number: int) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name}__release AS SELECT {int(number)} AS release")

    def retire(self, keep: int = 2) -> list[str]:
        """Drop the tables of releases before the newest ``keep`` published or older ones, and files that none of the others uses.

        Releases after the current one are left: a run may be writing them.
        """
        current = self.current()
        if current is None:
            return []
        listed = self.spark.sql(f"SHOW TABLES LIKE '{self.name}__*__r*'").select("tableName").collect()
        found = [(r[0], int(r[0].rpartition("__r")[2])) for r in listed if r[0].rpartition("__r")[2].isdigit()]
        kept_numbers = sorted({n for _, n in found if n <= current}, reverse=True)[:max(1, keep)]
        old = [t for t, n in found if n <= current and n not in kept_numbers]
        used = {p for t, n in found if t not in old for p in _places(self.spark, t)}
        places = {t: (location(self.spark, t), _places(self.spark, t)) for t in old}
        for table in old:
            self.spark.sql(f"DROP TABLE {table}")
        for home, own in places.values():
            if any(p.startswith(home.rstrip("/") + "/") for p in used):  # another release uses partitions of it
                for place in own - used:
                    if place.startswith(home.rstrip("/") + "/"):
                        remove(self.spark, place)
            else:
                remove(self.spark, home)
        return old


def _places(spark: SparkSession, table: str) -> set[str]:
    """Where the files of a table are: its folder, or those of its partitions."""
    columns = [r[0] for r in spark.sql(f"DESCRIBE TABLE {table}").collect()]
    if "# Partition Information" not in columns:
        return {location(spark, table)}
    return set(partition_locations(spark, table, columns[-1]).values())


def warehouse(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.warehouse.dir")

"""Keyed upsert (update all columns of matched rows, insert the rest).

``merge_rows`` is the relational form: target rows whose key is not in the
updates, plus all update rows.  With unique update keys this equals
MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *; a null key never
matches, so such a target row stays and such an update row is inserted.
Rows absent from the updates are never deleted, and a column absent from the
updates keeps its value in matched rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.keys import pack_keys, unpack_keys
from lodestar.operators import bloom
from lodestar.sources import store


class DuplicateKeyError(ValueError):
    """Several update rows share one key (MERGE would be ambiguous)."""


def assert_unique_keys(updates: DataFrame, keys: Sequence[str]) -> None:
    """Raise when two update rows with non-null keys share a key.

    One aggregate, map-side combined; at most one offending key is fetched.
    """
    keys = list(keys)
    non_null = updates.dropna(how="any", subset=keys)
    with store.settled(updates.sparkSession):
        dup = (non_null.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
               .where(F.col("_n") > 1).limit(1).collect())
    if dup:
        raise DuplicateKeyError(f"update keys {keys} not unique, e.g. {dup[0].asDict()}")


def merge_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after the upsert; columns new in the updates are null in kept rows."""
    keys = list(keys)
    changed = [f.name for f in updates.schema for t in target.schema if f.name == t.name and f.dataType != t.dataType]
    if changed:
        raise TypeError(f"columns {changed} have another type in the updates")
    absent = [c for c in target.columns if c not in updates.columns]
    if absent:
        updates = _joined(updates, target.select(*keys, *absent), keys, "left")
    kept = _joined(target, updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


#: So many values of the last key, as bits, stay together in a shuffle.
_BLOCK = 6


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``left`` joined with ``right`` by the keys, of which it has one copy.

    Rows are dealt by all keys but the low bits of the last one, if that is an
    integer: lines of an order travel and are written side by side, so that what
    they share is compressed, and a huge order still goes to many tasks.  With
    unique keys a row meets at most ``2 ** _BLOCK`` others there.
    """
    # Packed on both sides, so that a key may be among the packed columns.
    a, b = pack_keys(left), pack_keys(right)
    *first, last = keys
    if not (first and all(dict(x.dtypes)[last] in ("int", "bigint") for x in (a, b))):
        both = a.join(b, on=list(keys), how=how)
    else:
        other = {k: f"_right_{i}" for i, k in enumerate(keys)}
        b = b.withColumnsRenamed(other)
        mine, its = F.col(last), F.col(other[last])
        on = [F.col(k) == F.col(other[k]) for k in first] + [F.shiftright(mine, _BLOCK) == F.shiftright(its, _BLOCK)]
        # An equality would be dealt by as well.
        both = a.join(b, on=reduce(Column.__and__, [*on, mine <= its, mine >= its]), how=how).drop(*other.values())
    names = [*left.columns, *[c for c in right.columns if c not in left.columns and how != "left_anti"]]
    return unpack_keys(unpack_keys(both, left), right.drop(*left.columns)).select(*names)


def upsert(updates: DataFrame, name: str, keys: Sequence[str], path: str | None = None, **layout) -> DataFrame:
    """Upsert ``updates`` into the stored table ``name``; return its new rows.

    The first run is a plain load, checked before it can be read.  The updates are evaluated once.
    """
    spark = updates.sparkSession
    if not store.exists(spark, name):
        store.save_version(updates, name, path, check=lambda rows: assert_unique_keys(rows, keys), **layout)
        return spark.table(name)
    with store.Staging(spark, "upsert") as staging:
        updates = staging.put(updates, "updates")
        assert_unique_keys(updates, keys)
        store.save_version(merge_rows(spark.table(name), updates, keys), name, path, **layout)
    return spark.table(name)


def touched_partitions(target: DataFrame, updates: DataFrame, keys: Sequence[str], partition_col: str) -> list:
    """Values of the partitions that hold update rows, or target rows of an updated key.

    The target's side of the semi join reads keys and partition value only, and
    a Bloom filter of the update keys drops nearly all rows that have no update
    before they are shuffled, unless the updates are more than an eighth of the
    target; the result is bounded by the number of partitions.  Both are stored
    tables.
    """
    own = updates.select(partition_col)
    near, count = target.select(*keys, partition_col), updates.count()
    if 8 * count < target.count():
        near = bloom.may_match(near, updates.select(*keys), keys, count)
    moved = near.join(updates.select(*keys), list(keys), "left_semi").select(partition_col)
    with store.settled(updates.sparkSession):
        return [r[0] for r in own.distinct().union(moved.distinct()).distinct().collect()]


def _in(column: str, values: Sequence):
    known = [v for v in values if v is not None]
    inside = F.col(column).isin(known) if known else F.lit(False)
    return inside | F.col(column).isNull() if len(known) < len(values) else inside


def as_text(values: Sequence) -> set[str | None]:
    """Partition values as the catalog writes them."""
    return {None if v is None else str(v).lower() if isinstance(v, bool) else str(v) for v in values}


def upsert_partitioned(updates: DataFrame, table: str, keys: Sequence[str], partition_col: str,
                       path: str | None = None) -> DataFrame:
    """Keyed upsert into a catalog table partitioned by ``partition_col``.

    Only the touched partitions are written, into a next table that takes over
    the others' files; one switch makes it the table.  Until then, and if the
    run ends before, the old rows stand; a moved row is never in two partitions
    and a partition that a correction left without rows is gone.
    """
    spark, keys = updates.sparkSession, list(keys)
    store.restore(spark, table)
    following = f"{table}__{uuid.uuid4().hex[:12]}"
    if not store.exists(spark, table):
        store.write_table(updates, following, path or store.warehouse(spark), partition_by=[partition_col])
        store.checked(spark, following, lambda rows: assert_unique_keys(rows, keys))
        spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
        return spark.table(table)
    with store.Staging(spark, "upsert") as staging:
        updates = staging.put(updates, "updates")
        assert_unique_keys(updates, keys)
        target = spark.table(table)
        touched = touched_partitions(target, updates, keys, partition_col)
        changed = merge_rows(target.where(_in(partition_col, touched)), updates, keys)
        store.write_next(changed, following, table, partition_col, as_text(touched), path)
        store.swap(spark, table, following, partition_col, as_text(touched))
    return spark.table(table)

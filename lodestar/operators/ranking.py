"""Global NTILE / DENSE_RANK / ROW_NUMBER without a single-partition window.

A window with ``ORDER BY`` and no ``PARTITION BY`` moves every row into one
task.  Here the rows are dealt by ranges of the total order
``(value desc, tiebreak asc)`` -- ties are split across tasks too, so a hot
value does not land in one task -- and ranked inside each range with an
ordinary partitioned window over that same dealing: one shuffle of the rows.
Statistics of one row a range give the offsets that turn local ranks into
global ones:

* row number:  ``rn = sum(rows of earlier ranges) + local rn``
* dense rank:  ``dr = sum(distinct values of earlier ranges)
                     - (boundaries where a range starts with the value the
                        previous one ended with, up to this range)
                     + local dr``
* ntile(k):    from ``rn`` and the total ``N``: ``base, rem = divmod(N, k)``,
  the first ``rem`` tiles hold ``base + 1`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sampled rows for each range.
SAMPLE = 20


def _tile(rn: Column, n: Column, k: int) -> Column:
    base = F.floor(n / F.lit(k))
    rem = n - base * F.lit(k)
    cut = rem * (base + 1)
    return F.when(rn <= cut, F.ceil(rn / (base + 1))) \
        .otherwise(rem + F.ceil((rn - cut) / base)).cast("int")


def halved(df: DataFrame, keys: Sequence[Column], bounds: Sequence[Column], names: Sequence[str], most: int) -> DataFrame:
    """``df`` with the number of sorted bounds (``most`` at the most) below each key in the column of that name.

    The bounds are halved once a projection, all keys together, so a row costs
    the logarithm of their number.
    """
    placed = df.withColumns({name: F.lit(0) for name in names})
    for bit in reversed(range(most.bit_length())):
        step = 1 << bit
        # A bound past the end is null, and so is the comparison: no step is taken, nor for a null key.
        above = [F.get(b, F.col(name) + (step - 1)) < key for b, key, name in zip(bounds, keys, names)]
        placed = placed.withColumns({name: F.col(name) + F.when(more, step).otherwise(0) for name, more in zip(names, above)})
    return placed


def _placed(df: DataFrame, order: list[Column], identity: Column, parts: int) -> DataFrame:
    """``df`` with its range of ``order`` in ``_range`` and the bounds of all ranges in ``_bounds``.

    The bounds come from a sample that depends on the rows alone, not on the
    order in which tasks finish: the rows with the smallest hashes of
    ``identity``, ``SAMPLE`` for each range.  Every evaluation of the plan has
    therefore the same ranges, so nothing needs to be pinned or run while the
    plan is built.
    """
    key = F.struct(*order)
    sample = df.select(key.alias("_k"), F.xxhash64(identity).alias("_h")).orderBy("_h", "_k").limit(SAMPLE * parts)
    picked = F.filter(F.sort_array(F.collect_list("_k")), lambda _, i: (i + 1) % SAMPLE == 0)
    bounds = sample.agg(picked).scalar()  # at most ``parts`` bounds
    return halved(df.withColumn("_bounds", bounds), [key], [F.col("_bounds")], ["_range"], parts)


def _dealt(placed: DataFrame, parts: int) -> DataFrame:
    """A task for each of the ``parts`` ranges and one for the rows above the last bound."""
    return placed.drop("_bounds").repartitionById(parts + 1, "_range")


def _before(stats: DataFrame, count: str, name: str) -> DataFrame:
    """The running total of ``count`` before each range: a row a range, so one task holds them all."""
    w = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return stats.withColumn(name, F.coalesce(F.sum(count).over(w), F.lit(0)))


def rank_globally(df: DataFrame, value: str, tiebreak: str, tiles: int = 10,
                  tile_col: str = "ntile", dense_col: str = "dense_rank",
                  row_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add ``ntile(tiles)`` over (value desc, tiebreak asc) and ``dense_rank()``
    over (value desc); ``tiebreak`` must make the order total."""
    n_parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v, t = F.col(value), F.col(tiebreak)
    in_range = Window.partitionBy("_range")
    local = (_dealt(_placed(df, [-v, t], t, n_parts), n_parts)
             .withColumn("_lrn", F.row_number().over(in_range.orderBy(v.desc(), t.asc())))
             .withColumn("_ldr", F.dense_rank().over(in_range.orderBy(v.desc()))))
    stats = local.groupBy("_range").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max("_ldr").alias("_d"),
        F.min_by(v, F.col("_lrn")).alias("_first"),
        F.max_by(v, F.col("_lrn")).alias("_last"),
    )
    w = Window.orderBy("_range")
    # A range that starts with the value the one before ended with adds one distinct value less.
    overlap = F.coalesce(F.lag("_last").over(w).eqNullSafe(F.col("_first")).cast("long"), F.lit(0))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = _before(_before(stats.withColumn("_overlap", overlap), "_n", "_rn_off"), "_d", "_dr_off")
    offsets = offsets.select("_range", "_rn_off", (F.col("_dr_off") - F.sum("_overlap").over(upto)).alias("_dr_off"),
                             F.sum("_n").over(Window.partitionBy()).alias("_total"))
    ranked = local.join(F.broadcast(offsets), "_range")  # a row a range
    rn = F.col("_rn_off") + F.col("_lrn")
    out = ranked.withColumns({
        tile_col: _tile(rn, F.col("_total"), tiles),
        dense_col: (F.col("_dr_off") + F.col("_ldr")).cast("int"),
    })
    if row_col:
        out = out.withColumn(row_col, rn)
    return out.drop("_range", "_lrn", "_ldr", "_rn_off", "_dr_off", "_total")


def number_within_groups(df: DataFrame, keys: list[str], order: list[str], col: str = "row_in_group",
                         num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` without
    putting a whole group into one task.

    Rows are dealt by ranges of (keys, order), so a group holding a third of
    all rows is split over many tasks.  Only a group that a bound lies in can
    continue from earlier ranges; its rows are counted for each range by a pass
    over the input, so the dealt rows are sorted once.  ``order`` must make the
    order total within a group (or the tied rows be identical).
    """
    n_parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [F.col(c) for c in [*keys, *order]]
    # The sample takes rows by their hash; equal rows have equal hashes and differ by nothing.
    placed = _placed(df, columns, F.struct(*columns), n_parts)

    def in_group_of(bound: Column) -> Column:
        return reduce(Column.__and__, [bound[k].eqNullSafe(F.col(k)) for k in keys], bound.isNotNull())

    below, above = F.get("_bounds", F.col("_range") - 1), F.get("_bounds", F.col("_range"))
    # Other rows are one group a range and go after it: a filter of rows would find the range anew at each mention of it.
    flagged = placed.withColumn("_cut", in_group_of(below) | in_group_of(above))
    cut = flagged.groupBy("_range", "_cut", *[F.when(F.col("_cut"), F.col(k)).alias(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("_n"), F.bool_or("_cut").alias("_some")).where("_some")
    # At most two groups a range: the rows of each in earlier ranges.
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = cut.withColumn("_carry", F.sum("_n").over(earlier)).where("_carry > 0").select(
        F.col("_range").alias("_at"), *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "_carry")
    local = _dealt(placed, n_parts).withColumn("_ln", F.row_number().over(
        Window.partitionBy("_range", *keys).orderBy(*[F.col(c).asc() for c in order])))
    continued = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)], F.col("_range") == F.col("_at"))
    out = local.join(F.broadcast(carry), continued, "left")
    number = F.col("_ln") + F.coalesce("_carry", F.lit(0))
    return out.withColumn(col, number).drop("_range", "_ln", "_carry", "_at", *[f"_key{i}" for i in range(len(keys))])

"""Sharding by extendible hashing, with DataFrame functions only.

The directory is indexed by leading bits of a 60-bit hash of the row's key.
A bucket whose rows exceed the byte limit is split on the next bit; others
stay as they are, so depth differs from bucket to bucket.  Bytes are first
summed per fine cell (a prefix some bits deeper than an even spread needs),
each cell then takes the shallowest prefix that fits; cells that do not fit
go on to the next round with deeper cells.  The number of cells, not of rows,
is what the rounds work on.

Rows, cells and directory stay distributed; the driver sees two numbers a
round.  Cells are joined by shuffles alone: their tables compress so well that
a broadcast, chosen by their stored bytes, would hold millions of them in the
driver.  Results for edge cases:

* null text counts zero bytes, a null key is hashed as its own value;
* a row larger than the limit, or rows with one and the same key, cannot be
  parted by any bit: they share a bucket of the full 60 bits with
  ``fits = false``, nothing is dropped;
* an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

#: Bits of the hash: 15 hexadecimal digits of md5.
BITS = 60
#: Depth that a round's cells have beyond the even spread of their bytes.
SLACK = 5


def hash60(key: Column) -> Column:
    """The first 60 bits of the key's md5; a null key is hashed as the byte 0."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("\0")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _prefix(h: Column, depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", h, (F.lit(BITS) - depth).cast("int"))


def assign_shards(docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, depth, prefix, shard, shard_rows, shard_bytes, fits), a row for each input row.

    ``shard`` is the prefix as a bit string of ``depth`` characters ("" for a
    table that fits as a whole).
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    scratch = Scratch(docs.sparkSession, "sharding")
    rows = docs.select(F.col(key).alias("_key"), hash60(F.col(key)).alias("_hash"),
                       F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("_bytes"))
    rows = scratch.put(rows, "rows")
    total = rows.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    rest, step, places = rows, 0, []
    floor, deepest = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + SLACK)
    while True:
        cells = rest.groupBy(_prefix(F.col("_hash"), deepest).alias("_cell")).agg(
            F.sum("_bytes").alias("_bytes"), F.count("*").alias("_rows"))
        cells = scratch.put(cells, f"cells{step}")
        # Each cell under all its prefixes since the last round, and what these prefixes hold.
        up = cells.select("*", F.explode(F.sequence(F.lit(floor), F.lit(deepest))).alias("_depth")).withColumn(
            "_prefix", F.call_function("shiftright", F.col("_cell"), (F.lit(deepest) - F.col("_depth")).cast("int")))
        sums = up.groupBy("_depth", "_prefix").agg(F.sum("_bytes").alias("_sum"), F.sum("_rows").alias("_n"))
        fits = (F.col("_sum") <= limit) | (F.col("_depth") == BITS)
        place = up.select("_cell", "_depth", "_prefix").join(sums.hint("merge"), ["_depth", "_prefix"]).groupBy("_cell").agg(
            F.min(F.when(fits, F.struct("_depth", "_prefix", "_sum", "_n"))).alias("_at"))
        place = scratch.put(place.select(F.lit(deepest).alias("_level"), "_cell", "_at"), f"place{step}")
        places.append((deepest, place.where(F.col("_at").isNotNull())))
        over = place.where(F.col("_at").isNull()).select("_cell")
        if deepest == BITS or over.isEmpty():
            break
        rest = rest.withColumn("_cell", _prefix(F.col("_hash"), deepest)).join(over.hint("merge"), "_cell", "left_semi").drop("_cell")
        floor, deepest, step = deepest, min(BITS, deepest + 8), step + 1
    # A row's cell has its place in one round's table, the round that settled it.
    levels = F.array(*[F.struct(F.lit(d).alias("_level"), _prefix(F.col("_hash"), d).alias("_cell")) for d, _ in places])
    every = places[0][1]
    for _, place in places[1:]:
        every = every.unionByName(place)
    placed = rows.select("_key", "_bytes", F.explode(levels).alias("_l")).select("_key", "_bytes", "_l.*").join(
        every.hint("merge"), ["_level", "_cell"]).select("_key", "_bytes", "_at.*")
    return placed.select(
        F.col("_key").alias(key), F.col("_bytes").alias("n_bytes"), F.col("_depth").cast("int").alias("depth"),
        F.col("_prefix").alias("prefix"),
        F.expr("substring(lpad(conv(cast(_prefix AS string), 10, 2), 60, '0'), 61 - _depth, _depth)").alias("shard"),
        F.col("_n").alias("shard_rows"), F.col("_sum").alias("shard_bytes"), (F.col("_sum") <= limit).alias("fits"))


def write_shards(docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` as one folder for each shard under ``path``; returns the directory.

    The folders' column is named ``shard``, with underscores appended while
    ``docs`` has a column of that name.  Rows that no bit can part share a
    folder, not a task: a folder far above the others gets several files.
    """
    folder = "shard"
    while folder.lower() in (c.lower() for c in docs.columns):
        folder += "_"
    placed = assign_shards(docs, limit, key, text).select(
        F.col(key).alias("_key"), F.concat(F.lit("b"), "shard").alias(folder), "shard_rows", "shard_bytes").distinct()
    rows = docs.select(F.col(key).alias("_own"), F.struct("*").alias("_row"))
    out = rows.join(placed.select("_key", folder), F.col("_own").eqNullSafe(F.col("_key"))).select("_row.*", folder)
    out.hint("rebalance", F.col(folder)).write.partitionBy(folder).parquet(path)
    return placed.groupBy(F.col(folder).alias("shard")).agg(
        F.first("shard_rows").alias("shard_rows"), F.first("shard_bytes").alias("shard_bytes"))

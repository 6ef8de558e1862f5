"""Rows as JSON text (a column operator, evaluated on the executors)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType


def rows_as_json(df: DataFrame, column: str = "json") -> DataFrame:
    """One JSON object per row; nulls kept, dates/decimals/timestamps as text.

    Mirrors a ``json.dumps(rows, default=str)`` over fetched rows, but each
    row is encoded where it lives instead of on a single machine.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DateType, DecimalType, TimestampType, TimestampNTZType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias(column))

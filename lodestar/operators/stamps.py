"""Audit stamps (load / update time)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP_COLUMNS = ("_load_timestamp", "_updated_timestamp")


def stamp_value(as_of: _dt.datetime | str | None = None) -> Column:
    """``current_timestamp()`` or a fixed ``as_of`` (reproducible reruns)."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp")


def without_stamps(df):
    return df.drop(*[c for c in STAMP_COLUMNS if c in df.columns])

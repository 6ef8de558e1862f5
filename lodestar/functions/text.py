"""Text and timestamp normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_text(c: str | Column) -> Column:
    """``lower(trim(c))``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.trim(c))


def parse_timestamp(c: str | Column) -> Column:
    """Text to a wall-clock timestamp; malformed text becomes null.

    ``to_timestamp`` without a format raises on bad text under ANSI mode;
    ``try_cast`` has the same parsing rules and yields null instead.  The
    source text carries no zone, so the result is ``timestamp_ntz`` and date
    keys do not depend on the session time zone.  An existing timestamp is
    passed through (cast), as the reference's cast is a no-op then.
    """
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("timestamp_ntz")

"""Surrogate and date keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(natural: str | Column) -> Column:
    """Lower-case hex SHA-256 of the natural key as text; null stays null."""
    return F.sha2(_col(natural).cast("string"), 256)


def date_key(ts: str | Column) -> Column:
    """``yyyyMMdd`` of a date or timestamp as an int (null stays null).

    Computed arithmetically instead of formatting a string per row; the
    value equals ``cast(date_format(ts, 'yyyyMMdd') as int)``.
    """
    c = _col(ts)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def pack_keys(df: DataFrame) -> DataFrame:
    """``df`` with its text columns named ``*_sk`` as bytes: a SHA-256 in half the space, any other text as it is.

    For rows on their way through a shuffle, whose compression does not shrink
    hexadecimal digits; ``unpack_keys`` gives the very same texts back.
    """
    return df.withColumns({c: packed(F.col(c)) for c in _text_keys(df)})


def packed(text: Column) -> Column:
    """The bytes of a text, those of a SHA-256's digits in half the space; equal for equal texts alone."""
    digest = (F.octet_length(text) == 64) & (F.lower(text) == text) & F.unhex(text).isNotNull()  # a pattern takes several times as long
    return F.when(digest, F.concat(F.lit(b"\x01"), F.unhex(text))).otherwise(F.concat(F.lit(b"\x00"), text.cast("binary")))


def unpack_keys(df: DataFrame, like: DataFrame) -> DataFrame:
    """The frame that ``pack_keys`` packed, with the columns of ``like`` that it had packed as text again."""
    def text(c: str) -> Column:
        value = F.substring(c, 2, 2147483647)
        return F.when(F.substring(c, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(value))).otherwise(value.cast("string"))

    return df.withColumns({c: text(c) for c in _text_keys(like) if c in df.columns})


def _text_keys(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.name.endswith("_sk") and f.dataType == StringType()]

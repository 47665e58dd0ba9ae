"""Casts and date parsing that yield NULL for malformed input under ANSI mode."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.columns import col

# Date and time formats of the inputs.
COMPACT_DATE = "yyyyMMdd"
ISO_DATE = "yyyy-MM-dd"
ISO_OFFSET_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ssXXX"
DATE_AND_MINUTE = "yyyy-MM-dd HH:mm"


def safe_cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; malformed text becomes NULL instead of an error."""
    return df.withColumns({name: col(name).try_cast(dtype) for name, dtype in types.items()})


def parse_date(value: Column, fmt: str = ISO_DATE) -> Column:
    """Date of text in ``fmt``; NULL for anything else, of a wrong length included."""
    return F.try_to_date(value, fmt)


def parse_offset_timestamp(value: Column) -> Column:
    """Instant of ISO-8601 text with an offset, such as ``2025-04-04T09:00:00-08:00``."""
    return F.try_to_timestamp(value, F.lit(ISO_OFFSET_TIMESTAMP))


def clock_text(hhmm: Column) -> Column:
    """``0540`` becomes ``05:40``."""
    return F.concat(F.substring(hhmm, 1, 2), F.lit(":"), F.substring(hhmm, 3, 2))


def at_clock(day: Column, clock: Column) -> Column:
    """Timestamp of a date and an ``HH:mm`` text in the session time zone."""
    text = F.concat(F.date_format(day, ISO_DATE), F.lit(" "), clock)
    return F.try_to_timestamp(text, F.lit(DATE_AND_MINUTE))


def scale_columns(df: DataFrame, columns: Sequence[str], divisor: float) -> DataFrame:
    """Divide those of ``columns`` that exist."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: col(c) / F.lit(float(divisor)) for c in present}) if present else df


def flatten_struct(df: DataFrame, parent: str, fields: Sequence[str] | None = None) -> DataFrame:
    """Lift struct fields to the top level and drop the struct."""
    dtype = df.schema[parent].dataType
    if not isinstance(dtype, T.StructType):
        raise TypeError(f"{parent} is not a struct")
    names = list(dtype.names if fields is None else fields)
    return df.select("*", *[col(parent).getField(n).alias(n) for n in names]).drop(parent)

"""Text normalisation of string columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.columns import col, string_columns

# Spellings of a missing value, per data set.
OBSERVATION_NULLS = ("NA", "N/A", "null", "", " ")
ENERGY_NULLS = ("", "NA", "N/A", "NULL")
EVENT_NULLS = ("", "NA", "N/A", "NaN", "NULL")

# Every character Unicode counts as white space.
WHITE_SPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def tokens_to_null(value: Column, tokens: Sequence[str]) -> Column:
    """NULL where the text is one of ``tokens``, the text itself otherwise."""
    return F.when(~value.isin(*tokens), value)


def nullify_tokens(df: DataFrame, tokens: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Homogenise NULL spellings, over string columns only."""
    names = string_columns(df) if columns is None else columns
    return df.withColumns({n: tokens_to_null(col(n), tokens) for n in names}) if names else df


def underscored(value: Column) -> Column:
    """Trim, then replace each run of white space by one underscore."""
    return F.regexp_replace(F.trim(value), r"\s+", "_")


def normalize_text(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    lower: bool = False,
    tokens: Sequence[str] = (),
) -> DataFrame:
    """Lower-case (optional), trim, underscore and NULL-homogenise in one pass."""
    names = string_columns(df) if columns is None else list(columns)
    if not names:
        return df
    cleaned = df.withColumns({n: underscored(F.lower(col(n)) if lower else col(n)) for n in names})
    # A step of its own, which reads each cleaned text twice: in one expression it would be cleaned for each reading.
    return nullify_tokens(cleaned, tokens, names) if tokens else cleaned


def strip_all(df: DataFrame) -> DataFrame:
    """Strip leading and trailing white space of every string column."""
    names = string_columns(df)
    return df.withColumns({n: F.btrim(col(n), F.lit(WHITE_SPACE)) for n in names}) if names else df


def snake_case(name: str) -> str:
    """``sensorId`` becomes ``sensor_id``."""
    return re.sub(r"(.)(?=[A-Z])", r"\1_", name).lower()


def rename_snake(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(n) for n in df.columns])

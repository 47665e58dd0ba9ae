"""Registration of queries and the common form of their results.

A query names its result columns with a kind each; both sides are cast by kind, so that
types and spellings agree: ``s`` text, ``i`` bigint, ``f`` double rounded to six places,
``b`` boolean as text, ``d`` date as text, ``t`` timestamp as text, ``a`` array of text
joined by ``|``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.columns import col

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_SPARK: dict[str, Callable[[Column], Column]] = {
    "s": lambda c: c.cast("string"),
    "i": lambda c: c.cast("bigint"),
    "f": lambda c: F.round(c.cast("double"), 6) + F.lit(0.0),
    "b": lambda c: c.cast("boolean").cast("string"),
    "d": lambda c: c.cast("date").cast("string"),
    "t": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    "a": lambda c: F.array_join(c, "|"),
}
_SQL = {
    "s": "CAST({0} AS VARCHAR)",
    "i": "CAST({0} AS BIGINT)",
    "f": "ROUND(CAST({0} AS DOUBLE), 6) + 0.0",
    "b": "CAST(CAST({0} AS BOOLEAN) AS VARCHAR)",
    "d": "CAST(CAST({0} AS DATE) AS VARCHAR)",
    "t": "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')",
    "a": "array_to_string({0}, '|')",
}


def query(name: str, columns: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``columns`` is a list such as ``"station:s n:i"``."""
    fields = [c.split(":") for c in columns.split()]

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(spark, sf_dir).select(*[_SPARK[kind](col(c)).alias(c) for c, kind in fields])

        QUERIES[name] = run
        if sql is not None:
            listed = ", ".join(f"{_SQL[kind].format(quoted(c))} AS {quoted(c)}" for c, kind in fields)
            ORACLES[name] = f"SELECT {listed} FROM ({sql.strip()}) AS result"
        return build

    return register


def quoted(name: str) -> str:
    return f'"{name}"'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

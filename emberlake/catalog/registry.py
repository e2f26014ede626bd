"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake.catalog.domain import Domain, domain
from emberlake.catalog.oracle import check

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Plain bigint, double and text columns, so both engines can be compared by value."""

    def plain(f: T.StructField):
        column = F.col(f"`{f.name}`")
        kind = f.dataType
        if isinstance(kind, T.DecimalType):
            wide_key = kind.scale == 0 and kind.precision > 18
            return column.cast("string" if wide_key else "double").alias(f.name)
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return column.cast("double").alias(f.name)
        if isinstance(kind, (T.IntegralType, T.BooleanType)):
            return column.cast("bigint").alias(f.name)
        return column.cast("string").alias(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def add(name: str, build: Callable[[Domain], DataFrame], body: str | None = None, **columns: str) -> None:
    """Register a query; ``columns`` gives its columns as i, f or s for the SQL side."""
    if name in QUERIES:
        raise ValueError(f"duplicate query {name}")
    QUERIES[name] = lambda spark, folder: portable(build(domain(spark, folder)).select(*columns))
    if body is not None:
        SQL[name] = check(body, **columns)

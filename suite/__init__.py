"""The registered queries: each library operator over the given tables, with its SQL twin.

Price lists, maps and registries are derived from the given tables, so every query grows
with them. The SQL twin states what the reference computes, row multiplication and all; the
Spark side computes it the way the library does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL twin if it has one."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = lambda spark, sf_dir: plain(run(spark, sf_dir))
        if sql is not None:
            ORACLE[run.__name__] = sql
        return run

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text: forms both engines hand out alike."""

    def column(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return c.cast("string").alias(field.name)
        return c

    return df.select(*[column(field) for field in df.schema])


def load_all() -> None:
    from suite import consolidation, enriching, loading, registering, syncing  # noqa: F401

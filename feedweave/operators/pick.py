"""Best-row picks.

Every pick is ``row_number() = 1``, which Spark plans with a WindowGroupLimit on both sides
of the shuffle: each task forwards at most one row per key, so a key holding a third of all
rows never reaches one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def ordering(text: str) -> Column:
    """``"price desc"`` -> column; NULLs first ascending and last descending."""
    expression, _, direction = text.rpartition(" ")
    if direction.lower() == "desc":
        return F.expr(expression).desc_nulls_last()
    if direction.lower() == "asc":
        return F.expr(expression).asc_nulls_first()
    return F.expr(text).asc_nulls_first()


def best_per(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key under ``order``, which should be total."""
    window = Window.partitionBy(*keys).orderBy(*[ordering(o) if isinstance(o, str) else o for o in order])
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def own_partitioning(keys: Sequence[str]) -> list[str | Column]:
    """The same groups under a hash partitioning no join on ``keys`` can reuse."""
    return [F.xxhash64(*keys), *keys]


def collapse_by(df: DataFrame, key: str, row_id: str, order: Sequence[str | Column]) -> DataFrame:
    """One row per non-blank ``key``; rows with a blank key all stay.

    Blank rows are spread over the partitions by ``row_id``, unique among them, instead of
    gathering under one NULL key.
    """
    filled = F.col(key) != ""
    groups = [F.when(filled, F.col(key)), F.when(F.coalesce(~filled, F.lit(True)), F.col(row_id))]
    return best_per(df, groups, order)


def concat_ranked(value: str, keys: Sequence[str], order: Sequence[str | Column]) -> Column:
    """All non-NULL values of a group joined by commas in rank order; NULL when there is none.

    For groups of a known small size, such as one row per feed.
    """
    window = (
        Window.partitionBy(*keys)
        .orderBy(*[ordering(o) if isinstance(o, str) else o for o in order])
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    values = F.collect_list(value).over(window)
    return F.when(F.size(values) > 0, F.array_join(values, ","))

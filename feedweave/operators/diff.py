"""Diff of a source against a stored table, in one full-outer join on the key.

Both sides hold each key once (the source is deduplicated, the target has a primary key), so
the join cannot be skewed and no row is copied.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedweave.functions.coerce import cut, kept_as, null_to_zero
from feedweave.functions.keys import match_key
from feedweave.operators.pick import best_per

INSERT, UPDATE, UNTOUCHED, DELETE = "insert", "update", "untouched", "delete"


def conform(
    df: DataFrame, schema: T.StructType, lengths: dict[str, int] | None = None, nulls: str = "keep", more: Sequence[str] = (),
) -> DataFrame:
    """The columns of ``schema`` as the store would keep them: read leniently, cut, rounded and clamped.

    ``nulls`` is ``keep``, or ``zero`` to store '' and 0 in place of NULL. Columns ``more``
    come along as they are.
    """
    if nulls not in ("keep", "zero"):
        raise ValueError("nulls is 'keep' or 'zero'")

    def stored(field: T.StructField) -> Column:
        c = kept_as(F.col(field.name), df.schema[field.name].dataType, field.dataType)
        if (lengths or {}).get(field.name):
            c = cut(c, lengths[field.name])
        return (null_to_zero(c, field.dataType) if nulls == "zero" else c).alias(field.name)

    return df.select(*[stored(field) for field in schema], *more)


def last_per_key(source: DataFrame, key: str, order: Sequence[str | Column], key_policy: str = "exact") -> DataFrame:
    """One source row per key: of rows applied in turn under ``order``, the last one stays.

    ``order`` is given last row first, so that the pick keeps it.
    """
    return best_per(source, [match_key(F.col(key), key_policy)], order)


def classify(
    source: DataFrame,
    target: DataFrame,
    key: str,
    columns: Sequence[str],
    stamp: str,
    now: Column,
    delete_missing: bool = True,
    key_policy: str = "exact",
) -> DataFrame:
    """Every key of either side with its resulting values, its stamp and an ``action``.

    Columns are compared null-safe after both sides were brought to the stored types.
    Inserted and updated rows carry ``now``; untouched and deleted ones their old stamp.
    With ``delete_missing`` off, keys absent from the source are untouched. Under a
    ``key_policy`` that equates keys, both sides meet by the equated form, and a key that
    only differs in spelling is an update to the source's spelling.
    """

    def side(df: DataFrame, mark: str, *more: Column) -> DataFrame:
        return df.select(
            match_key(F.col(key), key_policy).alias("_key"),
            *[F.col(c).alias(f"_{mark}_{c}") for c in columns],
            F.lit(True).alias(f"_in_{mark}"),
            *more,
        )

    compared = [c for c in columns if c != key or key_policy != "exact"]
    same = reduce(lambda a, b: a & b, [F.col(f"_s_{c}").eqNullSafe(F.col(f"_t_{c}")) for c in compared], F.lit(True))
    action = (
        F.when(F.col("_in_s").isNull(), F.lit(DELETE if delete_missing else UNTOUCHED))
        .when(F.col("_in_t").isNull(), F.lit(INSERT))
        .when(same, F.lit(UNTOUCHED))
        .otherwise(F.lit(UPDATE))
    )
    both = side(source, "s").join(side(target, "t", F.col(stamp).alias("_t_stamp")), "_key", "full_outer")
    return both.withColumn("action", action).select(
        *[F.when(F.col("_in_s").isNotNull(), F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c) for c in columns],
        F.when(F.col("action").isin(INSERT, UPDATE), now).otherwise(F.col("_t_stamp")).alias(stamp),
        "action",
    )


def applied(classified: DataFrame) -> DataFrame:
    """The table after the sync: every classified row but the deleted ones."""
    return classified.filter(F.col("action") != DELETE).drop("action")


def _counted(*actions: str) -> Column:
    return F.coalesce(F.sum(F.col("action").isin(*actions).cast("long")), F.lit(0).cast("long"))


def report_columns() -> list[Column]:
    return [
        _counted(INSERT, UPDATE).alias("changed"),
        _counted(UNTOUCHED).alias("untouched"),
        _counted(DELETE).alias("deleted"),
    ]


def report(classified: DataFrame) -> DataFrame:
    """One row: inserted or updated, untouched, deleted."""
    return classified.agg(*report_columns())


def missing_keys(target: DataFrame, source: DataFrame, key: str, key_policy: str = "exact") -> DataFrame:
    """Target rows whose key the source does not have."""
    if key_policy == "exact":
        return target.join(source.select(key), key, "left_anti")
    theirs = source.select(match_key(F.col(key), key_policy).alias("_key"))
    return target.join(theirs, match_key(target[key], key_policy) == theirs["_key"], "left_anti")


def replace_into(stored: DataFrame, new: DataFrame, key: str, key_policy: str = "exact") -> DataFrame:
    """Stored rows with the new rows put in place of those of the same key.

    Both are read once and a key keeps one row: a new one before a stored one, of several new
    ones the greatest by value. Stored rows hold each key once, and NULL keys never meet.
    """
    columns = stored.columns
    both = stored.select(*columns, F.lit(0).alias("_new")).unionByName(new.select(*columns, F.lit(1).alias("_new")))
    keyed = match_key(F.col(key), key_policy) if isinstance(stored.schema[key].dataType, T.StringType) else F.col(key)
    lone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    order = [F.col("_new").desc(), *[F.col(c).desc_nulls_last() for c in columns]]
    return best_per(both.withColumns({"_key": keyed, "_lone": lone}), ["_key", "_lone"], order).select(*columns)

"""Running sums over an order that no single task could hold, and rows told apart by content."""

from __future__ import annotations

import gc

from feedweave.session import scratch_dir
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def written(df: DataFrame, label: str, release: bool = False, compression: str = "snappy") -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe from lost executors.

    Spark deletes a finished query's shuffle files when the driver's garbage collector finds
    that nobody holds its plan any more; ``release`` has it look now, so that the files of
    one phase do not lie beside those of the next.
    """
    spark = df.sparkSession
    path, schema = scratch_dir(spark, label), df.schema
    df.write.parquet(path, compression=compression)
    if release:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def running_sums(df: DataFrame, keys: list[str], order: list[Column | str], values: list[str], label: str) -> DataFrame:
    """``df`` with ``before_<value>``: the sum of each value over the rows ahead within the same keys.

    Rows are range-partitioned by keys and order, so a key with a third of all rows spreads
    over many tasks. Each part's sums give the offsets: as many rows as there are parts and
    keys. NULL keys are keys like others; NULLs come first; a NULL value counts as 0. Rows
    equal in keys and order stand in any order among themselves.
    """
    if clash := [c for c in df.columns if c.startswith("_rs_")]:
        raise ValueError(f"columns {clash} have names used here")
    by = [F.col(k) for k in keys] + [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    at = ranged.withColumn("_rs_at", F.monotonically_increasing_id())
    placed = written(at.withColumn("_rs_part", F.shiftright("_rs_at", 33)), label)
    amounts = {v: F.coalesce(F.col(v), F.lit(0)).cast("long") for v in values}
    parts = placed.groupBy("_rs_part", *keys).agg(*[F.sum(a).alias(f"_rs_sum_{v}") for v, a in amounts.items()])
    ahead = Window.partitionBy(*keys).orderBy("_rs_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        F.col("_rs_part").alias("_rs_p"), *[F.col(k).alias(f"_rs_k{n}") for n, k in enumerate(keys)],
        *[F.coalesce(F.sum(f"_rs_sum_{v}").over(ahead), F.lit(0)).alias(f"_rs_offset_{v}") for v in values],
    )
    within = Window.partitionBy("_rs_part", *keys).orderBy("_rs_at").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({f"_rs_local_{v}": F.coalesce(F.sum(a).over(within), F.lit(0)) for v, a in amounts.items()})
    same = F.col("_rs_part") == F.col("_rs_p")
    for n, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_rs_k{n}"))
    return local.join(offsets, same).select(
        *df.columns, *[(F.col(f"_rs_local_{v}") + F.col(f"_rs_offset_{v}")).alias(f"before_{v}") for v in values],
    )


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


def whole_row(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{name}`") for name in df.columns])


def row_hash(df: DataFrame) -> Column:
    """128 bits over all columns: rows of equal content are equal."""
    parts = [F.col(f"`{f.name}`").cast("string") if _has_map(f.dataType) else F.col(f"`{f.name}`") for f in df.schema]
    return F.struct(F.xxhash64(F.lit(0), *parts).alias("x"), F.xxhash64(F.lit(1), *parts).alias("y"))


def one_of_each(df: DataFrame, key: str) -> DataFrame:
    """One row for each value of ``key``; a task hands on at most one row per value."""
    first = Window.partitionBy(key).orderBy(key)
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")

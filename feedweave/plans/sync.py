"""Guarded synchronisation of a stored table with a freshly computed one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from feedweave.functions.coerce import strip_pound
from feedweave.functions.keys import match_key
from feedweave.operators import diff
from feedweave.operators.pick import best_per
from feedweave.operators.registry import empty_tables
from feedweave.plans.branches import DEFAULT, Branch
from feedweave.plans.targets import Target
from feedweave.session import scratch_dir
from feedweave.sources.bucketed import BUCKET, DIGEST, KEY, BucketedTable, Manifest, bucket_of, bucketed_view, digest, write_buckets
from feedweave.sources.versioned import Staged, VersionedTable


@dataclass(frozen=True)
class SyncReport:
    """What a run did; ``empty`` names the needed tables that kept it from doing anything."""

    changed: int
    untouched: int
    deleted: int
    empty: tuple[str, ...] = ()


class LockedTable(RuntimeError):
    """A table the sync needs is being loaded."""


def needed_tables(branches: tuple[Branch, ...] = DEFAULT) -> list[str]:
    """Tables the branches read, each once."""
    return list(dict.fromkeys(name for branch in branches for name in branch.tables()))


def prepared(source: DataFrame, target: Target, nulls: str = "keep", more: Sequence[str] = ()) -> DataFrame:
    """The source in the stored shape, pound sign stripped, keys never NULL; columns ``more`` as they are."""
    schema = T.StructType(target.schema().fields[:-1])
    lengths = {name: n for name, _, n in target.columns if n}
    if "name" in source.columns:
        source = source.withColumn("name", strip_pound(F.col("name")))
    if isinstance(schema[target.key].dataType, T.StringType):
        source = source.withColumn(target.key, F.coalesce(F.col(target.key), F.lit("")))
    return diff.conform(source, schema, lengths, nulls, more)


def classify(
    source: DataFrame,
    stored: DataFrame,
    target: Target,
    now: Column,
    nulls: str = "keep",
    delete_missing: bool = True,
    key_policy: str = "exact",
    order: Sequence[str] = (),
) -> DataFrame:
    """Every key with its resulting row and action; of a repeated source key one row counts.

    ``order`` names source columns in the order in which rows are applied: the last row of a
    key stays. Rows equal under it, or all without it, are told apart by their values.
    """
    rows, last = _in_turn(source, target, nulls, key_policy, order)
    unique = diff.last_per_key(rows, target.key, last, key_policy).select(*target.fields())
    return diff.classify(unique, stored, target.key, target.fields(), target.stamp, now, delete_missing, key_policy)


def _in_turn(source: DataFrame, target: Target, nulls: str, key_policy: str, order: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """The prepared rows, and the order in which the last row of a key comes first."""
    kept = [f"_order{n}" for n in range(len(order))]
    rows = prepared(source.withColumns({k: F.col(c) for k, c in zip(kept, order)}), target, nulls, kept)
    last = [F.col(k).desc_nulls_last() for k in kept]
    last += [F.col(name).desc_nulls_last() for name in target.fields() if name != target.key]
    if key_policy != "exact":
        last.append(F.col(target.key).desc())
    return rows, last


def stamp(now: datetime) -> Column:
    """A run's start time as a column, independent of any time zone setting."""
    return F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")


def preflight(tables: Mapping[str, DataFrame | VersionedTable], locked: DataFrame | None = None, also: Sequence[str] = ()) -> list[str]:
    """Raise when a needed table, or one named in ``also``, is locked; return the names of empty ones."""
    names = [*tables, *also]
    if locked is not None and names:
        found = locked.select("local_name").filter(F.col("local_name").isin(*names)).distinct().take(len(names))
        if found:
            raise LockedTable(f"locked: {', '.join(sorted(row[0] for row in found))}")
    return empty_tables(tables)


def run_sync(
    spark: SparkSession,
    source: DataFrame,
    table: VersionedTable,
    target: Target,
    now: datetime,
    needed: Mapping[str, DataFrame | VersionedTable] | None = None,
    locked: DataFrame | None = None,
    nulls: str = "keep",
    delete_missing: bool = True,
    key_policy: str = "exact",
    max_delete_fraction: float | None = None,
    note: str = "",
    order: Sequence[str] = (),
    keep_versions: int = 2,
) -> SyncReport:
    """Bring the stored table in line with ``source`` and count what happened.

    The target itself, or a needed table, being locked raises; an empty needed table makes
    the run do nothing and is named in the report. The counts are taken by the writing tasks
    themselves, after the last shuffle, where a repeated task is counted once.
    ``max_delete_fraction`` refuses to commit a run that would delete more than that share of
    the stored rows. What is committed follows the version that was read, so another writer
    in between makes this run fail instead of being overwritten. Without any change nothing
    is committed, unless a note is to be kept. A ``BucketedTable`` is rewritten only in the
    buckets that change.
    """
    if empty := preflight(needed or {}, locked, [target.name]):
        return SyncReport(0, 0, 0, tuple(empty))
    if isinstance(table, BucketedTable):
        return _run_buckets(
            spark, source, table, target, now, nulls, delete_missing, key_policy, max_delete_fraction, note, order, keep_versions,
        )
    base = table.version()
    stored = table.read(target.schema(), base)
    classified = classify(source, stored, target, stamp(now), nulls, delete_missing, key_policy, order)
    counts = Observation()
    staged = table.stage(diff.applied(classified.observe(counts, *diff.report_columns())), base, [target.key])
    got = counts.get
    result = SyncReport(got["changed"], got["untouched"], got["deleted"])
    if max_delete_fraction is not None and result.deleted:
        # Every stored row is deleted, kept or updated; inserted rows only add to the base.
        before = table.rows(base)
        before = stored.count() if before is None else before
        if result.deleted > max_delete_fraction * before:
            table.discard(staged)
            raise RuntimeError(f"{result.deleted} of {before} rows would be deleted; nothing committed")
    if base and not note and not result.changed and not result.deleted:
        table.discard(staged)
        return result
    table.commit(staged, note)
    table.expire(keep_versions)
    return result


def keyed_rows(
    source: DataFrame, target: Target, buckets: int, nulls: str = "keep", key_policy: str = "exact", order: Sequence[str] = (),
) -> DataFrame:
    """One row per key as it will be stored, with key, digest and bucket: shuffled once, into the buckets."""
    rows, last = _in_turn(source, target, nulls, key_policy, order)
    dealt = rows.withColumn(KEY, match_key(F.col(target.key), key_policy).cast("string")).repartition(buckets, KEY)
    unique = best_per(dealt, [KEY], last)
    columns = [F.col(name) for name in target.fields()]
    return unique.select(*columns, KEY, *digest(columns), bucket_of(F.col(KEY), buckets).alias(BUCKET))


def bucket_diff(rows: DataFrame, stored: DataFrame, target: Target, delete_missing: bool = True) -> DataFrame:
    """(key, bucket, action, stamp) of every key, from keys and digests alone; ``stamp`` is the stored one."""
    new = rows.select(KEY, F.col(BUCKET).alias("_new"), *[F.col(d).alias(f"{d}_new") for d in DIGEST])
    old = stored.select(KEY, F.col(BUCKET).alias("_old"), *[F.col(d).alias(f"{d}_old") for d in DIGEST], F.col(target.stamp).alias("stamp"))
    same = reduce(lambda a, b: a & b, [F.col(f"{d}_new") == F.col(f"{d}_old") for d in DIGEST])
    action = (
        F.when(F.col("_new").isNull(), F.lit(diff.DELETE if delete_missing else diff.UNTOUCHED))
        .when(F.col("_old").isNull(), F.lit(diff.INSERT)).when(same, F.lit(diff.UNTOUCHED)).otherwise(F.lit(diff.UPDATE))
    )
    return new.join(old, KEY, "full_outer").select(KEY, F.coalesce("_new", "_old").alias(BUCKET), action.alias("action"), "stamp")


def _run_buckets(
    spark: SparkSession, source: DataFrame, table: BucketedTable, target: Target, now: datetime, nulls: str, delete_missing: bool,
    key_policy: str, max_delete_fraction: float | None, note: str, order: Sequence[str], keep_versions: int,
) -> SyncReport:
    """The sync of a bucketed table: the source is laid out in its buckets, keys and digests are compared, changed buckets written.

    What reaches the driver is a row of counts per bucket. Without ``delete_missing`` only buckets that the
    source has rows of are read.
    """
    base = table.version()
    before = table.manifest(base)
    if before.policy != key_policy:
        raise ValueError(f"the table's keys are compared by {before.policy!r}, not {key_policy!r}")
    laid = VersionedTable(spark, scratch_dir(spark, "sync_source"))
    try:
        return _run_laid(spark, source, table, base, before, laid, target, now, nulls, delete_missing, max_delete_fraction, note, order, keep_versions)
    finally:
        laid.drop()


def _run_laid(
    spark: SparkSession, source: DataFrame, table: BucketedTable, base: int, before: Manifest, laid: VersionedTable, target: Target, now: datetime,
    nulls: str, delete_missing: bool, max_delete_fraction: float | None, note: str, order: Sequence[str], keep_versions: int,
) -> SyncReport:
    n, key_policy = before.buckets, before.policy
    rows = keyed_rows(source, target, n, nulls, key_policy, order)
    schema = T.StructType([f for f in rows.schema if f.name != BUCKET])
    write_buckets(rows, laid.path, n)
    filled = laid.folders(f"{BUCKET}=")
    held = before if delete_missing else Manifest(n, before.policy, {b: p for b, p in before.parts.items() if b in filled})
    staged = None
    with bucketed_view(spark, schema, n, {b: f"{laid.path}/{BUCKET}={b}" for b in filled}, laid.path) as new, table.view(held) as old:
        counts = {row[BUCKET]: row for row in bucket_diff(new, old, target, delete_missing).groupBy(BUCKET).agg(
            *diff.report_columns(), F.count(F.lit(1)).alias("all"),
        ).collect()}
        apart = before.rows() - held.rows()
        result = SyncReport(*(sum(row[c] for row in counts.values()) for c in ("changed", "untouched", "deleted")))
        result = replace(result, untouched=result.untouched + apart)
        if max_delete_fraction is not None and result.deleted > max_delete_fraction * before.rows():
            raise RuntimeError(f"{result.deleted} of {before.rows()} rows would be deleted; nothing committed")
        touched = sorted(b for b, row in counts.items() if row["changed"] or row["deleted"])
        if base and not note and not touched:
            return result
        if touched:
            staged = table.stage_buckets(_bucket_rows(new, old, target, now, touched, delete_missing), base)
    parts = dict(before.parts)
    for bucket in touched:
        left = counts[bucket]["all"] - counts[bucket]["deleted"]
        parts.pop(bucket, None)
        if left:
            parts[bucket] = (staged.folder, left)
    folder = staged.folder if staged else "none"
    table.commit(Staged(base + 1, folder, Manifest(n, before.policy, parts).text()), note)
    table.expire(keep_versions)
    return result


def _bucket_rows(new: DataFrame, old: DataFrame, target: Target, now: datetime, touched: list[int], delete_missing: bool) -> DataFrame:
    """The rows of the touched buckets after the sync. Of the stored rows only those without a new one are read whole."""
    new, old = new.filter(F.col(BUCKET).isin(touched)), old.filter(F.col(BUCKET).isin(touched))
    stamps = old.select(KEY, *[F.col(d).alias(f"{d}_old") for d in DIGEST], F.col(target.stamp).alias("_stamp"))
    same = reduce(lambda a, b: a & b, [F.col(d) == F.col(f"{d}_old") for d in DIGEST])
    columns = [*target.fields(), target.stamp, KEY, *DIGEST, BUCKET]
    rows = new.join(stamps, KEY, "left").withColumn(target.stamp, F.when(same, F.col("_stamp")).otherwise(stamp(now))).select(*columns)
    if delete_missing:
        return rows
    return rows.unionByName(old.join(new.select(KEY), KEY, "left_anti").select(*columns))

"""Loading a feed: parse, coerce, keep the first row per key, set the rest aside."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedweave.functions.keys import match_key
from feedweave.operators.pick import best_per
from feedweave.operators.registry import active, due
from feedweave.session import scratch_dir
from feedweave.sources.reader import BAD_LINE, POSITION, read_feed
from feedweave.sources.schema import FeedSpec
from feedweave.sources.versioned import VersionedTable

FIELDS, DUPLICATE = "fields", "duplicate"


@dataclass(frozen=True)
class LoadReport:
    """Rows loaded and rows set aside; a load without a single good row has failed."""

    feed: str
    completed: int
    missed: int
    error: str = ""

    @property
    def success(self) -> bool:
        return self.completed > 0


def _keys(spec: FeedSpec, key_policy: str, stored: bool = True) -> list[Column]:
    """The key columns as they are compared, of rows that hold stored values or still the feed's text."""
    kinds = dict(spec.columns)
    columns = [F.col(f"`{k}`") if stored else spec.coercion(k) for k in spec.keys]
    return [match_key(c, key_policy) if kinds[k] in ("String", "Description") else c for k, c in zip(spec.keys, columns)]


def coerced(raw: DataFrame, spec: FeedSpec) -> DataFrame:
    """Stored values of every line, with its position and ``_bad_line``."""
    return raw.select(*POSITION, *spec.coercions(), BAD_LINE)


def good_rows(raw: DataFrame, spec: FeedSpec, key_policy: str = "exact") -> DataFrame:
    """Rows with the right number of fields, of each key the first in file order."""
    rows = coerced(raw.filter(F.col(BAD_LINE).isNull()), spec).drop(BAD_LINE)
    return best_per(rows, _keys(spec, key_policy), POSITION) if spec.keys else rows


def _marked(raw: DataFrame, spec: FeedSpec, key_policy: str) -> DataFrame:
    """``raw`` with ``reject_reason``: wrong field count, repeated key, or NULL when good.

    Keys and positions are counted first, one row per task and key; only keys that occur
    more than once are met again, and the first position of each tells which row stays. A
    feed without repeated keys moves nothing but those counts, and a key repeated a billion
    times is joined with one row, which AQE splits.
    """
    reason = F.when(F.col(BAD_LINE).isNotNull(), F.lit(FIELDS))
    if not spec.keys:
        return raw.withColumn("reject_reason", reason)
    columns = [name for name, _ in spec.columns]
    rows = raw.withColumns({f"_key{n}": key for n, key in enumerate(_keys(spec, key_policy, stored=False))})
    keys = [f"_key{n}" for n in range(len(spec.keys))]
    place = F.struct(*POSITION)
    repeated = rows.filter(F.col(BAD_LINE).isNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"))
    repeated = repeated.filter("_n > 1").select(*[F.col(k).alias(f"_r{k}") for k in keys], "_first")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in keys])
    joined = rows.join(repeated, same, "left")
    later = F.col("_first").isNotNull() & (F.col("_first") != place)
    return joined.withColumn("reject_reason", reason.when(later, F.lit(DUPLICATE))).select(*POSITION, *[f"`{c}`" for c in columns], BAD_LINE, "reject_reason")


def with_reasons(raw: DataFrame, spec: FeedSpec, key_policy: str = "exact") -> DataFrame:
    """Stored values of every row with ``reject_reason``: wrong field count, repeated key, or NULL when good."""
    return _marked(raw, spec, key_policy).select(*POSITION, *spec.coercions(), BAD_LINE, "reject_reason")


def quarantine(raw: DataFrame, spec: FeedSpec, key_policy: str = "exact") -> DataFrame:
    """The rows a load sets aside, as text, with the reason."""
    return _marked(raw, spec, key_policy).filter("reject_reason IS NOT NULL")


def load_counts(reasons: DataFrame) -> DataFrame:
    """One row: lines loaded, lines set aside, and whether the load succeeded."""
    good = F.coalesce(F.sum(F.col("reject_reason").isNull().cast("long")), F.lit(0))
    counted = reasons.agg(good.alias("completed"), F.count(F.lit(1)).alias("_all"))
    return counted.select(
        F.col("completed").cast("long"), (F.col("_all") - F.col("completed")).alias("missed"), (F.col("completed") > 0).alias("success")
    )


def load_feed(
    spark: SparkSession,
    spec: FeedSpec,
    warehouse: str,
    path: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    key_policy: str = "exact",
) -> LoadReport:
    """Replace the feed's table by the file's content and keep the rejects beside it.

    The file is unpacked and split once, into a columnar copy in the shared folder that the
    passes for good rows and rejects read. Both are written before the table becomes
    current, and the counts are read back from what was written, so they stay right when
    tasks are repeated. Without a good row the previous version stays.
    """
    table = VersionedTable(spark, f"{warehouse}/{spec.name}")
    rejects = VersionedTable(spark, f"{warehouse}/{spec.name}_rejected")
    copy = VersionedTable(spark, scratch_dir(spark, f"load_{spec.name}"))
    copy.overwrite(read_feed(spark, spec, path))
    try:
        return _load(spark, spec, copy.read(), table, rejects, transform, key_policy)
    finally:
        copy.drop()


def _load(
    spark: SparkSession,
    spec: FeedSpec,
    raw: DataFrame,
    table: VersionedTable,
    rejects: VersionedTable,
    transform: Callable[[DataFrame], DataFrame] | None,
    key_policy: str,
) -> LoadReport:
    base = table.version()
    rejects.overwrite(quarantine(raw, spec, key_policy))
    missed = rejects.rows()
    staged = table.stage(good_rows(raw, spec, key_policy).drop(*POSITION), base, spec.keys)
    completed = staged.rows
    if completed:
        if transform is None and spec.after_import:
            transform = after_import(spark, spec)
        if transform is not None:
            loaded = staged
            staged = table.stage(transform(table.staged(loaded)), base)
            table.discard(loaded)
        table.commit(staged)
    else:
        table.discard(staged)
    for kept in (table, rejects):
        kept.expire()
    return LoadReport(spec.name, completed, missed)


def after_import(spark: SparkSession, spec: FeedSpec) -> Callable[[DataFrame], DataFrame]:
    """The registered statement that a load ends with, a SELECT over the feed's own name."""

    def run(loaded: DataFrame) -> DataFrame:
        return spark.sql(spec.after_import.replace(f"{{{spec.name}}}", "{loaded}"), loaded=loaded)

    return run


def load_due(
    spark: SparkSession,
    resources: DataFrame,
    sources: DataFrame,
    services: DataFrame,
    warehouse: str,
    which: str = "all",
    at: str | None = None,
    root: str = "",
    workers: int = 4,
    key_policy: str = "exact",
) -> list[LoadReport]:
    """Load all active feeds, the ones due at ``at`` (``which='auto'``), or the named one.

    Feeds are independent Spark jobs run side by side; one that fails, or whose record cannot
    be read, is reported and does not stop the others.
    """
    listed = active(resources, sources, services, None if which in ("all", "auto") else which)
    if which == "auto":
        if at is None:
            raise ValueError("auto needs the time, as HH:MM")
        listed = due(listed, at)
    records = [row.asDict() for row in listed.toLocalIterator()]  # one per registered feed

    def one(record: dict) -> LoadReport:
        try:
            spec = FeedSpec.from_record(record)
            return load_feed(spark, spec, warehouse, root + spec.path, key_policy=key_policy)
        except Exception as error:  # reported per feed
            return LoadReport(str(record.get("local_name")), 0, 0, str(error))

    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(one, records))

"""Jobs over the registry: which feeds exist, which are due, and whether the tables are fit.

Registry tables: ``services(id, service, name, port)``, ``sources(id, name, host, username,
password, service_id)`` and ``resources(id, active, locked, path, local_name, source_id,
conversion_rule, delimiter, enclosure, empty_lines, csv_header_row, indices, columns,
sync_time)``. Columns of a joined result are prefixed by table instead of overwriting each other.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from feedweave.operators import schedule as bitmaps
from feedweave.sources.versioned import VersionedTable


def with_sources(resources: DataFrame, sources: DataFrame, services: DataFrame) -> DataFrame:
    """Every resource with its source and service, where they exist. Logins stay out."""
    source = sources.select(
        F.col("id").alias("source_id"), F.col("name").alias("source_name"),
        F.col("host").alias("source_host"), F.col("service_id"),
    )
    service = services.select(F.col("id").alias("service_id"), F.col("service"), F.col("port").alias("service_port"))
    return resources.join(source, "source_id", "left").join(service, "service_id", "left")


def active(resources: DataFrame, sources: DataFrame, services: DataFrame, name: str | None = None) -> DataFrame:
    """Active, unlocked resources, or the one of that name."""
    kept = resources.filter("active AND NOT locked")
    if name is not None:
        kept = kept.filter(F.col("local_name") == name)
    return with_sources(kept, sources, services)


def to_convert(resources: DataFrame, sources: DataFrame, services: DataFrame) -> DataFrame:
    """Active resources whose file is not a plain csv."""
    return with_sources(resources.filter("active AND conversion_rule != 'csv'"), sources, services)


def by_id(df: DataFrame, table: DataFrame, id_column: str, prefix: str) -> DataFrame:
    """Rows of ``df`` with the record their id points to, its columns prefixed."""
    record = table.select(*[F.col(c).alias(prefix + c) for c in table.columns])
    return df.join(record, F.col(id_column) == F.col(f"{prefix}id"), "left")


# Schedule ------------------------------------------------------------------------------

def _agree(digits: Column, pattern: Column, count: int) -> Column:
    """Whether each of the first ``count`` digits is the pattern's, or the pattern has ``*`` there."""
    wanted = [F.substring(pattern, i, 1) for i in range(1, count + 1)]
    return reduce(lambda a, b: a & b, [(w == "*") | (w == F.substring(digits, i + 1, 1)) for i, w in enumerate(wanted)])


def _without_colon(time: Column) -> Column:
    return F.replace(time, F.lit(":"), F.lit(""))


def matches(time: Column, pattern: Column) -> Column:
    """Whether a time is one of those an ``HH:MM`` pattern stands for."""
    return _agree(_without_colon(time), _without_colon(pattern), 4)


def due_minutes(pattern: Column) -> Column:
    """The minutes an ``HH:MM`` pattern with ``*`` digits stands for, in order.

    The 24 hours and 60 minutes are matched on their own and combined.
    """
    def matching(part: Column, last: int) -> Column:
        numbers = F.transform(F.sequence(F.lit(0), F.lit(last)), lambda n: F.format_string("%02d", n))
        return F.filter(numbers, lambda n: _agree(n, part, 2))

    digits = _without_colon(pattern)
    hours, minutes = matching(F.substring(digits, 1, 2), 23), matching(F.substring(digits, 3, 2), 59)
    return F.flatten(F.transform(hours, lambda h: F.transform(minutes, lambda m: F.concat(h, F.lit(":"), m))))


def _listed() -> Column:
    return F.from_json(F.coalesce("sync_time", F.lit("[]")), "array<string>")


def patterns(resources: DataFrame) -> DataFrame:
    """One row per resource and distinct pattern of its ``sync_time`` list."""
    return resources.select("local_name", F.explode(F.array_distinct(_listed())).alias("pattern"))


def schedule(resources: DataFrame) -> DataFrame:
    """Every minute of the day at which a resource is due, once per resource.

    Rows of one name meet as bitmaps; minutes are taken from those, so none comes twice and none is moved.
    """
    return bitmaps.times(bitmaps.schedules(resources))


def due(resources: DataFrame, time: str) -> DataFrame:
    """Resources due at one ``HH:MM``."""
    hit = F.exists(_listed(), lambda p: matches(F.lit(time), p))
    return resources.filter(hit)


# Preflight -----------------------------------------------------------------------------

def locked_tables(needed: DataFrame, resources: DataFrame) -> DataFrame:
    """Needed tables (column ``local_name``) the registry holds as locked; unregistered ones pass."""
    return needed.join(resources.filter("locked").select("local_name"), "local_name", "left_semi")


def _recorded(table: DataFrame | VersionedTable) -> int | None:
    """The rows of a versioned table as its last commit has them."""
    return table.rows() if isinstance(table, VersionedTable) else None


def _rows(table: DataFrame | VersionedTable) -> DataFrame:
    return table.read() if isinstance(table, VersionedTable) else table


def empty_tables(tables: Mapping[str, DataFrame | VersionedTable]) -> list[str]:
    """Names of the tables without any row: a versioned one's commit says so, of others at most one row is read."""
    found = {name: _recorded(table) for name, table in tables.items()}
    return [name for name, n in found.items() if n == 0 or n is None and _rows(tables[name]).isEmpty()]


def table_counts(tables: Mapping[str, DataFrame | VersionedTable]) -> DataFrame:
    """Row count of each table and whether it has any row; versioned tables are not scanned."""
    def counted(name: str, table: DataFrame | VersionedTable) -> DataFrame:
        if (n := _recorded(table)) is not None:
            return table.spark.range(1).select(F.lit(name).alias("table_name"), F.lit(n).cast("long").alias("row_count"))
        return _rows(table).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")

    counts = [counted(name, table) for name, table in tables.items()]
    return reduce(DataFrame.unionByName, counts).withColumn("has_rows", F.col("row_count") > 0)


# Validation ----------------------------------------------------------------------------

def _every_part(c: Column, separator: str, accepted) -> Column:
    return F.forall(F.split(c, separator), accepted)


def _host(c: Column) -> Column:
    """Four numbers up to 255 without leading zeros, or dotted names of letters, digits and inner hyphens."""
    number = lambda part: part.rlike("^[0-9]{1,3}$") & (part.try_cast("int") < 256) & ((part == "0") | ~part.startswith("0"))
    name = lambda part: part.rlike("^[a-zA-Z0-9-]+$") & ~part.startswith("-") & ~part.endswith("-")
    return (F.size(F.split(c, r"\.")) == 4) & _every_part(c, r"\.", number) | _every_part(c, r"\.", name)


def _path(c: Column) -> Column:
    """Absolute, every part made of letters, digits, dots, underscores and hyphens."""
    return c.startswith("/") & _every_part(F.substr(c, F.lit(2)), "/", lambda part: part.rlike("^[a-zA-Z0-9._-]+$"))


def _time(c: Column) -> Column:
    """HH:MM, any digit possibly an asterisk, such that some time of day fits."""
    at = [F.substring(c, k, 1) for k in (1, 2, 3, 4, 5)]
    hour = at[0].isin("*", "0", "1") & at[1].rlike("[0-9*]") | (at[0] == "2") & at[1].isin("*", "0", "1", "2", "3")
    return (F.length(c) == 5) & hour & (at[2] == ":") & at[3].rlike("[0-5*]") & at[4].rlike("[0-9*]")


# The accepted forms of registry values.
RULES = {
    "host": _host,
    "path": _path,
    "integer": lambda c: c.try_cast("double").isNotNull() & ~c.rlike("[A-DF-Za-df-z]"),
    "string": lambda c: c != "",
    "yes/no": lambda c: c.isin("yes", "no"),
    "time": _time,
}


def valid(c: Column, kind: str) -> Column:
    """Whether a value has the accepted form; NULL does not."""
    return F.coalesce(RULES[kind](c.cast("string")), F.lit(False))


def violations(df: DataFrame, id_column: str, kinds: Mapping[str, str]) -> DataFrame:
    """One row per value that breaks the rule of its column."""
    checks = [
        F.when(~valid(F.col(c), kind), F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("rule"), F.col(c).cast("string").alias("value")))
        for c, kind in kinds.items()
    ]
    broken = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return df.select(id_column, F.inline(broken))


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that should be unique but are not, with their count."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str = "id") -> DataFrame:
    """Rows whose reference points to no parent row."""
    return df.join(parent, df[column] == parent[parent_column], "left_anti")

"""Registry, schedule, preflight and validation jobs over registries derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedweave.functions.paths import directory, extension, file_name
from feedweave.operators import registry, schedule
from feedweave.session import scratch_dir
from feedweave.sources.schema import registered_columns
from feedweave.sources.versioned import VersionedTable
from suite import query, read
from suite.feeds import from_given, twin

SERVICES = """
    SELECT r_regionkey + 1 AS id, lower(r_name) AS service, concat('Service ', r_name) AS name,
           CASE WHEN r_regionkey = 4 THEN NULL ELSE 20 + r_regionkey END AS port FROM {region}"""
SOURCES = """
    SELECT s_suppkey AS id, CASE WHEN s_suppkey % 15 = 0 THEN 'shared name' ELSE s_name END AS name,
           CASE WHEN s_suppkey % 6 = 0 THEN concat('10.0.', CAST(s_nationkey AS STRING), '.', CAST(s_suppkey % 300 AS STRING))
                WHEN s_suppkey % 7 = 0 THEN concat('bad_host!', CAST(s_suppkey AS STRING)) WHEN s_suppkey % 11 = 0 THEN NULL
                ELSE concat(lower(replace(s_name, '#', '-')), '.example.com') END AS host,
           '' AS username, '' AS password, s_nationkey % 8 AS service_id
    FROM {supplier}"""
RESOURCES = """
    SELECT c_custkey AS id, c_custkey % 5 <> 0 AS active, c_custkey % 7 = 0 AS locked,
           concat(CASE WHEN c_custkey % 9 = 0 THEN '' ELSE '/' END, 'lists/', lower(c_mktsegment), CASE WHEN c_custkey % 8 = 0 THEN ' ' ELSE '/' END,
                  CAST(c_custkey AS STRING), '.csv') AS path,
           concat('feed_', CAST(CASE WHEN c_custkey % 50 = 0 THEN c_custkey + 1 ELSE c_custkey END AS STRING)) AS local_name,
           CASE WHEN c_custkey % 10 = 3 THEN -1 ELSE c_custkey % 90 END AS source_id,
           CASE c_custkey % 4 WHEN 0 THEN 'csv' WHEN 1 THEN 'gz→csv' WHEN 2 THEN 'zip→csv' ELSE NULL END AS conversion_rule,
           ';' AS delimiter, '~' AS enclosure, CAST(c_custkey % 3 AS INT) AS empty_lines, c_custkey % 2 = 0 AS csv_header_row,
           CASE WHEN c_custkey % 3 = 0 THEN '[]' ELSE '[~code~]' END AS indices,
           CASE WHEN c_custkey % 2 = 0 THEN '{{~name~:[~code~,~price~],~type~:[1,3]}}' ELSE '{{~name~:[~code~,~qty~,~day~],~type~:[~1~,~2~,~4~]}}' END AS columns,
           CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN concat('[~*', CAST(c_custkey % 10 AS STRING), ':0*~,~*', CAST(c_custkey % 10 AS STRING), ':05~]')
                WHEN 2 THEN concat('[~2*:', CAST(c_custkey % 6 AS STRING), '5~]') ELSE '[~12:3*~,~0*:00~]' END AS sync_time
    FROM {customer}"""


def dq(sql: str) -> str:
    """``~`` as a plain double quote inside text, for both engines."""
    return sql.replace("~", '"')


RES, SRC, SRV = twin(dq(RESOURCES)), twin(SOURCES), twin(SERVICES)
TABLES = f"WITH resources AS ({RES}), sources AS ({SRC}), services AS ({SRV})"
STAR = """resources LEFT JOIN sources ON resources.source_id = sources.id LEFT JOIN services ON sources.service_id = services.id"""
STAR_COLUMNS = """resources.id, local_name, path, conversion_rule, source_id, sources.name AS source_name,
    sources.host AS source_host, CAST(sources.service_id AS INTEGER) AS service_id, service, CAST(port AS INTEGER) AS service_port"""
STAR_SHOWN = ["id", "local_name", "path", "conversion_rule", "source_id", "source_name", "source_host", "service_id", "service", "service_port"]


def registry_tables(spark, sf_dir):
    return [from_given(spark, sf_dir, sql) for sql in (dq(RESOURCES), SOURCES, SERVICES)]


def resources(spark, sf_dir):
    return from_given(spark, sf_dir, dq(RESOURCES))


@query(f"{TABLES} SELECT {STAR_COLUMNS} FROM {STAR} WHERE active AND NOT locked")
def registry_active(spark, sf_dir):
    return registry.active(*registry_tables(spark, sf_dir)).select(*STAR_SHOWN)


@query(f"{TABLES} SELECT {STAR_COLUMNS} FROM {STAR} WHERE active AND conversion_rule <> 'csv'")
def registry_to_convert(spark, sf_dir):
    return registry.to_convert(*registry_tables(spark, sf_dir)).select(*STAR_SHOWN)


@query(f"{TABLES} SELECT resources.id, resources.source_id, sources.name AS source_name FROM resources LEFT JOIN sources ON source_id = sources.id")
def registry_by_id(spark, sf_dir):
    listed, sources, _ = registry_tables(spark, sf_dir)
    record = registry.by_id(listed.select("id", "source_id"), sources, "source_id", "record_")
    return record.select("id", "source_id", F.col("record_name").alias("source_name"))


@query(f"""SELECT local_name, position, column_name, type_name, is_key FROM (
    SELECT local_name, id, CAST(generate_subscripts(CASE WHEN id % 2 = 0 THEN ['code', 'price'] ELSE ['code', 'qty', 'day'] END, 1) - 1 AS INTEGER) AS position,
           unnest(CASE WHEN id % 2 = 0 THEN ['code', 'price'] ELSE ['code', 'qty', 'day'] END) AS column_name,
           unnest(CASE WHEN id % 2 = 0 THEN ['String', 'Float'] ELSE ['String', 'Integer', 'Date'] END) AS type_name,
           unnest(CASE WHEN id % 2 = 0 THEN [id % 3 <> 0, false] ELSE [id % 3 <> 0, false, false] END) AS is_key FROM ({RES}))""")
def read_registered_schema(spark, sf_dir):
    return registered_columns(resources(spark, sf_dir))


# Schedule --------------------------------------------------------------------------------

MINUTES = "SELECT lpad((m // 60)::VARCHAR, 2, '0') || ':' || lpad((m % 60)::VARCHAR, 2, '0') AS time FROM range(1440) t(m)"
PATTERNS = f"SELECT DISTINCT local_name, unnest(CAST(coalesce(sync_time, '[]')::JSON AS VARCHAR[])) AS pattern FROM ({RES})"
MATCHED = f"""SELECT DISTINCT local_name, time FROM ({PATTERNS}) JOIN ({MINUTES}) ON regexp_matches(time, concat('^', replace(pattern, '*', '.'), '$'))"""


@query(f"SELECT local_name, count(*) AS minutes, min(time) AS first_time, max(time) AS last_time FROM ({MATCHED}) GROUP BY local_name")
def schedule_expand(spark, sf_dir):
    hours = F.col("hours")
    return schedule.schedules(resources(spark, sf_dir)).select(
        "local_name", schedule.minutes(hours).alias("minutes"), schedule.first_time(hours).alias("first_time"), schedule.last_time(hours).alias("last_time"),
    )


@query(f"SELECT local_name, time FROM ({MATCHED})")
def schedule_minutes(spark, sf_dir):
    """Every minute at which a feed is due, for those who want rows."""
    return registry.schedule(resources(spark, sf_dir))


@query(f"""SELECT local_name, coalesce(min(time) FILTER (WHERE time > '12:35'), min(time)) AS next_time FROM ({MATCHED}) GROUP BY local_name""")
def schedule_next(spark, sf_dir):
    return schedule.schedules(resources(spark, sf_dir)).select("local_name", schedule.next_time(F.col("hours"), "12:35").alias("next_time"))


@query(f"SELECT time, count(*) AS resources FROM ({MATCHED}) GROUP BY time HAVING count(*) > 1")
def schedule_overlaps(spark, sf_dir):
    return schedule.load(schedule.schedules(resources(spark, sf_dir))).filter("resources > 1")


@query(f"SELECT id, local_name FROM ({RES}) WHERE sync_time IS NOT NULL AND local_name IN (SELECT local_name FROM ({MATCHED}) WHERE time = '12:35')"
       f" AND EXISTS (SELECT 1 FROM (SELECT unnest(CAST(sync_time::JSON AS VARCHAR[])) AS p) WHERE regexp_matches('12:35', concat('^', replace(p, '*', '.'), '$')))")
def schedule_due(spark, sf_dir):
    listed = F.from_json(F.coalesce("sync_time", F.lit("[]")), "array<string>")
    return resources(spark, sf_dir).filter(schedule.is_due(schedule.day_bits(listed), "12:35")).select("id", "local_name")


@query(f"""SELECT event_id, substr(CAST(ts AS VARCHAR), 12, 5) AS time FROM events WHERE regexp_matches(substr(CAST(ts AS VARCHAR), 12, 5), '^.1:00$')
    OR regexp_matches(substr(CAST(ts AS VARCHAR), 12, 5), '^0.:3.$') OR regexp_matches(substr(CAST(ts AS VARCHAR), 12, 5), '^12:..$')""")
def schedule_events(spark, sf_dir):
    """Events at whose time a feed with one of three patterns would be due."""
    events = read(spark, sf_dir, "events").select("event_id", F.date_format("ts", "HH:mm").alias("time"))
    first, second, third = (registry.matches(F.col("time"), F.lit(p)) for p in ("*1:00", "0*:3*", "12:**"))
    return events.filter(first | second | third)


# Preflight -------------------------------------------------------------------------------

NEEDED = "SELECT DISTINCT concat('feed_', CAST(o_custkey AS STRING)) AS local_name FROM {orders}"


@query(f"SELECT local_name FROM ({twin(NEEDED)}) WHERE local_name IN (SELECT local_name FROM ({RES}) WHERE locked)")
def preflight_locks(spark, sf_dir):
    return registry.locked_tables(from_given(spark, sf_dir, NEEDED), resources(spark, sf_dir))


def counted_tables(spark, sf_dir):
    lineitem, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    return {"lineitem": lineitem, "orders": orders, "returned": lineitem.filter("l_returnflag = 'R'"), "negative": orders.filter("o_totalprice < 0")}


COUNTS = """SELECT 'lineitem' AS table_name, count(*) AS row_count FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'returned', count(*) FROM lineitem WHERE l_returnflag = 'R' UNION ALL SELECT 'negative', count(*) FROM orders WHERE o_totalprice < 0"""


@query(f"SELECT *, row_count > 0 AS has_rows FROM ({COUNTS})")
def table_counts(spark, sf_dir):
    return registry.table_counts(counted_tables(spark, sf_dir))


@query(f"SELECT table_name FROM ({COUNTS}) WHERE row_count = 0")
def preflight_empty(spark, sf_dir):
    return registry.table_counts(counted_tables(spark, sf_dir)).filter("NOT has_rows").select("table_name")


@query(f"SELECT *, row_count > 0 AS has_rows FROM ({COUNTS})")
def table_counts_from_commits(spark, sf_dir):
    """The same tables as versioned ones: their commits know the counts."""
    folder, tables = scratch_dir(spark, "counted"), {}
    for name, df in counted_tables(spark, sf_dir).items():
        tables[name] = VersionedTable(spark, f"{folder}/{name}")
        tables[name].overwrite(df)
    return registry.table_counts(tables)


# Validation ------------------------------------------------------------------------------

# The accepted forms, worded here once more and apart from the library.
BAD_PATH = """path NOT LIKE '/%' OR path LIKE '%/' OR path LIKE '%//%' OR regexp_matches(path, '[^a-zA-Z0-9._/-]')"""
NUMBERS = """len(string_split(host, '.')) = 4 AND list_bool_and(list_transform(string_split(host, '.'), lambda x:
    try_cast(x AS INTEGER) BETWEEN 0 AND 255 AND CAST(try_cast(x AS INTEGER) AS VARCHAR) = x))"""
LABELS = """list_bool_and(list_transform(string_split(host, '.'), lambda x: x <> '' AND NOT x LIKE '-%' AND NOT x LIKE '%-'
    AND NOT regexp_matches(x, '[^a-zA-Z0-9-]')))"""


@query(f"""SELECT 'path' AS column_name, 'path' AS rule, path AS value, id FROM ({RES}) WHERE {BAD_PATH}
    UNION ALL SELECT 'conversion_rule', 'string', conversion_rule, id FROM ({RES}) WHERE conversion_rule IS NULL OR conversion_rule = ''
    UNION ALL SELECT 'local_name', 'integer', local_name, id FROM ({RES}) WHERE try_cast(local_name AS DOUBLE) IS NULL
    UNION ALL SELECT 'host', 'host', host, id FROM ({SRC}) WHERE host IS NULL OR NOT coalesce({NUMBERS}, false) AND NOT coalesce({LABELS}, false)""")
def registry_violations(spark, sf_dir):
    listed, sources, _ = registry_tables(spark, sf_dir)
    broken = registry.violations(listed, "id", {"path": "path", "conversion_rule": "string", "local_name": "integer"})
    return broken.unionByName(registry.violations(sources, "id", {"host": "host"}))


@query(f"""SELECT id, pattern FROM (SELECT id, unnest(CAST(coalesce(sync_time, '[]')::JSON AS VARCHAR[])) AS pattern FROM ({RES}))
    WHERE length(pattern) = 5 AND pattern[3] = ':' AND EXISTS (SELECT 1 FROM ({MINUTES})
        WHERE regexp_full_match(time, replace(pattern, '*', '.')))""")
def valid_times(spark, sf_dir):
    listed = F.from_json(F.coalesce("sync_time", F.lit("[]")), "array<string>")
    patterns = resources(spark, sf_dir).select("id", F.explode(listed).alias("pattern"))
    return patterns.filter(registry.valid(F.col("pattern"), "time"))


@query(f"""SELECT 'name' AS what, name AS value, count(*) AS n FROM ({SRC}) GROUP BY name HAVING count(*) > 1
    UNION ALL SELECT 'local_name', local_name, count(*) FROM ({RES}) GROUP BY local_name HAVING count(*) > 1
    UNION ALL SELECT 'orphan source', CAST(id AS VARCHAR), 1 FROM ({RES}) r WHERE source_id NOT IN (SELECT id FROM ({SRC}))
    UNION ALL SELECT 'orphan service', CAST(id AS VARCHAR), 1 FROM ({SRC}) s WHERE service_id NOT IN (SELECT id FROM ({SRV}))""")
def registry_dups_fks(spark, sf_dir):
    listed, sources, services = registry_tables(spark, sf_dir)

    def orphaned(what, df, column, parent):
        rows = registry.orphans(df, column, parent)
        return rows.select(F.lit(what).alias("what"), F.col("id").cast("string").alias("value"), F.lit(1).cast("long").alias("n"))

    def repeated(what, df):
        return registry.duplicates(df, what).select(F.lit(what).alias("what"), "value", "n")

    return (
        repeated("name", sources).unionByName(repeated("local_name", listed))
        .unionByName(orphaned("orphan source", listed, "source_id", sources))
        .unionByName(orphaned("orphan service", sources, "service_id", services))
    )


@query("""SELECT page_id, list_extract(string_split(url, '/'), -1) AS name, list_extract(string_split(list_extract(string_split(url, '/'), -1), '.'), -1) AS extension,
    array_to_string(list_slice(string_split(url, '/'), 1, len(string_split(url, '/')) - 1), '/') AS directory FROM pages""")
def path_parts(spark, sf_dir):
    url = F.col("url")
    return read(spark, sf_dir, "pages").select(
        "page_id", file_name(url).alias("name"), extension(url).alias("extension"), directory(url).alias("directory")
    )

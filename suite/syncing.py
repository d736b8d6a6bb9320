"""Diff, merge, report, replace and the guarded, versioned run."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from feedweave.functions.coerce import strip_pound
from feedweave.operators import diff
from feedweave.plans import flat, sync
from feedweave.plans.targets import CLOTHING, Target
from feedweave.session import scratch_dir
from feedweave.sources.bucketed import BucketedTable
from feedweave.sources.versioned import VersionedTable
from feedweave.streaming.sync_stream import sync_stream
from suite import query
from suite.consolidation import CLOTHING_SQL
from suite.feeds import Tables, from_given, twin, with_feeds

NOW = datetime(2024, 6, 1, 12, 30)
NOW_SQL = "CAST('2024-06-01 12:30:00' AS TIMESTAMP)"
VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]

SOURCE = """
    SELECT CAST(o_orderkey AS STRING) AS id, o_custkey, o_orderstatus, o_totalprice,
           CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
    FROM {orders} WHERE o_orderkey % 7 <> 0"""
STORED = """
    SELECT CAST(o_orderkey AS STRING) AS id, o_custkey, o_orderstatus,
           CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
           o_orderdate AS updated
    FROM {orders} WHERE o_orderkey % 3 <> 0"""
ORDERS = Target("orders", "id", "updated", (
    ("id", "string", None), ("o_custkey", "bigint", None), ("o_orderstatus", "string", 1),
    ("o_totalprice", "double", None), ("o_orderpriority", "string", 15),
))


def classified_sql(source: str, stored: str, values=tuple(VALUES), missing: str = "delete") -> str:
    changed = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in values)
    columns = ", ".join(f"CASE WHEN s.id IS NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in values)
    return f"""SELECT id, {', '.join(values)}, action,
        CASE WHEN action IN ('insert', 'update') THEN {NOW_SQL} ELSE stamp END AS updated FROM (
        SELECT coalesce(s.id, t.id) AS id, {columns}, t.updated AS stamp,
               CASE WHEN s.id IS NULL THEN '{missing}' WHEN t.id IS NULL THEN 'insert'
                    WHEN {changed} THEN 'update' ELSE 'untouched' END AS action
        FROM ({source}) s FULL JOIN ({stored}) t ON s.id = t.id)"""


CLASSIFIED = classified_sql(twin(SOURCE), twin(STORED))
SHOWN = "id, " + ", ".join(VALUES) + ", CAST(updated AS VARCHAR) AS updated"


def classified(spark, sf_dir, **options):
    source, stored = from_given(spark, sf_dir, SOURCE), from_given(spark, sf_dir, STORED)
    return diff.classify(source, stored, "id", ["id", *VALUES], "updated", sync.stamp(NOW), **options)


@query(f"SELECT {SHOWN}, action FROM ({CLASSIFIED})")
def sync_classify(spark, sf_dir):
    return classified(spark, sf_dir)


@query(f"SELECT {SHOWN} FROM ({CLASSIFIED}) WHERE action <> 'delete'")
def sync_apply(spark, sf_dir):
    return diff.applied(classified(spark, sf_dir))


@query(f"SELECT {SHOWN} FROM ({classified_sql(twin(SOURCE), twin(STORED), missing='untouched')})")
def sync_keep_missing(spark, sf_dir):
    return diff.applied(classified(spark, sf_dir, delete_missing=False))


@query(f"""SELECT count(*) FILTER (WHERE action IN ('insert', 'update')) AS changed,
    count(*) FILTER (WHERE action = 'untouched') AS untouched, count(*) FILTER (WHERE action = 'delete') AS deleted
    FROM ({CLASSIFIED})""")
def sync_report(spark, sf_dir):
    return diff.report(classified(spark, sf_dir))


@query(f"SELECT id, CAST(updated AS VARCHAR) AS updated FROM ({CLASSIFIED}) WHERE action IN ('insert', 'update')")
def sync_stamp(spark, sf_dir):
    return classified(spark, sf_dir).filter(F.col("action").isin("insert", "update")).select("id", "updated")


@query(f"SELECT id FROM ({twin(STORED)}) t WHERE NOT EXISTS (SELECT 1 FROM ({twin(SOURCE)}) s WHERE s.id = t.id)")
def sync_deleted(spark, sf_dir):
    return diff.missing_keys(from_given(spark, sf_dir, STORED), from_given(spark, sf_dir, SOURCE), "id").select("id")


# A source that holds each key many times, applied in turn by ship date and line.
REPEATED = """
    SELECT CAST(l_orderkey AS STRING) AS id, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate FROM {lineitem}"""


@query(f"""SELECT id, l_partkey, l_suppkey, l_extendedprice FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
    FROM ({twin(REPEATED)})) WHERE rn = 1""")
def sync_dedup_source(spark, sf_dir):
    order = [f"{c} desc" for c in ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    last = diff.last_per_key(from_given(spark, sf_dir, REPEATED), "id", order)
    return last.select("id", "l_partkey", "l_suppkey", "l_extendedprice")


@query(f"""SELECT id, o_totalprice FROM ({twin(STORED)}) t WHERE id NOT IN (SELECT id FROM ({twin(SOURCE)}))
    UNION ALL SELECT id, o_totalprice FROM ({twin(SOURCE)})""")
def replace_into(spark, sf_dir):
    stored = from_given(spark, sf_dir, STORED).select("id", "o_totalprice")
    return diff.replace_into(stored, from_given(spark, sf_dir, SOURCE).select("id", "o_totalprice"), "id")


@query(f"""SELECT id, o_totalprice FROM ({twin(STORED)}) t WHERE id NOT IN (SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem)
    UNION ALL SELECT CAST(l_orderkey AS VARCHAR), max(l_extendedprice) FROM lineitem GROUP BY l_orderkey""")
def replace_into_repeated_keys(spark, sf_dir):
    """Of several new rows of a key the greatest stays, so keys stay unique."""
    stored = from_given(spark, sf_dir, STORED).select("id", "o_totalprice")
    new = from_given(spark, sf_dir, "SELECT CAST(l_orderkey AS STRING) AS id, l_extendedprice AS o_totalprice FROM {lineitem}")
    return diff.replace_into(stored, new, "id")


# Lines applied in turn by ship date and line; the last one of an order stays, whatever its values.
TURNS = """
    SELECT CAST(l_orderkey AS STRING) AS id, l_partkey AS o_custkey, l_returnflag AS o_orderstatus, l_extendedprice AS o_totalprice,
           l_linestatus AS o_orderpriority, l_shipdate, l_linenumber, l_suppkey FROM {lineitem}"""


@query(f"""SELECT {SHOWN} FROM (SELECT *, CAST('2024-06-01 12:30:00' AS TIMESTAMP) AS updated, row_number() OVER (PARTITION BY id ORDER BY
    l_shipdate DESC, l_linenumber DESC, l_suppkey DESC, o_custkey DESC, o_orderstatus DESC, o_totalprice DESC, o_orderpriority DESC) AS rn
    FROM ({twin(TURNS)})) WHERE rn = 1""")
def sync_last_wins(spark, sf_dir):
    table = VersionedTable(spark, scratch_dir(spark, "sync_turns"))
    sync.run_sync(spark, from_given(spark, sf_dir, TURNS), table, ORDERS, NOW, order=["l_shipdate", "l_linenumber", "l_suppkey"])
    return table.read(ORDERS.schema())


@query(f"""SELECT 'empty: negative' AS outcome, count(*) AS rows FROM ({twin(STORED)})
    UNION ALL SELECT 'locked: orders', count(*) FROM ({twin(STORED)})
    UNION ALL SELECT 'too many deletes', count(*) FROM ({twin(STORED)})""")
def sync_guarded(spark, sf_dir):
    """Every guard stops the run and leaves the stored table as it was."""
    table = VersionedTable(spark, scratch_dir(spark, "sync_guarded"))
    stored, source = from_given(spark, sf_dir, STORED).drop("updated"), from_given(spark, sf_dir, SOURCE)
    sync.run_sync(spark, stored, table, ORDERS, CREATED)
    outcomes = []

    def attempt(**options):
        try:
            outcomes.append(f"empty: {', '.join(sync.run_sync(spark, source, table, ORDERS, NOW, **options).empty)}")
        except sync.LockedTable as error:
            outcomes.append(str(error))
        except RuntimeError:
            outcomes.append("too many deletes")
        return table.read().select(F.lit(outcomes[-1]).alias("outcome"))

    locked = from_given(spark, sf_dir, "SELECT DISTINCT 'orders' AS local_name FROM {orders}")
    attempts = [attempt(needed={"source": source, "negative": source.filter("o_totalprice < 0")}), attempt(locked=locked), attempt(max_delete_fraction=0.001)]
    return reduce(DataFrame.unionByName, attempts).groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))


@query(f"SELECT action, count(*) AS keys FROM ({CLASSIFIED}) GROUP BY action")
def sync_bucket_diff(spark, sf_dir):
    """Keys and digests of a bucketed table against the source's, without a shuffle of either."""
    folder, n = scratch_dir(spark, "sync_diff"), 16
    table = BucketedTable(spark, f"{folder}/table", ORDERS.schema(), buckets=n)
    sync.run_sync(spark, from_given(spark, sf_dir, STORED).drop("updated"), table, ORDERS, CREATED)
    rows = sync.keyed_rows(from_given(spark, sf_dir, SOURCE), ORDERS, n)
    with table.view(table.manifest()) as stored:
        counted = sync.bucket_diff(rows, stored, ORDERS).groupBy("action").agg(F.count(F.lit(1)).alias("keys"))
        counted.write.parquet(f"{folder}/result")
    return spark.read.parquet(f"{folder}/result")


# Ids in spellings that differ in case, accents and trailing spaces; the stored ones are plain.
ACCENTED = SOURCE.replace("CAST(o_orderkey AS STRING) AS id", "concat(CASE o_orderkey % 4 WHEN 0 THEN 'É' WHEN 1 THEN 'é' WHEN 2 THEN 'E ' ELSE 'e' END, CAST(o_orderkey AS STRING), CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE '' END) AS id")
PLAIN = STORED.replace("CAST(o_orderkey AS STRING) AS id", "concat(CASE WHEN o_orderkey % 4 = 2 THEN 'e ' ELSE 'e' END, CAST(o_orderkey AS STRING)) AS id")


@query(f"""WITH s AS ({twin(ACCENTED)}), t AS ({twin(PLAIN)})
    SELECT coalesce(s.id, t.id) AS id, CASE WHEN s.id IS NULL THEN 'delete' WHEN t.id IS NULL THEN 'insert'
        WHEN {' OR '.join(f's.{c} IS DISTINCT FROM t.{c}' for c in ('id', *VALUES))} THEN 'update' ELSE 'untouched' END AS action
    FROM s FULL JOIN t ON lower(strip_accents(rtrim(s.id))) = lower(strip_accents(rtrim(t.id)))""")
def sync_any_accent(spark, sf_dir):
    source, stored = from_given(spark, sf_dir, ACCENTED), from_given(spark, sf_dir, PLAIN)
    return sync.classify(source, stored, ORDERS, sync.stamp(NOW), key_policy="ci_ai").select("id", "action")


# The clothing list has several lines per article; the stored one lacks some and differs in others.
CLOTHING_VALUES = [c for c in CLOTHING.fields() if c != "id"]
LAST_LINE = ", ".join(f"{c} DESC NULLS LAST" for c in CLOTHING_VALUES)
CLOTHING_SOURCE = f"""SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY {LAST_LINE}) AS rn FROM ({CLOTHING_SQL})) WHERE rn = 1"""
CLOTHING_STORED = """
    SELECT concat('A', CAST(p_partkey AS STRING)) AS id, concat('A', CAST(p_partkey AS STRING)) AS CODART,
           '598' AS FAM, '006' AS SOTTOFAM, p_brand AS GENERE, p_type AS TIPO_PROD, 'S' AS STAGIONE, p_name AS DESCRIZIONE,
           p_size AS GIACENZA, CAST(p_retailprice AS DECIMAL(12,2)) AS PREZZO, p_name AS CODFOR, p_size AS TAGLIA,
           'none' AS COLORE, CAST('2023-01-01 00:00:00' AS {timestamp}) AS updated
    FROM {part} WHERE p_partkey % 4 <> 1"""


@query(f"""{with_feeds(['clothing_list'])}
    SELECT * REPLACE (CAST(PREZZO AS DOUBLE) AS PREZZO, CAST(updated AS VARCHAR) AS updated) FROM (
    {classified_sql(CLOTHING_SOURCE, twin(CLOTHING_STORED).replace('{timestamp}', 'TIMESTAMP'), CLOTHING_VALUES)})""")
def sync_single_feed(spark, sf_dir):
    source = flat.clothing(Tables(spark, sf_dir)["clothing_list"])
    stored = from_given(spark, sf_dir, CLOTHING_STORED.replace("{timestamp}", "TIMESTAMP_NTZ"))
    return sync.classify(source, stored, CLOTHING, sync.stamp(NOW))


# The whole run over a versioned table: create it, then bring it in line with the source.
CREATED = datetime(2024, 1, 1)
CREATED_SQL = f"SELECT * REPLACE (CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS updated) FROM ({twin(STORED)})"


@query(f"SELECT {SHOWN} FROM ({classified_sql(twin(SOURCE), CREATED_SQL)}) WHERE action <> 'delete'")
def sync_run(spark, sf_dir):
    """Into a bucketed table, whose unchanged buckets are left as they are."""
    table = BucketedTable(spark, scratch_dir(spark, "sync_run"), ORDERS.schema(), buckets=16)
    stored, source = from_given(spark, sf_dir, STORED).drop("updated"), from_given(spark, sf_dir, SOURCE)
    sync.run_sync(spark, stored, table, ORDERS, CREATED, needed={"stored": stored})
    sync.run_sync(spark, source, table, ORDERS, NOW, needed={"source": source})
    return table.read(ORDERS.schema())


def files_of(spark, path, schema):
    """The files of a table as a stream, whether the table is one file or a folder of them."""
    jvm, path = spark._jvm, path.rstrip("/")
    file = jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema)
    if file.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(file).isFile():
        folder, _, name = path.rpartition("/")  # a stream reads folders only
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


@query(f"SELECT {SHOWN} FROM ({classified_sql(twin(SOURCE), CREATED_SQL, missing='untouched')})")
def sync_stream_available_now(spark, sf_dir):
    folder = scratch_dir(spark, "sync_stream")
    table = BucketedTable(spark, f"{folder}/table", ORDERS.schema(), buckets=16)
    sync.run_sync(spark, from_given(spark, sf_dir, STORED).drop("updated"), table, ORDERS, CREATED)
    schema = spark.read.parquet(f"{sf_dir}/orders.parquet").schema
    arriving = files_of(spark, f"{sf_dir}/orders.parquet", schema)
    rows = arriving.filter("o_orderkey % 7 <> 0").select(
        F.col("o_orderkey").cast("string").alias("id"), "o_custkey", "o_orderstatus", "o_totalprice",
        F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    run = sync_stream(rows, table, ORDERS, f"{folder}/checkpoint", NOW)
    run.awaitTermination()
    if run.exception() is not None:
        raise run.exception()
    return table.read(ORDERS.schema())


@query("SELECT p_partkey, CASE WHEN name LIKE '£%' THEN substr(name, 2) ELSE name END AS name FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN concat('£', CASE WHEN p_partkey % 4 = 0 THEN '£' ELSE '' END, p_name) ELSE concat(p_name, '£') END AS name FROM part)")
def strip_prefix(spark, sf_dir):
    named = from_given(spark, sf_dir, "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN concat('£', CASE WHEN p_partkey % 4 = 0 THEN '£' ELSE '' END, p_name) ELSE concat(p_name, '£') END AS name FROM {part}")
    return named.select("p_partkey", strip_pound(F.col("name")).alias("name"))

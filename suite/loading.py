"""Lenient coercion, load rules and readers."""

from __future__ import annotations

import gzip
import io
import sys
import zipfile
from collections.abc import Callable
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from feedweave.functions import coerce as c
from feedweave.operators import diff, profile
from feedweave.session import scratch_dir
from feedweave.sources import load
from feedweave.sources.archives import archive_lines
from feedweave.sources.reader import clean_lines, clean_records, line_window, parse_lines, read_feed, read_lines
from feedweave.sources.records import whole_records
from feedweave.sources.schema import FeedSpec
from suite import query, read
from suite.feeds import from_given, twin

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors do not have this module

# Coercion of dirty text ------------------------------------------------------------------

BLANKED = "SELECT p_partkey, concat(chr(9), ' ', chr(10), p_name, '  ', chr(11), chr(13)) AS t FROM {part}"


@query(f"SELECT p_partkey, trim(t, concat(' ', chr(9), chr(10), chr(13), chr(11))) AS t FROM ({twin(BLANKED)})")
def coerce_trim(spark, sf_dir):
    return from_given(spark, sf_dir, BLANKED).select("p_partkey", c.trim_blanks(F.col("t")).alias("t"))


NUMBERS = """
    SELECT l_orderkey, l_linenumber,
           CASE l_linenumber WHEN 1 THEN concat(CAST(l_partkey AS STRING), '.7') WHEN 2 THEN 'abc' WHEN 3 THEN ' '
                WHEN 4 THEN concat('-', CAST(l_partkey AS STRING), 'x') WHEN 5 THEN concat('99999', CAST(l_partkey AS STRING), '00000')
                WHEN 6 THEN NULL ELSE concat('  ', CAST(l_partkey AS STRING), ' pcs') END AS t
    FROM {lineitem}"""


@query(f"""SELECT l_orderkey, l_linenumber, CAST(greatest(-2147483648.0, least(2147483647.0, n)) AS INTEGER) AS n FROM (
    SELECT *, coalesce(try_cast(regexp_extract(trim(t), '^([+-]?[0-9]+)', 1) AS DOUBLE), 0) AS n FROM ({twin(NUMBERS)}))""")
def coerce_int(spark, sf_dir):
    return from_given(spark, sf_dir, NUMBERS).select("l_orderkey", "l_linenumber", c.lenient_int(F.col("t")).alias("n"))


AMOUNTS = """
    SELECT l_orderkey, l_linenumber,
           CASE l_linenumber WHEN 1 THEN replace(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING), '.', ',') WHEN 2 THEN 'abc'
                WHEN 3 THEN concat('1.', CAST(l_partkey AS STRING), ',56') WHEN 4 THEN concat(CAST(l_suppkey AS STRING), ' EUR')
                WHEN 5 THEN concat('-', CAST(l_suppkey AS STRING), '.') WHEN 6 THEN NULL ELSE '1e2' END AS t
    FROM {lineitem}"""
FLOAT_SQL = r"""coalesce(try_cast(regexp_extract(replace(trim(t), ',', '.'), '^([+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?)', 1) AS DOUBLE), 0)"""


@query(f"SELECT l_orderkey, l_linenumber, {FLOAT_SQL} AS x FROM ({twin(AMOUNTS)})")
def coerce_float(spark, sf_dir):
    return from_given(spark, sf_dir, AMOUNTS).select("l_orderkey", "l_linenumber", c.lenient_float(F.col("t")).alias("x"))


DAYS = """
    SELECT o_orderkey, CASE o_orderkey % 7
               WHEN 0 THEN concat(substr(d, 9, 2), '/', substr(d, 6, 2), '/', substr(d, 3, 2))
               WHEN 1 THEN concat(substr(d, 9, 2), '/', substr(d, 6, 2), '/', substr(d, 1, 4))
               WHEN 2 THEN concat(substr(d, 9, 2), '-', substr(d, 6, 2), '-', substr(d, 1, 4))
               WHEN 3 THEN d WHEN 4 THEN 'junk' WHEN 5 THEN '' ELSE NULL END AS t
    FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d FROM {orders})"""


@query("""SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN concat('20', substr(d, 3)) WHEN 1 THEN d WHEN 2 THEN d WHEN 3 THEN d
    ELSE '1970-01-01' END AS d FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders)""")
def coerce_date(spark, sf_dir):
    return from_given(spark, sf_dir, DAYS).select("o_orderkey", c.lenient_date(F.col("t")).alias("d"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0 THEN
    CAST(CAST(least(l_extendedprice * (l_linenumber * 40000), 9999999999.99) AS DECIMAL(12,2)) AS DOUBLE) END AS x FROM lineitem""")
def round_money(spark, sf_dir):
    x = F.when(F.col("l_tax") > 0, F.col("l_extendedprice") * (F.col("l_linenumber") * 40000))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", c.round_money(x).alias("x"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0 THEN CAST(round(least(l_partkey * 3000000 + l_extendedprice, 2147483647)) AS INTEGER) END AS n, substr(concat(l_returnflag, l_shipdate::DATE::VARCHAR), 1, 8) AS t FROM lineitem")
def cut_clamp(spark, sf_dir):
    text = F.concat("l_returnflag", F.col("l_shipdate").cast("date").cast("string"))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", c.clamp_int(F.when(F.col("l_tax") > 0, F.col("l_partkey") * 3000000 + F.col("l_extendedprice"))).alias("n"), c.cut(text, 8).alias("t"))


GAPS = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS priority,
           CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS price,
           CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day
    FROM {orders}"""


@query(f"SELECT o_orderkey, coalesce(priority, '') AS priority, CAST(coalesce(price, 0) AS DOUBLE) AS price, CAST(day AS VARCHAR) AS day FROM ({twin(GAPS)})")
def null_policy(spark, sf_dir):
    schema = T.StructType.fromDDL("o_orderkey bigint, priority string, price decimal(12,2), day date")
    return diff.conform(from_given(spark, sf_dir, GAPS), schema, nulls="zero")


# A raw feed ------------------------------------------------------------------------------
# One line per order: key, price with a decimal comma, short date, status, quoted note. Some
# lines are short, some long; keys repeat.

LINES = """
    SELECT 'orders.csv' AS _file, CAST(0 AS BIGINT) AS _block, o_orderkey AS _row,
           CASE WHEN o_orderkey % 11 = 0 THEN concat(code, ';', price)
                ELSE concat(code, ';', price, ';', day, '; ', o_orderstatus, ' ;~', o_orderpriority, '; said ~~so~~~',
                            CASE WHEN o_orderkey % 13 = 0 THEN ';extra' ELSE '' END) END AS value
    FROM (SELECT *, concat(CASE WHEN o_orderkey % 2 = 0 THEN 'C' ELSE 'c' END, CAST(o_custkey AS STRING)) AS code,
                 replace(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING), '.', ',') AS price,
                 concat(substr(CAST(o_orderdate AS STRING), 9, 2), '/', substr(CAST(o_orderdate AS STRING), 6, 2), '/',
                        substr(CAST(o_orderdate AS STRING), 3, 2)) AS day FROM {orders})"""
SPEC = FeedSpec(
    "orders", (("code", "String"), ("price", "Float"), ("day", "Date"), ("status", "String"), ("note", "Description")), keys=("code",)
)
BAD = "(o_orderkey % 11 = 0 OR o_orderkey % 13 = 0)"
ROWS_SQL = f"""SELECT o_orderkey AS _row, concat(CASE WHEN o_orderkey % 2 = 0 THEN 'C' ELSE 'c' END, o_custkey) AS code,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price, concat('20', substr(CAST(o_orderdate AS VARCHAR), 3, 8)) AS day,
    o_orderstatus AS status, concat(o_orderpriority, '; said "so"') AS note, {BAD} AS bad FROM orders"""
GOOD_SQL = f"SELECT * FROM ({ROWS_SQL}) WHERE NOT bad"


def first_lines(key: str) -> str:
    return f"""SELECT _row, code, price, day, status, note FROM (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY _row) AS rn FROM ({GOOD_SQL})) WHERE rn = 1"""


def raw_lines(spark, sf_dir) -> DataFrame:
    # In these lines ~ stands for the quote character of the feed.
    return from_given(spark, sf_dir, LINES.replace("~", '"'))


def raw(spark, sf_dir) -> DataFrame:
    return parse_lines(raw_lines(spark, sf_dir), SPEC)


@query(f"SELECT code, price, day, status, note, _row FROM ({GOOD_SQL})")
def load_parse(spark, sf_dir):
    rows = load.coerced(raw(spark, sf_dir), SPEC).filter("_bad_line IS NULL")
    return rows.select("_row", "code", "price", "day", "status", "note")


@query(f"""SELECT r._row, r.code, CASE WHEN r.bad THEN 'fields' WHEN f._row IS NULL THEN 'duplicate' END AS reject_reason
    FROM ({ROWS_SQL}) r LEFT JOIN ({first_lines('code')}) f ON r._row = f._row """)
def load_quarantine(spark, sf_dir):
    return load.with_reasons(raw(spark, sf_dir), SPEC).select("_row", "code", "reject_reason")


@query(first_lines("code"))
def load_unique_first(spark, sf_dir):
    return load.good_rows(raw(spark, sf_dir), SPEC).select("_row", "code", "price", "day", "status", "note")


@query(first_lines("lower(code)"))
def load_unique_first_any_case(spark, sf_dir):
    return load.good_rows(raw(spark, sf_dir), SPEC, "ci").select("_row", "code", "price", "day", "status", "note")


# The same lines with codes in four spellings.
CASES, SPELLINGS = "CASE WHEN o_orderkey % 2 = 0 THEN 'C' ELSE 'c' END", "CASE o_orderkey % 4 WHEN 0 THEN 'Ç' WHEN 1 THEN 'ç' WHEN 2 THEN 'C' ELSE 'c' END"


@query(first_lines("lower(strip_accents(code))").replace(CASES, SPELLINGS))
def load_unique_first_any_accent(spark, sf_dir):
    lines = from_given(spark, sf_dir, LINES.replace("~", '"').replace(CASES, SPELLINGS))
    return load.good_rows(parse_lines(lines, SPEC), SPEC, "ci_ai").select("_row", "code", "price", "day", "status", "note")


@query(f"""SELECT good AS completed, total - good AS missed, good > 0 AS success FROM
    (SELECT count(*) AS good FROM ({first_lines('code')})), (SELECT count(*) AS total FROM orders)""")
def load_report(spark, sf_dir):
    return load.load_counts(load.with_reasons(raw(spark, sf_dir), SPEC))


@query(f"""SELECT status, count(*) AS n, CAST(sum(CAST(price * 100 AS BIGINT)) AS BIGINT) AS cents FROM ({first_lines('code')}) WHERE status <> 'P' GROUP BY status""")
def load_post_transform(spark, sf_dir):
    def after(df: DataFrame) -> DataFrame:
        cents = F.sum((F.col("price") * 100).cast("bigint")).alias("cents")
        return df.filter("status <> 'P'").groupBy("status").agg(F.count(F.lit(1)).alias("n"), cents)
    return load.good_rows(raw(spark, sf_dir), SPEC).transform(after)


# Readers: the lines above, written and read back ----------------------------------------

FILE_ROWS = f"SELECT code, price, day, status, note FROM ({GOOD_SQL})"


def good_of(spark, spec, path) -> DataFrame:
    rows = load.coerced(read_feed(spark, spec, path), spec).filter("_bad_line IS NULL")
    return rows.select("code", "price", "day", "status", "note")


def spec_with(**changes) -> FeedSpec:
    return FeedSpec(SPEC.name, SPEC.columns, **changes)


@query(FILE_ROWS)
def read_csv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    raw_lines(spark, sf_dir).select("value").write.text(path)
    return good_of(spark, spec_with(), path)


@query(FILE_ROWS)
def read_gz(spark, sf_dir):
    path = scratch_dir(spark, "gz")
    raw_lines(spark, sf_dir).select("value").write.text(path, compression="gzip")
    return good_of(spark, spec_with(conversion=("gz", "csv")), path)


def with_junk(lines: DataFrame) -> DataFrame:
    """Two junk lines and a header in front of every file to be written."""

    def add(batches):
        yield pd.DataFrame({"value": ["Price list", ""]})
        yield pd.DataFrame({"value": ["code;price;day;status;note"]})
        yield from batches

    return lines.select("value").mapInPandas(add, "value string")


@query(FILE_ROWS)
def read_skip_lines(spark, sf_dir):
    path = scratch_dir(spark, "junk")
    with_junk(raw_lines(spark, sf_dir)).write.text(path)
    return good_of(spark, spec_with(skip_lines=2, header=True, multi_line=False), path)


@query(first_lines("code").replace('_row, code', "code", 1))
def read_and_load(spark, sf_dir):
    """The whole load into versioned tables. One file, so that file order is the row order."""
    folder = scratch_dir(spark, "load")
    ordered = raw_lines(spark, sf_dir).repartitionByRange("_row").sortWithinPartitions("_row")
    ordered.select("value").write.text(f"{folder}/in")
    load.load_feed(spark, SPEC, f"{folder}/tables", f"{folder}/in")
    return load.VersionedTable(spark, f"{folder}/tables/{SPEC.name}").read(SPEC.schema())


def zipped(text: str) -> bytes:
    """The text as a zip archive whose first entry holds it and whose second is a decoy."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("list.csv", text)
        archive.writestr("readme.txt", "not this one")
    return out.getvalue()


def zipped_gzip(text: str) -> bytes:
    """The text gzipped inside a zip archive."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("list.csv.gz", gzip.compress(text.encode()))
    return out.getvalue()


#: Archives that are in memory at once.
PACKED_AT_ONCE = 64


def archives_of(texts: DataFrame, pack: Callable[[str], bytes]) -> DataFrame:
    """(path, content): each text (path, text) in an archive; of a batch a few are packed and handed on at a time."""

    def add(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, PACKED_AT_ONCE):
                some = batch.slice(k, PACKED_AT_ONCE)
                contents = pa.array((pack(text.as_py()) for text in some.column(1)), pa.binary())
                yield pa.RecordBatch.from_arrays([some.column(0), contents], ["path", "content"])

    return texts.select("path", "text").mapInArrow(add, "path string, content binary")


TEXT_LINES = r"""SELECT doc_id, line_no - 1 AS _row, value FROM (
    SELECT doc_id, generate_subscripts(parts, 1) AS line_no, regexp_replace(unnest(parts), '[\x{FEFF}\r\n]', '', 'g') AS value
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)) WHERE value <> ''"""


def unpacked(spark, sf_dir, pack, steps) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    texts = documents.select(F.col("doc_id").cast("string").alias("path"), "text")
    lines = clean_lines(archive_lines(archives_of(texts, pack), steps))
    return lines.select(F.col("_file").cast("bigint").alias("doc_id"), "_row", "value")


@query(TEXT_LINES)
def read_zip(spark, sf_dir):
    return unpacked(spark, sf_dir, zipped, ["zip"])


@query(TEXT_LINES)
def read_conversion_chain(spark, sf_dir):
    return unpacked(spark, sf_dir, zipped_gzip, ["zip", "gz", "csv"])


# Records over several lines: a document's id, its quoted text with all its line breaks, its language.

DOCUMENT_SPEC = FeedSpec("documents", (("id", "String"), ("body", "Description"), ("lang", "String")), keys=("id",))
DOCUMENT_RECORD = "concat(CAST(doc_id AS STRING), ';\"', replace(translate(text, '\\r\\0\\u000b\\ufeff', ''), '\"', '\"\"'), '\";', lang)"
STORED_TEXT = r"trim(translate(text, concat(chr(13), chr(11), chr(65279)), ''), concat(' ', chr(9), chr(10)))"
DOCUMENT_ROWS = f"SELECT CAST(doc_id AS VARCHAR) AS id, {STORED_TEXT} AS body, lang FROM documents"


@query(DOCUMENT_ROWS)
def read_multi_line(spark, sf_dir):
    path = scratch_dir(spark, "multi")
    read(spark, sf_dir, "documents").select(F.expr(DOCUMENT_RECORD)).write.text(path)
    rows = load.coerced(read_feed(spark, DOCUMENT_SPEC, path), DOCUMENT_SPEC).filter("_bad_line IS NULL")
    return rows.select("id", "body", "lang")


@query(DOCUMENT_ROWS)
def read_zip_multi_line(spark, sf_dir):
    """Each document an archive of one record; the records are put together from the lines unpacked."""
    texts = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.expr(DOCUMENT_RECORD).alias("text"))
    lines = scratch_dir(spark, "unpacked")
    archive_lines(archives_of(texts, zipped), ["zip"]).write.parquet(lines)
    records = clean_records(whole_records(spark.read.parquet(lines), ";", '"'))
    rows = load.coerced(parse_lines(records, DOCUMENT_SPEC), DOCUMENT_SPEC).filter("_bad_line IS NULL")
    return rows.select("id", "body", "lang")


# Of each order one line; every seventh has a quote that is never closed.
OPEN_LINES = """
    SELECT 'open.csv' AS _file, CAST(0 AS BIGINT) AS _block, o_orderkey AS _row,
           concat(CAST(o_orderkey AS STRING), ';', CASE WHEN o_orderkey % 7 = 0 THEN '~never closed' WHEN o_orderkey % 5 = 0 THEN '~a;b~~c~' ELSE '5~ disk' END) AS value
    FROM {orders}"""


@query("SELECT o_orderkey AS _row, CASE WHEN o_orderkey % 7 = 0 THEN 'fields' END AS reject_reason FROM orders")
def load_open_quotes(spark, sf_dir):
    spec = FeedSpec("open", (("id", "Integer"), ("note", "String")), multi_line=False)
    lines = from_given(spark, sf_dir, OPEN_LINES.replace("~", '"'))
    return load.with_reasons(parse_lines(lines, spec), spec).select("_row", "reject_reason")


# The same orders in 16 files, each with quoted notes over two lines up to its middle, where a quote opens that nothing closes.
OPEN_FILES = """
    SELECT part, o_orderkey, concat(CAST(o_orderkey AS STRING), ';', CASE WHEN place < half THEN concat('~over', chr(10), 'two; ~~lines~~~')
           WHEN place = half THEN '~never closed' ELSE concat('plain ', o_orderpriority) END) AS value
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey % 16 ORDER BY o_orderkey) AS place,
                 floor(count(*) OVER (PARTITION BY o_custkey % 16) / 2) + 1 AS half, o_custkey % 16 AS part FROM {orders})"""


@query("""SELECT CASE WHEN place <> half THEN o_orderkey END AS id, CASE WHEN place < half THEN concat('over', chr(10), 'two; "lines"')
        WHEN place > half THEN concat('plain ', o_orderpriority) END AS note, CASE WHEN place = half THEN concat(o_orderkey, ';"never closed') END AS bad
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey % 16 ORDER BY o_orderkey) AS place,
                 floor(count(*) OVER (PARTITION BY o_custkey % 16) / 2) + 1 AS half FROM orders)""")
def read_open_quotes(spark, sf_dir):
    """A quote that is never closed costs its own line, however much stands behind it."""
    path = scratch_dir(spark, "open")
    lines = from_given(spark, sf_dir, OPEN_FILES.replace("~", '"'))
    lines.repartition("part").sortWithinPartitions("part", "o_orderkey").select("part", "value").write.partitionBy("part").text(path)
    spec = FeedSpec("open", (("id", "Integer"), ("note", "Description")))
    raw = read_feed(spark, spec, path)
    good, bad = F.col("_bad_line").isNull(), F.col("_bad_line")
    return load.coerced(raw, spec).select(F.when(good, F.col("id").cast("long")).alias("id"), F.when(good, F.col("note")).alias("note"), bad.alias("bad"))


# Registered imports: three feeds of the same lines, one of them due, one with a statement after it.
IMPORTED = f"SELECT code, price, status FROM ({first_lines('code')})"
COLUMNS = '{"name":["code","price","day","status","note"],"type":[1,3,4,1,5]}'


def imported(spark, sf_dir, **which) -> DataFrame:
    folder = scratch_dir(spark, "import")
    raw_lines(spark, sf_dir).repartitionByRange("_row").sortWithinPartitions("_row").select("value").write.text(f"{folder}/in/lines")
    rows = [
        (1, True, False, "/lines", "lines", 1, "csv", ";", '"', 0, False, '["code"]', COLUMNS, '["12:**"]', None),
        (2, True, False, "/lines", "open_orders", 1, "csv", ";", '"', 0, False, '["code"]', COLUMNS, None,
         "SELECT code, price, status FROM {open_orders} WHERE status = 'O'"),
        (3, True, False, "/lines", "broken", 1, "csv", ";", '"', 0, False, '["code"]', "{", '["12:30"]', None),
    ]
    resources = spark.createDataFrame(
        rows, "id long, active boolean, locked boolean, path string, local_name string, source_id long, conversion_rule string, "
        "delimiter string, enclosure string, empty_lines int, csv_header_row boolean, indices string, columns string, sync_time string, sql_after_import string",
    )
    sources = spark.createDataFrame([(1, "lists", "host", 1)], "id long, name string, host string, service_id long")
    services = spark.createDataFrame([(1, "local", "Local", None)], "id long, service string, name string, port int")
    reports = load.load_due(spark, resources, sources, services, f"{folder}/tables", root=f"{folder}/in", **which)
    tables = [
        load.VersionedTable(spark, f"{folder}/tables/{r.feed}").read().select(F.lit(r.feed).alias("feed"), "code", "price", "status")
        for r in reports if r.success
    ]
    failed = spark.createDataFrame([(r.feed,) for r in reports if not r.success], "feed string")
    return reduce(DataFrame.unionByName, tables).unionByName(failed, allowMissingColumns=True)


@query(f"SELECT 'lines' AS feed, code, price, status FROM ({IMPORTED}) UNION ALL SELECT 'broken', NULL, NULL, NULL")
def import_due(spark, sf_dir):
    return imported(spark, sf_dir, which="auto", at="12:30")


@query(f"SELECT 'open_orders' AS feed, code, price, status FROM ({IMPORTED}) WHERE status = 'O'")
def import_named(spark, sf_dir):
    return imported(spark, sf_dir, which="open_orders")


@query(f"SELECT code, price, day, status, note FROM ({GOOD_SQL})")
def header_schema(spark, sf_dir):
    """The spec comes from the header that every file begins with."""
    path = scratch_dir(spark, "header")
    with_junk(raw_lines(spark, sf_dir)).write.text(path)
    header = read_lines(spark, path, 2).limit(1).first()["value"]
    spec = FeedSpec.from_header("orders", header, {"price": "Float", "day": "Date", "note": "Description"}, skip_lines=2)
    return good_of(spark, spec, path)


# Profiling -------------------------------------------------------------------------------

PROFILED = f"""SELECT code, price, day, status, note FROM (SELECT concat(CASE WHEN o_orderkey % 2 = 0 THEN 'C' ELSE 'c' END, o_custkey) AS code,
    replace(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') AS price, CAST(o_orderdate AS VARCHAR) AS day,
    o_orderstatus AS status, concat(o_orderpriority, '; said "so"') AS note FROM orders WHERE NOT {BAD})"""


@query(f"""SELECT column_name, count(*) AS filled, 0::BIGINT AS as_integer,
    count(*) FILTER (WHERE column_name = 'price') AS as_float, count(*) FILTER (WHERE column_name = 'day') AS as_date,
    count(*) AS as_string, count(*) AS as_description,
    CASE column_name WHEN 'price' THEN 'Float' WHEN 'day' THEN 'Date' ELSE 'String' END AS proposed_type
    FROM (UNPIVOT ({PROFILED}) ON code, price, day, status, note INTO NAME column_name VALUE v) GROUP BY column_name""")
def profile_columns(spark, sf_dir):
    return profile.profile_columns(raw(spark, sf_dir).filter("_bad_line IS NULL"), ["code", "price", "day", "status", "note"])


@query(f"""SELECT d AS delimiter, (length(bare) - length(replace(bare, d, '')) + 1)::INTEGER AS n_fields, count(*) AS n_lines
    FROM (SELECT regexp_replace(value, '"[^"]*"', '', 'g') AS bare FROM ({LINES.replace('~', '"').replace('{orders}', 'orders')})),
         (SELECT unnest([';', ',', '|', chr(9)]) AS d) GROUP BY ALL""")
def field_count_histogram(spark, sf_dir):
    return profile.field_counts(raw_lines(spark, sf_dir))


@query(f"""SELECT d AS delimiter, (length(bare) - length(replace(bare, d, '')) + 1)::INTEGER AS n_fields, count(*) AS n_lines
    FROM (SELECT regexp_replace(value, '\\|[^|]*\\|', '', 'g') AS bare FROM ({LINES.replace('~', '|').replace('{orders}', 'orders')})),
         (SELECT unnest([';', ',']) AS d) GROUP BY ALL""")
def field_count_other_enclosure(spark, sf_dir):
    return profile.field_counts(from_given(spark, sf_dir, LINES.replace("~", "|")), (";", ","), "|")


@query(f"""SELECT _row, unnest(['code', 'status', 'note']) AS column_name, unnest([code, status, note]) AS value
    FROM (SELECT * FROM ({GOOD_SQL}) ORDER BY _row LIMIT 10)""")
def head_sample(spark, sf_dir):
    return profile.column_sample(raw(spark, sf_dir).filter("_bad_line IS NULL"), ["code", "status", "note"], ["_row"])


@query(f"""SELECT value FROM (SELECT _row, value FROM ({LINES.replace('~', '"').replace('{orders}', 'orders')}) ORDER BY _row LIMIT 25 OFFSET 5)""")
def line_window_sample(spark, sf_dir):
    return line_window(raw_lines(spark, sf_dir), 5, 25).select("value")

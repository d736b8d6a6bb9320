"""Catalogue enrichment of products derived from the parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedweave.functions.paths import without_login
from feedweave.operators import catalogue, diff
from feedweave.operators.lookup import Lookup, join_lookup
from feedweave.plans import enrich
from feedweave.session import scratch_dir
from feedweave.sources.catalogue_files import entries as catalogue_entries, stored_entries
from feedweave.sources.versioned import VersionedTable
from suite import query
from suite.feeds import from_given, twin

PRODUCTS = """
    SELECT concat('P', CAST(p_partkey AS STRING)) AS id, p_brand AS manufacturer_id,
           CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 7 = 0 THEN NULL
                ELSE concat('EAN', CAST(p_partkey % 700 AS STRING)) END AS EAN,
           CASE WHEN p_partkey % 23 = 0 THEN '' ELSE concat('P', CAST(p_partkey AS STRING)) END AS part_number
    FROM {part}"""
# Names of a manufacturer; one has none, one is not listed.
MANUFACTURERS = """
    SELECT DISTINCT p_brand AS cod,
           CASE WHEN p_brand = 'Brand#7' THEN ''
                ELSE concat(upper(p_brand), '/Maker', substr(p_brand, 7), '/Works', substr(p_brand, 7)) END AS des
    FROM {part} WHERE p_brand <> 'Brand#3'"""
CATALOGUE = """
    SELECT CASE WHEN l_suppkey % 20 = 0 THEN concat('EAN', CAST(l_partkey % 700 AS STRING)) ELSE '' END AS ean,
           concat('P', CAST(l_partkey AS STRING)) AS prod_id,
           concat(CASE WHEN l_linenumber % 2 = 0 THEN 'Maker' ELSE 'Works' END, CAST(l_suppkey % 25 + 1 AS STRING)) AS vendor,
           CASE WHEN l_returnflag = 'A' THEN '1' ELSE '-1' END AS code,
           concat('item/', CAST(l_orderkey AS STRING), '/', CAST(l_linenumber AS STRING)) AS path,
           concat('high/', CAST(l_suppkey AS STRING)) AS high_pic, concat('text ', CAST(l_partkey AS STRING)) AS short_desc
    FROM {lineitem}"""
ENTRIES = """
    SELECT DISTINCT concat('P', CAST(l_partkey AS STRING)) AS id, 'old' AS path, 'old' AS high_pic, 'old' AS short_desc
    FROM {lineitem} WHERE l_quantity = 50"""
FIELDS = ("path", "high_pic", "short_desc")

MISSING = f"""SELECT p.id, p.EAN, p.part_number, m.des AS manufacturer FROM ({twin(PRODUCTS)}) p
    LEFT JOIN ({twin(MANUFACTURERS)}) m ON p.manufacturer_id = m.cod
    LEFT JOIN ({twin(ENTRIES)}) e ON e.id = p.id WHERE e.id IS NULL"""
ALIASES = f"""SELECT p.*, unnest(string_split(manufacturer, '/')) AS alias, generate_subscripts(string_split(manufacturer, '/'), 1) AS n FROM ({MISSING}) p"""
# What the reference does: try the EAN, then each alias in turn, and stop at the first hit.
HITS = f"""SELECT id, found_by, path, high_pic, short_desc FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY found_by, path, high_pic, short_desc) AS rn FROM (
        SELECT p.id, 0 AS found_by, c.path, c.high_pic, c.short_desc FROM ({MISSING}) p
        JOIN ({twin(CATALOGUE)}) c ON p.EAN <> '' AND c.ean = p.EAN AND c.code = '1'
        UNION ALL
        SELECT a.id, a.n AS found_by, c.path, c.high_pic, c.short_desc FROM ({ALIASES}) a
        JOIN ({twin(CATALOGUE)}) c ON a.part_number <> '' AND a.manufacturer <> '' AND c.prod_id = a.part_number
             AND c.vendor = a.alias AND c.code = '1')) WHERE rn = 1"""
LOOKED_UP = f"""SELECT p.*, CAST(h.found_by AS INTEGER) AS found_by, h.path, h.high_pic, h.short_desc
    FROM ({MISSING}) p LEFT JOIN ({HITS}) h ON p.id = h.id"""


def missing(spark, sf_dir):
    opened = {}
    products, makers, entries = (from_given(spark, sf_dir, sql, opened) for sql in (PRODUCTS, MANUFACTURERS, ENTRIES))
    return catalogue.missing_entries(products, makers, entries)


def looked_up(spark, sf_dir):
    return catalogue.first_hit(missing(spark, sf_dir), from_given(spark, sf_dir, CATALOGUE), FIELDS, FIELDS)


@query(MISSING)
def missing_entries(spark, sf_dir):
    return missing(spark, sf_dir)


@query(f"SELECT p.id, p.manufacturer_id, m.des AS manufacturer FROM ({twin(PRODUCTS)}) p LEFT JOIN ({twin(MANUFACTURERS)}) m ON p.manufacturer_id = m.cod")
def dimension_name(spark, sf_dir):
    name = Lookup("manufacturers", (("manufacturer_id", "cod"),), {"manufacturer": "des"}, how="left")
    joined = join_lookup(from_given(spark, sf_dir, PRODUCTS), from_given(spark, sf_dir, MANUFACTURERS), name)
    return joined.select("id", "manufacturer_id", "manufacturer")


@query(f"SELECT id, alias, CAST(n - 1 AS INTEGER) AS position FROM ({ALIASES})")
def enrich_aliases(spark, sf_dir):
    return catalogue.aliases(missing(spark, sf_dir)).select("id", "alias", "position")


@query(LOOKED_UP)
def enrich_first_hit(spark, sf_dir):
    return looked_up(spark, sf_dir)


@query(f"SELECT count(found_by) AS found, count(*) AS looked_up, count(found_by) * 100.0::DOUBLE / count(*) AS percent FROM ({LOOKED_UP})")
def enrich_hit_rate(spark, sf_dir):
    return catalogue.hit_rate(looked_up(spark, sf_dir))


@query(f"""SELECT id, path, high_pic, short_desc FROM ({HITS})
    UNION ALL SELECT * FROM ({twin(ENTRIES)}) e WHERE e.id NOT IN (SELECT id FROM ({HITS}))""")
def enrich_replace(spark, sf_dir):
    hits = looked_up(spark, sf_dir).filter("found_by IS NOT NULL").select("id", *FIELDS)
    return diff.replace_into(from_given(spark, sf_dir, ENTRIES), hits, "id")


@query(f"""SELECT id, path, high_pic, short_desc FROM ({HITS})
    UNION ALL SELECT * FROM ({twin(ENTRIES)}) e WHERE e.id NOT IN (SELECT id FROM ({HITS}))""")
def enrich_run(spark, sf_dir):
    """The whole run over a stored table: candidates, look-up, replacement, commit."""
    table = VersionedTable(spark, scratch_dir(spark, "enrich_run"))
    table.overwrite(from_given(spark, sf_dir, ENTRIES))
    products, manufacturers, entries = (from_given(spark, sf_dir, sql) for sql in (PRODUCTS, MANUFACTURERS, CATALOGUE))
    enrich.run_enrichment(spark, products, manufacturers, table, entries, FIELDS)
    return table.read()


# The catalogue as XML, several products to a line or a product over several lines; some have two EANs, some end in their tag.
XML_LINES = """
    SELECT concat(CASE WHEN n % 50 = 0 THEN '<?xml version=~1.0~?>\n<Catalogue>' ELSE '' END,
           '<Product Code=~', code, '~ Prod_id=~', prod_id, '~ path=~', path, '~\n HighPic=~', high_pic, '~>',
           CASE WHEN ean <> '' THEN concat('<EANCode EAN=~', ean, '~/>', CASE WHEN n % 3 = 0 THEN concat('<EANCode EAN=~', ean, '~/>') ELSE '' END) ELSE '' END,
           '<Supplier Name=~', vendor, '~/>\n<SummaryDescription><ShortSummaryDescription>', short_desc,
           '</ShortSummaryDescription></SummaryDescription></Product>', CASE WHEN n % 50 = 49 THEN '</Catalogue>' ELSE '' END,
           CASE WHEN n % 97 = 0 THEN '<Product Prod_id=~bare > /~ Code=~1~/>' WHEN n % 89 = 0 THEN '<Product Prod_id=~broken~></Wrong></Product>' ELSE '' END) AS value
    FROM (SELECT *, pmod(hash(path), 1000) AS n FROM ({catalogue}))"""


def catalogue_files(spark, sf_dir):
    folder = scratch_dir(spark, "catalogue")
    rows = from_given(spark, sf_dir, XML_LINES.replace("{catalogue}", CATALOGUE).replace("~", '"'))
    rows.write.text(folder)
    return folder


@query(f"SELECT nullif(ean, '') AS ean, prod_id, vendor, code, path, high_pic, short_desc FROM ({twin(CATALOGUE)})")
def catalogue_scan(spark, sf_dir):
    """Products of XML files, cut at their tags; the bare and the broken ones among them are left out here."""
    found = catalogue_entries(spark, catalogue_files(spark, sf_dir)).filter("path IS NOT NULL")
    return found.select("ean", "prod_id", "vendor", "code", *FIELDS)


@query(f"""SELECT id, path, high_pic, short_desc FROM ({HITS})
    UNION ALL SELECT * FROM ({twin(ENTRIES)}) e WHERE e.id NOT IN (SELECT id FROM ({HITS}))""")
def enrich_run_from_files(spark, sf_dir):
    """The whole run with a catalogue of XML files."""
    table = VersionedTable(spark, scratch_dir(spark, "enrich_files"))
    table.overwrite(from_given(spark, sf_dir, ENTRIES))
    products, manufacturers = (from_given(spark, sf_dir, sql) for sql in (PRODUCTS, MANUFACTURERS))
    enrich.run_enrichment(spark, products, manufacturers, table, stored_entries(spark, catalogue_files(spark, sf_dir), catalogue.VALID), FIELDS)
    return table.read()


# Catalogue documents, one per part, with escaped text and a few broken ones.
DOCUMENTS = """
    SELECT p_partkey, CASE WHEN p_partkey % 29 = 0 THEN '<broken' ELSE concat('<Catalogue><Product Code=~', CASE WHEN p_partkey % 4 = 0 THEN '-1' ELSE '1' END,
           '~ HighPic=~high/', CAST(p_partkey AS STRING), '.jpg~ LowPic=~low/', CAST(p_size AS STRING), '.jpg~ ThumbPic=~thumb.jpg~>',
           '<SummaryDescription><ShortSummaryDescription>', p_name, ' &amp; more</ShortSummaryDescription><LongSummaryDescription>',
           p_type, ' ', p_name, '</LongSummaryDescription></SummaryDescription></Product></Catalogue>') END AS xml
    FROM {part}"""


@query("""SELECT p_partkey, CASE WHEN ok THEN CASE WHEN p_partkey % 4 = 0 THEN '-1' ELSE '1' END END AS code,
    CASE WHEN ok THEN concat('high/', p_partkey, '.jpg') END AS high_pic, CASE WHEN ok THEN concat('low/', p_size, '.jpg') END AS low_pic,
    CASE WHEN ok THEN 'thumb.jpg' END AS thumb_pic, CASE WHEN ok THEN concat(p_type, ' ', p_name) END AS long_desc,
    CASE WHEN ok THEN concat(p_name, ' & more') END AS short_desc FROM (SELECT *, p_partkey % 29 <> 0 AS ok FROM part)""")
def enrich_xml(spark, sf_dir):
    documents = from_given(spark, sf_dir, DOCUMENTS.replace("~", '"'))
    return catalogue.from_document(documents)


URLS = "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url ELSE replace(url, '://', '://user:secret@') END AS url FROM {pages}"


@query(f"SELECT page_id, regexp_replace(url, '^[a-z]+://[^/@]+@', '') AS path FROM ({twin(URLS)})")
def strip_credentials(spark, sf_dir):
    return from_given(spark, sf_dir, URLS).select("page_id", without_login(F.col("url")).alias("path"))

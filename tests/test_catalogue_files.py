"""Products cut out of XML files."""

import random
import xml.etree.ElementTree as ET

from conftest import plan_of, values
from feedweave.sources import catalogue_files as files
from pyspark.sql import functions as F

TEXT = """<?xml version="1.0"?>
<Catalogue><Product Code="1" Prod_id="a" HighPic="h &amp; &quot;x&quot;"><EANCode EAN="1"/><EANCode EAN="2"/><EANCode EAN="1"/>
<Supplier Name="S &lt;"/><SummaryDescription><ShortSummaryDescription>two
lines</ShortSummaryDescription></SummaryDescription></Product>
<Product Prod_id="b > /" Code='-1'/><ProductOther Prod_id="no"/>   <Product
Prod_id="c"></Product><Product Prod_id="bad"><Open></Product><Product Prod_id="d"/>
<Product Prod_id="cut off"><Supplier"""


def test_elements_and_bad_ones(spark, tmp_path):
    (tmp_path / "c.xml").write_text(TEXT)
    rows = files.scan(spark, str(tmp_path / "c.xml"))
    assert values(rows.filter("_bad_product IS NULL"), "prod_id", "ean", "code", "vendor", "high_pic", "short_desc") == [
        ("a", "1", "1", "S <", 'h & "x"', "two\nlines"), ("a", "2", "1", "S <", 'h & "x"', "two\nlines"),
        ("b > /", None, "-1", None, None, None), ("c", None, None, None, None, None), ("d", None, None, None, None, None),
    ]
    bad = rows.filter("_bad_product IS NOT NULL")
    assert [r["_bad_product"].split(">")[0] for r in bad.orderBy("_bad_product").collect()] == ['<Product Prod_id="bad"', '<Product Prod_id="cut off"']
    assert bad.filter("coalesce(prod_id, ean, vendor) IS NOT NULL").count() == 0
    assert files.entries(spark, str(tmp_path / "c.xml")).count() == 5


def test_products_do_not_depend_on_the_cuts(spark, tmp_path):
    rng, parts = random.Random(4), []
    for k in range(300):
        inner = "".join(f'<EANCode EAN="{rng.randrange(50)}"/>' for _ in range(rng.randrange(3))) + "\n" * rng.randrange(3) + f'<Supplier Name="é{k % 7}"/>'
        parts.append(f'<Product Prod_id="p{k}"/>' if rng.random() < 0.3 else f'<Product Prod_id="p{k}">{inner}</Product>')
        parts.append(rng.choice(["", "\n", "  ", "<Other/>"]))
    text = "<Catalogue>" + "".join(parts) + "</Catalogue>"
    (tmp_path / "c.xml").write_text(text, encoding="utf-8")
    wanted = []
    for product in ET.fromstring(text).iter("Product"):
        supplier = product.find("Supplier")
        eans = {e.get("EAN") for e in product.findall("EANCode")} or {None}
        wanted += [(product.get("Prod_id"), ean, None if supplier is None else supplier.get("Name")) for ean in eans]
    for size in ("128m", "700"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = files.scan(spark, str(tmp_path / "c.xml"))
            assert size == "128m" or rows.rdd.getNumPartitions() >= 8
            got = [(r["prod_id"], r["ean"], r["vendor"]) for r in rows.collect()]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sorted(map(repr, got)) == sorted(map(repr, wanted))
    assert "Python" not in plan_of(rows) and "Exchange" not in plan_of(rows)


def test_products_are_parsed_once(spark, tmp_path):
    (tmp_path / "c.xml").write_text(TEXT)
    plan = plan_of(files.entries(spark, str(tmp_path / "c.xml")).filter("path IS NULL").select("ean", "prod_id", "vendor", "short_desc"))
    assert plan.count("from_xml(") == 1 and plan.count("regexp_replace(") == 1


def test_a_run_parses_its_catalogue_once(spark, sf_dir, monkeypatch):
    from suite import enriching

    taken, run = [], enriching.enrich.run_enrichment
    monkeypatch.setattr(enriching.enrich, "run_enrichment", lambda *a: taken.append(a[4]) or run(*a))
    enriching.enrich_run_from_files(spark, sf_dir)
    assert "from_xml" not in plan_of(taken[0])


def test_stored_entries_are_those_of_the_code(spark, tmp_path):
    """However the code is written, and whatever else holds its digits."""
    codes = ['Code="1"', "Code='1'", 'Code = " 1\t"', 'Code\n=\n"&#49;"', 'Code="&#x31;"', 'Code="11"', 'Code="-1"', 'Code="2" _Code="1"', 'Other="1"', 'Code=""', ""]
    bodies = ["", "<_Code>1</_Code>", '<Code>1</Code><EANCode EAN="1"/>', "<Open>"]
    text = "".join(f'<Product Prod_id="p{k}.{j}" {c}>{b}</Product><Product {c} path="s{k}.{j}"/>' for k, c in enumerate(codes) for j, b in enumerate(bodies))
    (tmp_path / "c.xml").write_text(f"<Catalogue>{text}</Catalogue>")
    for code in ("1", "-1", "11"):
        wanted = values(files.entries(spark, str(tmp_path / "c.xml")).filter(F.col("code") == code))
        assert wanted and values(files.stored_entries(spark, str(tmp_path / "c.xml"), code)) == wanted

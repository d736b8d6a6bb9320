"""Catalogue files: one XML element per product, cut at its end tag by all tasks.

Spark's text source cuts the files at the tag's end, wherever its splits fall; what stands before it
is the product, which is parsed by itself. A product that cannot be parsed is kept as text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from feedweave.session import scratch_dir
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BAD_PRODUCT = "_bad_product"

# Layout of a product; attributes start with "_". Fixed values.
PRODUCT_FIELDS = (
    "_Code: string, _Prod_id: string, _path: string, _HighPic: string, _LowPic: string, _ThumbPic: string, "
    "EANCode: array<struct<_EAN: string>>, Supplier: struct<_Name: string>, "
    "SummaryDescription: struct<LongSummaryDescription: string, ShortSummaryDescription: string>"
)
#: What an entry takes from a product, by the names that the look-up knows.
ENTRY = {
    "prod_id": "_Prod_id", "vendor": "Supplier._Name", "code": "_Code", "path": "_path", "high_pic": "_HighPic", "low_pic": "_LowPic",
    "thumb_pic": "_ThumbPic", "long_desc": "SummaryDescription.LongSummaryDescription", "short_desc": "SummaryDescription.ShortSummaryDescription",
}


def elements(spark: SparkSession, path: str | Sequence[str], tag: str) -> DataFrame:
    """(xml): every element ``tag`` of the files as text, ``<tag ../>`` and ``<tag ..>..</tag>``; they do not nest.

    An end tag within a comment or a CDATA section ends the element too, which then is a bad one.
    """
    pieces = spark.read.option("lineSep", f"</{tag}>").text(path)
    closed = rf"<{tag}(?:\s(?:[^>\"'/]++|/(?!>)|\"[^\"]*+\"|'[^']*+')*+)?/>"
    rest = F.regexp_replace("value", closed, "")
    begun = F.regexp_extract_all(rest, F.lit(rf"(?s)<{tag}(?=[\s>]).*$"), 0)  # one or none
    whole = F.transform(begun, lambda x: F.concat(x, F.lit(f"</{tag}>")))
    return pieces.select(F.explode(F.concat(F.regexp_extract_all("value", F.lit(closed), 0), whole)).alias("xml"))


def scan(spark: SparkSession, path: str | Sequence[str], tag: str = "Product") -> DataFrame:
    """Catalogue entries of XML files, one per product and EAN (a product without any has a NULL one).

    ``_bad_product`` holds the text of an element that is no product; its other columns are NULL.
    """
    return _parsed(elements(spark, path, tag), tag)


def _parsed(products: DataFrame, tag: str) -> DataFrame:
    schema = f"struct<{PRODUCT_FIELDS}, {BAD_PRODUCT}: string>"
    options = {"rowTag": tag, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_PRODUCT}
    # As a generator's output a product is parsed once; as a plain column Spark would copy the parsing into every filter on it.
    parsed = products.select(F.inline(F.array(F.struct(F.from_xml("xml", schema, options).alias("p")))))
    codes = F.transform("p.EANCode", lambda e: e["_EAN"])
    each = parsed.select("p", F.explode_outer(F.array_distinct(codes)).alias("ean"))

    def of(name: str) -> Column:
        return F.when(F.col(f"p.{BAD_PRODUCT}").isNull(), F.col(f"p.{name}"))

    ean = F.when(F.col(f"p.{BAD_PRODUCT}").isNull(), F.col("ean")).alias("ean")
    return each.select(ean, *[of(place).alias(name) for name, place in ENTRY.items()], F.col(f"p.{BAD_PRODUCT}").alias(BAD_PRODUCT))


def entries(spark: SparkSession, path: str | Sequence[str], tag: str = "Product") -> DataFrame:
    """The products of ``scan`` that could be parsed, as the look-up wants them."""
    return _good(scan(spark, path, tag))


def _good(scanned: DataFrame) -> DataFrame:
    return scanned.filter(F.col(BAD_PRODUCT).isNull()).drop(BAD_PRODUCT)


def _may_have(xml: Column, code: str) -> Column:
    """False only where no parser could find that code: as an attribute, blanks around it, an entity in it, or as an element ``_Code``."""
    written = rf"Code\s*=\s*[\"'][\x00-\x20]*{re.escape(code)}"
    return F.contains(xml, F.lit("&")) | F.contains(xml, F.lit("_Code")) | xml.rlike(written)


def stored_entries(spark: SparkSession, path: str | Sequence[str], code: str, tag: str = "Product") -> DataFrame:
    """The ``entries`` of one code, from a table in the shared folder: the files are read and parsed once, however often they are used.

    Elements whose text cannot have the code are not parsed.
    """
    able = elements(spark, path, tag).filter(_may_have(F.col("xml"), code))
    folder, found = scratch_dir(spark, "products"), _good(_parsed(able, tag)).filter(F.col("code") == code)
    found.write.parquet(folder)
    return spark.read.schema(found.schema).parquet(folder)

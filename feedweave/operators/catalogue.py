"""Enrichment of products from a bulk catalogue table.

The reference asks a remote service product by product; here the catalogue is a table that
is joined once by EAN and, for products without a hit, once by part number and alias.
Catalogue columns: ``ean``, ``prod_id``, ``vendor``, ``code`` (``'1'`` marks a valid entry)
and whatever is to be taken over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from feedweave.functions.keys import match_key
from feedweave.operators.pick import best_per, own_partitioning

VALID = "1"  # fixed value

# Layout of a catalogue document; attributes start with "_". Fixed values.
PRODUCT_XML = (
    "Product struct<_Code: string, _HighPic: string, _LowPic: string, _ThumbPic: string, "
    "SummaryDescription: struct<LongSummaryDescription: string, ShortSummaryDescription: string>>"
)


def missing_entries(products: DataFrame, manufacturers: DataFrame, entries: DataFrame, key_policy: str = "exact") -> DataFrame:
    """Products without a catalogue entry, with the name list of their manufacturer.

    ``manufacturers`` holds ``cod`` (unique) and ``des``. The anti join is written as such:
    Spark does not derive it from an outer join with a NULL test.
    """
    names = manufacturers.select(match_key(F.col("cod"), key_policy).alias("_maker"), F.col("des").alias("manufacturer"))
    known = entries.select(match_key(F.col("id"), key_policy).alias("_id"))
    missing = products.join(known, match_key(products["id"], key_policy) == known["_id"], "left_anti")
    keyed = missing.withColumn("_maker", match_key(F.col("manufacturer_id"), key_policy))
    return keyed.join(names, "_maker", "left").select("id", "EAN", "part_number", "manufacturer")


def aliases(products: DataFrame) -> DataFrame:
    """One row per product and alias: names are separated by ``/`` and tried in order."""
    return products.select("*", F.posexplode(F.split("manufacturer", "/")).alias("position", "alias"))


def first_hit(
    products: DataFrame, catalogue: DataFrame, fields: Sequence[str], first: Sequence[str], key_policy: str = "exact",
) -> DataFrame:
    """Each product's catalogue entry: by EAN, else by part number and first alias that hits.

    Adds ``found_by`` (0 for the EAN, 1 + n for alias n, NULL without a hit) and the fields.
    The catalogue is reduced to one valid entry per EAN and per part number and vendor, the
    first under ``first``, so neither join multiplies rows, and both can be split at a hot
    key (see ``lookup.reduced``). Products with a blank EAN join
    on their own id instead of meeting under one key, and only products without a hit go on
    to the second join.
    """
    same = lambda c: match_key(c, key_policy)
    valid = catalogue.filter(F.col("code") == VALID)
    entry = F.struct(*fields).alias("_entry")
    # What ranks entries is taken before their keys are brought to the compared form.
    kept = [name for name in _extra(first, []) if name in ("ean", "prod_id", "vendor")]
    if key_policy != "exact":
        valid = valid.withColumns({f"_raw_{name}": F.col(name) for name in kept})
        valid = valid.withColumns({name: same(F.col(name)) for name in ("ean", "prod_id", "vendor")})
        first = [f"_raw_{o}" if o.split(" ")[0] in kept else o for o in first]
    by_ean = valid.filter("ean <> ''").select("ean", entry, *_extra(first, ["ean"]))
    by_ean = best_per(by_ean, own_partitioning(["ean"]), first)
    by_ean = by_ean.select(F.lit(True).alias("_has_ean"), F.col("ean").alias("_key"), "_entry")
    has_ean = F.coalesce(F.col("EAN") != "", F.lit(False))
    keyed = products.withColumns({"_has_ean": has_ean, "_key": F.when(has_ean, same(F.col("EAN"))).otherwise(F.col("id"))})
    tried = keyed.join(by_ean, ["_has_ean", "_key"], "left").drop("_has_ean", "_key")

    by_part = valid.select("prod_id", "vendor", entry, *_extra(first, ["prod_id", "vendor"]))
    by_part = best_per(by_part, own_partitioning(["prod_id", "vendor"]), first)
    by_part = by_part.select(F.col("prod_id").alias("part_number"), F.col("vendor").alias("alias"), F.col("_entry").alias("_part_entry"))
    # Only what still needs the second lookup is multiplied by its aliases.
    wanted = F.when(
        F.col("_entry").isNull() & (F.col("part_number") != "") & (F.col("manufacturer") != ""),
        F.split("manufacturer", "/"),
    )
    candidates = tried.select("*", F.posexplode_outer(wanted).alias("_position", "alias"))
    # A candidate without alias keeps a key of its own, so that these rows spread as well.
    candidates = candidates.withColumns({
        "_by_alias": F.col("alias").isNotNull(),
        "_part": F.when(F.col("alias").isNotNull(), same(F.col("part_number"))).otherwise(F.col("id")),
        "alias": same(F.coalesce("alias", F.lit(""))),
    })
    by_part = by_part.select(F.lit(True).alias("_by_alias"), F.col("part_number").alias("_part"), "alias", "_part_entry")
    joined = candidates.join(by_part, ["_by_alias", "_part", "alias"], "left")
    found_by = F.when(F.col("_entry").isNotNull(), F.lit(0)).when(F.col("_part_entry").isNotNull(), F.col("_position") + 1)
    ranked = joined.select(*products.columns, found_by.alias("found_by"), F.coalesce("_entry", "_part_entry").alias("_entry"))
    best = best_per(ranked, ["id"], [F.col("found_by").asc_nulls_last()])
    return best.select(*products.columns, "found_by", *[F.col(f"_entry.{f}").alias(f) for f in fields])


def _extra(order: Sequence[str], taken: Sequence[str]) -> list[str]:
    return [name for name in dict.fromkeys(o.split(" ")[0] for o in order) if name not in taken]


def from_document(documents: DataFrame, column: str = "xml") -> DataFrame:
    """Catalogue fields taken out of XML documents; ``code`` is the validity mark."""
    product = F.col("_xml.Product")
    parsed = documents.withColumn("_xml", F.from_xml(F.col(column), PRODUCT_XML))
    return parsed.select(
        *[name for name in documents.columns if name != column],
        product["_Code"].alias("code"),
        product["_HighPic"].alias("high_pic"),
        product["_LowPic"].alias("low_pic"),
        product["_ThumbPic"].alias("thumb_pic"),
        product["SummaryDescription"]["LongSummaryDescription"].alias("long_desc"),
        product["SummaryDescription"]["ShortSummaryDescription"].alias("short_desc"),
    )


def hit_rate(products: DataFrame) -> DataFrame:
    """Found, looked up, and the percentage found."""
    return products.agg(F.count("found_by").alias("found"), F.count(F.lit(1)).alias("looked_up")).select(
        "found", "looked_up", F.try_divide(F.col("found") * 100.0, F.col("looked_up")).alias("percent")
    )

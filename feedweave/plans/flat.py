"""Consolidation of all feeds into one row per product.

Each branch filters its feed, joins what filters or ranks, keeps the best offer per part and
only then joins the rest. Where a branch's output is still hash-partitioned by part number,
its union with the others keeps that, so the pick across feeds needs no further shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from feedweave.functions.coerce import lenient_float
from feedweave.functions.keys import availability_rank, match_key, row_key
from feedweave.operators.diff import conform
from feedweave.operators.lookup import join_lookup
from feedweave.operators.pick import best_per, collapse_by, concat_ranked, ordering
from feedweave.plans.branches import ALL, DEFAULT, PRODUCT, Branch

Tables = Mapping[str, DataFrame]


def _product_schema(names: Iterable[str] = tuple(PRODUCT)) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{name}` {PRODUCT[name]}" for name in names))



def _price_order(price: str, direction: str) -> Column:
    if direction not in ("asc", "desc"):
        raise ValueError("price_order is 'asc' or 'desc'")
    return ordering(f"{price} {direction}")


def branch_offers(tables: Tables, branch: Branch, key_policy: str = "exact") -> DataFrame:
    """The branch's offers in product shape, as far as they are known before the pick.

    Beside the product columns: ``_available``, ``_price`` and ``_then0..`` to rank by, and
    what late lookups need.
    """
    feed = tables[branch.feed]
    if branch.where:
        feed = feed.filter(branch.where)
    for lookup in branch.lookups:
        if not lookup.late:
            feed = join_lookup(feed, tables[lookup.table], lookup, key_policy)
    values = {"source": f"'{branch.source}'", "priority": str(branch.priority), **branch.columns}
    now = [name for name in PRODUCT if name not in branch.late]
    then = {f"_then{i}": o.rpartition(" ")[0] for i, o in enumerate(branch.then)}
    ranked = {"_available": branch.available, "_price": branch.price, **then, **branch.carry}
    offers = feed.selectExpr(
        *[f"{values.get(name, 'NULL')} AS `{name}`" for name in now], *[f"{e} AS `{name}`" for name, e in ranked.items()],
    )
    kept = conform(offers, _product_schema(now), more=ranked)
    numbers = [name for name in ("_available", "_price") if isinstance(offers.schema[name].dataType, T.StringType)]
    return kept.withColumns({name: lenient_float(F.col(name)) for name in numbers}) if numbers else kept


def best_in_branch(
    tables: Tables, branch: Branch, price_order: str = "desc", key_policy: str = "exact"
) -> DataFrame:
    """The best offer per part of one feed, in product shape.

    Offers equal in rank are told apart by stock, then by every other column in order, so
    the result does not depend on how the feed is partitioned.
    """
    offers = branch_offers(tables, branch, key_policy)
    part = "part_number"
    if key_policy != "exact":
        part = "_part"
        offers = offers.withColumn(part, match_key(F.col("part_number"), key_policy))
    order = [
        availability_rank(F.col("_available")).desc(),
        _price_order("_price", branch.price_order or price_order),
        *[ordering(f"_then{i} {o.rpartition(' ')[2]}") for i, o in enumerate(branch.then)],
        ordering("external_availability desc"),
        *[ordering(name) for name in (*PRODUCT, *branch.carry) if name in offers.columns and name not in ("source", "priority")],
    ]
    best = best_per(offers, [part], order)
    for lookup in branch.lookups:
        if lookup.late:
            by_part = [left for left, _ in lookup.on] == ["part_number"]
            best = join_lookup(best, tables[lookup.table], lookup, key_policy, hot=not by_part)
    more = [part] if part not in PRODUCT else []
    late = best.selectExpr(*[f"{branch.late.get(name, name)} AS `{name}`" for name in PRODUCT], *more)
    return conform(late, _product_schema(), more=more)


def chosen(sources: Iterable[str] | None) -> list[Branch]:
    """The branches of the given source marks, or the default ones."""
    if sources is None:
        return list(DEFAULT)
    unknown = [s for s in sources if s not in ALL]
    if unknown:
        raise ValueError(f"unknown sources {unknown}")
    return [ALL[s] for s in ALL if s in set(sources)]


def union_branches(frames: Sequence[DataFrame], distinct: bool = False) -> DataFrame:
    """All rows of all branches; ``distinct`` drops repeated rows."""
    union = reduce(DataFrame.unionByName, frames)
    return union.distinct() if distinct else union


def cross_feed_order(price_order: str = "desc") -> list[Column]:
    """Rank across feeds: priority, then availability, then price; the source mark breaks ties."""
    return [
        F.col("priority").desc(),
        availability_rank(F.col("external_availability")).desc(),
        _price_order("enduser_price", price_order),
        F.col("source").asc(),
    ]


def best_across(union: DataFrame, price_order: str = "desc", part: str = "part_number") -> DataFrame:
    """One row per part with the codes of all its feeds joined in rank order."""
    order = cross_feed_order(price_order)
    # Codes and rank share one window: a part has at most one row per feed by now.
    rank = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    ranked = union.withColumns({"code": concat_ranked("code", [part], order), "_rank": rank})
    return ranked.filter("_rank = 1").drop("_rank")


def consolidate(
    tables: Tables,
    branches: Sequence[Branch] = DEFAULT,
    price_order: str = "desc",
    key_policy: str = "exact",
) -> DataFrame:
    """The full consolidation: one row per part over all feeds, collapsed by EAN."""
    part = "part_number" if key_policy == "exact" else "_part"
    picks = [best_in_branch(tables, branch, price_order, key_policy) for branch in branches]
    parts = best_across(union_branches(picks), price_order, part)
    barcode = "EAN"
    if key_policy != "exact":
        barcode, parts = "_barcode", parts.withColumn("_barcode", match_key(F.col("EAN"), key_policy))
    products = collapse_by(parts, barcode, part, [*cross_feed_order(price_order)[:-1], F.col(part).asc_nulls_first()])
    return products.select(
        row_key(F.col("manufacturer_id"), F.col("part_number")).alias("id"),
        *[name for name in PRODUCT if name != "priority"],
    )


def project(df: DataFrame, fields: Sequence[str], prefix: str = "") -> DataFrame:
    """Some columns under prefixed names."""
    return df.select(*[F.col(name).alias(prefix + name) for name in fields])


# The fields and prefix of the restricted list.
RESTRICTED_FIELDS = (
    "id",
    "external_availability",
    "in_arrival",
    "arrival_date",
    "min_orderable_qty",
    "source",
    "retailers_price",
)
RESTRICTED_PREFIX = "b2b_"
RESTRICTED_SOURCES = ("IN",)


def restricted(tables: Tables, sources: Iterable[str] = RESTRICTED_SOURCES, key_policy: str = "exact") -> DataFrame:
    """Consolidation of some feeds only, reduced to prefixed fields."""
    return project(consolidate(tables, chosen(sources), key_policy=key_policy), RESTRICTED_FIELDS, RESTRICTED_PREFIX)


# Families and subfamilies of the clothing list, and the mark each family's
# part numbers carry.
CLOTHING_FAMILIES = ("598", "528", "526", "501")
CLOTHING_SUBFAMILIES = ("006", "001")
CLOTHING_MARKS = {"526": "PU", "501": "NK"}


def clothing(listing: DataFrame) -> DataFrame:
    """The single-feed list: chosen families, part numbers without their mark."""
    part = F.col("CODFOR")
    clean = part
    for family, mark in CLOTHING_MARKS.items():
        clean = F.when(F.col("FAM") == family, F.replace(part, F.lit(mark), F.lit(""))).otherwise(clean)
    kept = listing.filter(F.col("FAM").isin(*CLOTHING_FAMILIES) & F.col("SOTTOFAM").isin(*CLOTHING_SUBFAMILIES))
    return kept.select(
        "CODART", "FAM", "SOTTOFAM", "GENERE", "TIPO_PROD", "STAGIONE", "DESCRIZIONE", "GIACENZA", "PREZZO",
        clean.alias("CODFOR"), "TAGLIA", "COLORE", F.col("CODART").alias("id"),
    )

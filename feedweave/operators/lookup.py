"""Joins of a feed with its maps, stock, fee and code tables.

A lookup table may hold several rows per key. The reference lets them multiply the feed and
then keeps one row per part; here the table is first reduced to the row that pick would
take, so no join ever multiplies rows and a hot key on both sides stays linear.

No join carries a broadcast hint: Spark broadcasts a lookup when its size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from feedweave.functions.keys import match_key
from feedweave.operators.pick import best_per, own_partitioning


@dataclass(frozen=True)
class Lookup:
    """How one table is joined to a feed; all values are Spark SQL expressions.

    ``on`` pairs a feed expression with a table expression, ``columns`` names what is taken
    over, ``where`` restricts the table before the join, ``first`` decides between several
    rows of one key. ``late`` marks a left lookup that has no say in the ranking: it is
    joined after the pick, to one row per part instead of to every offer.
    """

    table: str
    on: tuple[tuple[str, str], ...]
    columns: dict[str, str] = field(default_factory=dict)
    how: str = "inner"
    where: str | None = None
    first: tuple[str, ...] = ()
    late: bool = False

    def __post_init__(self) -> None:
        if self.late and self.how != "left":
            raise ValueError("only a left lookup can be late: an inner one filters offers")


def reduced(table: DataFrame, lookup: Lookup, key_policy: str = "exact", hot: bool = True) -> DataFrame:
    """The lookup table with key columns ``_k0..`` and one row per key.

    With ``hot``, the table is reduced under a partitioning of its own, so that a join on the
    keys shuffles it once more. Only a join whose two sides both come straight from a
    shuffle can be split where a key is hot (AQE); what is moved again is one row per key.
    """
    if lookup.where:
        table = table.filter(lookup.where)
    keys = [f"_k{i}" for i in range(len(lookup.on))]
    selected = table.select(
        *[match_key(F.expr(right), key_policy).alias(k) for k, (_, right) in zip(keys, lookup.on)],
        *[F.expr(e).alias(name) for name, e in lookup.columns.items()],
    ).dropna(subset=keys)
    order = lookup.first or tuple(lookup.columns) or tuple(keys)
    return best_per(selected, own_partitioning(keys) if hot else keys, order)


def join_lookup(
    feed: DataFrame, table: DataFrame, lookup: Lookup, key_policy: str = "exact", hot: bool = True
) -> DataFrame:
    """The feed with the lookup's columns added (``inner`` drops rows without a match).

    ``hot=False`` is for a feed that holds each key once and is already partitioned by it.
    """
    keys = [f"_k{i}" for i in range(len(lookup.on))]
    keyed = feed.select("*", *[match_key(F.expr(left), key_policy).alias(k) for k, (left, _) in zip(keys, lookup.on)])
    return keyed.join(reduced(table, lookup, key_policy, hot), keys, lookup.how).drop(*keys)

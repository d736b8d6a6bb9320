"""Schemas of the stored tables. Names, lengths and types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Target:
    """A stored table: its key, the stamp column, and ``(name, type, length)`` of the rest."""

    name: str
    key: str
    stamp: str
    columns: tuple[tuple[str, str, int | None], ...]

    def fields(self) -> list[str]:
        return [name for name, _, _ in self.columns]

    def schema(self) -> T.StructType:
        columns = [f"`{name}` {kind}" for name, kind, _ in self.columns]
        return T.StructType.fromDDL(", ".join([*columns, f"`{self.stamp}` timestamp_ntz"]))


FULL = Target(
    "full",
    "id",
    "updated",
    (
        ("id", "string", 138),
        ("name", "string", None),
        ("EAN", "string", 15),
        ("part_number", "string", 35),
        ("code", "string", None),
        ("original_cat_id", "string", 50),
        ("original_subcat_id", "string", 50),
        ("cat_id", "string", 10),
        ("subcat_id", "string", 10),
        ("original_manufacturer_id", "string", 3),
        ("manufacturer_id", "string", 100),
        ("enduser_price", "float", None),
        ("internal_availability", "decimal(32,0)", None),
        ("external_availability", "decimal(32,0)", None),
        ("in_arrival", "int", None),
        ("arrival_date", "date", None),
        ("width", "float", None),
        ("height", "float", None),
        ("depth", "float", None),
        ("weight", "float", None),
        ("min_orderable_qty", "int", None),
        ("source", "string", 2),
        ("state", "string", 1),
        ("promo", "string", 1),
        ("retailers_price", "float", None),
        ("list_price", "float", None),
    ),
)

RESTRICTED = Target(
    "restricted",
    "b2b_id",
    "b2b_updated",
    (
        ("b2b_id", "string", 138),
        ("b2b_external_availability", "decimal(32,0)", None),
        ("b2b_in_arrival", "int", None),
        ("b2b_arrival_date", "date", None),
        ("b2b_min_orderable_qty", "int", None),
        ("b2b_source", "string", 2),
        ("b2b_retailers_price", "float", None),
    ),
)

CLOTHING = Target(
    "clothing",
    "id",
    "updated",
    (
        ("id", "string", 50),
        ("CODART", "string", 50),
        ("FAM", "string", 50),
        ("SOTTOFAM", "string", 50),
        ("GENERE", "string", 50),
        ("TIPO_PROD", "string", 50),
        ("STAGIONE", "string", 50),
        ("DESCRIZIONE", "string", 250),
        ("GIACENZA", "int", None),
        ("PREZZO", "decimal(12,2)", None),
        ("CODFOR", "string", 50),
        ("TAGLIA", "int", None),
        ("COLORE", "string", 50),
    ),
)

CATALOGUE_FIELDS = ("id", "path", "high_pic", "low_pic", "thumb_pic", "long_desc", "short_desc")

"""The feeds and how each maps to the common product shape.

A branch is data: Spark SQL expressions over the columns of its feed and lookups. Adding a
feed means adding a ``Branch``. Tables are passed in by logical name (``own_list``, ...), so
they may come from parquet, a catalog table or a freshly loaded feed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from feedweave.operators.lookup import Lookup

# Columns and in-flight types of the common product shape.
PRODUCT = {
    "name": "string",
    "EAN": "string",
    "part_number": "string",
    "code": "string",
    "original_cat_id": "string",
    "original_subcat_id": "string",
    "cat_id": "string",
    "subcat_id": "string",
    "original_manufacturer_id": "string",
    "manufacturer_id": "string",
    "enduser_price": "decimal(14,2)",
    "internal_availability": "int",
    "external_availability": "int",
    "in_arrival": "int",
    "arrival_date": "date",
    "source": "string",
    "state": "string",
    "promo": "string",
    "width": "decimal(12,2)",
    "height": "decimal(12,2)",
    "depth": "decimal(12,2)",
    "weight": "decimal(12,2)",
    "min_orderable_qty": "int",
    "priority": "int",
    "retailers_price": "decimal(14,2)",
    "list_price": "decimal(14,2)",
}


@dataclass(frozen=True)
class Branch:
    """One feed: where it comes from, what it is joined to, and how its offers rank.

    ``columns`` gives an expression for each product column (a missing one is NULL).
    Offers of one part rank by availability first, then ``price`` (descending unless
    ``price_order`` says otherwise), then ``then``.

    Late lookups join the picked offers; one keyed by part number should come first among
    them, as the picked offers are still partitioned by it. ``carry`` names what their keys need beside the
    product columns; ``late`` gives the product columns computed from them, over the product
    columns, ``_price``, the carried columns and the lookups' columns.
    """

    source: str
    feed: str
    columns: dict[str, str]
    available: str
    price: str
    priority: int = 0
    price_order: str | None = None
    then: tuple[str, ...] = ()
    where: str | None = None
    lookups: tuple[Lookup, ...] = ()
    carry: dict[str, str] = field(default_factory=dict)
    late: dict[str, str] = field(default_factory=dict)

    def tables(self) -> list[str]:
        return [self.feed, *(lookup.table for lookup in self.lookups)]


# Fixed values below: column names of the feeds, source marks, sentinels and prefixes.

OWN_CODE = Lookup(
    table="own_codes",
    on=(("part_number", "codfor"),),
    columns={"code": "codart"},
    how="left",
    where="codfor <> '' AND codart NOT LIKE 'H%' AND codart NOT LIKE 'R%'",
    late=True,
)


def manufacturer(table: str, key: str) -> Lookup:
    return Lookup(table, ((key, "feed_manufacturer_id"),), {"manufacturer_id": "manufacturer_id"})


def category(table: str, *on: tuple[str, str]) -> Lookup:
    return Lookup(table, on, {"cat_id": "cat_id", "subcat_id": "subcat_id"})


OWN = Branch(
    source="M",
    feed="own_list",
    priority=2,
    where="codfor != ''",
    available="disp",
    price="PREART3",
    price_order="asc",
    then=("disp desc",),
    columns={
        "name": "desart",
        "EAN": "EAN",
        "part_number": "codfor",
        "code": "codart",
        "original_cat_id": "clin1",
        "original_subcat_id": "clin2",
        "cat_id": "clin1",
        "subcat_id": "clin2",
        "original_manufacturer_id": "cpro",
        "manufacturer_id": "cpro",
        "enduser_price": "PREART3",
        "internal_availability": "disp",
        "external_availability": "0",
        "in_arrival": "OFOR",
        "arrival_date": "DTFOR",
        "state": "stato",
        "promo": "promo",
        "weight": "peso",
        "retailers_price": "PREART2",
        "list_price": "PREART4",
    },
)

FO = Branch(
    source="FO",
    feed="fo_list",
    available="Disponibili",
    price="Prezzo",
    lookups=(
        manufacturer("fo_manufacturers", "Marca"),
        category("fo_categories", ("Linea", "feed_cat_id"), ("Famiglia", "feed_subcat_id")),
        OWN_CODE,
    ),
    late={"code": "code"},
    columns={
        "name": "Descr",
        "EAN": "EAN",
        "part_number": "Cod",
        "original_cat_id": "Linea",
        "original_subcat_id": "Famiglia",
        "cat_id": "cat_id",
        "subcat_id": "subcat_id",
        "original_manufacturer_id": "Marca",
        "manufacturer_id": "manufacturer_id",
        "enduser_price": "Prezzo",
        "internal_availability": "0",
        "external_availability": "Disponibili",
        "in_arrival": "0",
        "weight": "Peso",
        "min_orderable_qty": "0",
        "retailers_price": "Prezzo",
        "list_price": "Prezzo",
    },
)

ES = Branch(
    source="ES",
    feed="es_list",
    where="tipo != 'N' AND (dispo > 0 OR arrivi > 0 OR stato <> 'C')",
    available="dispo",
    price="prezzoRivenditore",
    lookups=(
        manufacturer("es_manufacturers", "prod"),
        category("es_categories", ("catMerc", "feed_cat_id"), ("fam", "feed_subcat_id")),
        OWN_CODE,
        Lookup("es_arrivals", (("_article", "codice"),), {"_arrival": "arrival_date"}, how="left", late=True),
    ),
    carry={"_article": "codice"},
    late={"arrival_date": "_arrival", "code": "code"},
    columns={
        "name": "descrizione",
        "EAN": "codiceEAN",
        "part_number": "codiceProduttore",
        "original_cat_id": "catMerc",
        "original_subcat_id": "fam",
        "cat_id": "cat_id",
        "subcat_id": "subcat_id",
        "original_manufacturer_id": "prod",
        "manufacturer_id": "manufacturer_id",
        "enduser_price": "prezzoRivenditore + raee",
        "internal_availability": "0",
        "external_availability": "dispo",
        "in_arrival": "arrivi",
        "width": "lunghezza",
        "height": "altezza",
        "depth": "profondita",
        "weight": "pesoLordo",
        "min_orderable_qty": "qtaMinimaOrd",
        "retailers_price": "prezzoRivenditore + raee",
        "list_price": "prezzolistino",
    },
)

IN = Branch(
    source="IN",
    feed="in_list",
    available="availability",
    price="custom_price",
    lookups=(
        manufacturer("in_manufacturers", "vendor_number"),
        category("in_categories", ("ingram_cat_subcat", "concat(feed_cat_id, feed_subcat_id)")),
        Lookup(
            "in_stock",
            (("ingram_part_number", "ingram_part_number"),),
            {"availability": "availability"},
            first=("availability desc",),
        ),
        OWN_CODE,
        Lookup(
            "in_fees",
            (("_article", "ingram_part_number"),),
            {"_fee": "coalesce(siae, 0)"},
            how="left",
            where="country = 'IT'",
            late=True,
        ),
    ),
    carry={"_article": "ingram_part_number"},
    late={
        "enduser_price": "_price + coalesce(_fee, 0)",
        "retailers_price": "_price + coalesce(_fee, 0)",
        "code": "code",
    },
    columns={
        "name": "ingram_part_description_1",
        "EAN": "if(upc_code <> '9999999999999', upc_code, '')",
        "part_number": "vendor_part_number",
        "original_cat_id": "substring(ingram_cat_subcat, 1, 2)",
        "original_subcat_id": "substring(ingram_cat_subcat, 3, 2)",
        "cat_id": "cat_id",
        "subcat_id": "subcat_id",
        "original_manufacturer_id": "vendor_number",
        "manufacturer_id": "manufacturer_id",
        "internal_availability": "0",
        "external_availability": "availability",
        "in_arrival": "ordered",
        "arrival_date": "arrival_date",
        "width": "width",
        "height": "height",
        "depth": "length",
        "weight": "weight",
        "min_orderable_qty": "1",
        "list_price": "retail_price",
    },
)

# Suspended: not part of the default feeds, usable by naming it.
CG = Branch(
    source="CG",
    feed="cg_list",
    available="immediata",
    price="prezzo_netto",
    lookups=(
        manufacturer("cg_manufacturers", "produttore"),
        category(
            "cg_categories",
            ("codice_macrocategoria", "feed_cat_id"),
            ("concat_ws('$', codice_categoria, codice_sottocategoria)", "feed_subcat_id"),
        ),
        OWN_CODE,
    ),
    late={"code": "code"},
    columns={
        "name": "descrizione",
        "EAN": "''",
        "part_number": "codice_articolo_fornitore",
        "original_cat_id": "codice_macrocategoria",
        "original_subcat_id": "concat_ws('$', codice_categoria, codice_sottocategoria)",
        "cat_id": "cat_id",
        "subcat_id": "subcat_id",
        "original_manufacturer_id": "produttore",
        "manufacturer_id": "manufacturer_id",
        "enduser_price": "prezzo_netto + `contr.siae` + `contr.raee`",
        "internal_availability": "0",
        "external_availability": "immediata",
        "in_arrival": "futura - immediata",
        "width": "0",
        "height": "0",
        "depth": "0",
        "weight": "0",
        "min_orderable_qty": "1",
        "retailers_price": "prezzo_netto + `contr.siae` + `contr.raee`",
        "list_price": "prezzo_listino",
    },
)

DEFAULT = (OWN, FO, ES, IN)
ALL = {branch.source: branch for branch in (OWN, FO, ES, IN, CG)}

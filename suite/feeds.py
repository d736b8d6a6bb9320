"""Feeds, maps and code lists derived from the given tables.

Each is one SELECT in the SQL both engines share; ``{table}`` names a given table and ``~``
stands for the identifier quote.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from suite import read

OFFERS = "FROM {lineitem} JOIN {part} ON l_partkey = p_partkey"

FEEDS = {
    # Own warehouse: every fourth supplier. Some lines have a blank part number.
    "own_list": f"""
        SELECT p_name AS desart,
               CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat('EAN', CAST(p_partkey % 700 AS STRING)) END AS EAN,
               CASE WHEN l_orderkey % 89 = 0 THEN '' ELSE concat('P', CAST(l_partkey AS STRING)) END AS codfor,
               CASE WHEN p_name LIKE 's%' THEN NULL ELSE p_name END AS codart,
               p_type AS clin1, CAST(p_size AS STRING) AS clin2, p_brand AS cpro,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS PREART3,
               CAST(l_extendedprice - l_quantity AS DECIMAL(12,2)) AS PREART2,
               CAST(l_extendedprice + l_quantity AS DECIMAL(12,2)) AS PREART4,
               CAST(greatest(l_quantity - 25, 0) AS INT) AS disp, l_linenumber AS OFOR,
               CAST(l_shipdate AS DATE) AS DTFOR, l_linestatus AS stato, l_returnflag AS promo,
               CAST(l_quantity / 4 AS DECIMAL(12,2)) AS peso
        {OFFERS} WHERE l_suppkey % 4 = 0""",
    # Code list: many codes per part, some of them excluded by prefix or blank part number.
    "own_codes": """
        SELECT CASE WHEN l_partkey % 41 = 0 THEN '' ELSE concat('P', CAST(l_partkey AS STRING)) END AS codfor,
               concat(CASE WHEN l_linenumber = 1 THEN 'H' WHEN l_linenumber = 2 THEN 'R' ELSE 'C' END,
                      CAST(l_suppkey AS STRING)) AS codart
        FROM {lineitem}""",
    "fo_list": f"""
        SELECT p_name AS Descr,
               CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE concat('EAN', CAST(p_partkey % 700 AS STRING)) END AS EAN,
               concat('P', CAST(l_partkey AS STRING)) AS Cod, p_type AS Linea, CAST(p_size AS STRING) AS Famiglia,
               p_brand AS Marca, CAST(l_extendedprice AS DECIMAL(12,2)) AS Prezzo,
               CAST(greatest(l_quantity - 25, 0) AS INT) AS Disponibili, CAST(l_quantity / 4 AS DECIMAL(12,2)) AS Peso
        {OFFERS} WHERE l_suppkey % 4 = 1""",
    "es_list": f"""
        SELECT CAST(l_orderkey AS STRING) AS codice, p_name AS descrizione,
               CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat('EAN', CAST(p_partkey % 700 AS STRING)) END AS codiceEAN,
               concat('P', CAST(l_partkey AS STRING)) AS codiceProduttore, p_type AS catMerc,
               CAST(p_size AS STRING) AS fam, p_brand AS prod, l_returnflag AS tipo,
               CASE WHEN l_linestatus = 'F' THEN 'C' ELSE l_linestatus END AS stato,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS prezzoRivenditore,
               CAST(CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS DECIMAL(12,2)) AS raee,
               CAST(l_extendedprice + 1 AS DECIMAL(12,2)) AS prezzolistino,
               CAST(l_quantity AS DECIMAL(12,2)) AS lunghezza, CAST(l_linenumber AS DECIMAL(12,2)) AS altezza,
               CAST(l_quantity / 2 AS DECIMAL(12,2)) AS profondita, CAST(l_quantity / 4 AS DECIMAL(12,2)) AS pesoLordo,
               CAST(greatest(l_quantity - 25, 0) AS INT) AS dispo, CAST(greatest(l_linenumber - 4, 0) AS INT) AS arrivi,
               l_linenumber AS qtaMinimaOrd
        {OFFERS} WHERE l_suppkey % 4 = 2""",
    # Arrivals: several dates per article code.
    "es_arrivals": """
        SELECT CAST(l_orderkey AS STRING) AS codice, CAST(l_shipdate AS DATE) AS arrival_date
        FROM {lineitem} WHERE l_linestatus = 'O'""",
    "in_list": f"""
        SELECT concat('I', CAST(l_orderkey AS STRING)) AS ingram_part_number,
               concat('P', CAST(l_partkey AS STRING)) AS vendor_part_number, p_brand AS vendor_number,
               concat(substr(p_type, 1, 2), lpad(CAST(p_size AS STRING), 2, '0')) AS ingram_cat_subcat,
               p_name AS ingram_part_description_1,
               CASE WHEN p_partkey % 5 = 0 THEN '9999999999999' WHEN p_partkey % 17 = 0 THEN NULL
                    ELSE concat('EAN', CAST(p_partkey % 700 AS STRING)) END AS upc_code,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS custom_price,
               CAST(l_extendedprice + l_linenumber AS DECIMAL(12,2)) AS retail_price,
               CAST(l_quantity AS DECIMAL(12,2)) AS width, CAST(l_linenumber AS DECIMAL(12,2)) AS height,
               CAST(l_quantity / 2 AS DECIMAL(12,2)) AS length, CAST(l_quantity / 4 AS DECIMAL(12,2)) AS weight,
               l_linenumber AS ordered, CAST(l_shipdate AS DATE) AS arrival_date
        {OFFERS} WHERE l_suppkey % 4 = 3""",
    "in_stock": """
        SELECT concat('I', CAST(l_orderkey AS STRING)) AS ingram_part_number,
               CAST(l_quantity - 25 AS INT) AS availability
        FROM {lineitem} WHERE l_returnflag <> 'A'""",
    "in_fees": """
        SELECT concat('I', CAST(l_orderkey AS STRING)) AS ingram_part_number,
               CAST(CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_quantity / 4 END AS DECIMAL(12,2)) AS siae,
               CASE WHEN l_returnflag = 'A' THEN 'IT' ELSE 'FR' END AS country
        FROM {lineitem} WHERE l_linenumber <= 2""",
    "cg_list": f"""
        SELECT p_name AS descrizione, concat('P', CAST(l_partkey AS STRING)) AS codice_articolo_fornitore,
               p_type AS codice_macrocategoria, substr(p_type, 1, 1) AS codice_categoria,
               CAST(p_size AS STRING) AS codice_sottocategoria, p_brand AS produttore,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS prezzo_netto,
               CAST(l_extendedprice + 2 AS DECIMAL(12,2)) AS prezzo_listino,
               CAST(l_linenumber AS DECIMAL(12,2)) AS ~contr.siae~,
               CAST(CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity / 4 END AS DECIMAL(12,2)) AS ~contr.raee~,
               CAST(greatest(l_quantity - 25, 0) AS INT) AS immediata, CAST(l_quantity AS INT) AS futura
        {OFFERS} WHERE l_suppkey % 5 = 2""",
    # Maps: one brand and the largest sizes are not mapped, so inner joins drop rows.
    "fo_manufacturers": """
        SELECT DISTINCT p_brand AS feed_manufacturer_id, concat('MF', substr(p_brand, 7)) AS manufacturer_id
        FROM {part} WHERE p_brand <> 'Brand#3'""",
    "fo_categories": """
        SELECT DISTINCT p_type AS feed_cat_id, CAST(p_size AS STRING) AS feed_subcat_id,
               substr(p_type, 1, 3) AS cat_id, concat('S', CAST(p_size AS STRING)) AS subcat_id
        FROM {part} WHERE p_size <= 40""",
    "in_categories": """
        SELECT DISTINCT substr(p_type, 1, 2) AS feed_cat_id, lpad(CAST(p_size AS STRING), 2, '0') AS feed_subcat_id,
               substr(p_type, 1, 3) AS cat_id, concat('S', CAST(p_size AS STRING)) AS subcat_id
        FROM {part} WHERE p_size <= 40""",
    "cg_categories": """
        SELECT DISTINCT p_type AS feed_cat_id, concat(substr(p_type, 1, 1), '$', CAST(p_size AS STRING)) AS feed_subcat_id,
               substr(p_type, 1, 3) AS cat_id, concat('S', CAST(p_size AS STRING)) AS subcat_id
        FROM {part} WHERE p_size <= 40""",
    # Clothing: one article in several lines, so the sync has to settle on one.
    "clothing_list": """
        SELECT concat('A', CAST(l_partkey AS STRING)) AS CODART,
               CASE l_partkey % 5 WHEN 0 THEN '598' WHEN 1 THEN '528' WHEN 2 THEN '526' WHEN 3 THEN '501' ELSE '777' END AS FAM,
               CASE l_partkey % 3 WHEN 0 THEN '006' WHEN 1 THEN '001' ELSE '002' END AS SOTTOFAM,
               l_returnflag AS GENERE, l_linestatus AS TIPO_PROD, CAST(l_linenumber AS STRING) AS STAGIONE,
               concat('item ', CAST(l_partkey AS STRING)) AS DESCRIZIONE, CAST(l_quantity AS INT) AS GIACENZA,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS PREZZO,
               CASE WHEN l_suppkey % 6 = 0 THEN NULL
                    ELSE concat(CASE WHEN l_suppkey % 2 = 0 THEN 'PU' ELSE 'NK' END, CAST(l_partkey AS STRING), 'PU') END AS CODFOR,
               CAST(l_quantity AS INT) AS TAGLIA, l_linestatus AS COLORE
        FROM {lineitem}""",
}
FEEDS["es_manufacturers"] = FEEDS["in_manufacturers"] = FEEDS["cg_manufacturers"] = FEEDS["fo_manufacturers"]
FEEDS["es_categories"] = FEEDS["fo_categories"]

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels")


def from_given(spark: SparkSession, sf_dir: str, sql: str, opened: dict[str, DataFrame] | None = None) -> DataFrame:
    """A shared SELECT run by Spark; ``opened`` keeps the given tables already looked up."""
    opened = {} if opened is None else opened
    used = [name for name in GIVEN if "{" + name + "}" in sql]
    for name in used:
        if name not in opened:
            opened[name] = read(spark, sf_dir, name)
    return spark.sql(sql.replace("~", "`"), **{name: opened[name] for name in used})


def twin(sql: str) -> str:
    """A shared SELECT as DuckDB text."""
    for name in GIVEN:
        sql = sql.replace("{" + name + "}", name)
    return sql.replace("{{", "{").replace("}}", "}").replace("~", '"')


class Tables(Mapping):
    """The derived tables by logical name, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        return from_given(self.spark, self.sf_dir, FEEDS[name], self.opened)

    def __iter__(self) -> Iterator[str]:
        return iter(FEEDS)

    def __len__(self) -> int:
        return len(FEEDS)


def with_feeds(names: Iterable[str], *more: str) -> str:
    """A WITH clause defining derived tables, then further ``name AS (...)`` parts."""
    parts = [f"{name} AS ({twin(FEEDS[name])})" for name in names]
    return "WITH " + ",\n".join([*parts, *more])

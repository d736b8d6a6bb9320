"""Branches, picks, joins and the full consolidation."""

from __future__ import annotations

import re

from pyspark.sql import Window, functions as F

from feedweave.functions.keys import availability_rank, row_key
from feedweave.operators.lookup import Lookup, join_lookup
from feedweave.operators.pick import best_per, collapse_by, concat_ranked, ordering
from feedweave.plans import flat
from feedweave.plans.branches import CG, ES, FO, IN, OWN, OWN_CODE
from suite import query, read
from suite.feeds import Tables, from_given, twin, with_feeds

# SQL twins ------------------------------------------------------------------------------

#: The product's columns and their types, as the targets' DDL has them.
KINDS = dict(re.findall(r"(\w+) (\w+(?:\(\d+,\d+\))?)", """
    name varchar, EAN varchar, part_number varchar, code varchar, original_cat_id varchar, original_subcat_id varchar, cat_id varchar,
    subcat_id varchar, original_manufacturer_id varchar, manufacturer_id varchar, enduser_price decimal(14,2),
    internal_availability int, external_availability int, in_arrival int, arrival_date date, source varchar, state varchar,
    promo varchar, width decimal(12,2), height decimal(12,2), depth decimal(12,2), weight decimal(12,2), min_orderable_qty int,
    priority int, retailers_price decimal(14,2), list_price decimal(14,2)"""))

# Ties: stock, then every column known before the late lookups, the article, then those lookups.
LATE = {"M": (), "FO": ("code",), "ES": ("arrival_date", "code"), "IN": ("enduser_price", "retailers_price", "code"), "CG": ("code",)}


def ties(source: str) -> str:
    early = [c for c in KINDS if c not in ("source", "priority", *LATE[source])]
    article = ["article"] if source in ("ES", "IN") else []
    return "external_availability DESC NULLS LAST, " + ", ".join(f"{c} ASC NULLS FIRST" for c in [*early, *article, *LATE[source]])


MONEY = {c for c, kind in KINDS.items() if kind.startswith("decimal")}


def shown(columns, prefix: str = "") -> str:
    """Product columns in the forms the comparison uses."""
    def one(c: str) -> str:
        if c in MONEY:
            return f"CAST({c} AS DOUBLE) AS {prefix}{c}"
        return f"CAST({c} AS VARCHAR) AS {prefix}{c}" if c == "arrival_date" else f"{c} AS {prefix}{c}"
    return ", ".join(one(c) for c in columns)


CODES = "LEFT JOIN own_codes ON codfor = {part} AND codfor <> '' AND codart NOT LIKE 'H%' AND codart NOT LIKE 'R%'"

# How each feed meets its tables when every join is written out, rows multiplying as they may.
JOINED = {
    "M": "own_list",
    "FO": f"""fo_list
        JOIN fo_manufacturers ON Marca = feed_manufacturer_id
        JOIN fo_categories ON (Linea, Famiglia) = (feed_cat_id, feed_subcat_id)
        {CODES.format(part='Cod')}""",
    "ES": f"""es_list
        JOIN es_manufacturers ON prod = feed_manufacturer_id
        JOIN es_categories ON (catMerc, fam) = (feed_cat_id, feed_subcat_id)
        LEFT JOIN es_arrivals ON es_list.codice = es_arrivals.codice
        {CODES.format(part='codiceProduttore')}""",
    "IN": f"""in_list
        JOIN in_manufacturers ON vendor_number = feed_manufacturer_id
        JOIN in_categories ON ingram_cat_subcat = concat(feed_cat_id, feed_subcat_id)
        JOIN in_stock ON in_list.ingram_part_number = in_stock.ingram_part_number
        LEFT JOIN in_fees ON in_list.ingram_part_number = in_fees.ingram_part_number AND country = 'IT'
        {CODES.format(part='vendor_part_number')}""",
    "CG": f"""cg_list
        JOIN cg_manufacturers ON produttore = feed_manufacturer_id
        JOIN cg_categories ON codice_macrocategoria = feed_cat_id
            AND concat_ws('$', codice_categoria, codice_sottocategoria) = feed_subcat_id
        {CODES.format(part='codice_articolo_fornitore')}""",
}
# What each feed puts into the product columns, worded here once more and apart from the
# library, so that a mistake there shows. The feeds' column names.
MAPPED = {
    "M": """name desart, EAN EAN, part_number codfor, code codart, original_cat_id clin1, original_subcat_id clin2, cat_id clin1,
        subcat_id clin2, original_manufacturer_id cpro, manufacturer_id cpro, enduser_price PREART3, internal_availability disp,
        external_availability 0, in_arrival OFOR, arrival_date DTFOR, state stato, promo promo, weight peso, priority 2,
        retailers_price PREART2, list_price PREART4""",
    "FO": """name Descr, EAN EAN, part_number Cod, code codart, original_cat_id Linea, original_subcat_id Famiglia, cat_id cat_id,
        subcat_id subcat_id, original_manufacturer_id Marca, manufacturer_id manufacturer_id, enduser_price Prezzo,
        internal_availability 0, external_availability Disponibili, in_arrival 0, weight Peso, min_orderable_qty 0, priority 0,
        retailers_price Prezzo, list_price Prezzo""",
    "ES": """name descrizione, EAN codiceEAN, part_number codiceProduttore, code codart, original_cat_id catMerc,
        original_subcat_id fam, cat_id cat_id, subcat_id subcat_id, original_manufacturer_id prod, manufacturer_id manufacturer_id,
        enduser_price raee+prezzoRivenditore, internal_availability 0, external_availability dispo, in_arrival arrivi,
        arrival_date es_arrivals.arrival_date, width lunghezza, height altezza, depth profondita, weight pesoLordo,
        min_orderable_qty qtaMinimaOrd, priority 0, retailers_price raee+prezzoRivenditore, list_price prezzolistino""",
    "IN": """name ingram_part_description_1, EAN nullif(coalesce(upc_code,'9999999999999'),'9999999999999'),
        part_number vendor_part_number, code codart, original_cat_id ingram_cat_subcat[1:2], original_subcat_id ingram_cat_subcat[3:4],
        cat_id cat_id, subcat_id subcat_id, original_manufacturer_id vendor_number, manufacturer_id manufacturer_id,
        enduser_price coalesce(siae,0)+custom_price, internal_availability 0, external_availability availability, in_arrival ordered,
        arrival_date arrival_date, width width, height height, depth length, weight weight, min_orderable_qty 1, priority 0,
        retailers_price coalesce(siae,0)+custom_price, list_price retail_price""",
    "CG": """name descrizione, EAN '', part_number codice_articolo_fornitore, code codart, original_cat_id codice_macrocategoria,
        original_subcat_id concat_ws('$',codice_categoria,codice_sottocategoria), cat_id cat_id, subcat_id subcat_id,
        original_manufacturer_id produttore, manufacturer_id manufacturer_id,
        enduser_price "contr.raee"+"contr.siae"+prezzo_netto, internal_availability 0, external_availability immediata,
        in_arrival futura-immediata, width 0, height 0, depth 0, weight 0, min_orderable_qty 1, priority 0,
        retailers_price "contr.raee"+"contr.siae"+prezzo_netto, list_price prezzo_listino""",
}
#: By feed: what its offers rank by, availability and price.
RANKING = {
    "M": ("disp", "PREART3"), "FO": ("Disponibili", "Prezzo"), "ES": ("dispo", "prezzoRivenditore"),
    "IN": ("availability", "custom_price"), "CG": ("immediata", "prezzo_netto"),
}
KEPT = {"M": "codfor <> ''", "ES": "tipo <> 'N' AND (greatest(dispo, arrivi) > 0 OR stato <> 'C')"}
TABLES_OF = {
    "M": ["own_list"], "FO": ["fo_list", "fo_manufacturers", "fo_categories", "own_codes"],
    "ES": ["es_list", "es_manufacturers", "es_categories", "own_codes", "es_arrivals"],
    "IN": ["in_list", "in_manufacturers", "in_categories", "in_stock", "own_codes", "in_fees"],
    "CG": ["cg_list", "cg_manufacturers", "cg_categories", "own_codes"],
}
ARTICLE = {"ES": "es_list.codice", "IN": "in_list.ingram_part_number"}
BRANCHES = {"M": OWN, "FO": FO, "ES": ES, "IN": IN, "CG": CG}


def rows(source: str) -> str:
    """All offers of a feed in product shape, before any pick; ``a`` and ``p`` rank them."""
    values = dict(part.split(None, 1) for part in re.split(r",\s+", MAPPED[source]))
    values["source"] = f"'{source}'"
    if source == "IN":  # an unknown or a sentinel barcode is blank
        values["EAN"] = f"coalesce({values['EAN']}, '')"
    columns = [f"CAST({values.get(c, 'NULL')} AS {kind}) AS {c}" for c, kind in KINDS.items()]
    columns += [f"{what} AS {name}" for what, name in zip(RANKING[source], "ap")]
    if source in ARTICLE:
        columns.append(f"{ARTICLE[source]} AS article")
    return f"SELECT {', '.join(columns)} FROM {JOINED[source]}" + (f" WHERE {KEPT[source]}" if source in KEPT else "")


def picked(source: str, price: str = "DESC NULLS LAST") -> str:
    """The best offer per part of one feed, as the reference words it: sort, keep the first."""
    if source == "M":
        price = "ASC NULLS FIRST, a DESC NULLS LAST"
    hidden = "a, p, rn, article" if source in ("ES", "IN") else "a, p, rn"
    return f"""SELECT * EXCLUDE ({hidden}) FROM (
        SELECT *, row_number() OVER (PARTITION BY part_number
            ORDER BY CASE WHEN a > 0 THEN 1 ELSE 0 END DESC, p {price}, {ties(source)}) AS rn
        FROM ({rows(source)})) WHERE rn = 1"""


def needs(sources) -> list[str]:
    return list(dict.fromkeys(t for s in sources for t in TABLES_OF[s]))


CROSS = """priority DESC, CASE WHEN external_availability > 0 THEN 1 ELSE 0 END DESC,
    enduser_price {price}"""


def flat_parts(sources, price: str = "DESC NULLS LAST") -> list[str]:
    """CTEs ``picks``, ``parts`` and ``products`` of a consolidation."""
    cross = CROSS.format(price=price)
    union = " UNION ALL BY NAME ".join(f"({picked(s, price)})" for s in sources)
    return [
        f"picks AS ({union})",
        f"""parts AS (SELECT * EXCLUDE (code, rn, codes), codes AS code FROM (
            SELECT *, row_number() OVER (PARTITION BY part_number ORDER BY {cross}, source) AS rn,
                   string_agg(code, ',' ORDER BY {cross}, source) OVER (PARTITION BY part_number) AS codes
            FROM picks) WHERE rn = 1)""",
        f"""products AS (SELECT concat_ws('|||', manufacturer_id, part_number) AS id, * EXCLUDE (rn, priority) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY CASE WHEN EAN <> '' THEN EAN END, CASE WHEN EAN <> '' THEN NULL ELSE part_number END
                ORDER BY {cross}, part_number) AS rn FROM parts) WHERE rn = 1)""",
    ]


PRODUCTS = ["id", *[c for c in KINDS if c != "priority"]]
DEFAULT = ("M", "FO", "ES", "IN")


def flat_sql(sources=DEFAULT, price: str = "DESC NULLS LAST", columns=PRODUCTS, prefix: str = "") -> str:
    return f"{with_feeds(needs(sources), *flat_parts(sources, price))}\nSELECT {shown(columns, prefix)} FROM products"


RESTRICTED = "id external_availability in_arrival arrival_date min_orderable_qty source retailers_price".split()

# Full and restricted consolidation ------------------------------------------------------

@query(flat_sql())
def flat_full(spark, sf_dir):
    return flat.consolidate(Tables(spark, sf_dir))


@query(flat_sql(price="ASC NULLS FIRST"))
def flat_lowest_price(spark, sf_dir):
    return flat.consolidate(Tables(spark, sf_dir), price_order="asc")


@query(flat_sql(("IN",)))
def flat_restricted(spark, sf_dir):
    return flat.consolidate(Tables(spark, sf_dir), flat.chosen(["IN"]))


@query(flat_sql(("M", "FO", "ES", "IN", "CG")))
def flat_with_suspended(spark, sf_dir):
    return flat.consolidate(Tables(spark, sf_dir), flat.chosen(["M", "FO", "ES", "IN", "CG"]))


@query(flat_sql(("IN",), columns=RESTRICTED, prefix="b2b_"))
def flat_prefixed(spark, sf_dir):
    return flat.restricted(Tables(spark, sf_dir))


def source_sql(source: str) -> str:
    return f"{with_feeds(needs([source]))}\nSELECT {shown(KINDS)} FROM ({picked(source)})"


def branch_query(name: str, source: str) -> None:
    def run(spark, sf_dir):
        return flat.best_in_branch(Tables(spark, sf_dir), BRANCHES[source])
    run.__name__ = name
    query(source_sql(source))(run)


for _name, _source in (
    ("flat_source_m", "M"), ("flat_source_fo", "FO"), ("flat_source_es", "ES"), ("flat_source_in", "IN"), ("flat_source_cg", "CG"),
):
    branch_query(_name, _source)


CLOTHING_SQL = """
    SELECT * REPLACE (regexp_replace(CODFOR, if(FAM = '526', 'PU', if(FAM = '501', 'NK', '^$')), '', 'g') AS CODFOR), CODART AS id
    FROM clothing_list WHERE regexp_full_match(FAM, '5(98|28|26|01)') AND regexp_full_match(SOTTOFAM, '00[16]')"""


@query(f"{with_feeds(['clothing_list'])} SELECT * REPLACE (CAST(PREZZO AS DOUBLE) AS PREZZO) FROM ({CLOTHING_SQL})")
def flat_single_feed(spark, sf_dir):
    return flat.clothing(Tables(spark, sf_dir)["clothing_list"])


# Picks over plain offers ----------------------------------------------------------------

OFFERS = """
    SELECT l_orderkey, l_linenumber, l_partkey AS part_no, l_suppkey AS supp,
           CASE l_suppkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'FO' WHEN 2 THEN 'ES' ELSE 'IN' END AS source,
           CASE WHEN l_suppkey % 4 = 0 THEN 2 ELSE 0 END AS priority,
           l_extendedprice AS price, CAST(greatest(l_quantity - 25, 0) AS INT) AS avail
    FROM {lineitem}"""
RANKED = "CASE WHEN avail > 0 THEN 1 ELSE 0 END DESC, price {price}, avail DESC, supp, l_orderkey, l_linenumber"


def offer_order(price: str = "desc"):
    return [availability_rank(F.col("avail")).desc(), ordering(f"price {price}"), ordering("avail desc"), "supp", "l_orderkey", "l_linenumber"]


def first_sql(keys: str, order: str, rows: str) -> str:
    return f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM ({rows})) WHERE rn = 1"


IN_SOURCE = first_sql("source, part_no", RANKED.format(price="DESC"), twin(OFFERS))
ACROSS = "priority DESC, CASE WHEN avail > 0 THEN 1 ELSE 0 END DESC, price DESC, source"


def offers(spark, sf_dir):
    return from_given(spark, sf_dir, OFFERS)


def across_order():
    return ["priority desc", availability_rank(F.col("avail")).desc(), "price desc", "source"]


@query(IN_SOURCE)
def best_in_source(spark, sf_dir):
    return best_per(offers(spark, sf_dir), ["source", "part_no"], offer_order())


@query(first_sql("part_no", ACROSS, IN_SOURCE))
def best_across_sources(spark, sf_dir):
    picks = best_per(offers(spark, sf_dir), ["source", "part_no"], offer_order())
    return best_per(picks, ["part_no"], across_order())


@query(first_sql("source, part_no", RANKED.format(price="ASC"), twin(OFFERS)))
def best_price_asc(spark, sf_dir):
    return best_per(offers(spark, sf_dir), ["source", "part_no"], offer_order("asc"))


EANS = """
    SELECT p_partkey, p_retailprice,
           CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 7 = 0 THEN NULL ELSE concat('EAN', CAST(p_partkey % 700 AS STRING)) END AS EAN
    FROM {part}"""


@query(first_sql("CASE WHEN EAN <> '' THEN EAN ELSE concat('#', p_partkey) END", "p_retailprice DESC, p_partkey", twin(EANS)))
def collapse_ean(spark, sf_dir):
    return collapse_by(from_given(spark, sf_dir, EANS), "EAN", "p_partkey", ["p_retailprice desc", "p_partkey"])


CODED = f"SELECT part_no, source, priority, avail, price, CASE WHEN supp % 3 = 0 THEN NULL ELSE concat('C', supp) END AS code FROM ({IN_SOURCE})"


@query(f"SELECT part_no, string_agg(code, ',' ORDER BY {ACROSS}) AS codes FROM ({CODED}) GROUP BY part_no")
def concat_codes(spark, sf_dir):
    picks = best_per(offers(spark, sf_dir), ["source", "part_no"], offer_order())
    coded = picks.withColumn("code", F.when(F.col("supp") % 3 != 0, F.concat(F.lit("C"), F.col("supp").cast("string"))))
    codes = coded.withColumn("codes", concat_ranked("code", ["part_no"], across_order()))
    return best_per(codes, ["part_no"], across_order()).select("part_no", "codes")


UNION_SQL = f"{with_feeds(needs(DEFAULT))}\nSELECT {shown(KINDS)} FROM (" + " {op} BY NAME ".join(f"({picked(s)})" for s in DEFAULT) + ")"


@query(UNION_SQL.replace("{op}", "UNION ALL"))
def union_branches(spark, sf_dir):
    tables = Tables(spark, sf_dir)
    return flat.union_branches([flat.best_in_branch(tables, b) for b in flat.DEFAULT])


@query(" UNION ".join(f"SELECT part_no, avail FROM ({twin(OFFERS)}) WHERE source = '{s}'" for s in DEFAULT))
def union_distinct(spark, sf_dir):
    rows = offers(spark, sf_dir).select("part_no", "avail", "source")
    return flat.union_branches([rows.filter(F.col("source") == s).drop("source") for s in DEFAULT], distinct=True)


@query(f"SELECT *, CASE WHEN avail > 0 THEN 1 ELSE 0 END AS available FROM ({twin(OFFERS)}) ORDER BY available DESC, price DESC, supp, l_orderkey, l_linenumber")
def ordered_rank(spark, sf_dir):
    ranked = offers(spark, sf_dir).withColumn("available", availability_rank(F.col("avail")))
    return ranked.orderBy(F.desc("available"), F.desc("price"), "supp", "l_orderkey", "l_linenumber")


# The three levels in one: best offer per feed and part, across feeds with all codes, by EAN.
PARTS = """
    SELECT p_partkey AS part_no, p_brand AS maker,
           CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat('EAN', CAST(p_partkey % 700 AS STRING)) END AS EAN,
           CASE WHEN p_name LIKE 's%' THEN NULL ELSE concat(p_name, ' ') END AS part_code
    FROM {part} WHERE p_size <= 40"""
THREE_LEVELS = f"""
    WITH offers AS (SELECT o.*, maker, EAN, part_code || source AS code FROM ({twin(OFFERS)}) o JOIN ({twin(PARTS)}) p ON o.part_no = p.part_no),
    picks AS ({first_sql("source, part_no", RANKED.format(price="DESC"), "SELECT * FROM offers")}),
    best AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY part_no ORDER BY {ACROSS}) AS rn,
        string_agg(code, ',' ORDER BY {ACROSS}) OVER (PARTITION BY part_no) AS codes FROM picks) WHERE rn = 1)
    SELECT concat_ws('|||', maker, part_no) AS id, EAN, source, price, avail, codes FROM (
        SELECT *, row_number() OVER (PARTITION BY CASE WHEN EAN <> '' THEN EAN ELSE concat('#', part_no) END
            ORDER BY priority DESC, CASE WHEN avail > 0 THEN 1 ELSE 0 END DESC, price DESC, part_no) AS rn FROM best) WHERE rn = 1"""


@query(THREE_LEVELS)
def three_level_consolidation(spark, sf_dir):
    # What a part is says nothing about which offer wins, so it joins after the first pick.
    picks = best_per(offers(spark, sf_dir), ["part_no", "source"], offer_order())
    parts = picks.join(from_given(spark, sf_dir, PARTS), "part_no").withColumn("code", F.concat("part_code", "source"))
    rank = F.row_number().over(Window.partitionBy("part_no").orderBy(*[ordering(o) if isinstance(o, str) else o for o in across_order()]))
    best = parts.withColumns({"codes": concat_ranked("code", ["part_no"], across_order()), "_rank": rank}).filter("_rank = 1")
    products = collapse_by(best, "EAN", "part_no", [*across_order()[:-1], "part_no"])
    return products.select(row_key(F.col("maker"), F.col("part_no").cast("string")).alias("id"), "EAN", "source", "price", "avail", "codes")


# Joins ----------------------------------------------------------------------------------

@query(f"{with_feeds(['fo_list', 'fo_manufacturers'])} SELECT Cod, Marca, CAST(Prezzo AS DOUBLE) AS Prezzo, manufacturer_id FROM fo_list JOIN fo_manufacturers ON Marca = feed_manufacturer_id")
def map_inner_join(spark, sf_dir):
    tables = Tables(spark, sf_dir)
    return join_lookup(tables["fo_list"], tables["fo_manufacturers"], FO.lookups[0]).select("Cod", "Marca", "Prezzo", "manufacturer_id")


# Customers with their nation's name in spellings of other case, accents and trailing spaces.
SPELLED = """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN lower(n_name) WHEN 1 THEN replace(n_name, 'A', 'Á')
    WHEN 2 THEN concat(lower(replace(n_name, 'E', 'Ë')), '  ') ELSE replace(replace(n_name, 'N', 'ñ'), 'I', 'í') END AS maker
    FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""


@query(f"SELECT c_custkey, maker, n_nationkey AS maker_id FROM ({twin(SPELLED)}) JOIN nation ON lower(strip_accents(rtrim(maker))) = lower(n_name)")
def map_join_any_accent(spark, sf_dir):
    names = from_given(spark, sf_dir, "SELECT n_name, n_nationkey FROM {nation}")
    lookup = Lookup("nation", (("maker", "n_name"),), {"maker_id": "n_nationkey"})
    return join_lookup(from_given(spark, sf_dir, SPELLED), names, lookup, key_policy="ci_ai")


@query(f"{with_feeds(['fo_list', 'fo_categories'])} SELECT Cod, Linea, Famiglia, CAST(Prezzo AS DOUBLE) AS Prezzo, cat_id, subcat_id FROM fo_list JOIN fo_categories ON Linea = feed_cat_id AND Famiglia = feed_subcat_id")
def map_composite_join(spark, sf_dir):
    tables = Tables(spark, sf_dir)
    return join_lookup(tables["fo_list"], tables["fo_categories"], FO.lookups[1]).select("Cod", "Linea", "Famiglia", "Prezzo", "cat_id", "subcat_id")


@query(f"{with_feeds(['in_list', 'in_categories'])} SELECT ingram_part_number, ingram_cat_subcat, ordered, cat_id, subcat_id FROM in_list JOIN in_categories ON ingram_cat_subcat = concat(feed_cat_id, feed_subcat_id)")
def map_computed_key_join(spark, sf_dir):
    tables = Tables(spark, sf_dir)
    return join_lookup(tables["in_list"], tables["in_categories"], IN.lookups[1]).select("ingram_part_number", "ingram_cat_subcat", "ordered", "cat_id", "subcat_id")


@query(f"{with_feeds(['cg_list', 'cg_categories'])} SELECT codice_articolo_fornitore, codice_sottocategoria, futura, cat_id, subcat_id FROM cg_list JOIN cg_categories ON codice_macrocategoria = feed_cat_id AND concat_ws('$', codice_categoria, codice_sottocategoria) = feed_subcat_id")
def map_joined_key_join(spark, sf_dir):
    tables = Tables(spark, sf_dir)
    return join_lookup(tables["cg_list"], tables["cg_categories"], CG.lookups[1]).select("codice_articolo_fornitore", "codice_sottocategoria", "futura", "cat_id", "subcat_id")


# The tables below have many rows per key. The twin multiplies and then reduces per article.

@query(f"""{with_feeds(['in_list', 'in_stock'])}
    SELECT vendor_part_number, max(availability) AS availability, count(DISTINCT in_list.ingram_part_number) AS articles
    FROM in_list JOIN in_stock ON in_stock.ingram_part_number = in_list.ingram_part_number GROUP BY vendor_part_number""")
def stock_join(spark, sf_dir):
    tables = Tables(spark, sf_dir)
    joined = join_lookup(tables["in_list"], tables["in_stock"], IN.lookups[2])
    return joined.groupBy("vendor_part_number").agg(
        F.max("availability").alias("availability"), F.countDistinct("ingram_part_number").alias("articles")
    )


@query(f"""{with_feeds(['fo_list', 'own_codes'])}
    SELECT Cod, min(codart) AS code, CAST(max(Prezzo) AS DOUBLE) AS price FROM fo_list {CODES.format(part='Cod')} GROUP BY Cod""")
def code_left_join_on_filter(spark, sf_dir):
    tables = Tables(spark, sf_dir)
    parts = tables["fo_list"].groupBy("Cod").agg(F.max("Prezzo").alias("price")).withColumn("part_number", F.col("Cod"))
    return join_lookup(parts, tables["own_codes"], OWN_CODE).select("Cod", "code", "price")


@query(f"""{with_feeds(['in_list', 'in_fees'])}
    SELECT in_list.ingram_part_number, CAST(max(custom_price) AS DOUBLE) AS price, CAST(min(coalesce(siae, 0)) AS DOUBLE) AS fee
    FROM in_list LEFT JOIN in_fees ON in_list.ingram_part_number = in_fees.ingram_part_number AND country = 'IT'
    GROUP BY in_list.ingram_part_number""")
def fee_left_join_const(spark, sf_dir):
    tables = Tables(spark, sf_dir)
    articles = tables["in_list"].groupBy(F.col("ingram_part_number").alias("_article")).agg(F.max("custom_price").alias("price"))
    joined = join_lookup(articles, tables["in_fees"], IN.lookups[4])
    return joined.select(F.col("_article").alias("ingram_part_number"), "price", F.coalesce("_fee", F.lit(0)).alias("fee"))


@query(f"""{with_feeds(['es_list', 'es_arrivals'])}
    SELECT codice, codiceProduttore, CAST(prezzoRivenditore AS DOUBLE) AS prezzoRivenditore, dispo, CAST(arrival_date AS VARCHAR) AS arrival_date FROM (
        SELECT es_list.*, arrival_date, row_number() OVER (PARTITION BY codiceProduttore
            ORDER BY prezzoRivenditore DESC, dispo DESC, es_list.codice, arrival_date NULLS FIRST) AS rn
        FROM es_list LEFT JOIN es_arrivals ON es_arrivals.codice = es_list.codice) WHERE rn = 1""")
def arrivals_fanout(spark, sf_dir):
    tables = Tables(spark, sf_dir)
    best = best_per(
        tables["es_list"].withColumn("_article", F.col("codice")), ["codiceProduttore"], ["prezzoRivenditore desc", "dispo desc", "codice"]
    )
    joined = join_lookup(best, tables["es_arrivals"], ES.lookups[3])
    return joined.select("codice", "codiceProduttore", "prezzoRivenditore", "dispo", F.col("_arrival").alias("arrival_date"))


# Expressions ----------------------------------------------------------------------------

@query(f"""{with_feeds(['es_list', 'cg_list'])}
    SELECT codiceProduttore AS part_number, CAST(prezzoRivenditore + raee AS DOUBLE) AS price, arrivi AS in_arrival FROM es_list
    UNION ALL SELECT codice_articolo_fornitore, CAST(prezzo_netto + "contr.siae" + "contr.raee" AS DOUBLE), futura - immediata FROM cg_list""")
def price_arith(spark, sf_dir):
    tables = Tables(spark, sf_dir)
    def priced(branch):
        e = branch.columns
        return tables[branch.feed].select(
            F.expr(e["part_number"]).alias("part_number"), F.expr(e["enduser_price"]).cast("double").alias("price"), F.expr(e["in_arrival"]).alias("in_arrival")
        )
    return priced(ES).unionByName(priced(CG))


@query(f"{with_feeds(['in_fees'])} SELECT ingram_part_number, country, CAST(coalesce(siae, 0) AS DOUBLE) AS fee FROM in_fees")
def ifnull_fee(spark, sf_dir):
    return Tables(spark, sf_dir)["in_fees"].select("ingram_part_number", "country", F.coalesce("siae", F.lit(0)).alias("fee"))


@query(f"{with_feeds(['in_list'])} SELECT ingram_part_number, CASE WHEN upc_code <> '9999999999999' THEN upc_code ELSE '' END AS EAN FROM in_list")
def sentinel_upc(spark, sf_dir):
    return Tables(spark, sf_dir)["in_list"].select("ingram_part_number", F.expr(IN.columns["EAN"]).alias("EAN"))


@query(f"{with_feeds(['in_list'])} SELECT ingram_part_number, substr(ingram_cat_subcat, 1, 2) AS original_cat_id, substr(ingram_cat_subcat, 3, 2) AS original_subcat_id FROM in_list")
def packed_code_split(spark, sf_dir):
    names = ("original_cat_id", "original_subcat_id")
    return Tables(spark, sf_dir)["in_list"].select("ingram_part_number", *[F.expr(IN.columns[n]).alias(n) for n in names])


@query("""SELECT concat_ws('|||', CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END) AS id, p_partkey FROM part""")
def concat_key(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    maker, name = F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")), F.when(F.col("p_partkey") % 4 != 0, F.col("p_name"))
    return part.select(row_key(maker, name).alias("id"), "p_partkey")


@query(f"{with_feeds(['own_codes'])} SELECT codfor, codart FROM own_codes WHERE codfor <> '' AND codart NOT LIKE 'H%' AND codart NOT LIKE 'R%'")
def code_prefix_filter(spark, sf_dir):
    return Tables(spark, sf_dir)["own_codes"].filter(OWN_CODE.where)


@query(f"{with_feeds(['own_list'])} SELECT codfor, desart, disp FROM own_list WHERE codfor <> ''")
def non_empty_part_filter(spark, sf_dir):
    return Tables(spark, sf_dir)["own_list"].filter(OWN.where).select("codfor", "desart", "disp")


@query(f"{with_feeds(['es_list'])} SELECT codice, codiceProduttore, tipo, stato, dispo, arrivi FROM es_list WHERE tipo <> 'N' AND (dispo > 0 OR arrivi > 0 OR stato <> 'C')")
def orderable_filter(spark, sf_dir):
    return Tables(spark, sf_dir)["es_list"].filter(ES.where).select("codice", "codiceProduttore", "tipo", "stato", "dispo", "arrivi")

"""Picks, lookups and the consolidation on hand-worked rows."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, values
from feedweave.functions.keys import availability_rank
from feedweave.operators.lookup import Lookup, join_lookup
from feedweave.operators.pick import best_per, collapse_by, concat_ranked
from feedweave.plans import flat
from feedweave.plans.enrich import EnrichReport, run_enrichment
from feedweave.sources.versioned import VersionedTable
from feedweave.plans.branches import CG, ES, FO, IN, OWN, PRODUCT

OWN_COLUMNS = "desart string, EAN string, codfor string, codart string, clin1 string, clin2 string, cpro string, PREART2 decimal(12,2), PREART3 decimal(12,2), PREART4 decimal(12,2), disp int, OFOR int, DTFOR date, stato string, promo string, peso decimal(12,2)"
FO_COLUMNS = "Descr string, EAN string, Cod string, Linea string, Famiglia string, Marca string, Prezzo decimal(12,2), Disponibili int, Peso decimal(12,2)"


def own(part, price, stock, ean="", code=None):
    price = Decimal(price)
    return ("own " + str(part), ean, part, code, "c", "s", "MAN", price, price, price, stock, 0, None, "A", "N", None)


def fo(part, price, stock, ean="", maker="M1"):
    return ("fo " + part, ean, part, "L", "F", maker, Decimal(price), stock, None)


def tables(spark, own_rows, fo_rows, codes=()):
    return {
        "own_list": spark.createDataFrame(own_rows, OWN_COLUMNS),
        "fo_list": spark.createDataFrame(fo_rows, FO_COLUMNS),
        "own_codes": spark.createDataFrame(list(codes), "codfor string, codart string"),
        "fo_manufacturers": spark.createDataFrame([("M1", "MAN")], "feed_manufacturer_id string, manufacturer_id string"),
        "fo_categories": spark.createDataFrame([("L", "F", "c", "s")], "feed_cat_id string, feed_subcat_id string, cat_id string, subcat_id string"),
    }


def test_own_feed_prefers_available_then_cheap_then_stock(spark):
    t = tables(spark, [own("p", 5, 0), own("p", 9, 3), own("p", 9, 8), own("", 1, 1), own(None, 1, 1)], [])
    assert values(flat.best_in_branch(t, OWN), "part_number", "enduser_price", "internal_availability") == [("p", Decimal("9.00"), 8)]


def test_other_feeds_prefer_the_higher_price(spark):
    t = tables(spark, [], [fo("p", 5, 2), fo("p", 7, 1), fo("p", 9, 0), fo("q", 1, 1, maker="unmapped")])
    assert values(flat.best_in_branch(t, FO), "part_number", "enduser_price") == [("p", Decimal("7.00"))]
    assert values(flat.best_in_branch(t, FO, price_order="asc"), "enduser_price") == [(Decimal("5.00"),)]
    with pytest.raises(ValueError):
        flat.best_in_branch(t, FO, price_order="up")


def test_priority_comes_before_availability(spark):
    t = tables(spark, [own("p", 5, 0, code="A")], [fo("p", 9, 9)], codes=[("p", "C2"), ("p", "C1"), ("p", "H0"), ("", "C0"), ("p", None)])
    rows = values(flat.consolidate(t, [OWN, FO]), "id", "source", "code", "external_availability")
    assert rows == [("MAN|||p", "M", "A,C1", 0)]


def test_codes_are_null_when_no_feed_has_one(spark):
    t = tables(spark, [own("p", 5, 0)], [fo("p", 9, 9)])
    assert values(flat.consolidate(t, [OWN, FO]), "code") == [(None,)]


def test_collapse_keeps_every_blank(spark):
    df = spark.createDataFrame([("1", 1), ("1", 2), ("", 3), ("", 4), (None, 5)], "EAN string, id long")
    assert values(collapse_by(df, "EAN", "id", ["id desc"]), "EAN", "id") == [(None, 5), ("", 3), ("", 4), ("1", 2)]


def test_consolidation_collapses_by_ean(spark):
    t = tables(spark, [own("p", 5, 1, ean="E"), own("q", 5, 1, ean="E"), own("r", 5, 1), own("s", 5, 1, ean=None)], [])
    assert values(flat.consolidate(t, [OWN]), "part_number") == [("p",), ("r",), ("s",)]


def test_concat_skips_nulls_and_keeps_repeats(spark):
    df = spark.createDataFrame([("k", "A", 1), ("k", None, 2), ("k", "A", 3), ("n", None, 1)], "k string, v string, r int")
    out = df.withColumn("c", concat_ranked("v", ["k"], ["r"])).select("k", "c").distinct()
    assert values(out) == [("k", "A,A"), ("n", None)]


def test_case_blind_keys(spark):
    t = tables(spark, [own("P ", 5, 1, code="X")], [fo("p", 9, 9)], codes=[("P", "C1")])
    assert len(values(flat.consolidate(t, [OWN, FO], key_policy="exact"))) == 2
    assert values(flat.consolidate(t, [OWN, FO], key_policy="ci"), "part_number", "code") == [("P ", "X,C1")]


def test_unknown_source_is_refused():
    with pytest.raises(ValueError):
        flat.chosen(["XX"])
    assert [b.source for b in flat.chosen(["IN", "M"])] == ["M", "IN"]


def test_lookup_equals_multiplying_then_picking(spark):
    """Reducing the lookup first gives what the reference's join, sort and group would."""
    feed = spark.range(300).selectExpr("id", "concat('k', id % 7) AS k", "id % 5 AS price")
    table = spark.range(200).selectExpr("concat('k', id % 9) AS k2", "concat('c', (id * 37) % 101) AS c")
    lookup = Lookup("t", (("k", "k2"),), {"c": "c"}, how="left")
    reduced = best_per(join_lookup(feed, table, lookup), ["k"], ["price desc", "id", "c"])
    multiplied = best_per(feed.join(table, F.col("k") == F.col("k2"), "left").drop("k2"), ["k"], ["price desc", "id", "c"])
    assert values(reduced, "k", "id", "price", "c") == values(multiplied, "k", "id", "price", "c")
    assert join_lookup(feed, table, lookup).count() == 300


def test_lookup_join_is_split_at_a_hot_key(spark):
    """A third of the feed and of the lookup under one key, and nothing may be broadcast."""
    key = "concat('K', CASE WHEN id % 3 = 0 THEN 0 ELSE id END)"
    feed = spark.range(0, 60000, 1, 8).selectExpr(f"{key} AS k", "id", "uuid() AS pad")
    table = spark.range(0, 30000, 1, 4).selectExpr(f"{key} AS c", "concat('c', id) AS code")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        for how in ("left", "inner"):
            joined = join_lookup(feed, table, Lookup("t", (("k", "c"),), {"code": "code"}, how=how))
            assert joined.groupBy().count().first()[0] == (60000 if how == "left" else 40000)
            rows = joined.select("id", "code", "pad")
            rows.collect()
            assert "skew=true" in plan_of(rows)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_late_lookup_must_be_left():
    with pytest.raises(ValueError):
        Lookup("t", (("a", "b"),), late=True)


def test_pick_limits_rows_before_the_shuffle(spark):
    """A key with a third of all rows: every task forwards one row of it."""
    df = spark.range(0, 30000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id")
    best = best_per(df, ["k"], ["id desc"])
    plan = plan_of(best)
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert best.filter("k = 0").first()["id"] == 29997
    assert best.count() == 20001


def test_available_rank_orders_unknown_last(spark):
    df = spark.createDataFrame([(None, 1), (0, 2), (5, 3)], "a int, id int")
    assert best_per(df, [F.lit(1)], [availability_rank(F.col("a")).desc(), "id"]).first()["id"] == 3


def test_projection_prefixes(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert flat.project(df, ["a", "c"], "b2b_").columns == ["b2b_a", "b2b_c"]


def test_product_shape(spark):
    t = tables(spark, [own("p", 5, 1)], [])
    assert flat.best_in_branch(t, OWN).columns == list(PRODUCT)
    assert "priority" not in flat.consolidate(t, [OWN]).columns


# One offer of each further feed, every product column worked out by hand.
MAPS = {"manufacturers": "feed_manufacturer_id string, manufacturer_id string", "categories": "feed_cat_id string, feed_subcat_id string, cat_id string, subcat_id string"}
D = Decimal


def product(**filled):
    return {**dict.fromkeys(PRODUCT), **filled}


def branch_tables(spark, feed, listed, columns, category, **more):
    made = {
        f"{feed}_list": spark.createDataFrame(listed, columns),
        f"{feed}_manufacturers": spark.createDataFrame([("V7", "MAN"), ("V8", "OTHER")], MAPS["manufacturers"]),
        f"{feed}_categories": spark.createDataFrame([category], MAPS["categories"]),
        "own_codes": spark.createDataFrame([("PN", "C5"), ("PN", "H1"), ("PN", "R2"), ("", "C0")], "codfor string, codart string"),
    }
    return made | {name: spark.createDataFrame(*rows) for name, rows in more.items()}


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_every_column_of_the_es_feed(spark):
    columns = (
        "codice string, descrizione string, codiceEAN string, codiceProduttore string, catMerc string, fam string, prod string, tipo string, stato string, "
        "prezzoRivenditore decimal(12,2), raee decimal(12,2), prezzolistino decimal(12,2), lunghezza decimal(12,2), altezza decimal(12,2), "
        "profondita decimal(12,2), pesoLordo decimal(12,2), dispo int, arrivi int, qtaMinimaOrd int"
    )
    offer = ("A1", "a screen", "800", "PN", "CM", "FM", "V7", "S", "C", D("10.00"), D("0.50"), D("15.00"), D("1.10"), D("2.20"), D("3.30"), D("4.40"), 6, 2, 3)
    change = lambda **new: tuple(new.get(c.split()[0], v) for c, v in zip(columns.split(", "), offer))
    rows = [
        offer, change(tipo="N", prezzoRivenditore=D(99)), change(dispo=0, arrivi=0, codice="A2", prezzoRivenditore=D(98)),
        change(dispo=0, arrivi=0, stato="A", codice="A3", prezzoRivenditore=D(97)), change(prod="V9", prezzoRivenditore=D(96)), change(prezzoRivenditore=D(9)),
    ]
    t = branch_tables(spark, "es", rows, columns, ("CM", "FM", "c", "s"), es_arrivals=([("A1", date(2024, 5, 6)), ("A1", date(2024, 5, 7))], "codice string, arrival_date date"))
    assert only(flat.best_in_branch(t, ES)) == product(
        name="a screen", EAN="800", part_number="PN", code="C5", original_cat_id="CM", original_subcat_id="FM", cat_id="c", subcat_id="s",
        original_manufacturer_id="V7", manufacturer_id="MAN", enduser_price=D("10.50"), internal_availability=0, external_availability=6,
        in_arrival=2, arrival_date=date(2024, 5, 6), source="ES", width=D("1.10"), height=D("2.20"), depth=D("3.30"), weight=D("4.40"),
        min_orderable_qty=3, priority=0, retailers_price=D("10.50"), list_price=D("15.00"),
    )


def test_every_column_of_the_in_feed(spark):
    columns = (
        "ingram_part_number string, ingram_part_description_1 string, upc_code string, vendor_part_number string, vendor_number string, ingram_cat_subcat string, "
        "custom_price decimal(12,2), retail_price decimal(12,2), width decimal(12,2), height decimal(12,2), length decimal(12,2), weight decimal(12,2), ordered int, arrival_date date"
    )
    offer = ("I1", "a disk", "9999999999999", "PN", "V7", "0412", D("20.00"), D("30.00"), D("1.00"), D("2.00"), D("3.00"), D("4.00"), 5, date(2024, 7, 8))
    rows = [offer, ("I2", "no stock", *offer[2:]), ("I3", "unmapped", *offer[2:5], "9912", *offer[6:])]
    t = branch_tables(
        spark, "in", rows, columns, ("04", "12", "c", "s"),
        in_stock=([("I1", 7), ("I3", 9)], "ingram_part_number string, availability int"),
        in_fees=([("I1", D("0.70"), "IT"), ("I1", D("9.00"), "FR")], "ingram_part_number string, siae decimal(12,2), country string"),
    )
    assert only(flat.best_in_branch(t, IN)) == product(
        name="a disk", EAN="", part_number="PN", code="C5", original_cat_id="04", original_subcat_id="12", cat_id="c", subcat_id="s",
        original_manufacturer_id="V7", manufacturer_id="MAN", enduser_price=D("20.70"), internal_availability=0, external_availability=7,
        in_arrival=5, arrival_date=date(2024, 7, 8), source="IN", width=D("1.00"), height=D("2.00"), depth=D("3.00"), weight=D("4.00"),
        min_orderable_qty=1, priority=0, retailers_price=D("20.70"), list_price=D("30.00"),
    )


def test_every_column_of_the_cg_feed(spark):
    columns = (
        "descrizione string, codice_articolo_fornitore string, codice_macrocategoria string, codice_categoria string, codice_sottocategoria string, produttore string, "
        "prezzo_netto decimal(12,2), prezzo_listino decimal(12,2), `contr.siae` decimal(12,2), `contr.raee` decimal(12,2), immediata int, futura int"
    )
    offer = ("a phone", "PN", "MC", "K", "J", "V7", D("5.00"), D("8.00"), D("0.20"), D("0.03"), 4, 9)
    t = branch_tables(spark, "cg", [offer, ("other", *offer[1:4], "X", *offer[5:])], columns, ("MC", "K$J", "c", "s"))
    assert only(flat.best_in_branch(t, CG)) == product(
        name="a phone", EAN="", part_number="PN", code="C5", original_cat_id="MC", original_subcat_id="K$J", cat_id="c", subcat_id="s",
        original_manufacturer_id="V7", manufacturer_id="MAN", enduser_price=D("5.23"), internal_availability=0, external_availability=4,
        in_arrival=5, source="CG", width=D("0.00"), height=D("0.00"), depth=D("0.00"), weight=D("0.00"), min_orderable_qty=1, priority=0,
        retailers_price=D("5.23"), list_price=D("8.00"),
    )


def test_text_stock_does_not_end_the_consolidation(spark):
    t = tables(spark, [], [fo("p", 5, 2), fo("q", 5, 2)])
    t["fo_list"] = t["fo_list"].withColumn("Disponibili", F.when(F.col("Cod") == "p", "12 pz").otherwise("none"))
    assert values(flat.best_in_branch(t, FO), "part_number", "external_availability") == [("p", 12), ("q", 0)]


def test_barcodes_follow_the_key_policy(spark):
    t = tables(spark, [own("p", 5, 1, ean="abc"), own("q", 5, 1, ean="ABC ")], [])
    assert len(values(flat.consolidate(t, [OWN]), "id")) == 2
    assert len(values(flat.consolidate(t, [OWN], key_policy="ci"), "id")) == 1


def test_enrichment_run(spark, tmp_path):
    products = spark.createDataFrame([("1", "m", "E1", "P1"), ("2", "m", "", "p2"), ("3", "M", None, "P3")], "id string, manufacturer_id string, EAN string, part_number string")
    makers = spark.createDataFrame([("m", "X/Y")], "cod string, des string")
    xml = '<Catalogue><Product Code="1" HighPic="h"/></Catalogue>'
    entries = spark.createDataFrame([("E1", "z", "z", xml), ("", "P2", "y", xml), ("", "P3", "X", xml)], "ean string, prod_id string, vendor string, xml string")
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert run_enrichment(spark, products, makers, table, entries) == EnrichReport(1, 3)
    assert values(table.read(), "id", "high_pic") == [("1", "h")]
    assert run_enrichment(spark, products, makers, table, entries, key_policy="ci") == EnrichReport(2, 2)
    assert values(table.read(), "id") == [("1",), ("2",), ("3",)]
    assert run_enrichment(spark, products, makers, table, entries) == EnrichReport(0, 0) and table.version() == 2


def test_keys_without_accents(spark):
    from feedweave.functions.keys import fold_letter, match_key

    pairs = [("É1", "e1"), ("straße", "STRASE"), ("ẞ", "s"), ("ΟΔΟΣ", "οδοσ"), ("οδος", "οδοσ"), ("İ", "i"), ("e\u0301x ", "EX"), ("Ångström  ", "angstrom"), ("Ǆ", "ǆ"), ("Ж", "ж"), ("", "  ")]
    rows = spark.createDataFrame(pairs, "a string, b string").select(match_key(F.col("a"), "ci_ai"), match_key(F.col("b"), "ci_ai")).collect()
    assert [r for r in rows if r[0] != r[1]] == []
    apart = [("a", "b"), ("ł", "l"), ("æ", "ae"), ("e x", "ex"), (" e", "e"), ("o", "ø")]
    rows = spark.createDataFrame(apart, "a string, b string").select(match_key(F.col("a"), "ci_ai"), match_key(F.col("b"), "ci_ai")).collect()
    assert [r for r in rows if r[0] == r[1]] == []
    assert all(fold_letter(fold_letter(c)) == fold_letter(c) for c in map(chr, range(0x3000)) if c.isalpha())
    with pytest.raises(ValueError):
        match_key(F.col("a"), "other")


def test_accent_blind_keys_group_by_hash(spark):
    from feedweave.functions.keys import match_key

    df = spark.createDataFrame([("É", 1), ("e ", 2), ("f", 4)], "k string, n long")
    counted = df.groupBy(match_key(F.col("k"), "ci_ai").alias("k")).agg(F.sum("n").alias("n"))
    assert values(counted) == [("e", 3), ("f", 4)] and "SortAggregate" not in plan_of(counted)

"""Every registered query against its SQL twin, and the plans of the headline ones."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
import suite
from conftest import plan_of
from feedweave.plans import flat
from feedweave.plans.branches import DEFAULT
from suite.feeds import Tables

GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLE = suite.QUERIES, suite.ORACLE


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in GIVEN:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def sorted_rows(rows):
    return sorted(tuple(repr(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_equals_its_twin(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted_rows([row[c] for c in columns] for row in df.collect())
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted_rows([row[names.index(c)] for c in columns] for row in result.fetchall())
    assert got == expected
    assert got


def test_entry_survives_what_the_training_operators_lack():
    import subprocess
    import sys

    script = (
        "import sys; sys.modules[{0!r}] = None\n"
        "import warnings; warnings.simplefilter('ignore')\n"
        "import __spark_entry__ as e; print(len(e.queries()), 'flat_full' in e.oracle_sql())"
    )
    for module in ("public_tokenizers", "feedweave.llm", "corpus_pipeline"):
        out = subprocess.run([sys.executable, "-c", script.format(module)], capture_output=True, text=True, check=True).stdout.split()
        assert int(out[0]) >= len(QUERIES) and out[1] == "True"


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "id"


def test_consolidation_does_not_depend_on_partitioning(spark, sf_dir):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for partitions in ("1", "7", "60"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            results.append(sorted_rows(QUERIES["flat_full"](spark, sf_dir).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


def test_consolidation_survives_shuffled_joins_and_skew(spark, sf_dir):
    """The same rows when nothing may be broadcast and AQE splits skewed partitions."""
    expected = sorted_rows(QUERIES["flat_full"](spark, sf_dir).collect())
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = QUERIES["flat_full"](spark, sf_dir)
        assert "BroadcastHashJoin" not in plan_of(df)
        assert sorted_rows(df.collect()) == expected
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_union_of_branches_needs_no_further_shuffle(spark, sf_dir):
    tables = Tables(spark, sf_dir)
    own, fo = DEFAULT[:2]
    union = flat.union_branches([flat.best_in_branch(tables, own), flat.best_in_branch(tables, fo)])
    plan = plan_of(flat.best_across(union))
    assert "Exchange" not in plan[:plan.index("Union")]


def test_core_stays_in_the_jvm(spark, sf_dir):
    for name in ("flat_full", "sync_apply", "load_quarantine", "enrich_first_hit", "schedule_expand", "profile_columns"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_restricted_reads_one_feed(spark, sf_dir):
    df = flat.restricted(Tables(spark, sf_dir))
    assert df.columns[0] == "b2b_id"
    assert {r["b2b_source"] for r in df.select("b2b_source").distinct().collect()} == {"IN"}


def test_a_feed_found_empty_at_run_time(spark, sf_dir):
    """AQE drops an empty branch while the query runs; the others stay whole."""

    class Emptied(Tables):
        def __getitem__(self, name):
            df = super().__getitem__(name)
            return df.filter("abs(Prezzo) < -abs(Prezzo)") if name == "fo_list" else df

    for partitions in ("1", "4", "23"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = sorted_rows(flat.consolidate(Emptied(spark, sf_dir)).collect())
        expected = sorted_rows(flat.consolidate(Tables(spark, sf_dir), flat.chosen(["M", "ES", "IN"])).collect())
        assert got == expected
    spark.conf.set("spark.sql.shuffle.partitions", "4")

"""Bucketed tables: what a sync writes, what it leaves, what it moves."""

import random
from datetime import datetime
from pathlib import Path

import pytest

from conftest import plan_of, values
from feedweave.plans import sync
from feedweave.plans.targets import Target
from feedweave.sources.bucketed import BUCKET, DIGEST, KEY, BucketedTable
from feedweave.sources.versioned import LostRace, VersionedTable

OLD, NOW, LATER = datetime(2024, 1, 1), datetime(2024, 2, 2, 3, 4, 5), datetime(2024, 3, 3)
LIST = Target("list", "id", "updated", (("id", "string", 5), ("name", "string", None), ("qty", "int", None), ("price", "float", None)))


def source(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, qty long, price double").repartition(3)


def table_at(spark, path, buckets=16, policy="exact"):
    return BucketedTable(spark, str(path), LIST.schema(), buckets, policy)


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


ROWS = [(f"k{i}", f"name {i}", i, i / 3) for i in range(400)]


def test_only_buckets_with_changes_are_written(spark, tmp_path):
    table = table_at(spark, tmp_path / "t")
    assert sync.run_sync(spark, source(spark, ROWS), table, LIST, OLD) == sync.SyncReport(400, 0, 0)
    first = table.manifest()
    assert len(first.parts) == 16 and table.rows() == 400 and len({folder for folder, _ in first.parts.values()}) == 1
    before = files(tmp_path / "t")
    changed = [("k7", "new", 7, 1.0) if r[0] == "k7" else r for r in ROWS if r[0] != "k9"] + [("n1", "x", 1, None)]
    assert sync.run_sync(spark, source(spark, changed), table, LIST, NOW) == sync.SyncReport(2, 398, 1)
    second = table.manifest()
    touched = {b for b in second.parts if second.parts[b][0] != first.parts[b][0]}
    assert 1 <= len(touched) <= 3 and table.rows() == 400
    after = files(tmp_path / "t")
    assert all(after[f] == before[f] for f in before) and len(after) - len(before) == len(touched)
    got = {r["id"]: r for r in table.read().collect()}
    assert set(got) == {r[0] for r in changed}
    assert {k for k, r in got.items() if r["updated"] == NOW} == {"k7", "n1"}
    assert table.read(version=1).count() == 400 and table.read().columns == LIST.schema().names


def test_a_diff_moves_nothing_and_reads_keys_and_digests(spark, tmp_path):
    table = table_at(spark, tmp_path / "t")
    sync.run_sync(spark, source(spark, ROWS), table, LIST, OLD)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with table.view(table.manifest()) as stored:
            rows = sync.keyed_rows(source(spark, ROWS), LIST, 16)
            found = sync.bucket_diff(rows, stored, LIST)
            plan = plan_of(found)
            assert plan.count("Exchange") - plan.count("Exchange RoundRobin") - plan.count("Exchange SinglePartition") == 1  # the source, into its buckets
            assert "Bucketed: true" in plan
            scan = next(line for line in plan.splitlines() if "FileScan" in line and "updated" in line)
            assert "name" not in scan.split("ReadSchema")[1] and all(d in scan for d in DIGEST)
            assert found.filter("action = 'untouched'").count() == 400
            twice = sync.bucket_diff(stored.drop("updated"), stored, LIST)
            assert "Exchange" not in plan_of(twice) and twice.filter("action = 'untouched'").count() == 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("policy", ["exact", "ci"])
@pytest.mark.parametrize("delete_missing", [True, False])
def test_equals_a_table_rewritten_whole(spark, tmp_path, policy, delete_missing):
    rng = random.Random(1)
    bucketed, whole = table_at(spark, tmp_path / "b", 7, policy), VersionedTable(spark, str(tmp_path / "w"))
    for now in (OLD, NOW, LATER):
        rows = [
            (rng.choice([None, "", "a", "A ", f"K{k}", f"k{k}"]) if rng.random() < 0.2 else f"k{k}",
             rng.choice([None, "£n", "n", ""]), rng.choice([None, 0, 1, 99999999999]), rng.choice([None, 0.0, -0.0, float("nan"), 1.25]))
            for k in range(rng.randrange(60, 90))
        ]
        options = {"delete_missing": delete_missing, "key_policy": policy, "order": ["qty"]}
        reports = [sync.run_sync(spark, source(spark, rows), t, LIST, now, **options) for t in (bucketed, whole)]
        assert reports[0] == reports[1]
        assert sorted(map(repr, bucketed.read().collect())) == sorted(map(repr, whole.read().collect()))
        assert bucketed.rows() == whole.read().count()


def test_digests_tell_nulls_apart(spark, tmp_path):
    table = table_at(spark, tmp_path / "t")
    sync.run_sync(spark, source(spark, [("a", None, 1, None), ("b", "x", None, 2.0)]), table, LIST, OLD)
    assert sync.run_sync(spark, source(spark, [("a", "", 1, None), ("b", "x", None, 2.0)]), table, LIST, NOW) == sync.SyncReport(1, 1, 0)


def test_guards_empty_tables_and_other_policies(spark, tmp_path):
    table = table_at(spark, tmp_path / "t")
    assert table.read().count() == table.rows() == 0
    sync.run_sync(spark, source(spark, ROWS), table, LIST, OLD)
    with pytest.raises(RuntimeError):
        sync.run_sync(spark, source(spark, ROWS[:10]), table, LIST, NOW, max_delete_fraction=0.5)
    with pytest.raises(ValueError):
        sync.run_sync(spark, source(spark, ROWS), table, LIST, NOW, key_policy="ci")
    assert sync.run_sync(spark, source(spark, ROWS), table, LIST, NOW) == sync.SyncReport(0, 400, 0)
    assert table.version() == 1
    assert sync.run_sync(spark, source(spark, []), table, LIST, NOW) == sync.SyncReport(0, 0, 400)
    assert table.version() == 2 and table.read().count() == 0 and table.manifest().parts == {}
    assert sync.run_sync(spark, source(spark, ROWS[:3]), table, LIST, LATER) == sync.SyncReport(3, 0, 0)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("feedweave_")]


def test_expire_keeps_folders_that_are_still_referred_to(spark, tmp_path):
    table = table_at(spark, tmp_path / "t")
    for k in range(5):
        rows = [(r[0], f"{r[1]} {k}" if r[0] == "k7" else r[1], *r[2:]) for r in ROWS]
        sync.run_sync(spark, source(spark, rows), table, LIST, OLD)
    folders = {folder for folder, _ in table.manifest().parts.values()}
    assert len(folders) == 2 and table.read().count() == table.read(version=4).count() == 400
    assert len(list((tmp_path / "t" / "data").glob("0*"))) == 3  # the first, and the last two


def test_only_one_of_two_writers_commits(spark, tmp_path):
    table = table_at(spark, tmp_path / "t")
    sync.run_sync(spark, source(spark, ROWS), table, LIST, OLD)

    class Late(BucketedTable):
        def commit(self, staged, note=""):
            if self.version() == 1:
                sync.run_sync(spark, source(spark, ROWS[:5]), table, LIST, NOW)
            super().commit(staged, note)

    late = Late(spark, str(tmp_path / "t"), LIST.schema())
    with pytest.raises(LostRace):
        sync.run_sync(spark, source(spark, ROWS[:50]), late, LIST, LATER)
    assert table.read().count() == 5 and KEY not in table.read().columns and BUCKET not in table.read().columns

"""Diff, report, replace, the guarded run and the stream."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from conftest import plan_of, values
from feedweave.operators import diff
from feedweave.plans import sync
from feedweave.plans.targets import CLOTHING, FULL, RESTRICTED, Target
from feedweave.sources.versioned import LostRace, VersionedTable
from feedweave.streaming.sync_stream import sync_stream

OLD, NOW, LATER = datetime(2024, 1, 1), datetime(2024, 2, 2, 3, 4, 5), datetime(2024, 3, 3)
LIST = Target("list", "id", "updated", (("id", "string", 5), ("name", "string", None), ("qty", "int", None)))


def source(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, qty long")


def stored(spark, rows):
    return spark.createDataFrame([(*r, OLD) for r in rows], LIST.schema())


def test_the_four_outcomes(spark):
    target = stored(spark, [("1", "a", 0), ("2", "b", 0), ("3", "c", 0)])
    got = sync.classify(source(spark, [("2", "b", 0), ("3", "x", 0), ("4", "d", 0)]), target, LIST, sync.stamp(NOW))
    assert values(got, "id", "name", "updated", "action") == [
        ("1", "a", OLD, "delete"), ("2", "b", OLD, "untouched"), ("3", "x", NOW, "update"), ("4", "d", NOW, "insert"),
    ]
    assert values(diff.report(got)) == [(2, 1, 1)]
    assert values(diff.applied(got), "id") == [("2",), ("3",), ("4",)]


def test_rows_are_compared_as_stored(spark):
    target = stored(spark, [("12345", "a", 2147483647), ("2", None, 1)])
    got = sync.classify(source(spark, [("1234567", "£a", 99999999999), ("2", None, 1)]), target, LIST, sync.stamp(NOW))
    assert values(got, "id", "action") == [("12345", "untouched"), ("2", "untouched")]


def test_null_policy(spark):
    target = stored(spark, [("2", "", 0)])
    rows = source(spark, [("2", None, None)])
    assert values(sync.classify(rows, target, LIST, sync.stamp(NOW)), "action") == [("update",)]
    assert values(sync.classify(rows, target, LIST, sync.stamp(NOW), nulls="zero"), "action") == [("untouched",)]


def test_keys_that_differ_in_case_only(spark):
    target = stored(spark, [("a", "n", 1), ("B", "n", 1)])
    rows = source(spark, [("A", "n", 1), ("B ", "n", 1), ("b", "m", 1)])
    exact = sync.classify(rows, target, LIST, sync.stamp(NOW))
    assert values(exact, "id", "action") == [("A", "insert"), ("B", "delete"), ("B ", "insert"), ("a", "delete"), ("b", "insert")]
    equated = sync.classify(rows, target, LIST, sync.stamp(NOW), key_policy="ci")
    assert values(equated, "id", "name", "action") == [("A", "n", "update"), ("B ", "n", "update")]


def test_repeated_source_keys_leave_one_row(spark):
    got = sync.classify(source(spark, [("1", "a", 1), ("1", "b", 1), (None, "n", 1)]), stored(spark, []), LIST, sync.stamp(NOW))
    assert values(got, "id", "name") == [("", "n"), ("1", "b")]


def test_counts_add_up(spark):
    rows = [(str(i), f"n{i % 4}", i) for i in range(200)]
    target = stored(spark, [(k, n if int(k) % 5 else "old", q) for k, n, q in rows if int(k) % 3])
    got = sync.classify(source(spark, [r for r in rows if int(r[0]) % 7]), target, LIST, sync.stamp(NOW))
    by = {r["action"]: r["count"] for r in got.groupBy("action").count().collect()}
    assert by["insert"] + by["update"] + by["untouched"] == sum(1 for r in rows if int(r[0]) % 7)
    assert by["untouched"] + by["update"] + by["delete"] == target.count()


def test_missing_keys_and_replace(spark):
    old, new = source(spark, [("1", "a", 1), ("2", "b", 2)]), source(spark, [("2", "x", 9), ("3", "c", 3)])
    assert values(diff.missing_keys(old, new, "id"), "id") == [("1",)]
    assert values(diff.replace_into(old, new, "id"), "id", "name") == [("1", "a"), ("2", "x"), ("3", "c")]
    assert "LeftAnti" in plan_of(diff.missing_keys(old, new, "id"))


def test_run_creates_then_settles(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    rows = source(spark, [("1", "a", 1), ("2", "b", 2)])
    assert sync.run_sync(spark, rows, table, LIST, OLD) == sync.SyncReport(2, 0, 0)
    assert sync.run_sync(spark, rows, table, LIST, NOW) == sync.SyncReport(0, 2, 0)
    assert values(table.read(), "updated") == [(OLD,), (OLD,)]
    assert sync.run_sync(spark, source(spark, [("2", "x", 2)]), table, LIST, LATER) == sync.SyncReport(1, 0, 1)
    assert values(table.read(), "id", "updated") == [("2", LATER)]


def test_guards(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    rows = source(spark, [(str(i), "a", i) for i in range(10)])
    sync.run_sync(spark, rows, table, LIST, OLD)
    empty = rows.limit(0)
    assert sync.run_sync(spark, rows, table, LIST, NOW, needed={"feed": empty}).empty == ("feed",)
    locked = spark.createDataFrame([("feed",), ("other",)], "local_name string")
    with pytest.raises(sync.LockedTable):
        sync.run_sync(spark, rows, table, LIST, NOW, needed={"feed": rows}, locked=locked)
    own = spark.createDataFrame([("list",)], "local_name string")
    with pytest.raises(sync.LockedTable):  # the target's own lock counts, needed tables or not
        sync.run_sync(spark, rows, table, LIST, NOW, locked=own)
    with pytest.raises(RuntimeError):
        sync.run_sync(spark, rows.filter("qty < 3"), table, LIST, NOW, max_delete_fraction=0.5)
    assert table.version() == 1 and table.read().count() == 10
    assert sync.run_sync(spark, rows.filter("qty < 6"), table, LIST, NOW, max_delete_fraction=0.5) == sync.SyncReport(0, 6, 4)


def test_only_one_of_two_writers_commits(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    first, second = table.stage(spark.range(3)), table.stage(spark.range(5))
    table.commit(first, "one")
    with pytest.raises(Exception):
        table.commit(second)
    assert table.read().count() == 3 and table.note() == "one"


class Overwriting(VersionedTable):
    """A table on a store whose rename replaces what is there."""

    def _rename(self, half, final):
        fs, _ = self._hadoop(self.path)
        fs.delete(final, False)
        assert fs.rename(half, final)


@pytest.mark.parametrize("claim, winners", [("rename", 2), ("create", 1)])
def test_two_writers_where_rename_replaces(spark, tmp_path, claim, winners):
    """Renaming lets both believe that they have won; the conditional create tells them apart."""
    first, second = (Overwriting(spark, str(tmp_path / "t"), claim) for _ in range(2))
    staged = [first.stage(spark.range(3)), second.stage(spark.range(5))]
    outcomes = []
    for table, data in zip((first, second), staged):
        try:
            table.commit(data, f"{len(outcomes)}")
            outcomes.append(True)
        except LostRace:
            outcomes.append(False)
    assert sum(outcomes) == winners
    if claim == "create":
        assert first.read().count() == 3 and first.note() == "0" and first.rows() == 3
        assert len(list((tmp_path / "t" / "data").iterdir())) == 1  # the loser's data is gone
        first.overwrite(spark.range(7))
        assert second.read().count() == 7 and second.version() == 2


def test_a_create_that_fails_is_told_from_a_lost_race(spark, tmp_path):
    class Failing(VersionedTable):
        def _put(self, out, content):
            out.close()
            fs, path = self._hadoop(f"{self.path}/commits/00000001")
            fs.delete(path, False)
            raise OSError("no space")

    with pytest.raises(OSError):
        Failing(spark, str(tmp_path / "t"), "create").overwrite(spark.range(2))
    assert list((tmp_path / "t" / "data").iterdir()) == []
    with pytest.raises(ValueError):
        VersionedTable(spark, "x", "other")


def test_a_commit_in_between_is_not_lost(spark, tmp_path):
    """The version that was read is the one that is followed, so the slower run fails."""
    table = VersionedTable(spark, str(tmp_path / "t"))
    rows = source(spark, [("1", "a", 1)])
    sync.run_sync(spark, rows, table, LIST, OLD)

    class Slow(VersionedTable):
        def read(self, schema=None, version=None):
            df = super().read(schema, version)
            sync.run_sync(spark, source(spark, [("1", "a", 1), ("2", "other", 2)]), table, LIST, NOW)
            return df

    with pytest.raises(LostRace):
        sync.run_sync(spark, source(spark, [("1", "mine", 1)]), Slow(spark, table.path), LIST, LATER)
    assert values(table.read(), "id", "name") == [("1", "a"), ("2", "other")]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2  # the loser's data is gone


def test_a_crash_while_committing_leaves_the_table_usable(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.overwrite(spark.range(3))
    (tmp_path / "t" / "commits" / ".half").write_text("")
    (tmp_path / "t" / "commits" / "notes.txt").write_text("x")
    assert table.version() == 1 and table.read().count() == 3
    table.stage(spark.range(9))  # never committed
    table.overwrite(spark.range(4))
    assert table.version() == 2 and table.read().count() == 4
    table.expire(keep=1)
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2  # another writer may still commit its own
    table.expire(keep=1, grace=0)
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1 and table.read().count() == 4


def test_rows_are_applied_in_turn(spark, tmp_path):
    rows = spark.createDataFrame([("1", "z", 9, 1), ("1", "a", 1, 2), ("2", "b", 1, 1)], "id string, name string, qty long, turn int")
    table = VersionedTable(spark, str(tmp_path / "t"))
    sync.run_sync(spark, rows, table, LIST, NOW, order=["turn"])
    assert values(table.read(), "id", "name") == [("1", "a"), ("2", "b")]


def test_no_commit_without_a_change(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    rows = source(spark, [("1", "a", 1)])
    sync.run_sync(spark, rows, table, LIST, OLD)
    assert sync.run_sync(spark, rows, table, LIST, NOW) == sync.SyncReport(0, 1, 0)
    assert table.version() == 1 and len(list((tmp_path / "t" / "data").iterdir())) == 1


def test_replaced_keys_stay_unique(spark):
    old = source(spark, [("1", "a", 1), ("2", "b", 2), (None, "n", 1), (None, "m", 1)])
    new = source(spark, [("2", "x", 9), ("2", "y", 1), ("A", "c", 3), ("a", "d", 3)])
    got = diff.replace_into(old, new, "id")
    assert values(got, "id", "name") == [(None, "m"), (None, "n"), ("1", "a"), ("2", "y"), ("A", "c"), ("a", "d")]
    assert diff.replace_into(old, new, "id", "ci").count() == 5
    assert values(diff.missing_keys(new, source(spark, [("a ", "q", 1)]), "id", "ci"), "id") == [("2",), ("2",)]


def test_text_is_stored_leniently(spark):
    df = spark.createDataFrame([("12 pz", "2.5", "x", 2.7, "05/03/14"), (None, "99999999999", "1,5", -2.5, "junk")], "a string, b string, c string, d double, e string")
    got = diff.conform(df, T.StructType.fromDDL("a int, b int, c decimal(6,2), d int, e date")).collect()
    assert [tuple(map(str, r)) for r in got] == [
        ("12", "3", "0.00", "3", "2014-03-05"), ("None", "2147483647", "1.50", "-3", "None"),
    ]


def test_expire_keeps_the_latest(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for n in (1, 2, 3, 4):
        table.overwrite(spark.range(n))
    table.expire(keep=2)
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2
    assert table.version() == 4 and table.read().count() == 4


def test_no_version_yet(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "none"))
    assert table.version() == 0 and table.note() == ""
    assert table.read(LIST.schema()).count() == 0
    with pytest.raises(FileNotFoundError):
        table.read()


def test_commits_know_rows_and_ranges(spark, tmp_path):
    """Counts and preflight ask the commit: they still work where the data cannot be read."""
    from feedweave.operators import registry

    table, none = VersionedTable(spark, str(tmp_path / "t")), VersionedTable(spark, str(tmp_path / "none"))
    sync.run_sync(spark, source(spark, [(str(i), "a", i) for i in range(12)]), table, LIST, OLD)
    assert (table.rows(), table.statistics()["ranges"]) == (12, {"id": ["0", "9"]})
    sync.run_sync(spark, source(spark, []), table, LIST, NOW)
    assert (table.rows(), table.rows(1), none.rows()) == (0, 12, 0)
    (tmp_path / "t" / "data").rename(tmp_path / "t" / "elsewhere")
    assert registry.empty_tables({"t": table, "none": none, "df": spark.range(1)}) == ["t", "none"]
    counts = registry.table_counts({"t": table, "df": spark.range(3)})
    assert values(counts) == [("df", 3, True), ("t", 0, False)] and "FileScan" not in plan_of(counts)
    (tmp_path / "t" / "elsewhere").rename(tmp_path / "t" / "data")
    commit = tmp_path / "t" / "commits" / "00000002"
    commit.write_text("\n".join(commit.read_text().split("\n")[:2]) + "\n")  # as written before counts were kept
    (tmp_path / "t" / "commits" / ".00000002.crc").unlink(missing_ok=True)
    assert table.rows() is None and registry.empty_tables({"t": table}) == ["t"]


def test_target_schemas():
    assert FULL.schema()["enduser_price"].dataType.simpleString() == "float"
    assert RESTRICTED.schema().names[-1] == "b2b_updated"
    assert CLOTHING.schema()["PREZZO"].dataType.simpleString() == "decimal(12,2)"


def run_stream(spark, inbox, table, checkpoint):
    arriving = spark.readStream.schema("id string, name string, qty long").parquet(inbox)
    query = sync_stream(arriving, table, LIST, checkpoint, NOW)
    assert query.awaitTermination(120)
    assert query.exception() is None


def test_stream_applies_each_file_once(spark, tmp_path):
    inbox, checkpoint, table = str(tmp_path / "in"), str(tmp_path / "cp"), VersionedTable(spark, str(tmp_path / "t"))
    source(spark, [("1", "a", 1), ("2", "b", 2)]).coalesce(1).write.mode("append").parquet(inbox)
    run_stream(spark, inbox, table, checkpoint)
    source(spark, [("2", "x", 2), ("3", "c", 3)]).coalesce(1).write.mode("append").parquet(inbox)
    run_stream(spark, inbox, table, checkpoint)
    assert values(table.read(), "id", "name") == [("1", "a"), ("2", "x"), ("3", "c")]
    version = table.version()
    run_stream(spark, inbox, table, checkpoint)
    assert table.version() == version


def test_replayed_batch_is_skipped_but_a_new_stream_is_not(spark, tmp_path):
    inbox, checkpoint, table = str(tmp_path / "in"), tmp_path / "cp", VersionedTable(spark, str(tmp_path / "t"))
    source(spark, [("1", "a", 1)]).coalesce(1).write.parquet(inbox)
    run_stream(spark, inbox, table, str(checkpoint))
    # As if the job had died between the table's commit and the stream's.
    for file in (checkpoint / "commits").iterdir():
        file.unlink()
    run_stream(spark, inbox, table, str(checkpoint))
    assert table.version() == 1
    run_stream(spark, inbox, table, str(tmp_path / "fresh"))
    assert table.version() == 2 and table.read().count() == 1


def test_stream_over_a_file_and_over_a_folder(spark, tmp_path):
    from suite.syncing import files_of

    rows = source(spark, [(str(i), "a", i) for i in range(20)])
    rows.repartition(4).write.parquet(str(tmp_path / "many" / "list.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "parts"))
    part = next((tmp_path / "parts").glob("*.parquet"))
    (tmp_path / "single").mkdir()
    part.rename(tmp_path / "single" / "list.parquet")
    for kind in ("many", "single"):
        table = VersionedTable(spark, str(tmp_path / f"t-{kind}"))
        arriving = files_of(spark, str(tmp_path / kind / "list.parquet"), rows.schema)
        query = sync_stream(arriving, table, LIST, str(tmp_path / f"cp-{kind}"), NOW, order=["qty"])
        assert query.awaitTermination(120) and query.exception() is None
        assert table.read().count() == 20, kind


def test_no_full_rows_are_shuffled_twice(spark):
    """Deduplication and the full-outer join share the partitioning by key."""
    big = spark.range(1000).select(F.col("id").cast("string").alias("id"), F.lit("n").alias("name"), F.col("id").alias("qty"))
    plan = plan_of(sync.classify(big, stored(spark, []), LIST, sync.stamp(NOW)))
    assert plan.count("Exchange hashpartitioning") == 2

"""Registry, schedule, validation, profiling and enrichment."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, values
from feedweave.operators import catalogue, profile, registry, schedule


def minutes(spark, pattern):
    return spark.range(1).select(registry.due_minutes(F.lit(pattern)).alias("m")).first()["m"]


def test_patterns(spark):
    assert minutes(spark, "*1:00") == ["01:00", "11:00", "21:00"]
    assert minutes(spark, "2*:00") == ["20:00", "21:00", "22:00", "23:00"]
    assert minutes(spark, "*4:00") == ["04:00", "14:00"]
    assert minutes(spark, "12:3*") == [f"12:3{i}" for i in range(10)]
    assert len(minutes(spark, "**:**")) == 1440
    assert minutes(spark, "25:00") == []


def test_matching_agrees_with_expanding(spark):
    times = spark.range(1440).selectExpr("format_string('%02d:%02d', int(id / 60), int(id % 60)) AS t")
    for pattern in ("*1:00", "0*:3*", "12:**", "**:*5", "2*:59"):
        matched = [t for (t,) in values(times.filter(registry.matches(F.col("t"), F.lit(pattern))))]
        assert matched == minutes(spark, pattern)


def test_schedule_and_due(spark):
    df = spark.createDataFrame([("a", '["*1:00","01:0*"]'), ("b", None), ("c", '["*1:00"]')], "local_name string, sync_time string")
    got = values(registry.schedule(df))
    assert len([r for r in got if r[0] == "a"]) == 12 and len([r for r in got if r[0] == "c"]) == 3
    assert values(registry.due(df, "11:00"), "local_name") == [("a",), ("c",)]
    assert values(registry.due(df, "01:07"), "local_name") == [("a",)]


def test_minutes_are_not_moved(spark):
    rows = [("a", '["12:3*","12:*5"]'), ("a", '["12:35"]'), (None, '["00:00"]'), ("b", "[]"), ("c", "no list"), ("d", '["1","24:00",null]'), ("e", '["23:59"]')]
    df = registry.schedule(spark.createDataFrame(rows, "local_name string, sync_time string"))
    assert values(df) == [(None, "00:00"), *[("a", t) for t in sorted({f"12:3{i}" for i in range(10)} | {f"12:{i}5" for i in range(6)})], ("e", "23:59")]
    plan = plan_of(df)
    assert plan.index("Generate") < plan.index("Exchange")  # they are made behind the last exchange


def test_patterns_are_parsed_once_for_a_day(spark):
    df = spark.createDataFrame([(["12:3*", "0*:00"],), ([None, "x"],), (None,)], "p array<string>").select(schedule.day_bits(F.col("p")).alias("d"))
    assert "aggregate(transform(" not in plan_of(df)
    nothing = [0] * 24
    assert [r["d"] for r in df.collect()] == [[*[1] * 10, 0, 0, 0x3FF << 30, *[0] * 11], nothing, [None] * 24]


def agreeing(patterns):
    """The minutes of a list of patterns, each minute tried."""
    times = [f"{m // 60:02d}:{m % 60:02d}" for m in range(1440)]
    digits = [p.replace(":", "") for p in patterns]
    return [t for t in times if any(len(d) >= 4 and all(a in ("*", b) for a, b in zip(d, t.replace(":", ""))) for d in digits)]


def test_bitmaps_hold_the_minutes_that_patterns_stand_for(spark):
    import json
    import random

    rng = random.Random(2)
    rows = [(f"r{k}", json.dumps(["".join(rng.choice("0123456789**") if i != 2 else ":" for i in range(5)) for _ in range(rng.randrange(5))])) for k in range(60)]
    rows += [("all", '["**:**"]'), ("one", '["23:59"]'), ("zero", '["00:00"]'), ("odd", '["12:3", "x", "", "2a:00", "**:6*", "07:0512"]'), ("none", None), ("two", '["1*:00"]'), ("two", '["09:59", "1*:00"]')]
    wanted = {}
    for name, patterns in rows:
        wanted.setdefault(name, set()).update(agreeing(json.loads(patterns or "[]")))
    days = schedule.schedules(spark.createDataFrame(rows, "local_name string, sync_time string").repartition(3))
    hours = F.col("hours")
    got = {r["local_name"]: r for r in days.select(
        "local_name", "hours", schedule.minutes(hours).alias("n"), schedule.first_time(hours).alias("first"), schedule.last_time(hours).alias("last"),
        *[schedule.next_time(hours, t).alias(f"next {t}") for t in ("00:00", "07:05", "12:35", "23:59")],
        *[schedule.is_due(hours, t).alias(f"due {t}") for t in ("00:00", "07:05", "23:59")],
    ).collect()}
    assert set(got) == {name for name, times in wanted.items() if times}
    for name, row in got.items():
        times = sorted(wanted[name])
        assert [f"{h:02d}:{m:02d}" for h in range(24) for m in range(60) if row["hours"][h] >> m & 1] == times
        assert (row["n"], row["first"], row["last"]) == (len(times), times[0], times[-1])
        for t in ("00:00", "07:05", "12:35", "23:59"):
            assert row[f"next {t}"] == min((x for x in times if x > t), default=times[0]), (name, t)
        for t in ("00:00", "07:05", "23:59"):
            assert row[f"due {t}"] == (t in times)
    from collections import Counter

    assert {tuple(r) for r in schedule.load(days).collect()} == set(Counter(t for times in wanted.values() for t in times).items())
    assert "Generate" not in plan_of(days) and "Join" not in plan_of(days)
    with pytest.raises(ValueError):
        schedule.is_due(hours, "24:00")


@pytest.mark.parametrize("kind, good, bad", [
    ("host", ["10.0.0.1", "a.example.com", "x"], ["a_b", "-x", "a..b", ""]),
    ("path", ["/a", "/a/b.csv", "/a-b/c_d"], ["a", "/a b", "/", "/a/", ""]),
    ("integer", ["1", "-2.5", "1e3", " 7"], ["x", "", "1x"]),
    ("string", ["x", "\n"], [""]),
    ("yes/no", ["yes", "no"], ["YES", ""]),
    ("time", ["*1:00", "2*:**", "09:59"], ["24:00", "9:00", "12:60", "1*:6*"]),
])
def test_rules(spark, kind, good, bad):
    df = spark.createDataFrame([(v,) for v in [*good, *bad, None]], "v string")
    assert {v for (v,) in values(df.filter(registry.valid(F.col("v"), kind)))} == set(good)


def test_violations_duplicates_orphans(spark):
    df = spark.createDataFrame([(1, "h", 1), (2, "b_d", 2), (3, "h", None)], "id long, host string, service_id long")
    services = spark.createDataFrame([(1,)], "id long")
    assert values(registry.violations(df, "id", {"host": "host"})) == [(2, "host", "host", "b_d")]
    assert values(registry.duplicates(df, "host")) == [("h", 2)]
    assert values(registry.orphans(df, "service_id", services), "id") == [(2,), (3,)]


def test_preflight(spark):
    one, none = spark.range(1), spark.range(0)
    assert registry.empty_tables({"one": one, "none": none}) == ["none"]
    assert values(registry.table_counts({"one": one, "none": none})) == [("none", 0, False), ("one", 1, True)]
    resources = spark.createDataFrame([("a", True), ("b", False)], "local_name string, locked boolean")
    needed = spark.createDataFrame([("a",), ("b",), ("unregistered",)], "local_name string")
    assert values(registry.locked_tables(needed, resources)) == [("a",)]


def test_profile(spark):
    df = spark.createDataFrame([("1", "1,5", "05/03/14", "x" * 300, ""), ("-2", "3", "2014-03-05", "y", " ")], "i string, f string, d string, t string, e string")
    got = {r["column_name"]: r["proposed_type"] for r in profile.profile_columns(df, df.columns).collect()}
    assert got == {"i": "Integer", "f": "Float", "d": "Date", "t": "Description", "e": "Description"}
    sample = profile.column_sample(df.withColumn("row", F.monotonically_increasing_id()), ["i"], ["row"], 1)
    assert values(sample, "column_name", "value") == [("i", "1")]


def test_field_counts(spark):
    lines = spark.createDataFrame([('a;"b;c";d',), ("1;2;3",), ("x,y",)], "value string")
    got = {(d, n): c for d, n, c in values(profile.field_counts(lines))}
    assert got[(";", 3)] == 2 and got[(";", 1)] == 1 and got[(",", 2)] == 1


def test_header_names():
    assert profile.header_names(' a ;"b;c";d', ";") == ["a", "b;c", "d"]
    with pytest.raises(ValueError):
        profile.header_names("a;a", ";")


def test_first_hit(spark):
    products = spark.createDataFrame(
        [("p1", "E1", "n1", "A/B"), ("p2", "E9", "n2", "A/B"), ("p3", "", "n3", "B/A"), ("p4", None, "", "A"), ("p5", "E5", "n5", None), ("p6", "E6", "n2", "C")],
        "id string, EAN string, part_number string, manufacturer string",
    )
    entries = spark.createDataFrame(
        [("E1", "x", "x", "1", "by ean"), ("", "n1", "A", "1", "not reached"), ("", "n2", "B", "1", "by B"), ("", "n2", "C", "1", "by C"),
         ("", "n3", "A", "1", "second alias"), ("", "n3", "B", "-1", "invalid"), ("E5", "n5", "A", "-1", "invalid"), ("", "", "A", "1", "blank")],
        "ean string, prod_id string, vendor string, code string, path string",
    )
    got = catalogue.first_hit(products, entries, ["path"], ["path"])
    assert values(got, "id", "found_by", "path") == [
        ("p1", 0, "by ean"), ("p2", 2, "by B"), ("p3", 2, "second alias"), ("p4", None, None), ("p5", None, None), ("p6", 1, "by C"),
    ]
    rate = catalogue.hit_rate(got).first()
    assert (rate["found"], rate["looked_up"]) == (4, 6) and abs(rate["percent"] - 66.667) < 0.01


def test_missing_entries_is_an_anti_join(spark):
    products = spark.createDataFrame([("p1", "m", "", ""), ("p2", "x", "", "")], "id string, manufacturer_id string, EAN string, part_number string")
    makers = spark.createDataFrame([("m", "A/B")], "cod string, des string")
    entries = spark.createDataFrame([("p9",)], "id string")
    got = catalogue.missing_entries(products, makers, entries)
    assert "LeftAnti" in plan_of(got)
    assert values(got, "id", "manufacturer") == [("p1", "A/B"), ("p2", None)]
    assert values(catalogue.aliases(got), "id", "alias", "position") == [("p1", "A", 0), ("p1", "B", 1)]


def test_documents(spark):
    xml = '<C><Product Code="1" HighPic="h" LowPic="l" ThumbPic="t"><SummaryDescription><LongSummaryDescription>long &amp; more</LongSummaryDescription><ShortSummaryDescription>s</ShortSummaryDescription></SummaryDescription></Product></C>'
    df = spark.createDataFrame([(1, xml), (2, "<broken")], "id long, xml string")
    assert values(catalogue.from_document(df)) == [(1, "1", "h", "l", "t", "long & more", "s"), (2, None, None, None, None, None, None)]

"""Registered schemas, readers, load rules and reports."""

import gzip
import json
import zipfile
from datetime import date
from decimal import Decimal

import pytest

from conftest import plan_of, values
from feedweave.sources import load
from feedweave.sources.reader import clean_lines, line_window, parse_lines, raw_lines, read_feed, read_lines
from feedweave.sources.records import open_quote, whole_records
from feedweave.sources.schema import FeedSpec, registered_columns
from feedweave.sources.versioned import VersionedTable

SPEC = FeedSpec("list", (("k", "String"), ("n", "Integer"), ("x", "Float"), ("d", "Date"), ("t", "Description")), keys=("k",))
TEXT = 'a;1;1,5;05/03/14;one\n\na;2;2,5;06/03/14;two\nb;x;y;z;"q;""r"""\nc;1\nd;1;1;;t;extra\n'


def spec(**changes):
    return FeedSpec(SPEC.name, SPEC.columns, **{"keys": ("k",), **changes})


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_spec_from_record():
    record = {
        "local_name": "f", "path": "/f.zip", "delimiter": "|", "enclosure": "'", "csv_header_row": True, "empty_lines": 2,
        "conversion_rule": "zip → csv", "indices": '["a"]', "columns": json.dumps({"name": ["a", "b"], "type": [1, "3"]}),
    }
    got = FeedSpec.from_record(record)
    assert got.columns == (("a", "String"), ("b", "Float")) and got.keys == ("a",) and got.conversion == ("zip", "csv")
    assert (got.header, got.skip_lines, got.delimiter, got.enclosure) == (True, 2, "|", "'")
    assert got.schema().simpleString() == "struct<a:string,b:decimal(12,2)>"
    assert got.multi_line and not FeedSpec.from_record({**record, "multi_line": False}).multi_line


def test_spec_is_checked():
    with pytest.raises(ValueError):
        FeedSpec("f", (("a", "Text"),))
    with pytest.raises(ValueError):
        FeedSpec("f", (("a", "String"), ("a", "String")))
    with pytest.raises(ValueError):
        FeedSpec("f", (("a", "String"),), keys=("b",))


def test_registered_columns(spark):
    df = spark.createDataFrame([("f", '{"name":["a","b"],"type":[1,9]}', '["b"]'), ("g", None, None)], "local_name string, columns string, indices string")
    assert values(registered_columns(df)) == [("f", 0, "a", "String", False), ("f", 1, "b", None, True)]


def expect(rows):
    assert values(rows, "k", "n", "x", "d", "t") == [
        ("a", 1, Decimal("1.50"), date(2014, 3, 5), "one"), ("b", 0, Decimal("0.00"), date(1970, 1, 1), 'q;"r"'),
    ]


def test_plain_file(spark, tmp_path):
    raw = read_feed(spark, spec(), write(tmp_path / "f.csv", "﻿" + TEXT))
    expect(load.good_rows(raw, spec()))
    reasons = load.with_reasons(raw, spec())
    assert values(reasons.filter("reject_reason IS NOT NULL"), "k", "reject_reason") == [("a", "duplicate"), ("c", "fields"), ("d", "fields")]
    assert values(load.load_counts(reasons)) == [(2, 3, True)]
    assert values(load.quarantine(raw, spec()), "k", "reject_reason") == [("a", "duplicate"), ("c", "fields"), ("d", "fields")]


def test_header_and_junk_lines(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "1.csv", "Price list\r\n\r\nk;n;x;d;t\r\n" + TEXT.replace("\n", "\r\n"))
    write(folder / "2.csv", "Price list\n\nk;n;x;d;t\nz;3;3;;last\n")
    got = load.good_rows(read_feed(spark, spec(header=True, skip_lines=2), str(folder)), spec())
    assert values(got, "k") == [("a",), ("b",), ("z",)]
    write(tmp_path / "h.csv", "k;n;x;d;t\n" + TEXT)
    expect(load.good_rows(read_feed(spark, spec(header=True), str(tmp_path / "h.csv")), spec()))


def test_junk_lines_are_dropped_once_per_file_whatever_the_split(spark, tmp_path):
    lines = "".join(f"k{i};{i};1;;t\n" for i in range(5000))
    path = write(tmp_path / "big.csv", "junk\njunk\n" + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        raw = read_feed(spark, spec(skip_lines=2, multi_line=False), path)
        assert raw.rdd.getNumPartitions() > 4
        assert raw.count() == 5000
        doubled = write(tmp_path / "twice.csv", lines + lines.replace(";t\n", ";second\n"))
        for reader in (spec(), spec(skip_lines=1), spec(multi_line=False), spec(skip_lines=1, multi_line=False)):
            kept = load.good_rows(read_feed(spark, reader, doubled), spec())
            # The skipped first line leaves its key to the second half of the file.
            assert kept.filter("t = 'second'").count() == reader.skip_lines
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_multi_line_records(spark, tmp_path):
    raw = read_feed(spark, spec(multi_line=True), write(tmp_path / "m.csv", 'a;1;1;;"two\nlines"\nb;2;2;;x\n'))
    assert values(load.good_rows(raw, spec()), "k", "t") == [("a", "two\nlines"), ("b", "x")]


MULTI = 'junk;"\na;1;1;;"two\nlines; ""x"""\nb;2;2;;x\nc;3;3;;"never\nclosed\n'


def test_records_over_lines_on_every_path(spark, tmp_path):
    """Line breaks in quotes stay in the record; a line with a quote that never closes is a reject, and reading goes on behind it."""
    path = write(tmp_path / "m.csv", MULTI)
    (tmp_path / "m.csv.gz").write_bytes(gzip.compress(MULTI.encode()))
    with zipfile.ZipFile(tmp_path / "m.zip", "w") as archive:
        archive.writestr("m.csv", MULTI)
    record = {
        "local_name": "f", "delimiter": ";", "enclosure": '"', "csv_header_row": False, "empty_lines": 1, "indices": '["k"]',
        "columns": json.dumps({"name": ["k", "n", "x", "d", "t"], "type": [1, 2, 3, 4, 5]}),
    }
    for file, rule in ((path, "csv"), (f"{path}.gz", "gz→csv"), (str(tmp_path / "m.zip"), "zip→csv")):
        registered = FeedSpec.from_record({**record, "path": file, "conversion_rule": rule})
        raw = read_feed(spark, registered)
        assert values(load.good_rows(raw, registered), "k", "t") == [("a", 'two\nlines; "x"'), ("b", "x")], file
        assert values(load.quarantine(raw, registered), "_bad_line") == [('c;3;3;;"never',), ("closed",)]
    single = spec(skip_lines=1, multi_line=False)
    raw = read_feed(spark, single, path)
    assert values(load.good_rows(raw, single), "k") == [("b",)]
    assert values(load.quarantine(raw, single), "reject_reason") == [("fields",)] * 4


def test_records_of_any_length_are_whole(spark, tmp_path):
    """A record of more than a megabyte ends at its closing quote; lines in it that look like records are none."""
    long = "\n".join(f"q{k};{k};1;;not a record\r, 漢" for k in range(120_000))
    path = write(tmp_path / "m.csv", f'a;1;1;;x\nb;2;2;;"{long}"\nc;3;3;;y\n')
    raw = read_feed(spark, spec(multi_line=True), path)
    got = {r["k"]: r["t"] for r in raw.collect()}
    assert got == {"a": "x", "b": long, "c": "y"} and raw.filter("_bad_line IS NOT NULL").count() == 0


def test_an_open_quote_does_not_take_the_rest_of_a_long_file(spark, tmp_path):
    rest = 'd;3;3;;say ""\ne";4;4;;"again\n' + "".join(f"r{k};1;1;;{'z' * 100}\n" for k in range(30_000))
    raw = read_feed(spark, spec(multi_line=True), write(tmp_path / "m.csv", 'a;1;1;;x\nc;3;3;;"never closed\n' + rest))
    bad = raw.filter("_bad_line IS NOT NULL").select("_row", "_bad_line").collect()
    assert sorted(tuple(r) for r in bad) == [(1, 'c;3;3;;"never closed'), (3, 'e";4;4;;"again')]
    good = raw.filter("_bad_line IS NULL").select("k").collect()
    assert {r["k"] for r in good} == {"a", "d", *(f"r{k}" for k in range(30_000))} and len(good) == 30_002


def records_in_turn(lines, delimiter, enclosure):
    """(number of the first line, record) by one pass, as a reader without tasks would find them."""
    import re

    opened = re.compile(open_quote(delimiter, enclosure))
    result, at = [], 0
    while at < len(lines):
        upto = at
        inside = bool(opened.match(lines[at].rstrip("\r\n")))
        while inside and upto + 1 < len(lines):
            upto += 1
            inside = bool(opened.match(enclosure + lines[upto].rstrip("\r\n")))
        upto = at if inside else upto
        result.append((at, "\n".join(lines[at:upto + 1])))
        at = upto + 1
    return result


def odd_lines(seed, n):
    import random

    rng = random.Random(seed)
    parts = ['"', '""', ";", "a", "b c", "", "\r", 'x"', '";"', ';"', '";', "é", ";plain;"]
    rare = seed % 3 == 0
    return ["".join(rng.choice(["a", ";", "b"] if rare and rng.random() < 0.97 else parts) for _ in range(rng.randrange(6))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(9))
def test_records_do_not_depend_on_the_cuts(spark, tmp_path, seed):
    """Files of lines that open, close and swap the quote state, read as a whole and in many splits."""
    folder = tmp_path / "in"
    folder.mkdir()
    expected = []
    for k, n in enumerate((700, 1, 130, 64)):
        lines = odd_lines(seed * 10 + k, n)
        if k == 0:
            lines[-1] = "a" if seed % 2 else 'a;"'
        (folder / f"{k}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8", newline="\n")
        expected += [(f"{k}.csv", record) for _, record in records_in_turn(lines, ";", '"')]
    for size in ("128m", "300"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            lines = raw_lines(spark, str(folder))
            assert size == "128m" or lines.rdd.getNumPartitions() >= 8
            got = whole_records(lines, ";", '"').collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        got = [(r["_file"].rsplit("/", 1)[-1], r["value"]) for r in sorted(got, key=lambda r: (r["_file"], r["_block"], r["_row"]))]
        assert got == sorted(expected, key=lambda r: r[0])


def test_records_over_lines_are_found_without_python(spark, tmp_path):
    raw = read_feed(spark, spec(), write(tmp_path / "m.csv", MULTI))
    assert not {"MapInPandas", "MapInArrow", "Python", "Arrow"} & set(plan_of(raw).replace("(", " ").split())


def test_a_quote_that_never_closes_costs_its_line_whatever_follows(spark, tmp_path):
    for n in (3, 30_000):
        lines = ['a;1;1;;x', 'b;2;2;;"never', *[f"k{i};1;1;;{'z' * 50}" for i in range(n)]]
        raw = read_feed(spark, spec(), write(tmp_path / f"{n}.csv", "\n".join(lines) + "\n"))
        assert values(raw.filter("_bad_line IS NOT NULL"), "_bad_line") == [('b;2;2;;"never',)]
        assert raw.count() == n + 2


def test_encodings_and_names_decide_the_path(spark, tmp_path):
    text = 'é;1;1;;"ü\nö"\nb;2;2;;x\n'
    for name, encoding in (("a.csv", "ISO-8859-1"), ("b.csv", "windows-1252"), ("c.csv", "UTF-16")):
        (tmp_path / name).write_bytes(text.encode(encoding))
        raw = read_feed(spark, spec(encoding=encoding), str(tmp_path / name))
        assert values(raw, "k", "t") == [("b", "x"), ("é", "ü\nö")], encoding
    (tmp_path / "packed").write_bytes(gzip.compress(text.encode()))
    raw = read_feed(spark, spec(conversion=("gz", "csv")), str(tmp_path / "packed"))
    assert values(raw, "k", "t") == [("b", "x"), ("é", "ü\nö")]


def test_open_quotes():
    import re

    opened = re.compile(open_quote(";", '"'))
    for line, expected in (
        ('a;"b', True), ('a;"b"', False), ('"a;""b"', False), ('a;"b"";c', True), ('a;5" disk;b', False), ('"', True), ('""', False),
        ('a;"b" tail;"c', True), ("", False), ('"""', True), ('a"b;c', False), (';;"x;y', True), ('"' + '""' * 5000 + '"', False),
    ):
        assert bool(opened.match(line)) == expected, line
    assert re.match(open_quote("|", "^"), "a|^b") and not re.match(open_quote("|", "^"), "a|^b^")


def zip_of(text, method, path, later=False):
    """A zip archive whose first entry holds the text; ``later`` writes it to a pipe, sizes behind the entry."""
    import io

    class Pipe(io.RawIOBase):
        def __init__(self):
            self.data = b""

        def writable(self):
            return True

        def write(self, data):
            self.data += bytes(data)
            return len(data)

    out = Pipe() if later else io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as archive:
        archive.writestr("f.csv", text)
        archive.writestr("other.csv", "zz;1;1;;no\n")
    path.write_bytes(out.data if later else out.getvalue())


def test_large_archives_come_in_stretches(spark, tmp_path, monkeypatch):
    """Files beyond a cell are read by Spark in many splits and unpacked in order, whatever their bytes."""
    import random

    from feedweave.sources import archives

    rng = random.Random(1)
    body = "".join(f"k{i};{i};1;;{rng.getrandbits(200):x}\n" for i in range(3000))
    folder = tmp_path / "in"
    folder.mkdir()
    zip_of(body, zipfile.ZIP_DEFLATED, folder / "a.zip")
    zip_of(body.replace("k", "s"), zipfile.ZIP_STORED, folder / "b.zip")
    zip_of(body.replace("k", "p"), zipfile.ZIP_DEFLATED, folder / "c.zip", later=True)
    zip_of(body[:60], zipfile.ZIP_DEFLATED, folder / "small.zip")
    monkeypatch.setattr(archives, "CELL_BYTES", 1000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        files = archives.packed_files(spark, str(folder))
        assert files.count() > 100
        raw = read_feed(spark, spec(conversion=("zip", "csv"), multi_line=False), str(folder))
        got = sorted((r["k"], r["t"]) for r in raw.collect())
        wanted = [tuple(line.split(";"))[::4] for text in (body, body.replace("k", "s"), body.replace("k", "p"), body[:60]) for line in text.splitlines()]
        assert [g for g in got if g[1] is not None] == sorted(w for w in wanted if len(w) == 2)
        (tmp_path / "x").mkdir()
        for name, end in (("n", b"\n"), ("n2", b"\n\n"), ("r", b"\r"), ("z", b"\x00")):  # bytes of a file come back as they were
            (tmp_path / "x" / name).write_bytes(b"\n" + body.encode() + end)
        back = {}
        for r in archives.packed_files(spark, str(tmp_path / "x")).collect():
            back.setdefault(r["path"].rsplit("/", 1)[-1], []).append((bytes(r["content"]), r["length"]))
        for name, parts in back.items():
            assert b"".join(archives._Joined._whole(iter(parts))) == (tmp_path / "x" / name).read_bytes()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_compressed_files_under_other_encodings_and_sizes(spark, tmp_path, monkeypatch):
    from feedweave.sources import archives

    monkeypatch.setattr(archives, "CELL_BYTES", 10)
    (tmp_path / "f.csv.gz").write_bytes(gzip.compress(TEXT.encode("UTF-16")))
    expect(load.good_rows(read_feed(spark, spec(conversion=("gz", "csv"), encoding="UTF-16"), str(tmp_path / "f.csv.gz")), spec()))
    (tmp_path / "g.bin").write_bytes(gzip.compress(TEXT.encode()) * 1 + gzip.compress(b"z;9;9;;end\n"))
    raw = read_feed(spark, spec(conversion=("gz", "csv")), str(tmp_path / "g.bin"))
    assert raw.filter("k = 'z'").count() == 1


class Handed:
    """Files of which only the function that tasks run is wanted."""

    columns = ("path", "content", "length")

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_archives_are_unpacked_a_cell_at_a_time(tmp_path):
    import tracemalloc

    import pyarrow as pa
    from feedweave.sources import archives

    zip_of("one line of a feed;1;2\n" * 4000, zipfile.ZIP_DEFLATED, tmp_path / "f.zip")
    data = (tmp_path / "f.zip").read_bytes()
    n = 300
    batch = pa.RecordBatch.from_arrays([pa.array([f"f{k}" for k in range(n)]), pa.array([data] * n), pa.array([len(data)] * n)], list(Handed.columns))
    unpack = archives.archive_lines(Handed(), ["zip"])
    tracemalloc.start()
    try:
        sizes = [part.num_rows for part in unpack(iter([batch]))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(sizes) == 4000 * n and max(sizes) <= archives.BATCH_LINES
    assert peak < 8e6


def test_texts_are_packed_a_few_at_a_time():
    import pyarrow as pa
    from suite import loading

    texts = pa.RecordBatch.from_arrays([pa.array([str(k) for k in range(1000)]), pa.array(["text"] * 1000)], ["path", "text"])
    parts = list(loading.archives_of(Handed(), loading.zipped)(iter([texts])))
    assert max(part.num_rows for part in parts) <= 64
    assert [path for part in parts for path in part.column(0).to_pylist()] == [str(k) for k in range(1000)]


def test_damaged_archives_fail(spark, tmp_path):
    zip_of(TEXT * 50, zipfile.ZIP_DEFLATED, tmp_path / "f.zip")
    data = bytearray((tmp_path / "f.zip").read_bytes())
    for name, broken in (("cut", data[:90]), ("none", b"no archive at all, but long enough to be one"), ("sum", data[:14] + b"\0\0\0\0" + data[18:])):
        (tmp_path / name).write_bytes(bytes(broken))
        with pytest.raises(Exception):
            read_feed(spark, spec(conversion=("zip", "csv"), multi_line=False), str(tmp_path / name)).count()


def test_packed_files(spark, tmp_path):
    (tmp_path / "f.csv.gz").write_bytes(gzip.compress(TEXT.encode()))
    expect(load.good_rows(read_feed(spark, spec(conversion=("gz", "csv")), str(tmp_path / "f.csv.gz")), spec()))
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as archive:
        archive.writestr("f.csv", "k;n;x;d;t\n" + TEXT)
        archive.writestr("other.csv", "zz;1;1;;no\n")
    expect(load.good_rows(read_feed(spark, spec(conversion=("zip", "csv"), header=True), str(tmp_path / "f.zip")), spec()))
    with zipfile.ZipFile(tmp_path / "g.zip", "w") as archive:
        archive.writestr("f.csv.gz", gzip.compress(TEXT.encode()))
    expect(load.good_rows(read_feed(spark, spec(conversion=("zip", "gz", "csv")), str(tmp_path / "g.zip")), spec()))


def test_spreadsheets_are_refused(spark):
    with pytest.raises(ValueError):
        read_feed(spark, spec(conversion=("zip", "xls", "csv")), "/nowhere")


def test_line_window(spark, tmp_path):
    path = write(tmp_path / "w.txt", "one\n\ntwo\r\nthree\nfour\n")
    assert values(read_lines(spark, path), "value") == [("four",), ("one",), ("three",), ("two",)]
    raw = spark.read.text(path).selectExpr("'f' AS _file", "0L AS _block", "monotonically_increasing_id() AS _row", "value")
    assert [r["value"] for r in line_window(raw, 1, 3).collect()] == ["two", "three"]
    assert clean_lines(raw).count() == 4


def test_line_window_orders_little_of_a_long_split(spark, monkeypatch):
    """Only the stretches that the window meets are ordered, however the lines lie and their numbers are spread."""
    from feedweave.sources import reader
    from pyspark.sql import functions as F

    monkeypatch.setattr(reader, "STRETCHES", 50)
    numbers = [*range(0, 5000, 3), *range(2**60, 2**60 + 4000)]
    rows = [("f", 0, k, f"a{k}") for k in numbers] + [("f", 7, None, "none")] + [("f", 7, k, "" if k == 3 else f"b{k}") for k in range(2000)]
    lines = spark.createDataFrame(rows, "_file string, _block long, _row long, value string").repartition(3, F.hash("value"))
    wanted = [row[3] for row in rows]
    kept, write = [], reader._kept
    monkeypatch.setattr(reader, "_kept", lambda spark, parts: kept.append(write(spark, parts)) or kept[-1])
    for start, n in ((0, 4), (5, 25), (1660, 20), (len(numbers) - 2, 6), (len(numbers) + 700, 300), (len(rows) - 3, 10), (len(rows), 5)):
        got = sorted(r["value"] for r in line_window(lines, start, n).collect())
        assert got == sorted(v for v in wanted[start:start + n] if v)
    assert kept[-5].agg(F.sum("_lines")).first()[0] < 600


def test_case_blind_first_wins(spark):
    lines = spark.createDataFrame([("f", 0, 1, "B;1;1;;x"), ("f", 0, 2, "b ;2;2;;y"), ("e", 9, 3, "b;3;3;;z")], "_file string, _block long, _row long, value string")
    raw = parse_lines(lines, spec())
    assert values(load.good_rows(raw, spec(), "ci"), "n") == [(3,)]
    assert values(load.good_rows(raw, spec()), "n") == [(1,), (3,)]


def test_rejects_do_not_gather_by_key(spark):
    """Keys are counted, one row per task; what occurs once moves no row."""
    lines = spark.range(2000).selectExpr("'f' AS _file", "0L AS _block", "id AS _row", "concat('same;', id, ';1;;x') AS value")
    reasons = load.with_reasons(parse_lines(lines, spec()), spec())
    assert "Window" not in plan_of(reasons) and plan_of(reasons).count("Exchange hashpartitioning") == 1
    assert values(load.load_counts(reasons)) == [(1, 1999, True)]


def test_nothing_is_left_behind_by_a_load(spark, tmp_path):
    warehouse = str(tmp_path / "w")
    path = write(tmp_path / "f.csv", TEXT)
    for _ in range(4):
        load.load_feed(spark, spec(), warehouse, path, transform=lambda df: df.filter("n = 1"))
    load.load_feed(spark, spec(), warehouse, write(tmp_path / "bad.csv", "x\n"))
    assert len(list((tmp_path / "w" / "list" / "data").iterdir())) == 2
    assert len(list((tmp_path / "w" / "list_rejected" / "data").iterdir())) == 2


def test_statement_after_import(spark, tmp_path):
    after = spec(after_import="SELECT k, n + 1 AS n FROM {list} WHERE n > 0")
    load.load_feed(spark, after, str(tmp_path / "w"), write(tmp_path / "f.csv", TEXT))
    assert values(VersionedTable(spark, str(tmp_path / "w" / "list")).read(), "k", "n") == [("a", 2)]


def test_spec_from_header():
    got = FeedSpec.from_header("f", 'code ;"the; price"; day', {"day": "Date"}, keys=("code",))
    assert got.columns == (("code", "String"), ("the; price", "String"), ("day", "Date")) and got.header
    with pytest.raises(ValueError):
        FeedSpec.from_header("f", "a;a")


def test_load_replaces_and_keeps_rejects(spark, tmp_path):
    warehouse = str(tmp_path / "w")
    report = load.load_feed(spark, spec(), warehouse, write(tmp_path / "f.csv", TEXT))
    assert (report.completed, report.missed, report.success) == (2, 3, True)
    table = VersionedTable(spark, f"{warehouse}/list")
    expect(table.read())
    assert VersionedTable(spark, f"{warehouse}/list_rejected").read().count() == 3
    failed = load.load_feed(spark, spec(), warehouse, write(tmp_path / "bad.csv", "x\ny\n"))
    assert not failed.success and failed.missed == 2
    expect(table.read())
    load.load_feed(spark, spec(), warehouse, str(tmp_path / "f.csv"), transform=lambda df: df.filter("n = 1"))
    assert table.read().count() == 1


def test_load_all_due_and_named(spark, tmp_path):
    for name in ("one", "two"):
        write(tmp_path / f"{name}.csv", "a;1\n")
    columns, row = '{"name":["k","n"],"type":[1,2]}', ("/{0}.csv", 1, "csv", ";", '"', 0, False, '["k"]')
    def resource(i, name, locked, sync_time):
        return (i, True, locked, row[0].format(name), name, *row[1:], columns, sync_time)
    broken = (*resource(5, "broken", False, None)[:11], None, "{", None)
    resources = spark.createDataFrame(
        [resource(1, "one", False, '["*1:00"]'), resource(2, "two", False, None), resource(3, "three", True, None), resource(4, "gone", False, '["01:0*"]'), broken],
        "id long, active boolean, locked boolean, path string, local_name string, source_id long, conversion_rule string, delimiter string, enclosure string, empty_lines int, csv_header_row boolean, indices string, columns string, sync_time string",
    )
    sources = spark.createDataFrame([(1, "s", "h", 1)], "id long, name string, host string, service_id long")
    services = spark.createDataFrame([(1, "local", "Local", None)], "id long, service string, name string, port int")
    def run(**options):
        reports = load.load_due(spark, resources, sources, services, str(tmp_path / "w"), root=str(tmp_path), **options)
        return {r.feed: r.success for r in reports}
    assert run() == {"one": True, "two": True, "gone": False, "broken": False}
    assert run(which="auto", at="11:00") == {"one": True}
    assert run(which="two") == {"two": True}
    with pytest.raises(ValueError):
        run(which="auto")

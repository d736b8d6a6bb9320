"""WARC archives: round trips, files cut anywhere, records of any order, payloads that hold records."""

from __future__ import annotations

import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedweave.llm import warc
from feedweave.session import scratch_dir

DATE = "2026-01-01T00:00:00Z"
SCHEMA = "page_id long, url string, html string, record_id int, payload string, digest int, first int, n int"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def odd_pages():
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:x>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    texts = [
        "<p>one</p>", "<p>one</p>", None, "", "é\r\n\r\nü\x00 end\r\n", "\r\n\r\n", inner, "x" + inner + inner, "WARC/1.1\r\n", "a" * 300_000,
        "ends WARC/1.1\r\nContent-Length: 1000000\r\n\r\n", "<p>one</p>",
    ]
    rows = [(40 - k, None if k == 3 else f"http://h/{k}?a b\r\nX: y é", text, 1, "p", 2, 3, 4) for k, text in enumerate(texts)]
    rows += [rows[0], rows[0], (None, None, "<p>one</p>", 1, "p", 2, 3, 4), (None, "u", None, 1, "p", 2, 3, 4), (7, "u", "other", 1, "p", 2, 3, 4)]
    return rows


def expected(rows, least=0):
    first = {}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1] is not None, rows[k][1] or ""))
    result = []
    for k in order:
        page, _, text = rows[k][:3]
        size = len((text or "").encode())
        if size >= least and (text or "") in first:
            result.append((page, size, digest(text), "revisit", first[text or ""]))
        else:
            first.setdefault(text or "", page)
            result.append((page, size, digest(text), "response", None))
    return sorted(result, key=repr)


def read_back(spark, path):
    found = warc.resolved(warc.captures(warc.records(spark, path)))
    rows = found.select(F.col("page_id").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long")).collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("least, compression, split", [(0, "none", None), (11, "none", None), (0, "gzip", None), (0, "none", "700")])
def test_round_trip_of_odd_pages(spark, least, compression, split):
    pages = spark.createDataFrame(odd_pages(), SCHEMA).repartition(3)
    path = scratch_dir(spark, "warc-test")
    warc.write(pages, path, DATE, least_bytes=least, compression=compression)
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got, wanted = read_back(spark, path), expected(odd_pages(), least)
        assert (set(got) - set(wanted), set(wanted) - set(got)) == (set(), set())
        assert got == wanted
        payloads = warc.captures(warc.records(spark, path)).filter("response.record_type = 'response'").select("response.payload").collect()
        assert {bytes(r[0]) for r in payloads} == {(r[2] or "").encode() for r in odd_pages()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_are_valid_warc(spark):
    """A plain reader that follows the lengths, as other tools do."""
    path = Path(scratch_dir(spark, "warc-test").removeprefix("file:"))
    warc.write(spark.createDataFrame(odd_pages(), SCHEMA), str(path), DATE)
    kinds = []
    for file in path.glob("part-*"):
        data = file.read_bytes()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            fields = dict(line.split(": ", 1) for line in lines[1:])
            size = int(fields["Content-Length"])
            assert rest[size:size + 4] == b"\r\n\r\n"
            block, data = rest[:size], rest[size + 4:]
            kinds.append(fields["WARC-Type"])
            assert {"WARC-Record-ID", "WARC-Date", "Content-Type"} <= set(fields)
            if fields["WARC-Type"] == "response":
                body = block.partition(b"\r\n\r\n")[2]
                assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
            if fields["WARC-Type"] == "revisit":
                assert block.endswith(b"\r\n\r\n") and fields["WARC-Refers-To"]
    n = len(odd_pages())
    assert len(kinds) == 3 * n and kinds.count("request") == kinds.count("metadata") == n


def record(kind, name, to=(), body="x", **more):
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"warc-record-id:  <{name}> ", *[f"WARC-Concurrent-To: <{t}>" for t in to]]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in more.items()] + [f"Content-Length: {len(body.encode())}"]
    return "\r\n".join(lines) + "\r\n\r\n" + body + "\r\n\r\n"


def test_transactions_in_any_direction(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes("".join([
        record("warcinfo", "info"),
        record("metadata", "m1", ["q1"], "k: v\r\nk: w\r\nother:x", Content_Type="application/warc-fields"),  # through the request
        record("request", "q1", ["r1"]),
        record("response", "r2", ["q2", "m2"]), record("metadata", "m3", ["m2"]),  # the response points; m3 in three steps
    ]).encode())
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r.encode()) for r in [
        record("response", "r1", body="HTTP/1.1 200 OK\r\n\r\nbody", Content_Type="application/http; msgtype=response"),
        record("request", "q2"), record("metadata", "m2", ["q2"]), record("request", "lost", ["nowhere"]), record("request", "q9", ["r1"]),
    ]))
    rows = {r["capture_id"]: r for r in warc.captures(warc.records(spark, str(tmp_path))).collect()}
    assert set(rows) == {"r1", "r2", "lost", "info"}
    assert (rows["r1"]["request"]["record_id"], rows["r1"]["metadata"]["fields"], rows["r1"]["n_requests"]) == ("q1", {"k": "v", "other": "x"}, 2)
    assert bytes(rows["r1"]["response"]["payload"]) == b"body" and rows["r1"]["response"]["payload_digest"] == digest("body")
    assert (rows["r2"]["request"]["record_id"], rows["r2"]["metadata"]["record_id"], rows["r2"]["n_metadata"]) == ("q2", "m2", 2)
    assert rows["lost"]["response"] is None and rows["lost"]["request"]["record_id"] == "lost"


def test_broken_records_do_not_hide_others(spark, tmp_path):
    good = record("response", "good", body="fine")
    endless = record("response", "bad").replace("Content-Length: 1", "Content-Length: 100000")
    short = record("response", "bad").replace("Content-Length: 1", "Content-Length: 0")
    (tmp_path / "a.warc").write_bytes((good + endless + good.replace("good", "good2") + "WARC/1.1\r\nnothing\r\n\r\n" + short + good.replace("good", "good3")).encode())
    rows = warc.records(spark, str(tmp_path)).collect()
    assert sorted(r["record_id"] for r in rows if not r["malformed"]) == ["good", "good2", "good3"]
    assert sum(r["malformed"] for r in rows) == 3


def test_empty_and_lost_originals(spark, tmp_path):
    path = scratch_dir(spark, "warc-test")
    warc.write(spark.createDataFrame([], SCHEMA), path, DATE)
    assert read_back(spark, path) == []
    (tmp_path / "a.warc").write_bytes(record("revisit", "v", WARC_Refers_To="<gone>", WARC_Payload_Digest="sha1:ABC").encode())
    assert read_back(spark, str(tmp_path)) == [(None, None, "ABC", "revisit", None)]

"""WARC archives: captures written as request, response or revisit, and metadata records, and read back.

Writing. Payloads are told apart by their SHA-1. Of equal payloads one capture is the response, the
others are revisits of it and hold no payload. Spark's text sink writes the files: its line separator
is the two line breaks that end a WARC record, so every file is a run of valid records, on any store
that Spark can write to, and tasks may be repeated.

Reading. Spark's text source cuts the files at the version lines, many tasks to a file. A stretch
whose Content-Length says that it ends where the next one begins is a record. In a file where some
stretch is longer than that (a payload that holds a version line itself), the lengths alone are
followed from record to record, and the stretches of each record are put together again.

Transactions. Request and metadata records find their response through the WARC-Concurrent-To
identifiers, in whichever direction these point and over as many records as it takes; the result is
one nested row per capture, of which a key keeps counts and one record of each kind, never a list.

Defined cases: a NULL payload is empty; a NULL page id is written as an empty field and read as NULL;
a NULL url has no WARC-Target-URI, spaces and control characters in one are percent-encoded; of equal
payloads the one of smallest id (NULL ids last, then by url) is the response; repeated rows are one
response and its revisits; extra columns are not written; an empty table gives an empty archive,
which reads as no rows. A record whose length is missing or leads past its file's end is ``malformed``
and reading goes on behind its version line. A request or metadata record that leads to no response
is a capture of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa

from feedweave.llm.ranks import one_of_each, written
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

VERSION = "WARC/1.1"
END = "\r\n\r\n"
ROOTS = ("response", "revisit")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PLACE = ["_file", "_block", "_row"]


def base32_sha1(data: Column) -> Column:
    """The SHA-1 in upper-case base32: 40 bits at a time, eight digits each."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(hex_digits: Column) -> Column:
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(hex_digits, at, n) for at, n in cuts]))


def _record(kind: str | Column, record_id: Column, headers: list[tuple[str, Column | None]], block: Column) -> Column:
    """A record without its final line breaks; headers of NULL are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    every = [("WARC-Type", kind), ("WARC-Record-ID", F.concat(F.lit("<"), record_id, F.lit(">"))), *headers]
    every.append(("Content-Length", F.octet_length(block).cast("string")))
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in every if value is not None]
    return F.concat(F.concat_ws("\r\n", F.lit(VERSION), *lines), F.lit(END), block)


def _captures_of(pages: DataFrame, page_id: str, url: str, payload: str, least_bytes: int) -> DataFrame:
    """(page_id, url, payload, n_bytes, digest, record_id, original): the rows as they will be written.

    ``original`` is the record id that a revisit refers to. Payloads are shuffled only if some repeat,
    and then only rows that Spark does not join by broadcast; revisits are made without them.
    """
    rows = pages.select(
        F.col(f"`{page_id}`").cast("string").alias("page_id"), F.col(f"`{page_id}`").alias("_order"), F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{payload}`"), F.lit("")).alias("payload"),
    ).withColumn("digest", base32_sha1(F.col("payload"))).withColumn("n_bytes", F.octet_length("payload").cast("long"))
    place = F.struct(F.col("_order").isNull().alias("no_id"), F.col("_order").alias("id"), F.col("url").isNull().alias("no_url"), F.col("url").alias("url"))

    def fresh() -> Column:  # every call has a seed of its own
        return F.concat(F.lit("urn:uuid:"), F.uuid()).alias("record_id")

    large = rows.filter(F.col("n_bytes") >= least_bytes)
    repeated = large.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1")
    repeated = written(repeated.select("digest", "first"), "warc-repeated")
    columns = ["page_id", "url", "payload", "n_bytes", "digest"]
    none = F.lit(None).cast("string")
    single = rows.join(repeated, (rows["digest"] == repeated["digest"]) & (F.col("n_bytes") >= least_bytes), "left_anti")
    single = single.select(*columns, fresh(), none.alias("original"))
    shared_id = _urn(F.md5(F.concat(F.lit("response "), F.col("digest"))))
    among = large.join(repeated, "digest")
    firsts = one_of_each(among.filter(place.eqNullSafe(F.col("first"))), "digest")
    firsts = firsts.select(*columns, shared_id.alias("record_id"), none.alias("original"))
    # Rows equal in id, url and payload are told apart by number only.
    same = among.groupBy("digest", "page_id", "url", "n_bytes").agg(F.count(F.lit(1)).alias("n"), F.max(place.eqNullSafe(F.col("first"))).alias("has_first"))
    again = same.withColumn("n", F.col("n") - F.col("has_first").cast("int")).filter("n > 0")
    again = again.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    again = again.withColumn("payload", F.lit("")).select(*columns, fresh(), shared_id.alias("original"))
    return reduce(DataFrame.unionByName, [single, firsts, again])


def _uri(url: Column) -> Column:
    """The url with spaces and control characters percent-encoded, so that a header holds it in one line."""
    odd = r"[\x00-\x20\x7F]"
    each = F.transform(F.split(url, ""), lambda c: F.when(c.rlike(odd), F.concat(F.lit("%"), F.lpad(F.hex(F.encode(c, "UTF-8")), 2, "0"))).otherwise(c))
    return F.when(url.rlike(odd), F.array_join(each, "")).otherwise(url)


def write(
    pages: DataFrame, path: str, date: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
    least_bytes: int = 0, compression: str = "none",
) -> None:
    """Write a request, a response or revisit, and a metadata record for every row; files of many captures.

    ``date`` is the captures' WARC-Date. Payloads under ``least_bytes`` are never revisits. With
    ``compression='gzip'`` the files are smaller, and read by a task each.
    """
    made = _captures_of(pages, page_id, url, payload, least_bytes).withColumn("uri", _uri(F.col("url")))
    revisit = F.col("original").isNotNull()
    target = ("WARC-Target-URI", F.col("uri"))
    when = ("WARC-Date", F.lit(date))
    capture = ("WARC-Concurrent-To", F.concat(F.lit("<"), F.col("record_id"), F.lit(">")))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n_bytes").cast("string"), F.lit(END), F.col("payload"),
    )
    response = _record(F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), F.col("record_id"), [
        when, target, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<"), F.col("original"), F.lit(">")))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
    ], http)
    asked = F.concat(F.lit("GET "), F.coalesce("uri", F.lit("/")), F.lit(" HTTP/1.1"), F.lit(END))
    request = _record("request", _urn(F.md5(F.concat(F.lit("request "), F.col("record_id")))), [
        when, target, capture, ("Content-Type", F.lit("application/http; msgtype=request")),
    ], asked)
    fields = F.concat(F.lit("page-id: "), F.coalesce("page_id", F.lit("")), F.lit("\r\n"))
    metadata = _record("metadata", _urn(F.md5(F.concat(F.lit("metadata "), F.col("record_id")))), [
        when, target, capture, ("Content-Type", F.lit("application/warc-fields")),
    ], fields)
    made.select(F.explode(F.array(request, response, metadata)).alias("value")).write.option("lineSep", END).option(
        "compression", compression).text(path)


def _header(name: str) -> str:
    return rf"(?im)^{name}:[ \t]*([^\r\n]*)"


def _stretches(spark: SparkSession, path: str, version: str) -> DataFrame:
    """What lies between version lines, with its place, its length, and the length its header claims."""
    begin = f"{version}\r\n"
    rows = spark.read.option("lineSep", begin).text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"), "value",
    ).filter("value != ''")
    rows = rows.withColumn("_head", F.substring_index("value", END, 1))
    length = F.regexp_extract("_head", _header("Content-Length"), 1).try_cast("long")
    # -1 where no header or no length is found: more than any stretch can miss
    claim = F.coalesce(F.when(F.octet_length("_head") < F.octet_length("value"), F.octet_length("_head") + 2 * len(END) + length), F.lit(-1))
    return rows.withColumn("_size", F.octet_length("value").cast("long")).withColumn("_claim", claim.cast("long"))


def _followed(begin: int):
    """Stretches of a file in order, as lengths: the first stretch of the record that each belongs to.

    A record ends where its length says. One that would end within a stretch, or behind its file's
    end, is malformed, and the next stretch is tried as a record. Only lengths are held.
    """

    def scan(held: list[tuple], ended: bool) -> tuple[list[tuple], list[tuple]]:
        rows, at = [], 0
        while at < len(held):
            size, claim, upto = held[at][3], held[at][4], at + 1
            while size < claim and upto < len(held):
                size += begin + held[upto][3]
                upto += 1
            if size < claim and not ended:
                break
            whole = size == claim
            upto = upto if whole else at + 1
            rows += [(*row[:3], *held[at][1:3], not whole) for row in held[at:upto]]
            at = upto
        return rows, held[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("_file", pa.string()), ("_block", pa.int64()), ("_row", pa.int64()),
            ("_of_block", pa.int64()), ("_of_row", pa.int64()), ("_broken", pa.bool_()),
        ])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        held: list[tuple] = []
        for batch in batches:
            rows: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[0] != held[0][0]:
                    rows += scan(held, True)[0]
                    held = []
                held.append(row)
            found, held = scan(held, False)
            rows += found
            if rows:
                yield batch_of(rows)
        if held:
            yield batch_of(scan(held, True)[0])

    return run


def _whole(rows: DataFrame, version: str) -> DataFrame:
    """(place, value, malformed): the stretches put together to records by their lengths."""
    begin = f"{version}\r\n"
    odd = written(rows.filter("_claim != _size").select("_file").distinct(), "warc-odd-files")
    plain = rows.join(odd, "_file", "left_anti").select(*PLACE, "value", F.lit(False).alias("malformed"))
    if not odd.take(1):
        return rows.select(*PLACE, "value", F.lit(False).alias("malformed"))
    among = rows.join(odd, "_file", "left_semi")
    lengths = among.select(*PLACE, "_size", "_claim").repartition("_file").sortWithinPartitions(*PLACE)
    kind = "_file string, _block long, _row long, _of_block long, _of_row long, _broken boolean"
    placed = lengths.mapInArrow(_followed(len(begin)), kind)
    parts = among.select(*PLACE, "value").join(placed, PLACE)
    part = F.struct("_block", "_row", F.col("value").cast("binary").alias("part"))
    joined = parts.groupBy("_file", F.col("_of_block").alias("_block"), F.col("_of_row").alias("_row")).agg(
        F.array_sort(F.collect_list(part)).alias("parts"), F.max("_broken").alias("malformed"),
    )
    bodies = F.transform("parts", lambda p: p["part"].cast("string"))
    return plain.unionByName(joined.select(*PLACE, F.array_join(bodies, begin).alias("value"), "malformed"))


def records(spark: SparkSession, path: str, version: str = VERSION) -> DataFrame:
    """The records of archives: type, ids, links, date, uri, and the payload with its length and digest.

    ``block`` is what stands behind the header, ``payload`` that without the HTTP header of records
    that have one. Columns that are not used later are not computed.
    """
    rows = _whole(_stretches(spark, path, version), version)
    rows = rows.withColumn("_head", F.substring_index("value", END, 1))

    def of(name: str) -> Column:
        found = F.trim(F.regexp_extract("_head", _header(name), 1))
        return F.when(found != "", found)

    def bare(c: Column) -> Column:
        return F.regexp_replace(c, "^<|>$", "")

    data, ahead = F.col("value").cast("binary"), F.octet_length("_head") + len(END)
    size = F.octet_length("value") - ahead - F.when(F.col("malformed"), 0).otherwise(len(END))
    linked = F.transform(F.regexp_extract_all("_head", F.lit(_header("WARC-Concurrent-To")), 1), lambda c: bare(F.trim(c)))
    parsed = rows.select(
        of("WARC-Type").alias("record_type"), bare(of("WARC-Record-ID")).alias("record_id"), linked.alias("concurrent_to"),
        bare(of("WARC-Refers-To")).alias("refers_to"), of("WARC-Date").alias("date"), of("WARC-Target-URI").alias("uri"),
        of("Content-Type").alias("content_type"), F.regexp_replace(of("WARC-Payload-Digest"), "^sha1:", "").alias("stated_digest"),
        F.substring(data, ahead + 1, F.greatest(size, F.lit(0))).alias("block"), "malformed",
    )
    http = F.col("content_type").startswith("application/http")
    top = F.octet_length(F.substring_index(F.col("block").cast("string"), END, 1)) + len(END)
    behind = F.substring(F.col("block"), top + 1, F.greatest(F.octet_length("block") - top, F.lit(0)))
    parsed = parsed.withColumn("payload", F.when(http, behind).otherwise(F.col("block")))
    return parsed.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", base32_sha1(F.col("payload")))


def _owners(every: DataFrame) -> DataFrame:
    """(record_id, capture): the response or revisit that each other record leads to, the least if several."""
    links = every.select("record_id", F.explode("concurrent_to").alias("other"))
    links = links.unionByName(links.select(F.col("other").alias("record_id"), F.col("record_id").alias("other")))
    roots = every.filter(F.col("record_type").isin(*ROOTS)).select("record_id")
    open_links = written(links.join(roots, "record_id", "left_anti").distinct(), "warc-links")
    known, owned = roots.select(F.col("record_id").alias("other"), F.col("record_id").alias("capture")), None
    while True:
        step = open_links.join(known, "other").groupBy("record_id").agg(F.min("capture").alias("capture"))
        if owned is not None:
            step = step.join(owned, "record_id", "left_anti")
        step = written(step, "warc-step")
        owned = step if owned is None else owned.unionByName(step)
        left = open_links.join(owned, "record_id", "left_anti")
        if not step.take(1) or not left.take(1):
            return owned
        known = step.select(F.col("record_id").alias("other"), "capture")


def captures(every: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, its request, its metadata, and how many of each.

    Of several requests or metadata records the one of least id is shown. ``metadata.fields`` maps the
    names of an application/warc-fields block to their values.
    """
    every = every.filter("NOT malformed AND record_id IS NOT NULL")
    narrow = written(every.select("record_id", "record_type", "concurrent_to"), "warc-ids")
    main = every.filter(F.col("record_type").isin(*ROOTS)).select(
        F.col("record_id").alias("capture_id"),
        F.struct("record_id", "record_type", "date", "uri", "refers_to", "stated_digest", "payload_bytes", "payload_digest", "payload").alias("response"),
    )
    text = F.col("block").cast("string")
    pairs = F.filter(F.split(text, "\r?\n"), lambda line: line.contains(":"))
    entries = F.transform(pairs, lambda line: F.struct(F.substring_index(line, ":", 1).alias("k"), F.trim(F.substring(line, F.instr(line, ":") + 1, F.length(line))).alias("v")))
    named = F.transform(F.array_distinct(F.transform(entries, lambda e: e["k"])), lambda k: F.struct(k, F.element_at(F.filter(entries, lambda e: e["k"] == k), 1)["v"]))
    kind = F.col("record_type")
    side = every.filter(~kind.isin(*ROOTS)).select(
        "record_id", "record_type",
        F.when(kind == "request", F.struct("record_id", "date", "uri", F.substring_index(text, "\r\n", 1).alias("line"))).alias("request"),
        F.when(kind == "metadata", F.struct("record_id", F.map_from_entries(named).alias("fields"))).alias("metadata"),
    )
    owners = _owners(narrow)
    side = side.join(owners, "record_id", "left").withColumn("capture_id", F.coalesce("capture", "record_id"))
    least = {c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("record_id"))).alias(c) for c in ("request", "metadata")}
    gathered = side.groupBy("capture_id").agg(
        *least.values(), F.count("request").alias("n_requests"), F.count("metadata").alias("n_metadata"),
    )
    joined = main.join(gathered, "capture_id", "full_outer")
    return joined.withColumns({n: F.coalesce(n, F.lit(0)) for n in ("n_requests", "n_metadata")})


def resolved(found: DataFrame) -> DataFrame:
    """(capture_id, page_id, record_type, payload_bytes, payload_digest, refers_to) of every capture with a response.

    A revisit takes the payload's length and digest from the response that it refers to, whose page
    id is ``refers_to``; where that response is in none of the archives, length and page are NULL and the
    digest is the one its header states.
    """
    page = F.col("metadata.fields")["page-id"]
    flat = found.filter("response IS NOT NULL").select(
        "capture_id", F.when(page != "", page).alias("page_id"), "response.record_type", F.col("response.payload_bytes").alias("n"),
        F.col("response.payload_digest").alias("d"), "response.stated_digest", F.col("response.refers_to").alias("_to"),
    )
    flat = written(flat, "warc-captures")
    responses = flat.filter("record_type = 'response'").select(
        F.col("capture_id").alias("_to"), F.col("n").alias("_n"), F.col("d").alias("_d"), F.col("page_id").alias("refers_to"),
    )
    joined = flat.join(responses, "_to", "left")
    again = F.col("record_type") == "revisit"
    return joined.select(
        "capture_id", "page_id", "record_type", F.when(again, F.col("_n")).otherwise(F.col("n")).alias("payload_bytes"),
        F.when(again, F.coalesce("_d", "stated_digest")).otherwise(F.col("d")).alias("payload_digest"),
        F.when(again, F.col("refers_to")).alias("refers_to"),
    )

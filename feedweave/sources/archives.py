"""Lines of packed files, unpacked as a stream from whatever store Spark can read.

A small file comes as one cell. A larger one comes as the stretches between its line feed bytes, which
all tasks read from its splits; they meet in order, sorted on disk if need be, in the task that unpacks
the file. So no file is held, none is too large, and nothing but Spark's own readers opens one.
"""

from __future__ import annotations

import gzip
import io
import itertools
import struct
import sys
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

# The functions run by tasks travel with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Files up to this many bytes come as one cell.
CELL_BYTES = 64 << 20
LINE_COLUMNS = {"_file": pa.string(), "_block": pa.int64(), "_row": pa.int64(), "value": pa.string()}
#: Lines are handed on when they are so many or so long.
BATCH_LINES, BATCH_CHARS = 2_000, 1_000_000
#: The length of a large file named .gz: Spark has unzipped it when it comes.
UNZIPPED = -1


def packed_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(path, content, length): a row for a small file, several for a large one, one behind the other and in order."""
    files = spark.read.format("binaryFile").load(path)
    small = files.filter(F.col("length") <= CELL_BYTES).select("path", "content", "length")
    large = [row["path"] for row in files.filter(F.col("length") > CELL_BYTES).select("path").collect()]  # names of large files
    if not large:
        return small
    size = F.when(F.endswith("_metadata.file_name", F.lit(".gz")), UNZIPPED).otherwise(F.col("_metadata.file_size"))
    stretches = spark.read.option("lineSep", "\n").text(large).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("content"), size.alias("length"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"),
    )
    ordered = stretches.repartition("path").sortWithinPartitions("path", "_block", "_row")
    return small.unionAll(ordered.select("path", "content", "length"))


class _Joined(io.RawIOBase):
    """Stretches of a file as the file: a line feed stood between them, and behind the last if the length says so."""

    def __init__(self, parts: Iterator[tuple[bytes, int]]) -> None:
        self._parts = self._whole(parts)
        self._left = memoryview(b"")

    @staticmethod
    def _whole(parts: Iterator[tuple[bytes, int]]) -> Iterator[bytes]:
        size, length = 0, 0
        for number, (part, length) in enumerate(parts):
            if number:
                size += 1
                yield b"\n"
            size += len(part)
            yield part
        if size < length:
            yield b"\n"

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not len(self._left):
            part = next(self._parts, None)
            if part is None:
                return 0
            self._left = memoryview(part)
        n = min(len(buffer), len(self._left))
        buffer[:n] = self._left[:n]
        self._left = self._left[n:]
        return n


class _FirstEntry(io.RawIOBase):
    """What the entry that comes first in a zip archive holds, read from front to back."""

    def __init__(self, archive: io.BufferedIOBase) -> None:
        self._archive = archive
        head = archive.read(30)
        if len(head) < 30 or head[:4] != b"PK\x03\x04":
            raise ValueError("no zip archive")
        flags, method, self._crc, size, names, extras = struct.unpack("<6xHH4xII4xHH", head)
        archive.read(names)
        extra = archive.read(extras)
        if flags & 1 or method not in (0, 8):
            raise ValueError("encrypted entries, and methods other than stored and deflated, cannot be unpacked")
        self._later = bool(flags & 8)  # checksum and sizes stand behind the entry
        if size == 0xFFFFFFFF:
            size = self._long_size(extra)
        if method == 0 and self._later:
            raise ValueError("a stored entry of unknown size cannot be unpacked as a stream")
        self._size = size
        self._inflate = zlib.decompressobj(-15) if method else None
        self._sum, self._left, self._ended = 0, b"", False

    @staticmethod
    def _long_size(extra: bytes) -> int:
        while len(extra) >= 4:
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1:  # sizes of eight bytes: the unpacked one, then the packed one
                return struct.unpack("<8xQ", extra[4:20])[0]
            extra = extra[4 + n:]
        raise ValueError("broken zip archive")

    def readable(self) -> bool:
        return True

    def _more(self) -> bytes:
        if self._inflate is None:
            data = self._archive.read(min(self._size, 1 << 16))
            if not data and self._size:
                raise EOFError("the archive ends within its first entry")
            self._size -= len(data)
            self._ended = not self._size
            return data
        data = b""
        while not data and not self._inflate.eof:
            packed = self._inflate.unconsumed_tail or self._archive.read(1 << 16)
            if not packed:
                raise EOFError("the archive ends within its first entry")
            data = self._inflate.decompress(packed, 1 << 20)
        if self._inflate.eof:
            self._ended = True
            if self._later:
                tail = self._inflate.unused_data + self._archive.read(max(8 - len(self._inflate.unused_data), 0))
                self._crc = struct.unpack("<I", tail[4:8] if tail[:4] == b"PK\x07\x08" else tail[:4])[0]
        return data

    def readinto(self, buffer) -> int:
        while not self._left and not self._ended:
            self._left = self._more()
            self._sum = zlib.crc32(self._left, self._sum)
            if self._ended and self._sum != self._crc:
                raise ValueError("the archive's first entry is damaged")
        n = min(len(buffer), len(self._left))
        buffer[:n], self._left = self._left[:n], self._left[n:]
        return n


def _open(path: str, parts: Iterator[tuple[bytes, int]], steps: Sequence[str], encoding: str) -> io.TextIOWrapper:
    first = next(parts)
    stream: io.BufferedIOBase = io.BufferedReader(_Joined(itertools.chain([first], parts)), 1 << 20)
    steps = [*steps, "gz"] if path.endswith(".gz") and "gz" not in steps else list(steps)
    if first[1] == UNZIPPED:
        steps.remove("gz")
    for step in steps:
        if step == "zip":
            stream = io.BufferedReader(_FirstEntry(stream), 1 << 20)
        elif step == "gz":
            stream = gzip.GzipFile(fileobj=stream)
        elif step != "csv":
            raise ValueError(f"cannot unpack {step}")
    return io.TextIOWrapper(stream, encoding=encoding, errors="replace", newline="\n")


def _batch(rows: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), LINE_COLUMNS.values())], list(LINE_COLUMNS))


def archive_lines(files: DataFrame, steps: Sequence[str], encoding: str = "UTF-8", skip: int = 0) -> DataFrame:
    """Lines of packed files, unpacked step by step, without the first ``skip``.

    ``files`` has ``path`` and ``content``, and ``length`` where a file has several rows. One task
    unpacks an archive, as a stream: what Spark hands over at once (``spark.sql.execution.arrow.maxBytesPerBatch``),
    one cell of it and a few lines are in memory. Of a zip, the entry that comes first in the file counts.
    """
    steps = list(steps)
    if "length" not in files.columns:
        files = files.withColumn("length", F.octet_length("content").cast("long"))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes, int]]:
        for batch in batches:
            for k in range(batch.num_rows):  # one cell at a time leaves the batch
                path, content, length = (column[k].as_py() for column in batch.columns)
                yield path, content, length

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, int, int, str]] = []
        size = 0
        for path, group in itertools.groupby(cells(batches), lambda row: row[0]):
            with _open(path, ((content, length) for _, content, length in group), steps, encoding) as text:
                for _ in range(skip):
                    next(text, None)
                for number, line in enumerate(text):
                    rows.append((path, 0, skip + number, line.removesuffix("\n")))
                    size += len(line)
                    if len(rows) == BATCH_LINES or size > BATCH_CHARS:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)

    return files.select("path", "content", "length").mapInArrow(unpack, "_file string, _block long, _row long, value string")

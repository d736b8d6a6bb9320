"""Versioned tables in buckets of keys: a commit lists each bucket's folder, so an unchanged one is not written again.

A row lies in the bucket of its key's hash, the same that Spark's bucketed tables use, and carries its key
as compared and a digest of its values. Spark reads a version as a bucketed table (registered in the
session's catalog while a job needs it, every bucket a partition in the folder that the commit names), so
a join on the key moves nothing of it, and reads keys and digests alone where those are asked for. The
commit's row counts answer how many rows there are without a scan.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feedweave.sources.versioned import GRACE, Staged, VersionedTable

KEY, BUCKET = "_key", "_bucket"
DIGEST = ("_digest_x", "_digest_y")
#: Partitions that are registered by one statement.
AT_A_TIME = 500


@dataclass(frozen=True)
class Manifest:
    """What a commit holds: the number of buckets, how keys are compared, and each filled bucket's folder and rows."""

    buckets: int
    policy: str
    parts: Mapping[int, tuple[str, int]] = field(default_factory=dict)

    @staticmethod
    def of(text: str) -> Manifest:
        read = json.loads(text)
        return Manifest(read["buckets"], read["policy"], {int(b): (folder, rows) for b, (folder, rows) in read["parts"].items()})

    def text(self) -> str:
        return json.dumps({"buckets": self.buckets, "policy": self.policy, "parts": {str(b): list(p) for b, p in sorted(self.parts.items())}})

    def rows(self) -> int:
        return sum(rows for _, rows in self.parts.values())


def digest(columns: list[Column]) -> list[Column]:
    """128 bits of the values, as two numbers; which values are NULL is part of it, as Spark's hashes skip NULLs."""
    filled = F.concat(*[F.when(c.isNull(), F.lit("0")).otherwise(F.lit("1")) for c in columns])
    return [F.xxhash64(F.lit(seed), filled, *columns).alias(name) for seed, name in enumerate(DIGEST)]


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.hash(key), F.lit(buckets))


def kept_columns(schema: T.StructType) -> T.StructType:
    """A stored schema with what the table adds to each row."""
    added = [T.StructField(KEY, T.StringType()), *[T.StructField(name, T.LongType()) for name in DIGEST]]
    return T.StructType([*schema.fields, *added])


class BucketedTable(VersionedTable):
    """Rows of ``schema`` below ``path``: ``data/<folder>/_bucket=<n>`` and ``commits/<number>``.

    ``buckets`` counts for a table without a version; choose it so that a bucket fits a task.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, buckets: int = 64, policy: str = "exact", claim: str = "") -> None:
        super().__init__(spark, path, claim)
        self.schema = schema
        self._new = Manifest(buckets, policy)

    def manifest(self, version: int | None = None) -> Manifest:
        version = self.version() if version is None else version
        return Manifest.of(self._commit_lines(version)[0]) if version else self._new

    def rows(self, version: int | None = None) -> int:
        """The rows of a version, from its commit."""
        return self.manifest(version).rows()

    def read(self, schema: T.StructType | None = None, version: int | None = None) -> DataFrame:
        """A version's rows, by default the current ones; none before the first."""
        parts = self.manifest(version).parts
        if not parts:
            return self.spark.createDataFrame([], schema or self.schema)
        paths = [self._folder(folder, bucket) for bucket, (folder, _) in sorted(parts.items())]
        return self.spark.read.schema(schema or self.schema).parquet(*paths)

    def _folder(self, folder: str, bucket: int) -> str:
        return f"{self.path}/data/{folder}/{BUCKET}={bucket}"

    @contextmanager
    def view(self, manifest: Manifest) -> Iterator[DataFrame]:
        """The rows as Spark's own bucketed table, with key, digest and bucket, for jobs within the block."""
        paths = {bucket: self._folder(folder, bucket) for bucket, (folder, _) in manifest.parts.items()}
        with bucketed_view(self.spark, kept_columns(self.schema), manifest.buckets, paths, f"{self.path}/data") as view:
            yield view

    def stage_buckets(self, rows: DataFrame, base: int) -> Staged:
        """Write rows, which have key, digest and bucket, into a new folder; no bucket refers to it yet."""
        version = base + 1
        folder = f"{version:08d}-{uuid.uuid4().hex}"
        write_buckets(rows, f"{self.path}/data/{folder}", self.manifest(base).buckets)
        return Staged(version, folder)

    def expire(self, keep: int = 2, grace: float = GRACE) -> None:
        """Remove folders that none of the last ``keep`` versions refers to; those no commit ever named once they are old."""
        versions = self._versions()
        used = {folder for version in versions[-max(keep, 1):] for folder, _ in self.manifest(version).parts.values()}
        committed = {folder for version in versions for folder, _ in self.manifest(version).parts.values()}
        self._remove(lambda folder: folder not in used and folder in committed, lambda folder: folder not in used, grace)


def write_buckets(rows: DataFrame, path: str, buckets: int) -> None:
    """Rows with key and bucket as files of Spark's bucketed layout, a folder per bucket."""
    spark, name = rows.sparkSession, f"feedweave_{uuid.uuid4().hex}"
    try:
        rows.write.format("parquet").partitionBy(BUCKET).bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # its files stay


@contextmanager
def bucketed_view(spark: SparkSession, schema: T.StructType, buckets: int, paths: Mapping[int, str], root: str) -> Iterator[DataFrame]:
    """A table of the session's catalog over the folders of filled buckets, dropped behind the block."""
    name, columns = f"feedweave_{uuid.uuid4().hex}", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def quoted(path: str) -> str:
        return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"

    spark.sql(
        f"CREATE TABLE {name} ({columns}, {BUCKET} int) USING parquet PARTITIONED BY ({BUCKET}) "
        f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION {quoted(f'{root}/none-{name}')}"
    )
    try:
        listed = sorted(paths.items())
        for at in range(0, len(listed), AT_A_TIME):
            parts = " ".join(f"PARTITION ({BUCKET}={b}) LOCATION {quoted(path)}" for b, path in listed[at:at + AT_A_TIME])
            spark.sql(f"ALTER TABLE {name} ADD {parts}")
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")

"""Token ids as ORC files: integer run-length encoded stripes, row indexes, Bloom filters on ids.

``write`` range-partitions the documents by id, so the files in order of their names hold
ascending ids and every stripe's statistics cover a narrow stretch of them; readers prune
stripes and row groups by statistics and by the Bloom filter on the id, and large files are
read stripe by stripe in parallel. ``read`` returns what the files hold.

Defined cases: a NULL or empty text is the end id alone; NULL ids come first; rows of equal
id are ordered by a hash of their text, equal rows in any order; an empty table gives an
empty file; other columns are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from feedweave.llm.ranks import running_sums, written
from feedweave.llm.tokens import ENCODED_BYTES, release, shared_encoder, slices
from pyspark.sql import DataFrame, SparkSession, functions as F

END_ID = 1
STRIPE_BYTES = 64 << 20
ROWS_PER_INDEX = 1000
FALSE_HITS = 0.01
SCHEMA = "doc_id long, text_hash long, ids array<int>"


def write(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Encode every text and write doc_id, text_hash, ids in ascending order of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for batch in (part for batch in batches for part in slices(batch, 2, ENCODED_BYTES)):
            ids = encoder.encode_all(batch.column(2))
            offsets = np.concatenate([[0], np.cumsum([len(b) // 4 + 1 for b in ids])]).astype(np.int32)
            flat = pa.array(np.frombuffer(end.join([*ids, b""]), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(offsets), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["doc_id", "text_hash", "ids"])
        release()

    narrow = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"),
    )
    # Where ids are unique, the ranges are found without reading a text.
    repeated = narrow.groupBy("doc_id").count().filter("count > 1").take(1)
    order = ["doc_id", "text_hash"] if repeated else ["doc_id"]
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    options = {
        "compression": "snappy", "orc.stripe.size": STRIPE_BYTES, "orc.create.index": "true",
        "orc.row.index.stride": ROWS_PER_INDEX, "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": FALSE_HITS,
    }
    ranged.mapInArrow(run, SCHEMA).write.options(**options).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def index(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document; ``start`` counts all ids ahead."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends = lists.offsets.to_numpy()
            flat = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<u4")).cast("B")
            sums = [zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            columns = [batch.column(0), batch.column(1), pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_tokens", "ids_crc32"])

    sized = stored.mapInArrow(measure, "doc_id long, text_hash long, n_tokens long, ids_crc32 long")
    sized = written(sized, "token-sizes")
    placed = running_sums(sized, [], ["doc_id", "text_hash"], ["n_tokens"], "token-starts")
    return placed.select("doc_id", F.col("before_n_tokens").alias("start"), "n_tokens", "ids_crc32")

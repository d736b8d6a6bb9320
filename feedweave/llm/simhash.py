"""SimHash near-duplicates with covering locality-sensitive hashing.

Fingerprints: the 64-bit hashes of all word shingles vote on each bit. Tables: every bit
position gets a vector of radius + 1 bits; table v keeps the positions whose vector has an
odd inner product with v. The vectors of at most ``radius`` differing bits cannot span that
space, so some v is orthogonal to them all: every pair within the radius agrees in some table
(Pagh's covering construction), without a miss.

Copies are folded into one fingerprint first. A bucket of very many different fingerprints
is dealt out anew by a second covering of the bits its table left free, and so on; after a
few levels the bits left free bound a bucket's size. Buckets hand on each member's group,
never all pairs.

Defined cases: NULL and empty texts have the zero fingerprint and link like any other; fewer
words than a shingle are hashed as one sequence; repeated rows and equal ids stay rows;
a component whose ids are all NULL has a NULL id; other columns pass through, and
``fingerprint`` and ``component_id`` replace columns of those names; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from random import Random

import numpy as np
import pandas as pd
import pyarrow as pa

from feedweave.llm.components import components
from feedweave.llm.ranks import one_of_each, row_hash, whole_row, written
from pyspark.sql import DataFrame, functions as F

BITS = 64
SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
#: Different fingerprints in a bucket beyond which it is dealt out anew.
BUCKET_BOUND = 4096
#: Shingles whose bits are added up at a time.
STRIDE = 1 << 16


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text's shingles of ``size`` words, as a signed 64-bit number."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    shingles = map(b" ".join, zip(*(words[k:] for k in range(size))))
    n = len(words) - size + 1
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.zeros((8, 8), np.int64)
    lanes, shifts = np.uint64(0x0101010101010101), np.arange(8, dtype=np.uint64)
    for at in range(0, n, STRIDE):  # bit 8 b + s of a hash is added up in byte b of row s
        spread = (hashes[at:at + STRIDE, None] >> shifts) & lanes
        sums = np.add.reduceat(spread, np.arange(0, len(spread), 255), axis=0)
        ones += sums.view(np.uint8).reshape(len(sums), 8, 8).sum(axis=0, dtype=np.int64)
    bits = (2 * ones.T.reshape(64) > n).astype(np.uint8)  # sums' rows hold shift, then byte
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", size: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with ``_fp``, the fingerprint as a long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, size) for t in texts], dtype="int64")

    return docs.withColumn("_fp", of(F.col(text)))


def masks(radius: int, level: int = 0) -> list[int]:
    """The 2^(radius+1) - 1 bit masks of a covering, as signed longs; another one per level."""
    n = (1 << (radius + 1)) - 1
    vectors = [k % n + 1 for k in range(BITS)]
    Random(level).shuffle(vectors)
    kept = [sum(1 << k for k in range(BITS) if (vectors[k] & v).bit_count() % 2) for v in range(1, n + 1)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in kept]


def _dealt(df: DataFrame, radius: int, level: int) -> DataFrame:
    """Each row (path, mask, fp) once for every table of a further level."""
    tables = F.array(*[F.struct(F.lit(k).alias("t"), F.lit(m).alias("m")) for k, m in enumerate(masks(radius, level))])
    each = df.select("path", "mask", "fp", F.explode(tables).alias("x"))
    mask = F.col("mask").bitwiseOR(F.col("x.m"))
    return each.select(F.xxhash64("path", "x.t").alias("path"), mask.alias("mask"), mask.bitwiseAND(F.col("fp")).alias("key"), "fp")


def _groups(fps: np.ndarray, starts: np.ndarray, ends: np.ndarray, radius: int) -> np.ndarray:
    """The first row of each row's group, links being pairs within the radius and one bucket."""
    n = len(fps)
    label = np.arange(n)
    end_of = np.repeat(ends, ends - starts)
    rows, shift = np.arange(n), 1
    while len(rows := rows[rows + shift < end_of[rows]]):
        others = rows + shift
        near = np.bitwise_count(fps[rows] ^ fps[others]) <= radius
        a, b = rows[near], others[near]
        apart = label[a] != label[b]
        for x, y in zip(a[apart].tolist(), b[apart].tolist()):
            while label[x] != x:
                x = label[x]
            while label[y] != y:
                y = label[y]
            label[max(x, y)] = min(x, y)
        while True:  # every row points at its group's first row again
            up = label[label]
            if (up == label).all():
                break
            label = up
        shift += 1
    return label


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def linked(path, key, fp):
            new = np.flatnonzero((path[1:] != path[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.append(0, new), np.append(new, len(fp))
            several = ends - starts > 1
            take = np.repeat(several, ends - starts)
            sizes = (ends - starts)[several]
            ends, fps = np.cumsum(sizes), fp[take]
            label = _groups(fps.view(np.uint64), ends - sizes, ends, radius)
            a, b = fps[label], fps
            return pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], schema=schema)

        for batch in batches:
            columns = [batch.column(k).to_numpy() for k in range(3)]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            path, key, _ = columns
            if not len(path):
                continue
            last = np.flatnonzero((path != path[-1]) | (key != key[-1]))
            cut = last[-1] + 1 if len(last) else 0  # the last bucket may go on
            if cut:
                yield linked(*(c[:cut] for c in columns))
            held = [c[cut:] for c in columns]
        if held is not None and len(held[0]):
            yield linked(*held)

    return run


def links(distinct: DataFrame, radius: int = RADIUS, bound: int = BUCKET_BOUND) -> DataFrame:
    """(a, b): links that join all fingerprints of ``distinct`` (column fp) within the radius, transitively."""
    todo = distinct.select(F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("mask"), "fp")
    found, level = None, 0
    while True:
        dealt = _dealt(todo, radius, level)
        sizes = dealt.groupBy("path", "mask", "key").agg(F.count("*").alias("n"))
        free = BITS - F.bit_count("mask")
        large = sizes.filter((F.col("n") > bound) & (free > int(np.log2(bound)))).select("path", "key")
        again = bool(large.take(1))
        here = dealt.join(large, ["path", "key"], "left_anti") if again else dealt
        here = here.repartition("path", "key").sortWithinPartitions("path", "key", "fp").select("path", "key", "fp")
        pairs = here.mapInArrow(_links(radius), "a long, b long")
        found = pairs if found is None else found.unionByName(pairs)
        if not again:
            return found.distinct()
        todo = written(dealt.join(large, ["path", "key"], "left_semi").select("path", "mask", "fp"), "simhash-level")
        level += 1


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS,
    radius: int = RADIUS, bound: int = BUCKET_BOUND,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row; components link within ``radius`` bits."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    marked = written(fingerprints(narrow, "text", size).select("doc_id", "_fp"), "simhash")
    distinct = marked.groupBy(F.col("_fp").alias("fp")).agg(F.min("doc_id").alias("first"))
    roots = components(links(distinct, radius, bound))
    rooted = distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = rooted.join(least, "root").select("fp", "component_id")
    hexed = F.lpad(F.lower(F.hex("_fp")), 16, "0")
    return marked.join(by_print, marked["_fp"] == by_print["fp"]).select(
        "doc_id", hexed.alias("fingerprint"), "component_id",
    )


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of ``docs`` for each component: the one of smallest id (NULL ids last), then of least row hash."""
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), row_hash(docs).alias("_row"))
    marked = written(fingerprints(keyed, "text", options.get("size", SHINGLE_WORDS)).select("doc_id", "_row", "_fp"), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row")).alias("first")
    distinct = marked.groupBy(F.col("_fp").alias("fp")).agg(first)
    roots = components(links(distinct, options.get("radius", RADIUS), options.get("bound", BUCKET_BOUND)))
    rooted = distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
    kept = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    rows = one_of_each(docs.select(whole_row(docs).alias("_doc"), row_hash(docs).alias("_row")), "_row")
    return rows.join(kept.select(F.col("first._row").alias("_row")), "_row", "left_semi").select("_doc.*")

"""Substring dedup by content-defined chunking.

A gear hash rolls over the bytes (each byte shifts it and adds a random number, so it depends
on the last 32 bytes) and a chunk ends where its top bits are zero. Insertions shift bytes
but not these places, so equal passages are cut into equal chunks away from their edges.
Chunks with a digest that occurred earlier are removed if they form a run of ``least_run``
bytes, or one that is a whole text or whole lines of it; shorter coincidences within prose stay.

Copies within a batch are folded before the shuffle; after it, chunks stream by in order of
digest, document and place, so a chunk that every document has needs no memory.

Defined cases: a NULL or empty text has no chunk; rows equal in id and text are one document;
NULL ids come first; repeated passages within a text count like those across texts; other
columns pass through in ``_doc``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from feedweave.llm.substrings import _batch, _letters, cut, ordered_documents
from feedweave.llm.tokens import release, slices
from pyspark.sql import Column, DataFrame, functions as F

#: Zero bits at the top of the hash where a chunk ends: one place in 32.
ZERO_BITS = 5
LEAST, MOST = 24, 256
LEAST_RUN = 80
STRIDE = 1 << 20
LINE_FEED = 10


def _rolled(data: bytes, low: int, high: int, gears: np.ndarray) -> np.ndarray:
    """The hash at each place from ``low`` to ``high``, of the 32 bytes that end there."""
    begin = max(low - 31, 0)
    h, span = gears[np.frombuffer(data, np.uint8)[begin:high]], 1
    while span < 32:  # after each step the hash covers twice as many bytes
        longer = h.copy()
        longer[span:] += h[:-span] << np.uint32(span)
        h, span = longer, span * 2
    return h[low - begin:]


def gear_ends(data: bytes, gears: np.ndarray) -> np.ndarray:
    """The places behind which the hash allows a chunk to end."""
    found = [
        np.flatnonzero(_rolled(data, at, at + STRIDE, gears) >> np.uint32(32 - ZERO_BITS) == 0) + at + 1
        for at in range(0, len(data), STRIDE)
    ]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_ends(data: bytes, gears: np.ndarray) -> list[int]:
    """The end of each chunk: LEAST to MOST bytes long, but for the last one.

    Where the hash allows no end for so long, the chunk ends at its greatest value, which
    depends on the bytes alone as well.
    """
    result, start = [], 0
    for end in [*gear_ends(data, gears).tolist(), len(data)]:
        while end - start > MOST:
            start += LEAST + int(np.argmax(_rolled(data, start + LEAST - 1, start + MOST, gears)))
            result.append(start)
        if end - start >= LEAST:
            result.append(end)
            start = end
    if start < len(data):
        result.append(len(data))
    return result


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh3_128_digest

    gears = (_letters() >> np.uint64(32)).astype(np.uint32)
    for batch in (part for batch in batches for part in slices(batch, 1)):
        digests, ats, starts, stops = [], [], [], []
        for at, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass")
            ends = chunk_ends(data, gears)
            begins = [0, *ends[:-1]]
            view = memoryview(data)
            digests += [xxh3_128_digest(view[a:b]) for a, b in zip(begins, ends)]
            ats.append(np.full(len(ends), at, np.int64))
            starts += begins[:len(ends)]
            stops += ends
        if not digests:
            continue
        xy = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        at, start, stop = np.concatenate(ats), np.array(starts, np.int64), np.array(stops, np.int64)
        by = np.lexsort((start, at, xy[:, 1], xy[:, 0]))
        x, y, at, start, stop = xy[by, 0], xy[by, 1], at[by], start[by], stop[by]
        again = np.append(False, (x[1:] == x[:-1]) & (y[1:] == y[:-1]))
        x = np.where(again, x ^ (at << 24) ^ start, x)  # known to be repeated; spread
        yield _batch("x y at start stop settled", x, y, at, start, stop, again)
    release()


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by digest, document and place, all but the first of each digest."""
    last = None
    for batch in batches:
        x, y, at, start, stop, settled = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(x):
            continue
        fresh = np.flatnonzero(~settled)
        later = settled.copy()
        if len(fresh):
            keys = np.stack([x[fresh], y[fresh]], 1)
            same = np.append(last is not None and bool((keys[0] == last).all()), (keys[1:] == keys[:-1]).all(1))
            later[fresh[same]] = True
            last = keys[-1]
        yield _batch("at start stop", at[later], start[later], stop[later])


def repeated_chunks(docs: DataFrame, text: Column) -> DataFrame:
    """(_at, _spans): by document, the chunks that occur earlier. ``docs`` has each _at once."""
    found = docs.select("_at", text.alias("_text")).mapInArrow(
        _chunk_rows, "x long, y long, at long, start long, stop long, settled boolean",
    )
    dealt = found.repartition("x", "y").sortWithinPartitions("x", "y", "at", "start")
    later = dealt.mapInArrow(_later, "at long, start long, stop long")
    return later.groupBy(F.col("at").alias("_at")).agg(F.collect_list(F.struct("start", "stop")).alias("_spans"))


def runs(spans: list[tuple[int, int]], least: int, data: bytes) -> list[tuple[int, int]]:
    """Neighbouring chunks as runs; those shorter than ``least`` bytes are left out unless they are whole lines of ``data``."""
    joined: list[list[int]] = []
    for start, stop in sorted(set(spans)):
        if joined and start == joined[-1][1]:
            joined[-1][1] = stop
        else:
            joined.append([start, stop])


    def whole(a: int, b: int) -> bool:
        return (a == 0 or data[a - 1] == LINE_FEED) and (b == len(data) or LINE_FEED in data[b - 1:b + 1])

    return [(a, b) for a, b in joined if b - a >= least or whole(a, b)]


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_run: int = LEAST_RUN) -> DataFrame:
    """(_doc, text_left, n_bytes, n_removed, n_spans, kept_sha256) for every row.

    ``text_left`` is what remains; a character cut in two is left out of it.
    """
    placed, once = ordered_documents(docs, doc_id, text)
    body = F.col("_doc")[text]

    def run(texts: pa.Array, spans: pa.Array) -> pa.Array:
        ends = spans.offsets.to_numpy().tolist()
        start, stop = (spans.values.field(k).to_numpy().tolist() for k in range(2))
        rows = []
        for words, low, high in zip(texts, ends, ends[1:]):
            data = (words.as_py() or "").encode("utf-8", "surrogatepass")
            kept, removed, n = cut(data, runs(list(zip(start[low:high], stop[low:high])), least_run, data))
            rows.append((kept.decode("utf-8", "ignore"), len(data), removed, n, hashlib.sha256(kept).hexdigest()))
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, types)]
        return pa.StructArray.from_arrays(columns, ["text_left", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = "struct<text_left: string, n_bytes: long, n_removed: long, n_spans: long, kept_sha256: string>"
    joined = placed.join(repeated_chunks(once, body), "_at", "left")
    none = F.array().cast("array<struct<start: bigint, stop: bigint>>")
    cut_out = F.arrow_udf(run, kind)(body, F.coalesce("_spans", none)).alias("_cut")
    return joined.select("_doc", cut_out).select("_doc", "_cut.*")

"""Exact substring dedup: bytes under a long string that also starts earlier are removed.

1. Anchors. Every string of ``length`` bytes belongs to the first of its 32-byte grams with
   the least hash; which one it is depends on the string alone, so equal strings belong to
   equal grams. A task hands on a gram's hash and a digest of its context: the run of strings
   that belong to it.
2. Groups by gram. Anchors without a partner are dropped. Of equal contexts only the
   earliest matters further; the others lie under earlier strings entirely.
3. Suffix arrays. The different contexts of a gram form a short text whose suffixes are
   sorted by linear grouping (``lyndon``); neighbours that agree in ``length`` bytes are
   equal strings, and all but the earliest start are marked. A gram with very many different
   contexts would not fit a task; its contexts are dealt out string by string instead.
4. Marked strings are merged by document and cut out.

Copies are folded per batch before each shuffle, groups are bounded, and only what is
marked meets the texts, which are shuffled once.

Defined cases: a NULL text is empty; texts shorter than ``length`` lose nothing; rows equal
in id and text are one document and get equal results; different texts of one id are ordered
by a hash; NULL ids come first; other columns pass through; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from feedweave.llm.lyndon import suffix_arrays
from feedweave.llm.ranks import one_of_each, running_sums, whole_row, written
from feedweave.llm.tokens import release, slices
from pyspark.sql import Column, DataFrame, functions as F

LENGTH = 100
GRAM = 32
#: Different contexts of a gram that are sorted in one task.
GROUP_BOUND = 64
#: Anchors of a gram that a task holds at a time.
HELD = 1 << 20
#: Bytes of text whose equal contexts are folded before the shuffle.
FOLDED_BYTES = 1 << 24
#: Bytes whose suffixes are sorted at a time.
SORTED_BYTES = 1 << 20
#: Places of a text that are hashed at a time; a hash gives up so many bits for a place among them.
STRIDE, PLACE_BITS = 1 << 20, 21


def _letters() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def _sliding(op, x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = op(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return op(x[:-rest], x[rest:]) if rest else x


def gram_hashes(data: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes at every place."""
    with np.errstate(over="ignore"):
        h, span, factor = letters[data], 1, np.uint64(0xD6E8FEB86659FD93)
        while span < GRAM:
            h = h[:-span] * factor + h[span:]
            span, factor = span * 2, factor * factor
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(28))


def anchors(data: bytes, length: int, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, counts, hashes): runs of strings of ``length`` bytes whose first least gram is the same one.

    Every string belongs to one run, that of ``count`` strings beginning at ``start`` and so on,
    and to which gram depends on its bytes alone.
    """
    width, n = length - GRAM + 1, len(data)
    found = []
    low = np.uint64((1 << PLACE_BITS) - 1)
    for start in range(0, n - length + 1, STRIDE):
        h = gram_hashes(np.frombuffer(data, np.uint8)[start:start + STRIDE + length - 1], letters)
        least = _sliding(np.minimum, (h & ~low) | np.arange(len(h), dtype=np.uint64), width) & low
        heads = np.append(0, np.flatnonzero(least[1:] != least[:-1]) + 1)
        found.append((heads + start, np.diff(np.append(heads, len(least))), h[least[heads]]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return found[0] if len(found) == 1 else tuple(np.concatenate(c) for c in zip(*found))


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names.split())


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        letters = _letters()
        for batch in (part for batch in batches for part in slices(batch, 1, FOLDED_BYTES)):
            parts = []
            for at, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                starts, counts, hashes = anchors(data, length, letters)
                if not len(starts):
                    continue
                view = memoryview(data)
                stops = (starts + counts + length - 1).tolist()
                digests = np.array([xxh64_intdigest(view[a:b]) for a, b in zip(starts.tolist(), stops)], np.uint64)
                parts.append((hashes, digests, np.full(len(starts), at, np.int64), starts, counts))
            if not parts:
                continue
            gram, digest, at, start, count = (np.concatenate(c) for c in zip(*parts))
            by = np.lexsort((start, at, digest, gram))
            gram, digest, at, start, count = gram[by], digest[by], at[by], start[by], count[by]
            again = np.append(False, (gram[1:] == gram[:-1]) & (digest[1:] == digest[:-1]))
            gram = np.where(again, digest + start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), gram)  # settled; spread
            count = np.where(again, -count, count)
            yield _batch("gram digest at start count", gram.view(np.int64), digest.view(np.int64), at, start, count.astype(np.int32))
        release()

    return run


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new group begins in sorted rows."""
    new = np.zeros(max(len(keys[0]) - 1, 0), bool)
    for key in keys:
        new |= key[1:] != key[:-1]
    return np.append(0, np.flatnonzero(new) + 1)


def _meet(length: int, bound: int, held_most: int):
    """Rows sorted by gram, document, start: stretches that are settled, and contexts still open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stretches(at, start, count, gram=None, many=None):
            none = np.zeros(len(at), np.int64)
            return _batch("at start stop gram many", at, start, start + np.abs(count) + length - 1, none if gram is None else gram, none if many is None else many)

        def settle(gram, digest, at, start, count):
            by = np.lexsort((start, at, digest, gram))
            gram, digest, at, start, count = (c[by] for c in (gram, digest, at, start, count))
            kinds = _starts(gram, digest)
            later = np.ones(len(gram), bool)
            later[kinds] = False
            yield stretches(at[later], start[later], count[later])
            gram, at, start, count = gram[kinds], at[kinds], start[kinds], count[kinds]
            many = np.diff(np.append(_starts(gram), len(gram)))
            many = np.repeat(many, many)
            keep = many > 1
            yield stretches(at[keep], start[keep], count[keep], gram[keep], many[keep])

        def flood(gram, digest, at, start, count):
            return stretches(at, start, count, gram, np.full(len(gram), bound + 1, np.int64))

        held, flooded = None, None
        for batch in batches:
            rows = tuple(c.to_numpy() for c in batch.columns)
            settled = rows[4] < 0
            if settled.any():
                yield stretches(*(c[settled] for c in rows[2:]))
                rows = tuple(c[~settled] for c in rows)
            if held is not None:
                rows = tuple(np.concatenate(pair) for pair in zip(held, rows))
                held = None
            if flooded is not None and len(rows[0]):  # a gram too frequent to be held goes on as it comes
                here = rows[0] == flooded
                if here.any():
                    yield flood(*(c[here] for c in rows))
                    rows = tuple(c[~here] for c in rows)
            if not len(rows[0]):
                continue
            last = _starts(rows[0])[-1]
            if last:
                yield from settle(*(c[:last] for c in rows))
            held = tuple(c[last:] for c in rows)
            if len(held[0]) > held_most:
                flooded = held[0][0]
                yield flood(*held)
                held = None
        if held is not None and len(held[0]):
            yield from settle(*held)
        release()

    return run


def _contexts(length: int, bound: int):
    """Of each open context its bytes, or all strings in it if its gram has too many contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        names = "x y at start settled body"
        for batch in (part for batch in batches for part in slices(batch, 1)):
            keys, ats, starts, bodies, strings = [], [], [], [], []
            lists = batch.column(2)
            gram, begin, end, many = (lists.values.field(k).to_numpy().tolist() for k in range(4))
            ends = lists.offsets.to_numpy().tolist()
            for at, text, low, high in zip(batch.column(0).to_pylist(), batch.column(1), ends, ends[1:]):
                data = text.as_py().encode("utf-8", "surrogatepass")
                single = []
                for k in range(low, high):
                    if many[k] <= bound:
                        keys.append(gram[k])
                        ats.append(at)
                        starts.append(begin[k])
                        bodies.append(data[begin[k]:end[k]])
                    else:
                        single += range(begin[k], end[k] - length + 1)
                if single:
                    digests = b"".join([xxh3_128_digest(data[s:s + length]) for s in single])
                    strings.append((digests, np.full(len(single), at, np.int64), np.array(single, np.int64)))
            if keys:
                n = len(keys)
                yield _batch(names, pa.array(keys, pa.int64()), np.zeros(n, np.int64), pa.array(ats, pa.int64()),
                             pa.array(starts, pa.int64()), np.zeros(n, bool), pa.array(bodies, pa.binary()))
            if strings:
                xy = np.frombuffer(b"".join(s[0] for s in strings), "<i8").reshape(-1, 2)
                at, start = (np.concatenate([s[k] for s in strings]) for k in (1, 2))
                by = np.lexsort((start, at, xy[:, 1], xy[:, 0]))
                x, y, at, start = xy[by, 0], xy[by, 1], at[by], start[by]
                again = np.append(False, (x[1:] == x[:-1]) & (y[1:] == y[:-1]))
                x = np.where(again, x ^ (start << 20) ^ at, x)
                yield _batch(names, x, y, at, start, again, pa.nulls(len(x), pa.binary()))
        release()

    return run


def _merged(at: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    """Strings as spans; those of a document that touch become one."""
    by = np.lexsort((start, at))
    at, start = at[by], start[by]
    if not len(at):
        return _batch("at start stop", at, start, start)
    heads = np.append(0, np.flatnonzero((at[1:] != at[:-1]) | (start[1:] > start[:-1] + length)) + 1)
    tails = np.append(heads[1:], len(at)) - 1
    return _batch("at start stop", at[heads], start[heads], start[tails] + length)


def repeated_strings(group: np.ndarray, at: np.ndarray, start: np.ndarray, bodies: list[bytes], length: int) -> tuple:
    """(document, place) of each string of ``length`` bytes that starts earlier in a body of the same group.

    Rows are sorted by group. The suffixes of each group's bodies are sorted together;
    strings that are equal are neighbours then.
    """
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    data = np.frombuffer(b"".join(bodies), np.uint8)
    begins = np.cumsum(sizes) - sizes
    heads = _starts(group)
    order = suffix_arrays(data, begins[heads])
    body = np.repeat(np.arange(len(bodies)), sizes)
    order = order[order + length <= (begins + sizes)[body[order]]]  # strings do not run into the next body
    if not len(order):
        return at[:0], start[:0]
    which = np.cumsum(np.isin(np.arange(len(bodies)), heads)) - 1  # the group of each body
    owner = which[body[order]]
    same = np.append(False, owner[1:] == owner[:-1])
    rows = np.flatnonzero(same)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray(len(data), "<u8", padded.tobytes(), strides=(1,))
    for step in [*range(0, length - 7, 8), length - 8]:
        equal = words[order[rows] + step] == words[order[rows - 1] + step]
        same[rows[~equal]] = False
        rows = rows[equal]
    document, place = at[body[order]], start[body[order]] + order - begins[body[order]]
    run = np.cumsum(~same) - 1
    by = np.lexsort((place, document, run))
    earliest = np.append(True, run[by][1:] != run[by][:-1])
    first = by[earliest]
    later = (document != document[first][run]) | (place != place[first][run])
    return document[later], place[later]


def _repeats(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sort(rows):
            x, at, start = (np.concatenate([r[k] for r in rows]) for k in (0, 2, 3))
            return _merged(*repeated_strings(x, at, start, [b for r in rows for b in r[5]], length), length)

        waiting, size, last, single = [], 0, None, None
        for batch in batches:
            x, y, at, start, settled = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:5])
            whole = batch.column(5).is_valid().to_numpy(zero_copy_only=False)
            done = ~whole & settled
            strings = np.flatnonzero(~whole & ~settled)
            if len(strings):  # sorted by digest, document, place: the first one of a digest stays
                keys = np.stack([x[strings], y[strings]], 1)
                again = np.append(single is not None and bool((keys[0] == single).all()), (keys[1:] == keys[:-1]).all(1))
                done[strings[again]] = True
                single = keys[-1]
            if done.any():
                yield _merged(at[done], start[done], length)
            rows = np.flatnonzero(whole)
            if not len(rows):
                continue
            bodies = batch.column(5).take(pa.array(rows)).to_pylist()
            x, y, at, start = x[rows], y[rows], at[rows], start[rows]
            if size > SORTED_BYTES and x[0] != last:
                yield sort(waiting)
                waiting, size = [], 0
            elif size > SORTED_BYTES:  # up to the end of the group that goes on
                upto = int(np.argmax(np.append(x != last, True)))
                if upto < len(x):
                    waiting.append((x[:upto], y[:upto], at[:upto], start[:upto], None, bodies[:upto]))
                    yield sort(waiting)
                    waiting, size = [], 0
                    x, y, at, start, bodies = x[upto:], y[upto:], at[upto:], start[upto:], bodies[upto:]
            waiting.append((x, y, at, start, None, bodies))
            size += sum(map(len, bodies))
            last = x[-1]
        if waiting:
            yield sort(waiting)
            waiting.clear()
        release()

    return run


def ordered_documents(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(_at, _doc) of every row, and of one row for each _at.

    ``_at`` is a number in the documents' order, which is the id itself if ids are unique.
    Repeats are looked for among the second: a repeated row is no copy of an earlier document.
    """
    row = whole_row(docs).alias("_doc")
    ids = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("hash"))
    if not ids.groupBy("id").count().filter("id IS NULL OR count > 1").take(1):
        single = docs.select(F.col(doc_id).cast("long").alias("_at"), row)
        return single, single
    placed = running_sums(ids.distinct().withColumn("one", F.lit(1)), [], ["id", "hash"], ["one"], "substrings-order")
    rows = docs.select(row, F.col(doc_id).cast("long").alias("_id"), F.xxhash64(F.col(text)).alias("_hash"))
    same = F.col("_id").eqNullSafe(F.col("id")) & (F.col("_hash") == F.col("hash"))
    every = rows.join(placed, same).select(F.col("before_one").alias("_at"), "_doc")
    return every, one_of_each(every, "_at")


def spans(docs: DataFrame, text: Column, length: int = LENGTH, bound: int = GROUP_BOUND, held: int = HELD) -> DataFrame:
    """(_at, spans): by document, the stretches [start, stop) to remove. ``docs`` has _at, each once, and the text's struct."""
    texts = docs.select("_at", text.alias("_text"))
    found = texts.mapInArrow(_anchor_rows(length), "gram long, digest long, at long, start long, count int")
    by_gram = found.repartition("gram").sortWithinPartitions("gram", "at", "start")
    met = by_gram.mapInArrow(_meet(length, bound, held), "at long, start long, stop long, gram long, many long")
    met = written(met, "substrings-met", release=True)
    opened = met.filter("many > 0").groupBy(F.col("at").alias("_at")).agg(
        F.collect_list(F.struct("gram", "start", "stop", "many")).alias("opened"),
    )
    held_open = docs.join(opened, "_at").select("_at", text.alias("_text"), "opened")
    dealt = held_open.mapInArrow(_contexts(length, bound), "x long, y long, at long, start long, settled boolean, body binary")
    dealt = dealt.repartition("x").sortWithinPartitions("x", "y", "at", "start")
    later = written(dealt.mapInArrow(_repeats(length), "at long, start long, stop long"), "substrings-later", release=True)
    every = met.filter("many = 0").select("at", "start", "stop").unionByName(later)
    return every.groupBy(F.col("at").alias("_at")).agg(F.collect_list(F.struct("start", "stop")).alias("_spans"))


def cut(data: bytes, found: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, maximal removed runs)."""
    runs: list[list[int]] = []
    for start, stop in sorted((max(a, 0), min(b, len(data))) for a, b in found):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop)
        else:
            runs.append([start, stop])
    edges = [0, *(edge for run in runs for edge in run), len(data)]
    kept = b"".join([data[a:b] for a, b in zip(edges[::2], edges[1::2])])
    return kept, len(data) - len(kept), len(runs)


def _cutting(with_text: bool):
    """(text, spans) to what is left of it and counts; the text left has whole characters only."""
    kind = "struct<kept: string, n_bytes: long, n_removed: long, n_spans: long, kept_sha256: string>"

    def run(texts: pa.Array, spans: pa.Array) -> pa.Array:
        ends = spans.offsets.to_numpy().tolist()
        start, stop = (spans.values.field(k).to_numpy().tolist() for k in range(2))
        rows = []
        for text, low, high in zip(texts, ends, ends[1:]):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass")
            kept, removed, runs = cut(data, list(zip(start[low:high], stop[low:high])))
            sha = hashlib.sha256(kept).hexdigest()
            rows.append((kept.decode("utf-8", "ignore") if with_text and removed else None, len(data), removed, runs, sha))
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, types)]
        return pa.StructArray.from_arrays(columns, ["kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return F.arrow_udf(run, kind)


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = False, **bounds) -> DataFrame:
    """(_doc, kept, n_bytes, n_removed, n_spans, kept_sha256): each row and counts.

    ``kept`` holds what is left of texts that lost any, if ``with_text`` is set; a character cut in two goes.
    """
    placed, once = ordered_documents(docs, doc_id, text)
    body = F.col("_doc")[text]
    joined = placed.join(spans(once, body, **bounds), "_at", "left")
    none = F.array().cast("array<struct<start: bigint, stop: bigint>>")
    cut_out = _cutting(with_text)(body, F.coalesce("_spans", none)).alias("_cut")
    return joined.select("_doc", cut_out).select("_doc", "_cut.*")


def remaining(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **bounds) -> DataFrame:
    """``docs`` with the text that is left; a character cut in two goes, and so may whole texts, to ''.

    A column ``n_chars`` is brought in line with the text.
    """
    cut = deduplicated(docs, doc_id, text, with_text=True, **bounds)
    left = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("_doc")[text])
    cut = cut.select("_doc", left.alias("_left"))
    new = {text: F.col("_left"), "n_chars": F.char_length("_left")}
    return cut.select([
        new[f.name].cast(f.dataType).alias(f.name) if f.name in new else F.col("_doc")[f.name].alias(f.name)
        for f in docs.schema
    ])


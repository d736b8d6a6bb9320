"""Best-fit packing of token sequences with a linear grouping scheme.

Only lengths matter, so the packing is planned on their histogram, which has ``capacity``
entries however large the corpus is: large lengths are sorted, cut into groups of equal
cardinality and rounded up to the largest of their group; configurations of the few sizes
left are optimised by column generation; actual lengths take the places of the rounded ones,
which leaves some room. Configurations that leave too much of it are loosened, and their lengths
are grouped anew, in finer groups as they are fewer, in further rounds; what is left over and the
small lengths go best-fit into the room.
The plan is a list of runs ("ranks from .. of this length go to these sequences at this
offset"). Pieces get their rank within their length by distributed running sums, and each
task looks its pieces' runs up.

Defined cases: a NULL or empty text is the end id alone; repeated rows and equal ids are
packed one by one (in any order among equal rows); an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa

from feedweave.llm.ranks import running_sums, written
from feedweave.llm.tokens import ENCODED_BYTES, release, shared_encoder, slices
from pyspark.sql import DataFrame, functions as F

CAPACITY = 1024
END_ID = 2
#: Groups of equal cardinality.
GROUPS = 96
#: Lengths up to this share of the capacity are small.
SMALL = 1 / 8
#: Rounds of grouping: the room, as a share of the capacity, that a configuration may leave once actual lengths are in place.
#: Schedules of rounds, tried in turn until the sequences are NEAR enough to the lower bound: later ones leave more to best-fit.
SCHEDULES = (
    (*[1 / 128] * 4, *[1 / 64] * 4, *[1 / 32] * 2),
    (*[1 / 256] * 6, *[1 / 128] * 4),
    (*[1 / 512] * 6, *[1 / 256] * 2),
)
NEAR = 1.004
RANK_BITS = 42
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32. The first piece takes the odd length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in (part for batch in batches for part in slices(batch, 1, ENCODED_BYTES)):
            rows = []
            for doc, found in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1))):
                ids = bytes(found) + end
                n = len(ids) // 4
                start, upto, piece = 0, (n - 1) % capacity + 1, 0
                while start < n:
                    rows.append((doc, piece, start, upto - start, zlib.crc32(ids[4 * start:4 * upto])))
                    start, upto, piece = upto, upto + capacity, piece + 1
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])
        encoder.forget()  # other stages follow
        release()

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, PIECE)


def _knapsack(values: np.ndarray, sizes: list[int], capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of greatest value: how many of each size, at most ``capacity`` in all."""
    best = np.zeros(capacity + 1)
    steps = []
    for k in np.argsort(-values / np.array(sizes), kind="stable"):
        if values[k] <= 1e-12:
            continue
        size, copies, top = sizes[k], 0, best
        chosen = np.zeros(capacity + 1, np.int16)
        while (copies := copies + 1) * size <= capacity:
            offer = np.full(capacity + 1, -1.0)
            offer[copies * size:] = best[:capacity + 1 - copies * size] + copies * values[k]
            better = offer > top + 1e-12
            top = np.where(better, offer, top)
            chosen[better] = copies
        steps.append((k, chosen))
        best = top
    counts, room = np.zeros(len(sizes), np.int64), capacity
    for k, chosen in reversed(steps):
        counts[k] = chosen[room]
        room -= chosen[room] * sizes[k]
    return best[capacity], counts


def configurations(sizes: list[int], counts: list[int], capacity: int, rounds: int = 4000) -> list[tuple[int, np.ndarray]]:
    """(times, how many of each size): the linear programme's optimum, rounded down."""
    n, need = len(sizes), np.array(counts, float)
    columns = np.diag([capacity // s for s in sizes]).astype(float)
    inverse = np.linalg.inv(columns)
    times = inverse @ need
    for turn in range(rounds):
        value, new = _knapsack(np.ones(n) @ inverse, sizes, capacity)
        if value <= 1 + 1e-7:
            break
        move = inverse @ new
        ratios = np.where(move > 1e-9, times / np.where(move > 1e-9, move, 1), np.inf)
        out = int(np.argmin(ratios))
        columns[:, out] = new
        if turn % 50 == 49:  # rounding errors do not add up
            inverse = np.linalg.inv(columns)
            times = np.maximum(inverse @ need, 0)
            continue
        pivot = inverse[out] / move[out]
        inverse = inverse - np.outer(move, pivot)
        inverse[out] = pivot
        times = np.maximum(times - move * ratios[out], 0)
        times[out] = ratios[out]
    whole, left, result = np.floor(times + 1e-9).astype(np.int64), np.array(counts, np.int64), []
    for k in np.argsort(-whole, kind="stable"):
        used = columns[:, k].round().astype(np.int64)
        most = min([left[j] // used[j] for j in np.flatnonzero(used)], default=0)
        if (take := int(min(whole[k], most))) > 0:
            left -= take * used
            result.append((take, used))
    return result


class _Bins:
    """Kinds of sequences: how many, and what lies in them; found by the room left."""

    def __init__(self):
        self.rooms: list[int] = []
        self.by_room: dict[int, list[tuple[int, tuple]]] = {}

    def add(self, times: int, room: int, items: tuple) -> None:
        if times:
            if room not in self.by_room:
                insort(self.rooms, room)
                self.by_room[room] = []
            self.by_room[room].append((times, items))

    def tightest(self, length: int) -> tuple[int, int, tuple] | None:
        k = bisect_left(self.rooms, length)
        if k == len(self.rooms):
            return None
        room = self.rooms[k]
        times, items = self.by_room[room].pop()
        if not self.by_room[room]:
            del self.by_room[room]
            self.rooms.pop(k)
        return times, room, items


def _grouped(left: dict[int, int], capacity: int, groups: int) -> list[tuple[int, tuple]]:
    """(times, items): configurations of large lengths, actual ones in place of the rounded ones."""
    large = [(length, left[length]) for length in sorted(left, reverse=True) if length > capacity * SMALL]
    total = sum(n for _, n in large)
    if not total:
        return []
    runs: dict[int, list[list[int]]] = {}  # rounded size: its actual lengths, as [length, how many]
    per_group, filled, size = -(-total // groups), 0, 0
    for length, n in large:
        while n:
            if filled % per_group == 0:
                size = length
            take = min(n, per_group - filled % per_group)
            runs.setdefault(size, []).append([length, take])
            filled, n = filled + take, n - take
    sizes, result = sorted(runs, reverse=True), []
    for times, used in configurations(sizes, [sum(n for _, n in runs[s]) for s in sizes], capacity):
        kinds = [(times, ())]
        for s in [s for s, n in zip(sizes, used) for _ in range(n)]:
            after = []
            for many, items in kinds:
                while many:
                    run = runs[s][0]
                    take = min(many, run[1])
                    after.append((take, (*items, (run[0], 1))))
                    run[1] -= take
                    many -= take
                    if not run[1]:
                        runs[s].pop(0)
            kinds = after
        result += kinds
    return result


def configured(
    counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, rounds: Sequence[float] = SCHEDULES[0],
) -> tuple[list[tuple[int, tuple]], dict[int, int]]:
    """(times, items): the configurations of all rounds that leave little enough room, and the lengths that none holds."""
    left, kinds = dict(counts), []
    for slack in rounds:
        for times, items in _grouped(left, capacity, groups):
            if capacity - sum(length for length, _ in items) <= capacity * slack:
                kinds.append((times, items))
                for length, _ in items:
                    left[length] -= times
        left = {length: n for length, n in left.items() if n}
    return kinds, left


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[int, list[tuple[int, int]]]]:
    """(times, [(length, copies), ...]): kinds of sequences that hold all lengths of the histogram."""
    least = sum(length * n for length, n in histogram.items() if n > 0) / capacity
    best: list[tuple[int, list[tuple[int, int]]]] = []
    fewest = math.inf
    for rounds in SCHEDULES:
        made = _planned(histogram, capacity, groups, rounds)
        used = sum(times for times, _ in made)
        if used < fewest:
            best, fewest = made, used
        if fewest <= NEAR * least:
            break
    return best


def _planned(histogram: dict[int, int], capacity: int, groups: int, rounds: Sequence[float]) -> list[tuple[int, list[tuple[int, int]]]]:
    counts, bins = {length: n for length, n in histogram.items() if n > 0}, _Bins()
    bins.add(counts.pop(capacity, 0), 0, ((capacity, 1),))
    kinds, left = configured(counts, capacity, groups, rounds)
    for times, items in kinds:
        bins.add(times, capacity - sum(length for length, _ in items), items)
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            found = bins.tightest(length)
            times, room, items = found or (n, capacity, ())
            copies = min(room // length, n)
            used = min(times, n // copies)
            bins.add(used, room - copies * length, (*items, (length, copies)))
            if found:
                bins.add(times - used, room, items)
            n -= used * copies
    return [(times, list(items)) for some in bins.by_room.values() for times, items in some]


def runs(kinds: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, copies, first sequence, offset), sorted by length and rank."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for times, items in kinds:
        offset = 0
        for length, copies in items:
            rank = ranks.get(length, 0)
            rows.append((length, rank, copies, sequence, offset))
            ranks[length] = rank + times * copies
            offset += length * copies
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def packed(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with its sequence_id and offset; no sequence is longer than ``capacity``."""
    cut = written(pieces(docs, tokenizer, doc_id, text, capacity), "packing-pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    table = runs(plan(histogram, capacity))
    ordered = running_sums(cut.withColumn("_one", F.lit(1)), ["length"], ["doc_id", "piece", "ids_crc32"], ["_one"], "packing-order")
    starts = (table[:, 0] << RANK_BITS) + table[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(), rank.to_numpy()
        row = table[np.searchsorted(starts, (length << RANK_BITS) + rank, "right") - 1]
        ahead = rank - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 3] + ahead // row[:, 2], "offset": row[:, 4] + ahead % row[:, 2] * length})

    placed = ordered.withColumn("_at", place("length", "before__one"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "_at.sequence_id", "_at.offset")

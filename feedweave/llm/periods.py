"""Periodic runs of words, found with a dictionary of basic factors.

Basic factors are the stretches of 1, 2, 4, 8, ... words. A factor's name at each length is that of
its two halves, so one sort per length names them all, for many texts at once; a factor that occurs
once in its text has no successor, and neither has any that begins with it, so only the others go on
to the next length. Where an occurrence and the next two lie at equal distances of at most twice the
factor's length, they are an arithmetic progression whose difference is proposed as a period. A run
of period q shows in the first factors of at least q words: there the successor is exactly q words
off, as the period is primitive, and a run of four periods holds three of them. Proposals are
extended word by word to both sides, and those that reach the same run become one.

Each text is treated by itself where its row is, so nothing is shuffled; a task holds a slice of
about SLICE_BYTES of texts, or one longer text.

Defined cases: NULL and texts without words have no runs and collapse to ''; ids play no part, so
NULL, equal and repeated ones stay rows of their own; other columns pass through, whatever their
names, beside the nested result; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from feedweave.llm.tokens import release, slices
from pyspark.sql import Column, DataFrame, functions as F, types as T

LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Comparisons of words made at a time while proposals are extended.
COMPARED = 1 << 21
FOUND = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _reach(word: np.ndarray, at: np.ndarray, period: np.ndarray, step: int, room: np.ndarray) -> np.ndarray:
    """How many words in a row from ``at`` on, going by ``step``, equal the one a period later; at most ``room``."""
    reached, active, width = np.zeros(len(at), np.int64), np.flatnonzero(room > 0), 8
    while len(active):
        width = min(width * 2, max(COMPARED // len(active), 1))
        ahead = reached[active, None] + np.arange(width)
        inside = ahead < room[active, None]
        place = at[active, None] + step * np.where(inside, ahead, 0)
        equal = (word[place] == word[place + period[active, None]]) & inside
        run = np.where(equal.all(1), width, np.argmin(equal, 1))
        reached[active] += run
        active = active[run == width]
    return reached


def proposals(word: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period): the leftmost place of each stretch of progressions, for each factor length."""
    n = len(word)
    at, name, length = np.arange(n), np.full(n, -1, np.int64), 1
    key = owner * (int(word.max(initial=0)) + 1) + word
    while len(at) > 2:
        by = np.argsort(key, kind="stable")
        key, place = key[by], at[by]
        same, off = key[1:] == key[:-1], np.diff(place)
        first, d = place[:-2], off[:-1]
        three = same[:-1] & same[1:] & (d == off[1:]) & (d <= 2 * length) & (2 * d > length)
        first, d = first[three], d[three]
        if len(first):
            by = np.lexsort((first, d))
            first, d = first[by], d[by]
            heads = np.append(True, (d[1:] != d[:-1]) | (first[1:] != first[:-1] + 1))
            yield first[heads], d[heads]
        again = np.append(False, same) | np.append(same, False)
        names = np.cumsum(np.append(True, ~same))
        name.fill(-1)
        name[place[again]] = names[again]
        at = np.flatnonzero(name >= 0)
        at = at[at + length < n]
        mate = at + length
        at = at[(name[mate] >= 0) & (owner[mate] == owner[at])]
        key = name[at] * (len(names) + 1) + name[at + length]
        length *= 2


def find_runs(
    word: np.ndarray, sizes: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run of the texts, in order; starts count from the first text's first word.

    ``word`` holds numbers that stand for the words, text behind text, ``sizes`` how many each text has.
    """
    if least_periods < 4:
        raise ValueError("a progression of three occurrences needs runs of four periods at least")
    owner = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    found = []
    for place, period in proposals(word, owner):
        end = ends[owner[place]]
        right = _reach(word, place, period, 1, end - period - place)
        left = _reach(word, place - 1, period, -1, place - (end - sizes[owner[place]]))
        length = left + right + period
        kept = length >= np.maximum(least_words, least_periods * period)
        found.append(np.stack([place - left, period, length])[:, kept])
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, period, length = np.unique(np.concatenate(found, axis=1), axis=1)
    return start, length, period


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one behind the other, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    values = lists.flatten()
    filled = pc.greater(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    if not filled.all():
        values, owner = values.filter(pa.array(filled)), owner[filled]
    return values, np.bincount(owner, minlength=len(texts))


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), values)


def collapsed_runs(texts: pa.Array, least_words: int, least_periods: int) -> pa.StructArray:
    """n_words, runs, and the text without what repeats a run's first period, words joined by spaces."""
    words, sizes = words_of(texts)
    word = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    start, length, period = find_runs(word, sizes, least_words, least_periods)
    ends = np.cumsum(sizes)
    owner = np.searchsorted(ends, start, "right")
    steps = np.zeros(len(word) + 1, np.int64)
    np.add.at(steps, start + period, 1)
    np.add.at(steps, start + length, -1)
    kept = np.cumsum(steps)[:-1] == 0
    runs = pa.StructArray.from_arrays(
        [pa.array(start - (ends - sizes)[owner]), pa.array(length), pa.array(period)], ["start", "length", "period"],
    )
    count = np.append(0, np.cumsum(kept))
    whole = count[ends] - count[ends - sizes]
    left = pc.binary_join(_lists(words if kept.all() else words.filter(pa.array(kept)), whole), " ")
    columns = [pa.array(sizes.astype(np.int64)), _lists(runs, np.bincount(owner, minlength=len(sizes))), left]
    return pa.StructArray.from_arrays(columns, ["n_words", "runs", "collapsed"])


def periodic_runs(
    docs: DataFrame, text: Column, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """(_doc, n_words, runs, collapsed) for every row: ``_doc`` is the row itself, or its columns ``keep``.

    A run is a stretch of words that repeat with a smallest period, of ``least_words`` words and
    ``least_periods`` periods at least, that cannot be extended. ``runs`` is ordered by start, then
    period; ``collapsed`` leaves out what any run holds behind its first period.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in slices(batch, 1)):
            found = collapsed_runs(batch.column(1), least_words, least_periods)
            yield pa.RecordBatch.from_arrays([batch.column(0), *found.flatten()], ["_doc", "n_words", "runs", "collapsed"])
        release()

    names = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"), text.alias("_text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["_doc"], *T.StructType.fromDDL(FOUND).fields]))

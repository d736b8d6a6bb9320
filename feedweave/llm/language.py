"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram binds its letters' vectors, permuted
by place, by multiplication; a text bundles (adds up) its trigrams; a language's prototype
bundles all its texts. A text has the language whose prototype is nearest by cosine.

Training adds up trigram counts by language before any vector is made, so what reaches the
driver is one vector per language.

Defined cases: NULL and letterless texts are ``und`` with score 0, as is everything if
nothing could be learned; a NULL language teaches nothing; equal cosines go to the first
language by name; repeated rows count as often as they occur; an empty table gives an empty
result. Other columns than those named take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import Column, DataFrame, functions as F

DIMENSIONS = 512
#: Symbols: a gap, a to z, and other letters by a hash.
SYMBOLS = 128
SEED = 20
#: Characters treated at a time.
STRIDE = 1 << 20
#: Trigrams whose vectors a task keeps.
KEPT = 40_000
UNKNOWN = "und"


class Profiles:
    """Trigram counts and bundled vectors of texts, inside a task."""

    def __init__(self):
        self._letter = np.array([chr(c).isalpha() for c in range(0x10000)])
        signs = np.random.Generator(np.random.PCG64(SEED)).integers(0, 2, (SYMBOLS, DIMENSIONS)) * 2 - 1
        third = signs.astype(np.int8)
        self._places = np.roll(third, 2, axis=1), np.roll(third, 1, axis=1), third
        self._row = np.full(SYMBOLS**3, -1, np.int32)
        self._rows = np.empty((KEPT, DIMENSIONS), np.float32)
        self._used = 0

    def _symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = self._letter[np.minimum(points, 0xFFFF)]
        for k in np.flatnonzero(points > 0xFFFF):
            letter[k] = chr(points[k]).isalpha()
        other = 27 + (points * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(SYMBOLS - 27)
        return np.where(letter, np.where((points >= 97) & (points <= 122), points - 96, other), 0).astype(np.int64)

    def trigrams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(codes, counts) over the text's letters, every run of other characters being one gap."""
        text, held, codes, counts = text or "", np.zeros(1, np.int64), [], []
        for at in range(0, len(text), STRIDE):
            last = at + STRIDE >= len(text)
            s = np.concatenate([held, self._symbols(text[at:at + STRIDE]), np.zeros(int(last), np.int64)])
            s = s[np.append(True, (s[1:] != 0) | (s[:-1] != 0))]
            if len(s) > 2:
                found = np.unique((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], return_counts=True)
                codes.append(found[0])
                counts.append(found[1])
            held = s[-2:]
        if len(codes) == 1:
            return codes[0], counts[0]
        if not codes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return summed(np.concatenate(codes), np.concatenate(counts))

    def _bound(self, codes: np.ndarray) -> np.ndarray:
        a, b, c = self._places
        return a[codes // SYMBOLS**2] * b[codes // SYMBOLS % SYMBOLS] * c[codes % SYMBOLS]

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if len(codes) > KEPT:  # a text with very many trigrams goes part by part
            return sum(self.bundle(codes[k:k + KEPT], counts[k:k + KEPT]) for k in range(0, len(codes), KEPT))
        rows = self._row[codes]
        new = codes[rows < 0]
        if len(new):
            if self._used + len(new) > KEPT:
                self._row[:], self._used, new = -1, 0, codes
            self._rows[self._used:self._used + len(new)] = self._bound(new)
            self._row[new] = np.arange(self._used, self._used + len(new))
            self._used += len(new)
            rows = self._row[codes]
        return counts.astype(np.float32) @ self._rows[rows]


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, where = np.unique(codes, return_inverse=True)
    return unique, np.bincount(where, counts, len(unique)).astype(np.int64)


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """The prototype of each language of ``labelled``; rows without a language are ignored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles()
        for batch in batches:
            found: dict[str, list] = {}
            for language, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                found.setdefault(language, []).append(profiles.trigrams(words.as_py()))
            for language, each in found.items():
                codes, counts = summed(*(np.concatenate(x) for x in zip(*each)))
                columns = [pa.array([language] * len(codes), pa.string()), pa.array(codes), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "code", "n"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles, totals = Profiles(), {}
        for batch in batches:
            codes, counts = (batch.column(k).to_numpy() for k in (1, 2))
            languages = np.array(batch.column(0).to_pylist(), object)
            for language in set(languages.tolist()):
                mine = languages == language
                for k in range(0, int(mine.sum()), 4096):
                    bound = profiles._bound(codes[mine][k:k + 4096]).astype(np.int64)
                    part = counts[mine][k:k + 4096].astype(np.int64) @ bound
                    totals[language] = totals.get(language, 0) + part
        for language, total in totals.items():
            columns = [pa.array([language] * DIMENSIONS, pa.string()), pa.array(range(DIMENSIONS), pa.int32()), pa.array(total)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "d", "v"])

    known = labelled.filter(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counts = known.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    parts = counts.mapInArrow(add_up, "lang string, d int, v long")
    rows = parts.groupBy("lang", "d").agg(F.sum("v").alias("v")).collect()  # one vector per language
    prototypes: dict[str, np.ndarray] = {}
    for row in rows:
        prototypes.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["d"]] = row["v"]
    return {language: v / np.linalg.norm(v) for language, v in sorted(prototypes.items()) if v.any()}


def predicted(docs: DataFrame, prototypes: dict[str, np.ndarray], *columns: str | Column, text: str = "text") -> DataFrame:
    """``columns`` of ``docs`` with lang_pred and score, the cosine clipped to 0 to 1."""
    languages = list(prototypes)
    matrix = np.array([prototypes[x] for x in languages], np.float32).reshape(len(languages), DIMENSIONS)

    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        profiles = Profiles()
        for texts in parts:
            best = []
            for words in texts:
                codes, counts = profiles.trigrams(words)
                if not len(codes) or not len(languages):
                    best.append((UNKNOWN, 0.0))
                    continue
                v = profiles.bundle(codes, counts)
                cosines = matrix @ v / max(float(np.linalg.norm(v)), 1e-9)
                k = int(np.argmax(cosines))
                best.append((languages[k], min(max(float(cosines[k]), 0.0), 1.0)))
            yield pd.DataFrame(best, columns=["lang_pred", "score"])

    return docs.select(*columns, predict(F.col(text)).alias("_best")).select("*", "_best.*").drop("_best")

"""Periodic runs against a search of every stretch, on made texts and on the given table."""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from llm_data import WORDS, empty, odd, odd_rows
from pyspark.sql import functions as F

from feedweave.llm import periods, queries


def runs_of(words, least_words=6, least_periods=4):
    """(start, length, period) of the maximal runs: every period, every stretch of words equal to those a period later."""
    found, n = [], len(words)
    for q in range(1, n // least_periods + 1):
        k = 0
        while k + q < n:
            if words[k] != words[k + q]:
                k += 1
                continue
            end = k
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - k + q
            stretch = words[k:k + length]
            smallest = not any(all(stretch[i] == stretch[i + p] for i in range(length - p)) for p in range(1, q))
            if length >= max(least_words, least_periods * q) and smallest:
                found.append((k, length, q))
            k = end
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    dropped = {k for start, length, q in found for k in range(start + q, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in dropped)


def check(texts, least_words=6, least_periods=4):
    got = periods.collapsed_runs(pa.array(texts, pa.string()), least_words, least_periods).to_pylist()
    for text, row in zip(texts, got, strict=True):
        words = WORDS.findall(text or "")
        found = runs_of(words, least_words, least_periods)
        assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == found, text
        assert (row["n_words"], row["collapsed"]) == (len(words), collapsed(words, found))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab c", max_size=60), max_size=6))
def test_equals_brute_force_on_small_alphabets(texts):
    check(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcdefg"), min_size=1, max_size=9), st.integers(1, 9)), max_size=6), st.integers(0, 2))
def test_equals_brute_force_on_loops_within_loops(parts, again):
    words = [w for loop, times in parts for w in loop * times]
    check([" ".join(words * (1 + 3 * again)), None, "x"])


def test_odd_texts():
    check(["", None, "  ", "a", "a " * 5, "a " * 6, "\ta\na\x0ba\x0ca\ra a\t", "a a a a", "é é é é é é é é", "a\x1ca " * 7, "b " + "a b " * 500])
    check([" ".join("abcde" * 5) + " abcd", " ".join("abc" * 4)], least_words=1, least_periods=5)
    check([])


def test_compared_in_small_steps(monkeypatch):
    monkeypatch.setattr(periods, "COMPARED", 3)
    check(["x " + "a b c " * 90 + "y", "q " * 77, "a b " * 30 + "a c " * 30])


def test_fewer_than_four_periods_are_refused():
    with pytest.raises(ValueError):
        periods.find_runs(np.zeros(3, np.int64), np.array([3]), 6, 3)


def test_odd_and_empty_tables(spark):
    found = periods.periodic_runs(odd(spark), F.col("text")).select("_doc.*", F.col("runs").alias("r"), F.col("collapsed").alias("left")).collect()
    assert len(found) == len(odd_rows())
    for row in found:
        words = WORDS.findall(row["text"] or "")
        runs = runs_of(words) if len(words) < 3000 else []
        assert [tuple(r) for r in row["r"]] == runs and row["left"] == collapsed(words, runs)
    assert periods.periodic_runs(empty(spark), F.col("text")).count() == 0


def edited(doc_id, text):
    words = WORDS.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_op11_equals_brute_force(spark, sf_dir):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    expected = {}
    for doc_id, text in rows:
        words = edited(doc_id, text)
        numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
        found = fast_runs(np.array([numbers[w] for w in words], np.int64))
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        expected[doc_id] = (
            len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, found).encode()).hexdigest(),
        )
    columns = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {r["doc_id"]: tuple(r[c] for c in columns) for r in queries.QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    assert got == expected and sum(r[0] > 0 for r in got.values()) > len(rows) / 20


def fast_runs(word):
    """Every period by itself, with the stretches of equal words found at once; a divisor's run hides its multiples."""
    found, n = [], len(word)
    for q in range(1, n // 4 + 1):
        equal = np.concatenate([[False], word[:-q] == word[q:], [False]]).astype(np.int8)
        edges = np.flatnonzero(np.diff(equal))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = b - a + q
            if length >= max(6, 4 * q) and not any(s <= a and a + length <= s + m and q % p == 0 for s, m, p in found):
                found.append((a, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))

"""Conversation repair against an automaton that knows no alignment, in blocks and whole, and on the given table."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import duckdb
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from feedweave.llm import queries, repair, turns

SCHEMA = "conv_id long, turn long, role string, text string, place int, _conv string, k int, audit int, digest string, `a.b` int"
WHITE = " \t\n\x0b\x0c\r"


def cheapest(codes):
    """(cost, audit) by states of the grammar: of each turn and state the least rest, audits compared as text."""

    @cache
    def rest(i, state, inserts):
        offers = [(0, "")] if i == len(codes) and state in (0, 3) else []
        behind = 3 if state == 2 else 2
        if i < len(codes):
            code = codes[i]
            offers.append(add(2, "D", rest(i + 1, state, 0)))
            if not code & 4:
                open_end = 5 if code & 8 else 0
                if code & 3 == 0 and state == 0:
                    offers.append(add(open_end, "K", rest(i + 1, 1, 0)))
                fits = code & 3 == behind - 1
                offers.append(add(open_end + (not fits), "K" if fits else "R", rest(i + 1, behind, 0)))
        if inserts < 4:
            offers.append(add(5, "I", rest(i, behind, inserts + 1)))
        return min((x for x in offers if x is not None), default=None)

    def add(cost, edit, found):
        return found and (found[0] + cost, edit + found[1])

    return rest(0, 0, 0)


def put_together(codes, size):
    cut = [codes[k:k + size] for k in range(0, len(codes), size)]
    chosen = turns.compose([turns.align(x, k == 0, k == len(cut) - 1) for k, x in enumerate(cut)])
    assert [len(e) for e in (turns.edits(x, before, audit) for x, (before, _, audit) in zip(cut, chosen))] == [len(a) for _, _, a in chosen]
    return sum(cost for _, cost, _ in chosen), "".join(audit for _, _, audit in chosen)


codes_of = st.lists(st.sampled_from([0, 1, 2, 3, 1, 2, 4, 5, 6, 8, 9, 10, 11]), min_size=1, max_size=14)


@settings(max_examples=400, deadline=None)
@given(codes_of, st.integers(1, 5))
def test_least_cost_and_audit_whole_and_in_blocks(codes, size):
    expected = cheapest(tuple(codes))
    assert put_together(codes, len(codes)) == expected
    assert put_together(codes, size) == expected


@pytest.mark.parametrize("n", [90, 300])
def test_long_conversations_in_blocks(n):
    rng = random.Random(n)
    codes = [rng.choice([1, 2]) | (4 if rng.random() < 0.1 else 0) | (8 if rng.random() < 0.2 else 0) for _ in range(n)]
    expected = cheapest(tuple(codes))
    assert put_together(codes, n) == put_together(codes, 7) == put_together(codes, 64) == expected


def repair_rows(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, text) of a conversation's rows (turn, role, text) in order."""
    seen, codes, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        code = "sua".find(role[:1]) if role else 3
        code = 3 if code < 0 else code
        solid = text.strip(WHITE)
        if not solid:
            counts[0], code = counts[0] + 1, code | 4
        elif (role, text) in seen:
            counts[1], code = counts[1] + 1, code | 4
        elif solid[-1] not in ".!?":
            counts[2], code = counts[2] + 1, code | 8
        seen.add((role, text))
        codes.append(code)
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = cheapest(tuple(codes))
    lines, at, placed = [], 0, 0
    kept = sum(e != "D" for e in audit)
    for edit in audit:
        if edit != "D":
            role = "system" if kept % 2 and placed == 0 else ("user", "assistant")[(placed - kept % 2) % 2]
            lines.append(f"{rows[at][1]}:{rows[at][2]}" if edit == "K" else f"{role}:{rows[at][2] if edit == 'R' else ''}")
            placed += 1
        at += edit != "I"
    return gaps, *counts, illegal, cost, audit, "\n".join(lines)


def odd_rows():
    rng, rows = random.Random(7), []
    roles, texts = ["user", "assistant", "system", "tool", "", None, "User", "sys", "a"], ["Yes.", "No", "", None, " \n", "Well? ", "é!\x1c", "so ...\t", "?"]
    for conv in [None, *range(30)]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, None if rng.random() < 0.1 else turn * rng.choice([1, 1, 2]), rng.choice(roles), rng.choice(texts)))
    rows += [(77, t, ("user", "assistant")[t % 2], f"Turn {t}." if t % 11 else "Cut") for t in range(400)]
    rows += rows[:5]
    return rows


def expected_of(rows, order):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {conv: repair_rows(sorted(its, key=order)) for conv, its in by.items()}


@pytest.mark.parametrize("block", [3, repair.BLOCK])
def test_odd_tables(spark, block):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 1, "c", 2, 3, "d", 4) for r in rows], SCHEMA).repartition(3)
    found = repair.repaired(df, block=block)
    hashes = {(r["r"], r["t"]): r["h"] for r in spark.createDataFrame(
        {(" " if r[2] is None else r[2], " " if r[3] is None else r[3]) for r in rows}, "r string, t string").withColumn("h", F.xxhash64("r", "t")).collect()}
    wanted = expected_of(rows, lambda r: (r[0] is not None, r[0] or 0, hashes[r[1:]]))
    sums = {r["conv_id"]: r["sha256"] for r in repair.digests(found.turns, "conv_id", "place", F.concat("role", F.lit(":"), "text")).collect()}
    got = {r["conv_id"]: r for r in found.audits.collect()}
    assert set(got) == set(wanted)
    for conv, (*counts, audit, text) in wanted.items():
        assert [got[conv][c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] == counts, conv
        assert got[conv]["audit"] == audit
        assert sums.get(conv, hashlib.sha256(b"").hexdigest()) == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark):
    found = repair.repaired(spark.createDataFrame([], SCHEMA))
    assert found.audits.count() == found.turns.count() == 0
    assert repair.digests(found.turns, "conv_id", "place", F.col("text")).count() == 0


def damage(rows):
    result = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            result += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return result


def test_op12_equals_brute_force(spark, sf_dir):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{sf_dir}/conversations.parquet'").fetchall()
    wanted = expected_of(damage(rows), lambda r: r[0])
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = {r["conv_id"]: tuple(r[c] for c in columns) for r in queries.QUERIES["op12_conversation_repair"](spark, sf_dir).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, row in got.items():
        *counts, text = wanted.get(conv, (0, 0, 0, 0, 0, 0, "", ""))
        assert row == (*counts, hashlib.sha256(text.encode()).hexdigest()), conv

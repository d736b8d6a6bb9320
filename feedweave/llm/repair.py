"""Repair of conversations whose turns do not alternate.

Turns are numbered by running sums over a range partitioning, so a conversation of any length is
spread over tasks. What is wrong with a turn is told from narrow rows: a repeat, by the first place
of the digest of its role and text. A turn is then one code, and blocks of BLOCK codes are aligned with
the grammar side by side (``turns``); the blocks' tables of costs are put together per conversation,
and each edit finds its turn's text by conversation and place. Texts are shuffled when they are
numbered and when the edits meet them, never gathered.

Defined cases: a NULL role or text counts as one space; NULL conversations are one like others; NULL
turns come first; turns of equal number are ordered by a hash of role and text, so repeated rows are
neighbours and the second is a duplicate; other columns take no part; an empty table gives empty results.
A conversation's table of costs, 16 bytes a turn at most, is what one task must hold of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa

from feedweave.llm import turns
from feedweave.llm.ranks import running_sums, written
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Turns aligned at a time.
BLOCK = 512
WHITE = " \t\n\x0b\x0c\r"
EDITS = "_conv long, _block long, cost long, illegal long, audit string, edits array<struct<k: int, edit: string, at: int, role: string>>"


@dataclass(frozen=True)
class Repaired:
    """``audits``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, of every conversation with turns.
    ``turns``: conv_id, place, edit, turn, role, text, one row for each edit but the deletions.
    """

    audits: DataFrame
    turns: DataFrame


def _code(role: Column, must_go: Column, cut_off: Column) -> Column:
    initial = F.substring(role, 1, 1)
    letter = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(turns.OTHER)
    return letter + F.when(must_go, turns.MUST_GO).otherwise(0) + F.when(cut_off, turns.CUT_OFF).otherwise(0)


def _illegal(before: int, behind: int) -> bool:
    """Whether roles with these codes may not stand beside each other: su, ua and au may."""
    return (before & 3, behind & 3) not in ((0, 1), (1, 2), (2, 1))


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a conversation to their tables of costs, flat: states, cost, audit."""
    kind = pa.list_(pa.struct([("before", pa.int32()), ("behind", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    for batch in batches:
        tables = []
        for block, last, codes in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
            found = turns.align(codes, block == 0, block == last)
            tables.append([{"before": a, "behind": b, "cost": c, "audit": x} for (a, b), (c, x) in sorted(found.items())])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tables, kind)], [*batch.schema.names, "states"])


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order of conversation and number to the edits chosen: a conversation at a time."""
    types = pa.schema([
        ("_conv", pa.int64()), ("_block", pa.int64()), ("cost", pa.int64()), ("illegal", pa.int64()), ("audit", pa.string()),
        ("edits", pa.list_(pa.struct([("k", pa.int32()), ("edit", pa.string()), ("at", pa.int32()), ("role", pa.string())]))),
    ])
    held: list[tuple] = []

    def conversation(blocks: list[tuple]) -> list[tuple]:
        tables = [{(s["before"], s["behind"]): (s["cost"], s["audit"]) for s in b[4]} for b in blocks]
        rows, previous = [], []
        for (conv, block, _, codes, _), (before, cost, audit) in zip(blocks, turns.compose(tables), strict=True):
            pairs = [*previous[-1:], *codes]
            illegal = sum(_illegal(a, b) for a, b in zip(pairs, pairs[1:]))
            made = [{"k": k, "edit": e, "at": at, "role": role} for k, (e, at, role) in enumerate(turns.edits(codes, before, audit))]
            rows.append((conv, block, cost, illegal, audit, made))
            previous = codes
        return rows

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], schema=types)

    for batch in batches:
        rows: list[tuple] = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[0] != held[0][0]:
                rows += conversation(held)
                held = []
            held.append(row)
        if rows:
            yield batch_of(rows)
    if held:
        yield batch_of(conversation(held))


def repaired(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK,
) -> Repaired:
    """The cheapest edits that make every conversation alternate, and the conversations after them."""
    space = F.lit(" ")
    narrow = rows.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), space).alias("role"), F.coalesce(F.col(f"`{text}`"), space).alias("text"), F.lit(1).alias("one"),
    )
    placed = written(running_sums(narrow, ["conv_id"], ["turn", F.xxhash64("role", "text")], ["one"], "repair-order"), "repair-turns")
    placed = placed.withColumnRenamed("before_one", "place")
    conversations = written(_numbered(placed.select("conv_id").distinct()), "repair-conversations")
    # From here on a number stands for the conversation: plain equality meets NULL ids too.
    keyed = placed.join(conversations, placed["conv_id"].eqNullSafe(conversations["_id"])).drop("_id", "conv_id", "one")
    keyed = written(keyed, "repair-keyed")
    last = F.substring(F.rtrim(F.col("text"), F.lit(WHITE)), -1, 1)
    marked = keyed.select(
        "_conv", "place", "turn", "role", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("open"),
    )
    first = marked.groupBy("_conv", "digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    faults = marked.join(first, ["_conv", "digest"], "left")
    again = ~F.col("blank") & F.coalesce(F.col("place") > F.col("first"), F.lit(False))
    faults = faults.withColumn("duplicate", again).withColumn("truncated", F.col("open") & ~F.col("blank") & ~again)
    code = _code(F.col("role"), F.col("blank") | F.col("duplicate"), F.col("truncated"))
    faults = written(faults.select("_conv", "place", "turn", "blank", "duplicate", "truncated", code.alias("code")), "repair-faults")
    size = F.lit(block).cast("long")
    codes = F.transform(F.array_sort(F.collect_list(F.struct("place", "code"))), lambda x: x["code"])
    blocks = faults.groupBy("_conv", F.floor(F.col("place") / size).alias("_block")).agg(codes.alias("codes"))
    blocks = blocks.withColumn("_last", F.max("_block").over(Window.partitionBy("_conv"))).select("_conv", "_block", "_last", "codes")
    states = "states array<struct<before: int, behind: int, cost: long, audit: string>>"
    tables = blocks.mapInArrow(_aligned, f"_conv long, _block long, _last long, codes array<int>, {states}")
    tables = tables.repartition("_conv").sortWithinPartitions("_conv", "_block")
    chosen = written(tables.mapInArrow(_composed, EDITS), "repair-edits")
    return Repaired(_audits(conversations, faults, chosen), _turns(conversations, keyed, chosen, size))


def _numbered(ids: DataFrame) -> DataFrame:
    """(_id, _conv): the different ids, and a number for each."""
    return ids.select(F.col("conv_id").alias("_id"), F.monotonically_increasing_id().alias("_conv"))


def _audits(conversations: DataFrame, faults: DataFrame, chosen: DataFrame) -> DataFrame:
    def counted(name: str) -> Column:
        return F.sum(F.col(name).cast("long")).alias(name)

    numbers = faults.groupBy("_conv", "turn").agg(*map(counted, ("blank", "duplicate", "truncated"))).groupBy("_conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *map(counted, ("blank", "duplicate", "truncated")),
    )
    parts = F.transform(F.array_sort(F.collect_list(F.struct("_block", "audit"))), lambda x: x["audit"])
    costs = chosen.groupBy("_conv").agg(counted("illegal"), counted("cost"), F.array_join(parts, "").alias("audit"))
    joined = conversations.join(numbers, "_conv").join(costs, "_conv")
    return joined.select(F.col("_id").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _turns(conversations: DataFrame, keyed: DataFrame, chosen: DataFrame, size: Column) -> DataFrame:
    each = chosen.select("_conv", "_block", F.explode("edits").alias("e")).filter("e.edit != 'D'")
    each = each.select("_conv", F.struct("_block", "e.k").alias("place"), "e.edit", "e.role", (F.col("_block") * size + F.col("e.at")).alias("_at"))
    theirs = keyed.select(F.col("_conv").alias("_c"), F.col("place").alias("_p"), "turn", F.col("role").alias("_role"), "text")
    joined = each.join(theirs, (F.col("_conv") == F.col("_c")) & (F.col("_at") == F.col("_p")), "left")
    named = joined.join(conversations, "_conv")
    return named.select(
        F.col("_id").alias("conv_id"), "place", "edit", "turn", F.coalesce("role", "_role").alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )


def digests(lines: DataFrame, key: str, order: str, line: Column) -> DataFrame:
    """(key, sha256) of the lines of each key, joined by line feeds in order: one line at a time."""
    made = lines.select(F.col(key).alias("key"), F.col(order).alias("order"), line.alias("line")).repartition("key")
    kind = made.schema["key"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            keys, sums = [], []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if sha is None or k != now:
                    if sha is not None:
                        keys.append(now)
                        sums.append(sha.hexdigest())
                    now, sha = k, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(text.as_buffer())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.types[0]), pa.array(sums)], [key, "sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], batch.schema.types[0]), pa.array([sha.hexdigest()])], [key, "sha256"])

    return made.sortWithinPartitions("key", "order").select("key", "line").mapInArrow(run, f"`{key}` {kind.simpleString()}, sha256 string")

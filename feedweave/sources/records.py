"""Records over several lines, put together by all tasks at once.

A line acts on the quote state: whether the text before it ends in an open quote decides, for most
lines, nothing, and for others whether the text behind it does. So each line is a function of one
bit to one bit, and such functions compose. 64 lines make a word, folded for both states where they
lie; words compose along a split, splits along a file, each by one running composition over narrow
rows (a swap counts, a constant starts anew). Then every word knows the state it begins in, wherever
its file was cut, and only lines of records over several lines are gathered, by record.

A quote that is never closed makes a reject of its line alone: behind it every line is read by itself.
"""

from __future__ import annotations

import re

from feedweave.session import scratch_dir
from pyspark.sql import Column, DataFrame, Window, functions as F

WORD = 6  # 2^6 lines to a word of bits
ENDS = "\r\n"


def open_quote(delimiter: str, enclosure: str) -> str:
    """The pattern of a line that ends within a quoted field, for Java and Python alike.

    Quotes count where a field begins with one; a doubled one stands for itself.
    """
    d, e = re.escape(delimiter), re.escape(enclosure)
    quoted = f"{e}[^{e}]*+(?:{e}{e}[^{e}]*+)*+"
    return f"^(?:(?:{quoted}{e}[^{d}]*+|(?!{e})[^{d}]*+){d})*+{quoted}$"


def ends_open(text: Column, delimiter: str, enclosure: str) -> Column:
    """Whether a text that begins outside quotes ends within them; one without the enclosure is not looked into."""
    return F.contains(text, F.lit(enclosure)) & text.rlike(open_quote(delimiter, enclosure))


def _bits(flag: Column) -> Column:
    """The flags of a word's lines as one number."""
    place = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_row").bitwiseAND(F.lit(63)).cast("int"))
    return F.bit_or(F.when(flag, place).otherwise(F.lit(0).cast("long")))


def _words(lines: DataFrame, delimiter: str, enclosure: str) -> DataFrame:
    """(file, block, word): which lines there are, open a quote, and stay in one that is open; a row for 64 lines."""
    body = F.rtrim(F.col("value"), F.lit(ENDS))
    inside = ~F.contains(body, F.lit(enclosure)) | F.concat(F.lit(enclosure), body).rlike(open_quote(delimiter, enclosure))
    return lines.groupBy("_file", "_block", F.shiftright("_row", WORD).alias("_word")).agg(
        _bits(F.lit(True)).alias("here"), _bits(ends_open(body, delimiter, enclosure)).alias("opens"), _bits(inside).alias("stays"),
    )


#: The states before each line, as bits, and behind the last, for either state before the first.
FOLD = """
    aggregate(sequence(0, 63), named_struct('e0', 0L, 'e1', 1L, 'm0', 0L, 'm1', 0L), (t, k) -> named_struct(
        'e0', CASE WHEN t.e0 = 1 THEN shiftright(held, k) & 1L ELSE shiftright(opens, k) & 1L END,
        'e1', CASE WHEN t.e1 = 1 THEN shiftright(held, k) & 1L ELSE shiftright(opens, k) & 1L END,
        'm0', t.m0 | shiftleft(t.e0, k), 'm1', t.m1 | shiftleft(t.e1, k)))"""
#: The same where no line opens a quote: one that is open stays so up to the first line that closes it.
NO_OPENING = """
    named_struct('e0', 0L, 'e1', CASE WHEN held = -1L THEN 1L ELSE 0L END, 'm0', 0L, 'm1', coalesce(held ^ try_add(held, 1L), -1L))"""


def _composed(rows: DataFrame, window, before: str, behind: str, swaps: Column, constant: Column) -> DataFrame:
    """The effect of all rows ahead: a constant ``before`` (or NULL) xor the swaps ``<before>_swaps``; ``behind`` likewise with the row's own."""
    to_here, ahead = window.rowsBetween(Window.unboundedPreceding, 0), window.rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.withColumn(f"{behind}_swaps", F.sum(swaps.cast("long")).over(to_here))
    # A constant is kept free of the swaps counted so far, so that later ones only add their count.
    own = counted.withColumn("_own", (constant + F.col(f"{behind}_swaps")) % 2)
    return own.withColumn(before, F.last("_own", ignorenulls=True).over(ahead)).withColumn(
        behind, F.last("_own", ignorenulls=True).over(to_here),
    ).withColumn(f"{before}_swaps", F.col(f"{behind}_swaps") - swaps.cast("long")).drop("_own")


def _highest(bits: Column) -> Column:
    return F.length(F.bin(bits)) - 1


def _marks(words: DataFrame) -> DataFrame:
    """Words in which a record runs over lines: which lines begin within quotes, and where the record open at their start began.

    ``_end`` is the last place of the file at which a record began, if that is never closed.
    """
    held = words.withColumn("held", F.expr("stays | ~here"))
    folded = held.withColumn("f", F.expr(f"CASE WHEN opens = 0 THEN {NO_OPENING} ELSE {FOLD} END")).select("*", "f.*").drop("f")
    e0, e1 = F.col("e0"), F.col("e1")
    along = Window.partitionBy("_file", "_block").orderBy("_word")
    placed = _composed(folded, along, "fixed", "end", (e0 == 1) & (e1 == 0), F.when(e0 == e1, e0))
    ahead = along.rowsBetween(Window.unboundedPreceding, -1)
    for k in (0, 1):  # for either state that the split may begin in
        state = (F.coalesce("fixed", F.lit(k)) + F.col("fixed_swaps")) % 2
        placed = placed.withColumn(f"within{k}", F.when(state == 0, F.col("m0")).otherwise(F.col("m1")))
        placed = placed.withColumn(f"begin{k}", F.expr(f"~within{k} & here"))
        last = F.when(F.col(f"begin{k}") != 0, F.shiftleft("_word", WORD) + _highest(F.col(f"begin{k}")))
        placed = placed.withColumn(f"last{k}", last).withColumn(f"before{k}", F.last(last, ignorenulls=True).over(ahead))
    splits = _splits(placed)
    known = placed.join(splits, ["_file", "_block"])

    def of(name: str) -> Column:
        return F.when(F.col("state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    found = known.select("_file", "_block", "_word", "opens", "_ahead", "_end", *[of(name).alias(name) for name in ("within", "begin", "before")])
    opened = F.when(F.col("before").isNotNull(), F.struct("_block", F.col("before").alias("_row"))).otherwise(F.col("_ahead"))
    found = found.filter("within != 0 OR (opens & ~within) != 0")
    return found.select("_file", "_block", "_word", "within", "opens", "begin", opened.alias("_opened"), "_end")


def _splits(placed: DataFrame) -> DataFrame:
    """By split: the state it begins in, the last place ahead of it at which a record began, and ``_end``."""
    splits = placed.groupBy("_file", "_block").agg(
        F.max_by(F.struct("end", "end_swaps"), "_word").alias("x"), F.max("last0").alias("last0"), F.max("last1").alias("last1"),
    )
    odd = F.col("x.end_swaps") % 2
    # Behind the split: a constant, or the state before it, swapped or not.
    splits = splits.select("_file", "_block", "last0", "last1", odd.alias("odd"), ((F.col("x.end") + odd) % 2).alias("constant"))
    over = Window.partitionBy("_file").orderBy("_block")
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    splits = _composed(splits, over, "at", "to", F.col("constant").isNull() & (F.col("odd") == 1), F.col("constant"))
    splits = splits.withColumn("state", (F.coalesce("at", F.lit(0)) + F.col("at_swaps")) % 2)
    last = F.when(F.col("state") == 0, F.col("last0")).otherwise(F.col("last1"))
    splits = splits.withColumn("_place", F.when(last.isNotNull(), F.struct("_block", last.alias("_row"))))
    behind = F.last((F.coalesce("to", F.lit(0)) + F.col("to_swaps")) % 2).over(whole)
    ahead = F.last("_place", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1))
    return splits.select("_file", "_block", "state", ahead.alias("_ahead"), F.when(behind == 1, F.max("_place").over(whole)).alias("_end"))


def whole_records(lines: DataFrame, delimiter: str, enclosure: str) -> DataFrame:
    """Lines (file, block, row, value; neither line feeds nor lines left out) to records, in the place of their first line.

    Lines are read for one that opens a quote, without which they are the records; for the words' bits;
    and for the records, those of one line and the others.
    """
    columns = ["_file", "_block", "_row", "value"]
    lines = lines.select(*columns)
    if not lines.filter(ends_open(F.rtrim(F.col("value"), F.lit(ENDS)), delimiter, enclosure)).take(1):
        return lines
    folder, found = scratch_dir(lines.sparkSession, "records"), _marks(_words(lines, delimiter, enclosure))
    found.write.parquet(folder)  # a row for 64 lines at most: Spark knows its size when it plans the joins
    marks = lines.sparkSession.read.schema(found.schema).parquet(folder)
    placed = lines.withColumn("_word", F.shiftright("_row", WORD))
    keys = ["_file", "_block", "_word"]
    k = "CAST(_row & 63 AS INT)"
    inside, opens = F.expr(f"shiftright(within, {k}) & 1") == 1, F.expr(f"shiftright(opens & ~within, {k}) & 1") == 1
    closed = F.col("_end").isNull() | (F.struct("_block", "_row") < F.col("_end"))
    several = (inside | opens) & closed
    single = placed.join(marks, keys, "left").filter(~F.coalesce(several, F.lit(False))).select(*columns)
    below = F.expr(f"CASE WHEN {k} = 0 THEN 0L ELSE begin & shiftrightunsigned(-1L, 64 - {k}) END")
    here = F.struct("_block", "_row")
    earlier = F.struct("_block", (F.shiftleft("_word", WORD) + _highest(below)).alias("_row"))
    first = F.when(~inside, here).when(below != 0, earlier).otherwise(F.col("_opened"))
    parts = placed.join(marks, keys).filter(several).select("_file", first.alias("_first"), here.alias("_at"), "value")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("_at", "value"))), lambda x: x["value"])
    joined = parts.groupBy("_file", "_first").agg(F.array_join(texts, "\n").alias("value"))
    return single.unionByName(joined.select("_file", "_first.*", "value"))

"""Profiling of a feed before its schema is registered."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from feedweave.functions.coerce import lenient_date, trim_blanks

# How a delimiter or an enclosure is probed.
DELIMITERS = (";", ",", "|", "\t")
ENCLOSURE = '"'


def parses_as(c: Column) -> dict[str, Column]:
    """For each column type, whether the text reads as it without loss."""
    text = trim_blanks(c)
    number = F.replace(text, F.lit(","), F.lit("."))
    return {
        "Integer": text.rlike(r"^[+-]?[0-9]+$") & text.try_cast("int").isNotNull(),
        "Float": number.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"),
        "Date": lenient_date(text, "null").isNotNull(),
        "String": F.length(text) <= 250,
        "Description": F.lit(True),
    }


def profile_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: filled values, how many of them read as each type, and a proposed type.

    Every field becomes a row of its own, tested once and counted per task, so the plan
    stays the same size however wide the feed is. The proposal is the narrowest type all
    filled values read as.
    """
    fields = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value")) for c in columns])
    values = df.select(F.inline(fields)).withColumn("value", trim_blanks(F.col("value")))
    tests = parses_as(F.col("value"))
    counted = values.groupBy("column_name").agg(
        F.sum((F.col("value") != "").cast("long")).alias("filled"),
        *[F.sum(((F.col("value") != "") & test).cast("long")).alias(f"as_{kind.lower()}") for kind, test in tests.items()],
    )
    proposal = F.lit("Description")
    for kind in reversed(list(tests)[:-1]):
        proposal = F.when((F.col("filled") > 0) & (F.col(f"as_{kind.lower()}") == F.col("filled")), F.lit(kind)).otherwise(proposal)
    return counted.withColumn("proposed_type", proposal)


def column_sample(df: DataFrame, columns: Sequence[str], order: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` values of each column, trimmed, in the order of the feed."""
    head = df.orderBy(*order).limit(n).withColumn("_position", F.struct(*order))
    values = F.array(*[F.struct(F.lit(c).alias("column_name"), trim_blanks(F.col(c)).alias("value")) for c in columns])
    return head.select(*order, F.inline(values))


def field_counts(lines: DataFrame, delimiters: Sequence[str] = DELIMITERS, enclosure: str = ENCLOSURE, value: str = "value") -> DataFrame:
    """How many lines give how many fields under each candidate delimiter.

    Enclosed stretches are blanked first, so a delimiter inside them does not count. Lines
    are counted per task before the shuffle, which moves one row per delimiter and count.
    """
    mark = re.escape(enclosure)
    bare = F.regexp_replace(F.col(value), f"{mark}[^{mark}]*{mark}", "")
    # Two generators: the blanked line is computed once and used for every delimiter.
    blanked = lines.select(F.inline(F.array(F.struct(bare.alias("bare")))))
    fields = F.array(*[
        F.struct(F.lit(d).alias("delimiter"), (F.length("bare") - F.length(F.translate("bare", d, "")) + 1).alias("n_fields"))
        for d in delimiters
    ])
    return blanked.select(F.inline(fields)).groupBy("delimiter", "n_fields").agg(F.count(F.lit(1)).alias("n_lines"))


def header_names(header: str, delimiter: str, enclosure: str = ENCLOSURE) -> list[str]:
    """Trimmed column names of a header line; repeated names are refused."""
    names = [name.strip() for name in next(csv.reader([header], delimiter=delimiter, quotechar=enclosure))]
    if len(set(names)) != len(names):
        raise ValueError("a column name occurs twice")
    return names

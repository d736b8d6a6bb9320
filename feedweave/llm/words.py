"""Words as this subpackage counts them: runs of characters other than space and tab to CR."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: White space between words.
GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")

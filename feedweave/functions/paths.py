"""Parts of a slash-separated path."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    """Text after the last point of the file name; the whole name when it has none."""
    return F.element_at(F.split(file_name(path), r"\."), -1)


def directory(path: Column) -> Column:
    """Everything before the last slash, '' when there is none."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def without_login(url: Column) -> Column:
    """The address without scheme and ``user:password@``."""
    return F.regexp_replace(url, r"^[a-z]+://[^/@]+@", "")

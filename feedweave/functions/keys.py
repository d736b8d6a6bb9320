"""Key and ranking expressions shared by the operators."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

# Fixed value: separates manufacturer and part number in a product's id.
KEY_SEPARATOR = "|||"


def match_key(c: Column, policy: str = "exact") -> Column:
    """The form under which keys are compared.

    ``exact`` compares as is; ``ci`` ignores case and trailing spaces; ``ci_ai`` ignores accents as
    well. The key is normalised once as a plain string, which joins and grouping can hash, because
    grouping on a collated column falls back to sorting.
    """
    if policy == "exact":
        return c
    if policy == "ci":
        return F.lower(F.rtrim(c))
    if policy == "ci_ai":
        key = F.rtrim(c)
        plain = F.octet_length(key) == F.char_length(key)  # ASCII, for which lower() is all there is to do
        return F.when(plain, F.lower(key)).otherwise(F.translate(key, *folding()))
    raise ValueError("key policy is 'exact', 'ci' or 'ci_ai'")


@cache
def folding() -> tuple[str, str]:
    """Letters that ``ci_ai`` replaces, and by what, letter by letter; combining marks, behind them, go.

    A letter stands for the first one of its canonical decomposition, in lower case, so that
    variants such as the final sigma are one letter. Letters beyond the basic plane stay.
    """
    letters = (chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    pairs = {c: fold_letter(c) for c in letters if c.isalpha()}
    changed = {c: f for c, f in pairs.items() if f != c}
    marks = "".join(chr(c) for c in range(0x300, 0x370))
    return "".join(changed) + marks, "".join(changed.values())


def fold_letter(c: str) -> str:
    base = unicodedata.normalize("NFD", c)[0]
    if base in "\u00df\u1e9e":  # fixed value: a sharp s is an s
        return "s"
    upper = base.upper()
    lower = (upper if len(upper) == 1 else base).lower()
    return lower if len(lower) == 1 else base


def availability_rank(c: Column) -> Column:
    """1 when something is available, else 0; an unknown quantity counts as unavailable."""
    return F.when(c > 0, 1).otherwise(0)


def row_key(*parts: Column) -> Column:
    """Product id: the parts joined by the separator, NULL parts left out."""
    return F.concat_ws(KEY_SEPARATOR, *parts)

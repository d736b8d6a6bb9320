"""Lenient readings of feed text, as column expressions.

Feed text never fails a job: whatever does not read as a number is 0, whatever does not
read as a date is the epoch (or NULL on request). All casts are ``try_cast`` so that the
ANSI mode of Spark 4 does not turn a dirty field into an error.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The blanks a field is trimmed of, and the ranges of the stored types.
BLANKS = " \t\n\r\0\x0b"
INT_MIN, INT_MAX = -2147483648, 2147483647
MONEY = T.DecimalType(12, 2)
MONEY_MAX = 9999999999.99
POUND = "£"
EPOCH = "1970-01-01"


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def trim_blanks(c: Column) -> Column:
    """Trim space, tab, line feed, carriage return, NUL and vertical tab; NULL becomes ''."""
    return F.btrim(_text(c), F.lit(BLANKS))


def _between(c: Column, low: float, high: float) -> Column:
    """The number, or the nearest bound; ``greatest`` and ``least`` alone would skip a NULL."""
    number = c.cast("double")
    return F.when(number.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), number)))


def clamp_int(c: Column) -> Column:
    """Store a number in 32 bits, out-of-range values at the nearest bound, fractions rounded half away from zero."""
    return F.round(_between(c, float(INT_MIN), float(INT_MAX))).cast("int")


def kept_as(c: Column, found: T.DataType, stored: T.DataType) -> Column:
    """A value as a column of type ``stored`` keeps it; text never fails the job.

    Text is read leniently, numbers out of range go to the nearest bound.
    """
    if found == stored:
        return c
    if isinstance(found, T.StringType) and isinstance(stored, T.NumericType):
        c = F.when(c.isNotNull(), lenient_float(c))
    elif isinstance(found, T.StringType) and isinstance(stored, T.DateType):
        return F.when(c.isNotNull(), lenient_date(c, "null"))
    if isinstance(stored, T.IntegerType):
        return clamp_int(c)
    if isinstance(stored, T.DecimalType):
        most = "9" * (stored.precision - stored.scale) + "." + "9" * stored.scale
        over = F.when(c.cast("double") > 0, F.lit(most)).when(c.cast("double") < 0, F.lit(f"-{most}"))
        return F.coalesce(c.try_cast(stored), over.try_cast(stored))
    return c.try_cast(stored)


def lenient_int(c: Column) -> Column:
    """The leading integer of the text, 0 when there is none; what follows it is cut off."""
    digits = F.regexp_extract(trim_blanks(c), r"^([+-]?[0-9]+)", 1)
    return clamp_int(F.coalesce(digits.try_cast("double"), F.lit(0.0)))


def lenient_float(c: Column, decimal_comma: bool = False) -> Column:
    """The leading number of the text with every comma read as a point, 0 when there is none.

    ``1.234,56`` therefore reads as 1.234; ``decimal_comma`` drops the points first, for
    feeds known to use them between thousands.
    """
    text = trim_blanks(c)
    if decimal_comma:
        text = F.when(text.contains(","), F.replace(text, F.lit("."))).otherwise(text)
    text = F.replace(text, F.lit(","), F.lit("."))
    number = F.regexp_extract(text, r"^([+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?)", 1)
    return F.coalesce(number.try_cast("double"), F.lit(0.0))


def round_money(c: Column) -> Column:
    """Two decimals, out-of-range values at the nearest bound."""
    return _between(c, -MONEY_MAX, MONEY_MAX).cast(MONEY)


def lenient_date(c: Column, bad_date: str = "epoch") -> Column:
    """``dd/mm/yy``, ``dd/mm/yyyy``, ``dd-mm-yyyy`` and ISO dates, a time of day left out.

    Two-digit years are this century's. A day past the end of its month runs into the next
    month, 31/02 being 3 March, as it does for the reference. Anything else is a bad date.
    """
    if bad_date not in ("epoch", "null"):
        raise ValueError("bad_date is 'epoch' or 'null'")
    text = F.regexp_replace(trim_blanks(c), r"^([0-9]{2})/([0-9]{2})/([0-9]{2})$", "20$3-$2-$1")
    text = F.translate(text, "/", "-")
    iso = F.regexp_replace(text, r"^([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})([ T].*)?$", "$3-$2-$1")
    day = F.when(iso.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?$"), iso.try_cast("date"))
    late = r"^([0-9]{4}-[0-9]{1,2})-(29|30|31)([ T].*)?$"
    month = F.concat(F.regexp_extract(iso, late, 1), F.lit("-1")).try_cast("date")
    parsed = F.coalesce(day, F.date_add(month, F.regexp_extract(iso, late, 2).try_cast("int") - 1))
    return parsed if bad_date == "null" else F.coalesce(parsed, F.lit(EPOCH).cast("date"))


def cut(c: Column, length: int) -> Column:
    """The first ``length`` characters, as a bounded text column stores them."""
    return F.left(c, F.lit(length))


def strip_pound(c: Column) -> Column:
    """Drop one leading pound sign."""
    return F.regexp_replace(c, f"^{POUND}", "")


def null_to_zero(c: Column, data_type: T.DataType) -> Column:
    """The value a non-strict store keeps for NULL: '' or 0. Dates stay NULL (no zero date)."""
    if isinstance(data_type, T.StringType):
        return F.coalesce(c, F.lit(""))
    if isinstance(data_type, T.NumericType):
        return F.coalesce(c, F.lit(0).cast(data_type))
    return c

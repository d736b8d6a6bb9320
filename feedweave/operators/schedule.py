"""Schedules as bitmaps: a day is 24 numbers, one per hour, whose bits are the minutes at which a resource is due.

A pattern ``HH:MM`` with ``*`` digits stands for some hours times some minutes, so it is two bitmaps,
and a schedule ORs the minutes of its patterns into the hours they cover. Whether, how often and when
next a resource is due are bit operations on its row; no row per resource and minute is made.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

HOURS, MINUTES = 24, 60


def _bits(numbers) -> int:
    return reduce(lambda a, n: a | 1 << n, numbers, 0)


def _digit(c: Column, ten: bool, limit: int) -> Column:
    """The numbers below ``limit`` that have a pattern's character as their tens or units digit."""
    def fits(n: int, digit: str) -> bool:
        return str(n // 10 if ten else n % 10) == digit

    known = {d: _bits(n for n in range(limit) if fits(n, d)) for d in "0123456789"} | {"*": _bits(range(limit))}
    table = F.create_map(*[F.lit(x) for d, bits in known.items() for x in (d, F.lit(bits).cast("long"))])
    return F.coalesce(F.try_element_at(table, c), F.lit(0).cast("long"))


def _pair(c: Column, at: int, limit: int) -> Column:
    return _digit(F.substring(c, at, 1), True, limit).bitwiseAND(_digit(F.substring(c, at + 1, 1), False, limit))


def day_bits(patterns: Column) -> Column:
    """The 24 bitmaps of a list of patterns; what is no pattern adds nothing."""
    def parsed(pattern: Column) -> Column:
        digits = F.replace(pattern, F.lit(":"), F.lit(""))
        return F.struct(_pair(digits, 1, HOURS).alias("h"), _pair(digits, 3, MINUTES).alias("m"))

    def hours(pairs: Column) -> Column:
        def hour(h: Column) -> Column:
            covered = lambda p: F.call_function("shiftright", p["h"], h).bitwiseAND(F.lit(1)) == 1
            return F.aggregate(pairs, F.lit(0).cast("long"), lambda bits, p: bits.bitwiseOR(F.when(covered(p), p["m"]).otherwise(0)))

        return F.transform(F.sequence(F.lit(0), F.lit(HOURS - 1)), hour)

    # A lambda's variable stands for the pairs, so that patterns are parsed once and not for every hour.
    return F.get(F.transform(F.array(F.transform(patterns, parsed)), hours), F.lit(0))


def schedules(resources: DataFrame) -> DataFrame:
    """(local_name, hours): the bitmaps of every resource that is due at all; rows of one name are one schedule.

    Rows are dealt out before their bitmaps are made, so that a task holds those of few names, however
    few splits the registry has.
    """
    listed = F.from_json(F.coalesce("sync_time", F.lit("[]")), "array<string>")
    dealt = resources.select("local_name", "sync_time").repartition("local_name", "sync_time")
    days = dealt.select("local_name", F.coalesce(day_bits(listed), F.array_repeat(F.lit(0).cast("long"), HOURS)).alias("hours"))
    joined = days.groupBy("local_name").agg(*[F.bit_or(F.get("hours", F.lit(h))).alias(f"h{h}") for h in range(HOURS)])
    hours = F.array(*[F.col(f"h{h}") for h in range(HOURS)])
    return joined.select("local_name", hours.alias("hours")).filter(F.exists("hours", lambda x: x != 0))


def _time(hour: Column, minute: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), F.lpad(minute.cast("string"), 2, "0"))


def _lowest(bits: Column) -> Column:
    return F.bit_count(bits.bitwiseAND(-bits) - 1)


def _filled(hours: Column) -> Column:
    """(hour, bits) of the hours with any minute, in order."""
    return F.filter(F.transform(hours, lambda x, h: F.struct(h.alias("h"), x.alias("x"))), lambda s: s["x"] != 0)


def minutes(hours: Column) -> Column:
    """How many minutes of the day."""
    return F.aggregate(hours, F.lit(0).cast("long"), lambda n, x: n + F.bit_count(x))


def first_time(hours: Column) -> Column:
    first = F.get(_filled(hours), F.lit(0))
    return _time(first["h"], _lowest(first["x"]))


def last_time(hours: Column) -> Column:
    last = F.try_element_at(_filled(hours), F.lit(-1))
    return _time(last["h"], F.length(F.bin(last["x"])) - 1)


def _clock(time: str) -> tuple[int, int]:
    hour, _, minute = time.partition(":")
    if not (hour.isdecimal() and minute.isdecimal() and int(hour) < HOURS and int(minute) < MINUTES):
        raise ValueError(f"{time!r} is no time of the day")
    return int(hour), int(minute)


def is_due(hours: Column, time: str) -> Column:
    hour, minute = _clock(time)
    return F.get(hours, F.lit(hour)).bitwiseAND(F.lit(1 << minute)) != 0


def next_time(hours: Column, time: str) -> Column:
    """The next time after ``time``, on the next day if need be; ``time`` itself comes last."""
    hour, minute = _clock(time)
    passed = _bits(range(minute + 1))
    later = [F.get(hours, F.lit(hour)).bitwiseAND(F.lit(_bits(range(MINUTES)) & ~passed))]
    later += [F.get(hours, F.lit(h % HOURS)) for h in range(hour + 1, hour + HOURS)]
    later.append(F.get(hours, F.lit(hour)).bitwiseAND(F.lit(passed)))
    following = F.get(_filled(F.array(*later)), F.lit(0))
    return _time((following["h"] + hour) % HOURS, _lowest(following["x"]))


def times(days: DataFrame) -> DataFrame:
    """(local_name, time): every minute at which a resource is due, a row for each; nothing is moved."""
    each = days.select("local_name", F.posexplode("hours").alias("hour", "bits")).filter("bits != 0")
    every = F.posexplode(F.array(*[F.lit(f":{m:02d}") for m in range(MINUTES)])).alias("at", "minute")
    due = F.call_function("shiftright", F.col("bits"), F.col("at")).bitwiseAND(F.lit(1)) == 1
    hour = F.lpad(F.col("hour").cast("string"), 2, "0")
    return each.select("local_name", hour.alias("hour"), "bits", every).filter(due).select("local_name", F.concat("hour", "minute").alias("time"))


def load(days: DataFrame) -> DataFrame:
    """(time, resources): how many resources are due at each minute; 24 rows per resource are summed, 60 sums each."""
    each = days.select(F.posexplode("hours").alias("hour", "bits"))
    sums = [F.sum(F.shiftright("bits", m).bitwiseAND(F.lit(1))).alias(f"m{m}") for m in range(MINUTES)]
    counted = each.groupBy("hour").agg(*sums)
    per_minute = counted.select("hour", F.posexplode(F.array(*[F.col(f"m{m}") for m in range(MINUTES)])).alias("minute", "resources"))
    return per_minute.filter("resources > 0").select(_time(F.col("hour"), F.col("minute")).alias("time"), "resources")

"""Reading delimited feeds, plain, gzipped or in archives, with the position of every line.

``_file``, ``_block`` and ``_row`` order the lines of a feed as its files hold them: rows of one
file split are numbered by the one task that reads it, and splits follow by their offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedweave.session import scratch_dir
from feedweave.sources.archives import archive_lines, packed_files
from feedweave.sources.records import ends_open, whole_records
from feedweave.sources.schema import FeedSpec

POSITION = ("_file", "_block", "_row")
BAD_LINE = "_bad_line"


def _positions() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    ]


def clean_line(c: Column) -> Column:
    """The line without byte order mark, carriage return and line feed."""
    return F.translate(c, "\ufeff\r\n", "")


def clean_lines(lines: DataFrame) -> DataFrame:
    """Cleaned lines; blank ones are dropped."""
    return lines.withColumn("value", clean_line(F.col("value"))).filter("value != ''")


def clean_records(lines: DataFrame) -> DataFrame:
    """Records without byte order mark and final line break; those within quotes stay. Blank ones are dropped."""
    return lines.withColumn("value", F.regexp_replace("value", "^\ufeff|[\r\n]+$", "")).filter("value != ''")


def _decoded(value: Column, encoding: str) -> Column:
    return value if encoding.upper() == "UTF-8" else F.decode(value.cast("binary"), encoding)


def read_lines(spark: SparkSession, path: str | Sequence[str], skip: int = 0, encoding: str = "UTF-8") -> DataFrame:
    """Non-blank lines with their position, without the first ``skip`` lines of each file.

    Gzipped files are read as they are, one task per file.
    """
    lines = spark.read.text(path).select(*_positions(), _decoded(F.col("value"), encoding).alias("value"))
    return clean_lines(drop_leading(lines, skip) if skip else lines)


def raw_lines(spark: SparkSession, path: str | Sequence[str], skip: int = 0, encoding: str = "UTF-8") -> DataFrame:
    """All lines, cut at line feeds only, with their position; a byte order mark at the start of one goes."""
    value = _decoded(F.col("value"), encoding)
    unmarked = F.when(value.startswith("\ufeff"), F.substring(value, 2, 1 << 30)).otherwise(value)
    lines = spark.read.option("lineSep", "\n").text(path).select(*_positions(), unmarked.alias("value"))
    return drop_leading(lines, skip) if skip else lines


def drop_leading(lines: DataFrame, n: int) -> DataFrame:
    """Drop the first ``n`` lines of each file.

    They lie at the start of a file's first split or splits; of each file only the ``n`` first
    positions of every task travel, and the others are compared with the last of them.
    """
    place = F.struct("_block", "_row").alias("_place")
    order = Window.partitionBy("_file").orderBy("_place")
    heads = lines.select("_file", place).withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n)
    last = heads.groupBy("_file").agg(F.max("_place").alias("_last"))
    joined = lines.join(last, "_file").filter(F.struct("_block", "_row") > F.col("_last"))
    return joined.select(*lines.columns)


#: Into so many stretches a split is cut.
STRETCHES = 4096


def line_window(lines: DataFrame, start: int, n: int) -> DataFrame:
    """A sample of a feed: lines ``start`` to ``start + n`` in file order, blank ones left out.

    Lines are counted by file and split; the counts tell in which splits the window lies. Those are
    cut into stretches of equal width and counted again, so that only the lines of the stretches
    that the window meets are ordered, each stretch by itself, however long a split is.
    """
    spark, split = lines.sparkSession, ["_file", "_block"]
    counted = lines.groupBy(*split).agg(F.count(F.lit(1)).alias("_lines"), F.min("_row").alias("_low"), F.max("_row").alias("_high"))
    splits = _kept(spark, _met(counted, Window.orderBy(*split), start, n))
    # As doubles, so that no difference overflows; a line without a number comes first, as it does in order.
    width = F.col("_high").cast("double") - F.col("_low") + 1
    stretch = F.coalesce(F.floor((F.col("_row").cast("double") - F.col("_low")) / width * STRETCHES), F.lit(-1))
    placed = lines.join(splits.select(*split, "_low", "_high", F.col("_before").alias("_ahead")), split).withColumn("_stretch", stretch)
    counted = placed.groupBy(*split, "_stretch", "_ahead").agg(F.count(F.lit(1)).alias("_lines"))
    stretches = _kept(spark, _met(counted, Window.partitionBy(*split).orderBy("_stretch"), start, n, F.col("_ahead")))
    within = Window.partitionBy(*split, "_stretch").orderBy("_row")
    ordered = placed.drop("_ahead").join(stretches.select(*split, "_stretch", "_before"), [*split, "_stretch"])
    numbered = ordered.withColumn("_at", F.col("_before") + F.row_number().over(within) - 1)
    return clean_lines(numbered.filter((F.col("_at") >= start) & (F.col("_at") < start + n)).select(*lines.columns))


def _met(counted: DataFrame, order, start: int, n: int, ahead: Column | None = None) -> DataFrame:
    """The parts that lines ``start`` to ``start + n`` lie in, with the lines before each."""
    earlier = F.coalesce(F.sum("_lines").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counted.withColumn("_before", earlier if ahead is None else ahead + earlier)
    return placed.filter((F.col("_before") < start + n) & (F.col("_before") + F.col("_lines") > start))


def _kept(spark: SparkSession, parts: DataFrame) -> DataFrame:
    """The same rows from the shared folder: Spark knows their size when it plans the joins."""
    folder = scratch_dir(spark, "window")
    parts.write.parquet(folder)
    return spark.read.schema(parts.schema).parquet(folder)


def csv_options(spec: FeedSpec) -> dict[str, str]:
    """A doubled enclosure stands for itself; every line is kept, bad ones marked.

    Lines are always split whole: with columns pruned, a wrong field count would go unseen.
    """
    return {
        "sep": spec.delimiter,
        "quote": spec.enclosure,
        "escape": spec.enclosure,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": BAD_LINE,
        "columnPruning": "false",
    }


def parse_lines(lines: DataFrame, spec: FeedSpec) -> DataFrame:
    """Records split into the feed's columns, still text; ``_bad_line`` holds records that do not fit.

    A record whose last quote is never closed does not fit, whatever its field count.
    """
    fields = ", ".join(f"`{field.name}` string" for field in spec.raw_schema(BAD_LINE))
    broken = ends_open(F.col("value"), spec.delimiter, spec.enclosure)
    # As a generator's output the split line is computed once; as a plain column Spark would
    # copy the splitting into every filter on it.
    split = F.inline(F.array(F.struct(F.from_csv("value", fields, csv_options(spec)).alias("_fields"), F.when(broken, F.col("value")).alias("_open"))))
    rest = [c for c in lines.columns if c != "value"]
    names = [F.col("_fields")[name].alias(name) for name, _ in spec.columns]
    return lines.select(*rest, split).select(*rest, *names, F.coalesce("_open", F.col("_fields")[BAD_LINE]).alias(BAD_LINE))


def read_feed(spark: SparkSession, spec: FeedSpec, path: str | None = None) -> DataFrame:
    """The feed's columns as text with position and ``_bad_line``.

    With ``multi_line``, line breaks within quotes are part of a record, else every line is one.
    Files are split among tasks either way; an archive is unpacked by one task, into a table in
    the shared folder, and then treated like them.
    """
    path = path or spec.path
    unknown = set(spec.conversion) - {"zip", "gz", "csv"}
    if unknown:
        raise ValueError(f"cannot unpack {', '.join(sorted(unknown))}")
    packed = [step for step in spec.conversion if step != "csv"]
    skip = spec.skip_lines + int(spec.header)
    if packed in ([], ["gz"]) and spec.encoding.upper() in SPLIT_ENCODINGS and _by_name(spark, path, packed):
        if not spec.multi_line:
            return parse_lines(read_lines(spark, path, skip, spec.encoding), spec)
        lines = raw_lines(spark, path, skip, spec.encoding)
    else:
        lines = archive_lines(packed_files(spark, path), packed, spec.encoding, skip)
        if not spec.multi_line:
            return parse_lines(clean_lines(lines), spec)
        unpacked, kind = scratch_dir(spark, "unpacked"), lines.schema
        lines.write.parquet(unpacked)
        lines = spark.read.schema(kind).parquet(unpacked)
    return parse_lines(clean_records(whole_records(lines, spec.delimiter, spec.enclosure)), spec)


#: Encodings in which a line feed is one byte and that Spark can decode.
SPLIT_ENCODINGS = ("UTF-8", "US-ASCII", "ISO-8859-1")


def _by_name(spark: SparkSession, path: str | Sequence[str], packed: Sequence[str]) -> bool:
    """Whether Spark's text source can tell from the files' names how to read them."""
    if not packed:
        return True
    return not spark.read.format("binaryFile").load(path).select("path").filter("NOT endswith(path, '.gz')").take(1)

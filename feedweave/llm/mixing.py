"""Mixing sources to target weights by systematic sampling.

Targets: sources share ``share`` of all words by weight; none gets more than ``most`` times
its own words, and the excess goes to the others by weight until none is above. That is the
level at which min(most * size, level * weight) adds up to the total, found with running sums
over the sources in the order in which they reach their limit.

Sample: every document of a source has the same expected copies. They are summed up along
the source's documents in order of size, a random offset (drawn once from the source's name)
is added, and a document is emitted once for each integer that its stretch crosses. As
neighbours are alike in size, the words taken stay within one document of the target.

Defined cases: a NULL or empty text has size 0 and is sampled like others; a NULL source is
a source, ordered last; repeated rows are sampled one by one; a source without words has
target 0 and no copies; other columns pass through ``mixed``; an empty table gives an empty
result. Reruns agree, since nothing depends on partitions.
"""

from __future__ import annotations

from feedweave.llm.ranks import one_of_each, row_hash, running_sums, whole_row, written
from feedweave.llm.words import n_words
from pyspark.sql import Column, DataFrame, functions as F

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2


def random_offset(source: Column) -> Column:
    """A multiple of 1 / 65536 in [0, 1), fixed by the source's name."""
    name = F.coalesce(F.concat(F.lit("source "), source), F.lit("no source"))
    return F.conv(F.substring(F.md5(name), 1, 4), 16, 10).cast("double") / 65536


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
) -> DataFrame:
    """One row per source: source, source_size, target."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1))
    placed = running_sums(sources, [], [F.col("source").isNull(), F.col("source")], ["one"], "mix-sources")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("before_one") % len(weights)).cast("int"))
    weighted = written(placed.select("source", "source_size", weight.cast("long").alias("weight")), "mix-weights")
    total, all_weights = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    full = weighted.withColumn("limit", F.col("source_size") / F.col("weight"))
    ahead = running_sums(full, [], ["limit"], ["source_size", "weight"], "mix-levels")
    level = (share * (total or 0) - most * F.col("before_source_size")) / ((all_weights or 0) - F.col("before_weight"))
    free = ahead.withColumn("level", level).filter(F.col("level") <= most * F.col("limit"))
    level = free.agg(F.min_by("level", F.struct("limit", "before_weight"))).first()[0]
    if level is None:  # every source at its limit
        return full.select("source", "source_size", (most * F.col("source_size")).cast("double").alias("target"))
    target = F.least((most * F.col("source_size")).cast("double"), F.lit(level) * F.col("weight"))
    return full.select("source", "source_size", target.alias("target"))


def copies(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``sized`` (source, size, doc_id, ...) with source_size, target and copies."""
    ordered = running_sums(sized.withColumn("_one", F.lit(1)), ["source"], ["size", "doc_id"], ["_one"], "mix-order")
    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    joined = ordered.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "_one")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset, n = random_offset(F.col("source")), F.col("before__one")
    crossed = F.floor(offset + (n + 1) * rate) - F.floor(offset + n * rate)
    return joined.withColumn("copies", F.least(crossed, F.ceil(rate)).cast("long")).drop("before__one")


def sizes(docs: DataFrame, doc_id: str, text: str, source: str, *more: Column) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), *more,
    )


def sampled(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **targets) -> DataFrame:
    """doc_id, source, size, source_size, target, copies for every document."""
    sized = written(sizes(docs, doc_id, text, source), "mix-sizes")
    return copies(sized, source_targets(sized, **targets))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **targets) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken."""
    sized = written(sizes(docs, doc_id, text, source, row_hash(docs).alias("_row")), "mix-sizes")
    taken = copies(sized, source_targets(sized, **targets)).groupBy("_row").agg(F.sum("copies").alias("_taken"))
    rows = one_of_each(docs.select(whole_row(docs).alias("_doc"), row_hash(docs).alias("_row")), "_row")
    chosen = rows.join(taken.filter("_taken > 0"), "_row")
    # Copies of one row are emitted in runs, each no longer than a row's text is worth.
    runs = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_taken")))
    return chosen.select("_doc", runs.alias("_copy")).select("_doc.*")

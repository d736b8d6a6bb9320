"""Host-level quality rules on DataFrame functions alone.

Every document is held against simple rules. Rule failures are then counted by host, and a
host's failure rate is shrunk towards the rate of all hosts by a beta prior that is fitted
to the hosts' rates (method of moments), so that a host with few documents needs more
evidence. A host whose shrunk rate is above the limit is rejected with all its documents.

Defined cases: a NULL or empty text has no words and fails; a NULL host is a host like
others; repeated rows count and come back as often as they occur; other columns pass
through, and the operator's own columns replace columns of the same names; an empty table
gives an empty result.
"""

from __future__ import annotations

from feedweave.llm.ranks import whole_row, written
from feedweave.llm.words import words
from pyspark.sql import Column, DataFrame, functions as F

MIN_WORDS = 50
#: Percent of the words that may lie in repeated windows.
MAX_REPEATED_PERCENT = 50
#: Words in a window.
WINDOW = 3
#: A host is rejected above this shrunk failure rate.
HOST_LIMIT = 0.5
#: Bounds of the prior's weight, in documents.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1e6


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, not wherever a lambda names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(grams: Column) -> Column:
    """Words that lie in a window found twice or more, from the windows' hashes in order."""
    placed = F.sort_array(F.transform(grams, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))

    def found_twice(p: Column) -> Column:
        same_as = lambda x, k: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
        return F.filter(p, lambda x, k: same_as(x, k + 1) | same_as(x, k - 1))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda a, k: F.least(F.coalesce(F.get(at, k + 1) - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda total, n: total + n)

    return let(F.sort_array(F.transform(let(placed, found_twice), lambda x: x["k"])), covered)


def _measured(text: Column) -> Column:
    """All measures as one struct. Each list is computed once, whatever the optimiser moves around."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of(w: Column) -> Column:
        grams = F.when(F.size(w) >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW), lambda k: F.xxhash64(*[F.get(w, k + n) for n in range(WINDOW)]),
        )).otherwise(F.array().cast("array<bigint>"))
        repeated = let(grams, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), _repeat_words(g)).otherwise(0))
        return let(repeated, lambda n_repeat_words: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.char_length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            let(lines, lambda some: F.size(some) - F.size(F.array_distinct(some))).cast("long").alias("n_dup_lines"),
            n_repeat_words.cast("long").alias("n_repeat_words"),
            ((F.size(w) < MIN_WORDS) | (100 * n_repeat_words.cast("long") > MAX_REPEATED_PERCENT * F.size(w))).alias("base_failed"),
        ))

    return let(words(text), of)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    df = docs.drop(*MEASURES).withColumn("_measures", _measured(F.col(text)))
    return df.withColumns({name: F.col("_measures")[name] for name in MEASURES}).drop("_measures")


def host_verdicts(measured: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: n_docs, n_failed, shrunk_rate, rejected. The driver sees one row of moments."""
    failed = F.col("base_failed").cast("int")
    hosts = measured.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n_docs"), F.sum(failed).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("spread")).first()
    mean, spread = moments["mean"] or 0.0, moments["spread"] or 0.0
    weight = mean * (1 - mean) / spread - 1 if spread > 0 else MOST_WEIGHT
    weight = min(max(weight, LEAST_WEIGHT), MOST_WEIGHT)
    shrunk = (F.col("n_failed") + mean * weight) / (F.col("n_docs") + weight)
    return hosts.withColumn("shrunk_rate", shrunk).withColumn("rejected", F.col("shrunk_rate") > limit)


def judged(measured: DataFrame, hosts: DataFrame, host: str = "source") -> DataFrame:
    """``measured`` with ``kept``: the document passes its own rules and its host is not rejected."""
    verdicts = hosts.select(F.col("host").alias("_verdict_of"), F.col("rejected").alias("_rejected"))
    joined = measured.join(verdicts, F.col(host).eqNullSafe(F.col("_verdict_of")), "left")
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("_rejected"), F.lit(False))
    return joined.withColumn("kept", kept).drop("_verdict_of", "_rejected")


def filtered(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that pass, with the columns of ``docs``.

    Each text is measured once: the rows are written with their own verdict, of which the hosts'
    rates read no text. The rejected hosts are written too, so Spark knows their size when it plans
    the join: few of them are broadcast and no text is shuffled.
    """
    failed = _measured(F.col("_row")[text])["base_failed"].alias("base_failed")
    rows = docs.select(whole_row(docs).alias("_row")).select("_row", F.col("_row")[host].alias("_host"), failed)
    rows = written(rows, "quality-rows", compression="zstd")  # it lies there until its reader is done
    hosts = host_verdicts(rows, "_host").filter("rejected")
    rejected = written(hosts.select("host", "rejected"), "quality-hosts")
    return judged(rows, rejected, "_host").filter("kept").select("_row.*")

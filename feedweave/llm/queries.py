"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers

from feedweave.llm import chunks, imatch, language, licences, mixing, packing, periods, quality, repair, simhash, sql, substrings, tokenids, warc
from feedweave.llm.words import words
from feedweave.session import scratch_dir
from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if oracle is not None:
            ORACLE[run.__name__] = oracle
        return run

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query(sql.MIXING)
def op1_mixing(spark, sf_dir):
    taken = mixing.sampled(documents(spark, sf_dir))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query()
def op2_token_ids(spark, sf_dir):
    path = scratch_dir(spark, "token-ids")
    tokenids.write(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"))
    return tokenids.index(tokenids.read(spark, path))


@query()
def op3_content_defined_chunks(spark, sf_dir):
    cut = chunks.deduplicated(documents(spark, sf_dir))
    return cut.select("_doc.doc_id", "text_left", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op4_imatch(spark, sf_dir):
    return imatch.compared(documents(spark, sf_dir))


@query(sql.QUALITY)
def op5_quality_rules(spark, sf_dir):
    from feedweave.llm.ranks import written

    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    measured = written(quality.measures(docs).drop("text"), "quality")
    return quality.judged(measured, quality.host_verdicts(measured)).drop("source")


@query()
def op6_suffix_array_dedup(spark, sf_dir):
    cut = substrings.deduplicated(documents(spark, sf_dir))
    return cut.select("_doc.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op7_packing(spark, sf_dir):
    return packing.packed(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query(sql.LICENCES)
def op8_licences(spark, sf_dir):
    """The table has no paths: sources stand for repositories, and one document in 20 for a licence file."""
    i = F.col("doc_id")
    name = F.when(i % 20 == 0, F.lit("LICENSE.txt")).otherwise(F.concat(i.cast("string"), F.lit(".txt")))
    path = F.concat("source", F.lit("/"), "lang", F.lit("/"), (F.floor(i / 20) % 5).cast("string"), F.lit("/"), name)
    return licences.scanned(documents(spark, sf_dir), path)


@query()
def op9_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    held_out = F.coalesce(rest == 2, F.lit(False)).alias("held_out")
    prototypes = language.learn(docs.filter(~held_out))
    return language.predicted(docs, prototypes, "doc_id", held_out)


@query()
def op10_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


def looped(doc_id, text):
    """Every tenth text, by the id's crc32, ends in a loop of some of its own words."""
    h = F.crc32(doc_id.cast("string").cast("binary"))

    def edit(x):
        n, g, w = F.size(x["w"]), x["g"], x["w"]
        a = F.pmod(g, n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")

        def at(place):
            return F.array_join(F.transform(w, lambda word, i: F.when(i < place["a"], word).otherwise(F.get(w, place["a"] + (i - place["a"]) % place["p"]))), " ")

        return F.when(n > 0, quality.let(F.struct(a.alias("a"), p.alias("p")), at)).otherwise(text)

    return F.when(h % 10 == 0, quality.let(F.struct(words(text).alias("w"), F.floor(h / 10).alias("g")), edit)).otherwise(text)


@query()
def op11_periodic_runs(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = periods.periodic_runs(docs.select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text")), F.col("text"), keep=["doc_id"])

    def longer(best, r):
        more = r["length"] * best["period"] > best["length"] * r["period"]
        return F.when(best["period"].isNull() | more, r).otherwise(best)

    best = F.aggregate("runs", F.get("runs", F.lit(-1)), longer)  # begins with NULL
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return found.withColumn("best", best).select(
        "_doc.doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


def damaged(rows):
    """Conversations of which every fourth row or so has a fault, by the crc32 of conversation and turn."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("_fault", F.crc32(key.cast("binary")) % 20).filter("_fault != 0")
    fault, text = F.col("_fault"), F.coalesce("text", space)
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(F.coalesce("role", space)).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    ).drop("_copy")


@query()
def op12_conversation_repair(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = repair.repaired(damaged(rows))
    sums = repair.digests(found.turns, "conv_id", "place", F.concat("role", F.lit(":"), "text"))
    every = rows.select(F.col("conv_id").alias("_id")).distinct()
    audits = every.join(found.audits, F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    joined = audits.join(sums, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        F.col("_id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query(sql.WARC)
def op13_warc(spark, sf_dir):
    path = scratch_dir(spark, "warc")
    warc.write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path, date="2026-01-01T00:00:00Z", compression="gzip")
    found = warc.resolved(warc.captures(warc.records(spark, path)))
    ids = {c: F.col(c).cast("long") for c in ("page_id", "refers_to")}
    return found.withColumns(ids).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

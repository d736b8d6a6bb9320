"""Licence scan on DataFrame functions alone: TF-IDF cosine to notices and licence texts, inheritance by directory.

A document's lines are compared with the notices below as sparse TF-IDF vectors, and so are
its header (the leading comment, or the lines ahead of the first blank one) and, of a licence
file, its whole text with the standard headers and texts in ``licence_texts``; each different
line or block once, however many documents repeat it. Terms of notices weigh by the notices,
those of blocks by the corpus and the standard texts. Of terms that every match must share,
the rarest tell which lines and blocks are compared at all. A document has the licence of its
best line or block above the threshold. One without any inherits from the licence file
in the nearest directory above it: the different directories are joined with all their
ancestors, and documents with their directory.

Defined cases: a NULL or empty text has no line; a NULL path is in no directory and inherits
nothing; of licences equally near, and of several licence files of one directory, the first
by name counts; rows of one id and path are one file and get equal results; other columns
take no part; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from pathlib import Path

from feedweave.llm.ranks import written
from pyspark.sql import Column, DataFrame, functions as F

# What the notices of common licences say.
NOTICES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
TEXTS = Path(__file__).parent / "licence_texts"
#: A line of a comment.
COMMENT = r"^\s*(?:#|//|/\*|\*|--|;|%|<!--|dnl |rem |\(\*)"
TERM = r"[a-z0-9]+"
THRESHOLD = 0.8
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)(\.\w+)?$"


def _weights(texts: DataFrame, keys: list[str], idf: DataFrame, unknown: Column) -> DataFrame:
    """(*keys, term, weight): unit vectors, terms weighing their count times their idf."""
    terms = texts.select(*keys, F.explode(F.regexp_extract_all(F.lower("line"), F.lit(TERM), F.lit(0))).alias("term"))
    counted = terms.groupBy(*keys, "term").agg(F.count("*").alias("tf")).join(idf, "term", "left")
    weighed = counted.withColumn("weight", F.col("tf") * F.coalesce("idf", unknown))
    length = weighed.groupBy(*keys).agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("length"))
    return weighed.join(length, keys).select(*keys, "term", (F.col("weight") / F.col("length")).alias("weight"))


def matches(lines: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(line, licence, similarity) for the different lines that are near a notice: the nearest one's licence."""
    spark, n = lines.sparkSession, len(NOTICES)
    notices = spark.createDataFrame([(k, *notice) for k, notice in enumerate(NOTICES)], "notice int, licence string, line string")
    terms = notices.select("notice", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("line"), F.lit(TERM), F.lit(0)))).alias("term"))
    idf = terms.groupBy("term").agg((F.log((1 + F.lit(n)) / (1 + F.count("*"))) + 1).alias("idf"))
    unknown = F.log(F.lit(1.0 + n)) + 1
    theirs = _weights(notices, ["notice", "licence"], idf, unknown).withColumnRenamed("weight", "theirs")
    shared = _weights(lines, ["line"], idf, unknown).join(theirs, "term")
    near = shared.groupBy("line", "notice", "licence").agg(F.round(F.sum(F.col("weight") * F.col("theirs")), 6).alias("similarity"))
    best = F.min(F.struct((-F.col("similarity")).alias("far"), "licence")).alias("best")
    near = near.filter(F.col("similarity") >= threshold).groupBy("line").agg(best)
    return near.select("line", F.col("best.licence").alias("licence"), (-F.col("best.far")).alias("similarity"))


def standard_texts() -> list[tuple[str, str]]:
    """(licence, text): headers and whole texts. The Affero licence is worded as the GPL 3 but for its name."""
    texts = [(file.name.removesuffix(".txt").removesuffix(".header"), file.read_text()) for file in sorted(TEXTS.glob("*.txt"))]
    gpl = next(t for file, t in ((f, f.read_text()) for f in TEXTS.glob("GPL-3.0.txt")))
    affero = re.sub("GNU (GENERAL|General)", lambda m: "GNU " + ("AFFERO " if m[1].isupper() else "Affero ") + m[1], gpl)
    bsd = (TEXTS / "BSD-3-Clause.txt").read_text()
    third = re.search(r"^3\..*?\n(?=\s*\n|THIS)", bsd, re.DOTALL | re.MULTILINE)
    return [*texts, ("AGPL-3.0", affero), ("BSD-2-Clause", bsd.replace(third[0], ""))]


def _unit(text: str, idf: dict[str, float], unknown: float) -> dict[str, float]:
    weights = {term: n * idf.get(term, unknown) for term, n in Counter(re.findall(TERM, text.lower())).items()}
    length = math.sqrt(sum(w * w for w in weights.values()))
    return {term: w / length for term, w in weights.items()}


def required(vectors: Iterable[dict[str, float]], rare: dict[str, float], threshold: float) -> list[str]:
    """Terms of which every text has one whose cosine to one of the unit vectors reaches the threshold.

    Without any of them it shares only the others, whose squared weights add up to less than
    the squared threshold. Of each vector the rarest terms are taken.
    """
    taken = set()
    for vector in vectors:
        left = 1.0
        for term in sorted(vector, key=lambda t: (-rare.get(t, 0.0), t)):
            if left < threshold**2 - 1e-5:
                break
            taken.add(term)
            left -= vector[term] ** 2
    return sorted(taken)


def _has(text: Column, terms: list[str]) -> Column:
    return F.arrays_overlap(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)), F.lit(terms))


def _blocks(text: Column, path: Column) -> Column:
    """The header, and the whole text of a licence file."""
    lines = F.split(text, "\n")

    def ahead(ends) -> Column:
        at = F.array_position(F.transform(lines, ends), True)
        return F.array_join(F.slice(lines, F.lit(1), F.when(at == 0, F.size(lines)).otherwise(at - 1).cast("int")), "\n")

    comment = ahead(lambda line: ~line.rlike(COMMENT))
    paragraph = ahead(lambda line: ~line.rlike(r"\S"))
    whole = F.when(F.coalesce(path.rlike(LICENCE_FILE), F.lit(False)), text).otherwise("")
    return F.array_distinct(F.array(comment, paragraph, whole))


def corpus_idf(texts: DataFrame, standard: list[tuple[str, str]]) -> tuple[DataFrame, float]:
    """(term, idf) of all terms of the corpus' ``line`` and the standard texts, and the weight of any other term."""
    added = texts.sparkSession.createDataFrame([(text,) for _, text in standard], "line string")
    every = texts.select("line").unionAll(added)
    n = float(texts.count() + len(standard))
    terms = every.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("line"), F.lit(TERM), F.lit(0)))).alias("term"))
    idf = terms.groupBy("term").agg((F.log((1 + F.lit(n)) / (1 + F.count("*"))) + 1).alias("idf"))
    return written(idf, "licence-idf", release=True), math.log(1 + n) + 1


def block_matches(blocks: DataFrame, idf: DataFrame, unknown: float, vectors: list[tuple[str, dict]], threshold: float) -> DataFrame:
    """(key, licence, similarity) of the different blocks (key, line) near a standard text: the nearest one's licence."""
    rows = [(k, licence, term, weight) for k, (licence, vector) in enumerate(vectors) for term, weight in vector.items()]
    theirs = blocks.sparkSession.createDataFrame(rows, "standard int, licence string, term string, theirs double")
    shared = _weights(blocks, ["key"], idf, F.lit(unknown)).join(theirs, "term")
    near = shared.groupBy("key", "standard", "licence").agg(F.round(F.sum(F.col("weight") * F.col("theirs")), 6).alias("similarity"))
    best = F.min(F.struct((-F.col("similarity")).alias("far"), "licence")).alias("best")
    near = near.filter(F.col("similarity") >= threshold).groupBy("key").agg(best)
    return near.select("key", F.col("best.licence").alias("licence"), (-F.col("best.far")).alias("similarity"))


def scanned(
    docs: DataFrame, path: Column, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, path, licence, similarity, origin ('own', 'inherited' or NULL), inherited_from and distance in levels."""
    standard, body = standard_texts(), F.coalesce(F.col(text), F.lit(""))
    idf, unknown = corpus_idf(docs.select(body.alias("line")), standard)
    named = sorted({term for _, line in [*standard, *NOTICES] for term in re.findall(TERM, line.lower())})
    weigh = dict(idf.filter(F.col("term").isin(named)).collect())
    rare = {term: weigh.get(term, unknown) for term in named}
    vectors = [(licence, _unit(line, weigh, unknown)) for licence, line in standard]
    held = Counter(term for _, line in NOTICES for term in set(re.findall(TERM, line.lower())))
    by_notices = {term: math.log((1 + len(NOTICES)) / (1 + n)) + 1 for term, n in held.items()}
    cues = required((_unit(line, by_notices, 0.0) for _, line in NOTICES), rare, threshold)
    block_cues = required((vector for _, vector in vectors), rare, threshold)
    cued = F.filter(F.split(body, "\n"), lambda line: _has(line, cues))
    blocks = F.when(_has(body, block_cues), F.filter(_blocks(body, path), lambda block: _has(block, block_cues)))
    narrow = written(docs.select(
        F.col(doc_id).alias("doc_id"), path.alias("path"), F.array_distinct(cued).alias("lines"),
        F.coalesce(blocks, F.array().cast("array<string>")).alias("blocks"),
    ), "licences")
    found = matches(narrow.select(F.explode("lines").alias("line")).distinct(), threshold)
    told = narrow.filter(F.size("lines") > 0).select("doc_id", "path", F.explode("lines").alias("line")).join(found, "line")
    each = narrow.select("doc_id", "path", F.explode("blocks").alias("line")).withColumn("key", F.md5(F.col("line").cast("binary")))
    different = each.select("key", "line").groupBy("key").agg(F.first("line").alias("line"))
    whole = each.select("doc_id", "path", "key").join(block_matches(different, idf, unknown, vectors, threshold), "key")
    columns = ["doc_id", "path", "licence", "similarity"]
    told = told.select(columns).unionAll(whole.select(columns))
    best = F.min(F.struct((-F.col("similarity")).alias("far"), "licence")).alias("best")
    own = told.groupBy(F.col("doc_id").alias("_id"), F.col("path").alias("_path")).agg(best)

    file_of = own.filter(F.col("_path").rlike(LICENCE_FILE)).select(_directory(F.col("_path")).alias("above"), "best")
    licensed = file_of.groupBy("above").agg(F.min("best.licence").alias("theirs"))
    directories = narrow.filter("path IS NOT NULL").select(_directory(F.col("path")).alias("directory")).distinct()
    parts = F.filter(F.split("directory", "/"), lambda part: part != "")
    levels = directories.select("directory", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda up: F.array_join(F.slice(parts, F.lit(1), F.size(parts) - up), "/"),
    )).alias("distance", "above"))
    nearest = levels.join(licensed, "above").groupBy("directory").agg(
        F.min(F.struct("distance", F.col("above").alias("inherited_from"), "theirs")).alias("near"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("path").eqNullSafe(F.col("_path"))
    joined = narrow.select("doc_id", "path", _directory(F.col("path")).alias("directory")).join(own, same, "left")
    joined = joined.join(nearest, "directory", "left")
    mine, near = F.col("best.licence").isNotNull(), F.col("near.theirs").isNotNull()
    inherits = ~mine & near
    return joined.select(
        "doc_id", "path", F.coalesce("best.licence", "near.theirs").alias("licence"),
        F.when(mine, -F.col("best.far")).alias("similarity"),
        F.when(mine, "own").when(near, "inherited").alias("origin"),
        F.when(inherits, F.col("near.inherited_from")).alias("inherited_from"),
        F.when(inherits, F.col("near.distance").cast("long")).alias("distance"),
    )


def _directory(path: Column) -> Column:
    """The path without its last part and without empty parts; '' for a file at the top."""
    parts = F.filter(F.split(path, "/"), lambda part: part != "")
    return F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), "/")

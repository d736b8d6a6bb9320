"""Each operator on odd and empty tables, on clashing columns, and its inner parts by themselves."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from llm_data import empty, in_order, linked, odd, odd_rows, simhash, substrings
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedweave.llm import chunks, components, imatch, language, licences, mixing, packing, quality, simhash as sim, substrings as subs, tokenids
from feedweave.llm.lyndon import suffix_arrays
from feedweave.llm.ranks import one_of_each, row_hash, running_sums
from feedweave.llm.tokens import TextEncoder
from feedweave.session import scratch_dir

BYTES, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ROWS = odd_rows()


@contextmanager
def many_partitions(spark):
    """Small tables in as many partitions as large ones."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    settings = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# --- shared parts


def test_running_sums_cover_hot_and_null_keys(spark):
    rows = [(None if k % 3 == 0 else "a" if k % 3 == 1 else f"k{k}", k % 7, k) for k in range(400)]
    df = spark.createDataFrame(rows, "key string, ord int, v long").repartition(5).withColumns({"_at": -F.col("v"), "_part": F.col("v")})
    with many_partitions(spark):
        got = running_sums(df, ["key"], ["ord", "v"], ["v"], "t").collect()
    assert all((r["_at"], r["_part"]) == (-r["v"], r["v"]) for r in got)
    ahead = defaultdict(int)
    for key, _, v in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        row = next(r for r in got if r["v"] == v)
        assert row["before_v"] == ahead[key]
        ahead[key] += v


def test_one_row_of_equal_content(spark):
    df = odd(spark)
    kept = one_of_each(df.withColumn("_k", row_hash(df)), "_k").count()
    assert kept == len({repr(r) for r in ROWS})


@pytest.mark.parametrize("path", [BYTES, WORD])
def test_pieces_give_the_ids_of_the_whole_text(path):
    encoder, rng = TextEncoder(path, known_pieces=50), random.Random(1)
    texts = [r[1] for r in ROWS if r[1]] + [
        "".join(rng.choice("ab é.,'s  \n\t\x1c 　H̱😀1<|endoftext|>ßÀñ") for _ in range(rng.randrange(60))) for _ in range(600)
    ]
    for text in texts * 2:
        expected = encoder._tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == expected, text
    found = encoder.encode_all(pa.array([None, "", *texts]))
    assert found[0] == found[1] == b""
    assert [bytes(ids) for ids in found[2:]] == [encoder.encode(text) for text in texts]


@pytest.mark.parametrize("path", [BYTES, WORD])
def test_every_letter_before_a_mark(path):
    """Some letters' normal forms end in a combining mark, which belongs to the mark's unit."""
    import sys

    untouched, encoder = Tokenizer.from_file(path), TextEncoder(path)
    letters = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isalpha()]
    texts = [f"x a{c}. b{c}, {c}" for c in letters]
    expected = [e.ids for e in untouched.encode_batch(texts, add_special_tokens=False)]
    found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode_all(pa.array(texts))]
    assert [t for t, a, b in zip(texts, expected, found) if a != b] == []
    assert [t for t, a in zip(texts[:20000], expected) if np.frombuffer(encoder.encode(t), "<u4").tolist() != a] == []
    for text in ("TÜRKİYE CUMHURİYETİ, ANKARA", "Ｆｕｌｌ, ﬁ. ǅ, ß."):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == untouched.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORD])
def test_signs_behind_words(path):
    """Runs of signs at a piece's end, alone and in the company of contractions."""
    import string

    untouched, encoder, rng = Tokenizer.from_file(path), TextEncoder(path), random.Random(6)
    signs = string.punctuation
    texts = [f"a word{x}{y} wörd{y}{x}{x} WORD{x}\nthen{y} {x}{y}lead it's{x} x{y}s 'll{x} don't{y}." for x in signs for y in signs]
    for _ in range(1500):
        words = []
        for _ in range(12):
            run = "".join(rng.choice(signs + "'" * 6) for _ in range(rng.randrange(5)))
            words.append(rng.choice(["it", "Ça", "ß", "don", "x1", "é", ""]) + run + rng.choice(["", "s", "ll", "\n"]))
        texts.append(" ".join(words))
    expected = [e.ids for e in untouched.encode_batch(texts, add_special_tokens=False)]
    found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode_all(pa.array(texts))]
    assert [t for t, a, b in zip(texts, expected, found) if a != b] == []


@pytest.mark.parametrize("path", [BYTES, WORD])
def test_strings_of_added_tokens_become_their_ids(path):
    untouched, encoder = Tokenizer.from_file(path), TextEncoder(path)
    marks = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext|", "endoftext"]
    texts = [form.replace("#", mark) for mark in marks for form in ("a#b", "#", "one # two", "one\n#  é", "x##\n", "plain words, # and # again.")]
    texts += ["plain words, and again."]
    expected = [untouched.encode(text, add_special_tokens=False).ids for text in texts]
    assert [np.frombuffer(encoder.encode(text), "<u4").tolist() for text in texts] == expected
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode_all(pa.array(texts))] == expected


def test_components_of_chains_stars_and_loops(spark):
    rng, edges = random.Random(2), [(k, k + 1) for k in range(60)] + [(500, k) for k in range(501, 560)] + [(9000, 9000)]
    edges += [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(150)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in root if find(x) != x}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1 mixing


def test_mixing_odd(spark):
    rows = mixing.sampled(odd(spark)).collect()
    assert len(rows) == len(ROWS)
    mixed = mixing.mixed(odd(spark))
    assert mixed.dtypes == odd(spark).dtypes
    assert mixed.count() == sum(r["copies"] for r in rows)
    assert all(0 <= r["copies"] <= 2 for r in rows)
    assert Counter(repr(r["doc_id"]) for r in mixed.collect()) == Counter(repr(r["doc_id"]) for r in rows for _ in range(r["copies"]))
    assert mixing.sampled(empty(spark)).count() == 0 and mixing.mixed(empty(spark)).count() == 0


def test_mixing_of_wordless_sources(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, None, None), (3, "w " * 30, "b")], "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["target"], r["copies"]) for r in mixing.sampled(df).collect()}
    assert got[1] == (0.0, 0) and got[2] == (0.0, 0) and got[3][0] == 45.0


# --- 2 token ids


def test_token_ids_odd(spark):
    path = scratch_dir(spark, "orc")
    tokenids.write(odd(spark), path, WORD)
    rows = tokenids.index(tokenids.read(spark, path)).collect()
    assert len(rows) == len(ROWS) and min(r["n_tokens"] for r in rows) == 1
    end = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == end
        end += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    path = scratch_dir(spark, "orc")
    tokenids.write(empty(spark), path, WORD)
    assert tokenids.index(tokenids.read(spark, path)).count() == 0


def test_token_files_have_bloom_filters_and_prune(spark):
    import glob

    path = scratch_dir(spark, "orc")
    tokenids.write(spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text")), path, WORD)
    jvm, kinds = spark._jvm, set()
    for file in glob.glob(f"{path}/*.orc"):
        options = jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration())
        reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(file), options)
        assert reader.getRowIndexStride() == tokenids.ROWS_PER_INDEX
        for stripe in reader.getStripes():
            kinds |= {str(stream.getKind()) for stream in reader.rows().readStripeFooter(stripe).getStreamsList()}
    assert {"ROW_INDEX", "BLOOM_FILTER_UTF8"} <= kinds
    one = tokenids.read(spark, path).filter("doc_id = 4321")
    assert [r["doc_id"] for r in one.collect()] == [4321]
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,4321)]" in one._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


# --- 3 chunks, 6 suffix arrays


def test_chunks_resync_behind_an_insertion():
    gears = (subs._letters() >> np.uint64(32)).astype(np.uint32)
    rng = random.Random(3)
    data = bytes(rng.randrange(97, 123) for _ in range(4000))

    def cut(d):
        ends = chunks.chunk_ends(d, gears)
        return [d[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    shared = set(cut(data)) & set(cut(data[:1000] + b"inserted" + data[1000:]))
    assert sum(map(len, shared)) > 3500 and b"".join(cut(data)) == data
    sizes = [len(c) for c in cut(data)]
    assert max(sizes) <= chunks.MOST and min(sizes[:-1]) >= chunks.LEAST
    assert chunks.chunk_ends(b"", gears) == [] and chunks.chunk_ends(b"ab", gears) == [2]


def test_gear_hash_over_strides(monkeypatch):
    gears = (subs._letters() >> np.uint64(32)).astype(np.uint32)
    data = bytes(random.Random(4).randrange(256) for _ in range(5000))
    whole = chunks.gear_ends(data, gears).tolist()
    monkeypatch.setattr(chunks, "STRIDE", 700)
    assert chunks.gear_ends(data, gears).tolist() == whole


@pytest.mark.parametrize("operator", [chunks, subs])
def test_substring_operators_odd(spark, operator):
    rows = operator.deduplicated(odd(spark)).select("_doc.doc_id", "_doc.text", "_doc.source", "n_bytes", "n_removed").collect()
    assert len(rows) == len(ROWS)
    assert Counter((repr(r[0]), r[1]) for r in rows) == Counter((repr(r[0]), r[1]) for r in ROWS)
    results = defaultdict(set)
    for r in rows:
        assert r["n_bytes"] == len((r["text"] or "").encode())
        results[repr(r["doc_id"]), r["text"]].add(r["n_removed"])
    assert all(len(v) == 1 for v in results.values())  # repeated rows are one document
    with_passage = [v for (_, t), v in results.items() if t and t.startswith(ROWS[8][1][:200])]
    assert with_passage and all(min(v) > 300 for v in with_passage)
    assert operator.deduplicated(empty(spark)).count() == 0


@pytest.mark.parametrize("operator", [chunks, subs])
def test_repeated_rows_are_no_copies_of_themselves(spark, operator):
    rng = random.Random(12)
    texts = [" ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(10**6)) for _ in range(60)) for _ in range(4)]
    texts += [texts[0] + " " + texts[3], ""]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([*rows, *rows[:3], rows[0], rows[4], rows[5]], "doc_id long, text string").repartition(3)
    got = operator.deduplicated(df).select("_doc.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert len(got) == len(rows) + 6
    assert all(r["n_removed"] == 0 for r in got if r["doc_id"] < 4)  # they occur nowhere else
    if operator is subs:
        assert in_order(list({tuple(r) for r in got})) == substrings(rows, 100)
    else:
        alone = operator.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
        assert {tuple(r) for r in got} == {tuple(r) for r in alone.select("_doc.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}


def test_remaining_texts_are_whole_characters(spark):
    text = "é" * 75
    df = spark.createDataFrame([(1, text, 75), (2, "x" + text, 76), (3, None, None)], "doc_id long, text string, n_chars int")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in subs.remaining(df).collect()}
    assert got[3] == (None, None) and got[2] == ("x", 1)
    assert df.dtypes == subs.remaining(df).dtypes


def test_substrings_equal_brute_force_with_floods_and_small_groups(spark):
    rng = random.Random(6)
    for letters, bound, held in (("abc", 2, 3), ("ab", 64, 1 << 20), ("abcdefgh", 2, 1 << 20)):
        base = ["".join(rng.choice(letters) for _ in range(rng.choice([60, 150, 400]))) for _ in range(4)]
        rows = [
            (k * 3 - 20, "a" * rng.randrange(300) if k % 7 == 0 else "".join(
                rng.choice(base)[rng.randrange(30):rng.randrange(60, 500)] for _ in range(rng.randrange(4))))
            for k in range(60)
        ]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = subs.deduplicated(df, length=40, bound=bound, held=held)
        got = got.select("_doc.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
        assert in_order([tuple(r) for r in got]) == substrings(rows, 40)


def test_anchors_over_strides(monkeypatch):
    data = bytes(random.Random(7).randrange(97, 100) for _ in range(6000)) + b"z" * 400
    whole = [x.tolist() for x in subs.anchors(data, 100, subs._letters())]
    monkeypatch.setattr(subs, "STRIDE", 777)
    assert [x.tolist() for x in subs.anchors(data, 100, subs._letters())] == whole


@given(st.lists(st.lists(st.integers(0, 3), max_size=40), min_size=1, max_size=6))
@settings(max_examples=300, deadline=None)
def test_suffix_arrays(texts):
    flat = np.array([x for t in texts for x in t], np.int64)
    starts = np.cumsum([0] + [len(t) for t in texts])[:-1]
    expected = [int(s) + k for t, s in zip(texts, starts) for k in sorted(range(len(t)), key=lambda k: t[k:])]
    assert suffix_arrays(flat, starts).tolist() == expected


# --- 4 I-Match


def test_imatch_odd(spark):
    rows = imatch.compared(odd(spark)).collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in rows) == Counter((r[0], len(r[1] or "")) for r in ROWS)  # repeated ones too
    by_text = defaultdict(set)
    texts = {(r[0], len(r[1] or "")): r[1] or "" for r in ROWS}
    for r in rows:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        by_text[texts[r["doc_id"], r["n_chars"]]].add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    assert imatch.compared(empty(spark)).count() == 0


def test_imatch_over_many_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    few = {r["doc_id"]: r for r in imatch.compared(docs).collect()}
    with many_partitions(spark):
        many = {r["doc_id"]: r for r in imatch.compared(docs.repartition(9)).collect()}
    assert len(few) == docs.count() and many == few


def _likeness(a, b):
    either = [(x, y) for x, y in zip(a, b, strict=True) if x is not None or y is not None]
    return sum(x == y for x, y in either) / len(either)


def test_imatch_of_a_large_group_of_near_copies(spark):
    rng = random.Random(13)

    def prose(n):
        return [f"w{rng.randrange(4000)}" for _ in range(n)]

    one, texts = prose(60), [" ".join(prose(60)) for _ in range(200)]
    for k in range(100):
        words = list(one)
        words[rng.randrange(60)] = f"new{k}"
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "_at long, text string")
    prints = dict(imatch.fingerprints(df, {"fp": F.col("text")}, df).select("_at", "fp").collect())
    group = [prints[k] for k in range(200, 300)]
    assert min(_likeness(a, b) for a, b in zip(group, group[1:])) > 0.7
    assert max(_likeness(prints[k], group[0]) for k in range(100) if len(prints[k]) == len(group[0])) < 0.2


def test_imatch_counts_terms_over_different_texts(spark):
    texts = [f"common own{k}" for k in range(100)]
    rows = [(t,) for t in texts + 40 * ["common own7"] + 3 * ["common own8"]]
    df = spark.createDataFrame(rows, "text string").repartition(3)
    df = df.withColumn("text", F.concat("text", F.lit(" of"), F.regexp_replace("text", r"\D", "") % 40))
    counts, n = imatch.counted(df, F.col("text"), 4.2)
    of = {k: sum(j % 40 == k for j in range(100)) for k in range(40)}
    words = spark.createDataFrame([("common", 100), *[(f"of{k}", m) for k, m in of.items()]], "t string, df long").select(F.xxhash64("t").alias("h"), "df")
    assert n == 100 and {tuple(r) for r in counts.collect()} == {tuple(r) for r in words.collect()}
    found = imatch.lexicon(counts, n, 3.6, 4.0)
    assert {r["h"] for r in found.filter("rank = 0").collect()} == {r["h"] for r in words.filter("df = 2").collect()}
    assert {tuple(r) for r in found.filter("rank > 0").collect()} == {tuple(r) for r in words.filter("df > 2").collect()}
    assert imatch.counted(df, F.col("text"), 5.0)[0].count() == 141  # terms of one text are in the band of so few


def brute_prints(texts, corpus, min_idf=imatch.MIN_IDF, max_idf=imatch.MAX_IDF, enough=imatch.ENOUGH):
    """Of each text the set of terms that its fingerprint is made of."""
    import math

    def terms(text):
        return set(re.findall(r"[^\W_]+", text.lower()))

    df = Counter(t for text in set(corpus) for t in terms(text))
    n = len(set(corpus))

    def rank(t):
        idf = math.log(n / max(df[t], 1))
        return (0, 0.0) if min_idf <= idf <= max_idf else (1, min_idf - idf) if idf < min_idf else (2, idf - min_idf)

    used = []
    for text in texts:
        ranked = sorted(terms(text), key=rank)
        upto = max(sum(rank(t)[0] == 0 for t in ranked), enough)
        used.append((set(ranked[:upto]), upto >= len(ranked) or rank(ranked[upto - 1]) < rank(ranked[upto])))
    return used


def test_imatch_fingerprints_are_made_of_the_nearest_terms(spark, sf_dir):
    """Equal sets of terms have equal fingerprints, and different ones differ in the parts that differ."""
    docs = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    df = spark.createDataFrame(list(enumerate(docs)), "_at long, text string").repartition(3)
    prints = dict(imatch.fingerprints(df, {"fp": F.col("text")}, df).select("_at", "fp").collect())
    used = brute_prints(docs, docs)
    part = {r["t"]: (r["k"], r["h"]) for r in spark.createDataFrame([(t,) for t in set().union(*(u for u, _ in used))], "t string").select(
        "t", F.pmod(F.xxhash64(F.xxhash64("t"), F.lit(1)), F.lit(imatch.SUBSETS)).alias("k"), F.xxhash64("t").alias("h")).collect()}
    sets = {}
    checked = 0
    for k, (terms, certain) in enumerate(used):
        if not certain or not terms:
            continue  # terms of equal rank at the edge are told apart by a hash
        checked += 1
        parts = defaultdict(set)
        for t in terms:
            parts[part[t][0]].add(t)
        assert [h is not None for h in prints[k]] == [p in parts for p in range(imatch.SUBSETS)]
        for p, those in parts.items():
            assert sets.setdefault(prints[k][p], (p, frozenset(those))) == (p, frozenset(those))
    assert checked > len(docs) / 2 and len(sets) > 1000


def test_imatch_is_gradual_where_few_terms_are_in_the_band(spark):
    """Texts of a few more or fewer terms of the band than enough are alike if their terms are."""
    rng = random.Random(3)
    corpus = [" ".join([f"r{rng.randrange(4000)}" for _ in range(40)] + [f"c{rng.randrange(60)}" for _ in range(30)]) for _ in range(400)]
    pairs = []
    for k in range(0, 40):
        words = corpus[k].split()
        pairs += [" ".join(words), " ".join(words[:k] + words[k + 1:])]
    df = spark.createDataFrame(list(enumerate(pairs)), "_at long, text string")
    whole = spark.createDataFrame([(t,) for t in corpus], "text string")
    prints = dict(imatch.fingerprints(df, {"fp": F.col("text")}, whole).select("_at", "fp").collect())
    assert min(_likeness(prints[k], prints[k + 1]) for k in range(0, 80, 2)) > 0.7


def test_imatch_joins_a_large_lexicon(spark, sf_dir, monkeypatch):
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120), odd(spark)):
        looked_up = sorted(map(repr, imatch.compared(docs).collect()))
        monkeypatch.setattr(imatch, "MOST_TERMS", -1)
        assert sorted(map(repr, imatch.compared(docs).collect())) == looked_up
        monkeypatch.undo()


def test_imatch_of_one_document(spark):
    row = imatch.compared(spark.createDataFrame([(5, "a b c")], "doc_id long, text string")).first()
    assert row["near_next"] == 1.0 and row["n_chars"] == 5


@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300))
@settings(max_examples=60, deadline=None)
def test_cuckoo_table_finds_every_hash(hashes):
    table = imatch.hash_table(sorted(hashes))
    assert all(h in (table[a], table[b]) for h in hashes for a, b in [imatch._places(h, len(table))])


def test_native_operators_stay_in_the_jvm(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = F.concat("source", F.lit("/"), "lang", F.lit("/x"))
    for df in (quality.measures(docs), quality.filtered(docs), imatch.compared(docs), licences.scanned(docs, path)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# --- 5 quality


def test_quality_odd(spark):
    measured = quality.measures(odd(spark))
    rows = quality.judged(measured, quality.host_verdicts(measured)).collect()
    assert len(rows) == len(ROWS)
    assert all(r["base_failed"] for r in rows if not r["text"] or len(r["text"].split()) < 50)
    filtered = quality.filtered(odd(spark))
    assert filtered.dtypes == odd(spark).dtypes
    assert filtered.count() == sum(r["kept"] for r in rows)
    assert quality.filtered(empty(spark)).count() == 0


def test_quality_rejects_a_bad_host_but_not_a_small_one(spark):
    good, bad = " ".join(f"w{k}" for k in range(60)), "too short"
    rows = [(good if k % 7 else bad, f"h{k % 60}") for k in range(1200)] + [(bad, "spam")] * 300 + [(good, "spam")] * 5 + [(bad, "tiny")]
    measured = quality.measures(spark.createDataFrame(rows, "text string, source string"))
    verdicts = {r["host"]: r["rejected"] for r in quality.host_verdicts(measured).collect()}
    assert verdicts == {f"h{k}": False for k in range(60)} | {"spam": True, "tiny": False}


# --- 7 packing


def test_results_do_not_depend_on_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    def results(df):
        path = scratch_dir(spark, "orc")
        tokenids.write(df, path, WORD)
        frames = (
            mixing.sampled(df), tokenids.index(tokenids.read(spark, path)), packing.packed(df, BYTES).drop("sequence_id", "offset"),
            sim.near_duplicates(df), subs.deduplicated(df).select("_doc.doc_id", "n_removed", "n_spans", "kept_sha256"),
            chunks.deduplicated(df).select("_doc.doc_id", "n_removed", "n_spans", "kept_sha256"),
        )
        return [sorted(map(tuple, f.collect())) for f in frames]

    few = results(docs)
    with many_partitions(spark):
        assert results(docs.repartition(9)) == few


def test_packing_odd(spark):
    rows = packing.packed(odd(spark), BYTES).collect()
    assert sum(r["piece"] == 0 for r in rows) == len(ROWS)
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for some in places.values():
        some.sort()
        assert [o for o, _ in some] == [sum(n for _, n in some[:k]) for k in range(len(some))]
        assert sum(n for _, n in some) <= 1024
    assert packing.packed(empty(spark), BYTES).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40))
@settings(max_examples=60, deadline=None)
def test_plans_hold_every_length_once(histogram):
    kinds = packing.plan(histogram, 64, groups=8)
    held = Counter()
    for times, items in kinds:
        assert times > 0 and sum(length * n for length, n in items) <= 64
        for length, n in items:
            held[length] += times * n
    assert held == Counter(histogram)


def test_plans_are_near_the_lower_bound():
    rng = random.Random(8)
    histogram = Counter(rng.randrange(1, 1024) for _ in range(100_000))
    used = sum(times for times, _ in packing.plan(histogram))
    assert used <= 1.005 * sum(k * n for k, n in histogram.items()) / 1024


def test_most_large_pieces_are_packed_by_configurations():
    rng = random.Random(4)
    histogram = Counter(min(int(rng.lognormvariate(5.6, 0.9)) + 2, 1024) for _ in range(30_000))
    counts = {length: n for length, n in histogram.items() if length < 1024}
    kinds, left = packing.configured(counts)
    large = sum(n for length, n in counts.items() if length > packing.CAPACITY * packing.SMALL)
    held = Counter()
    for times, items in kinds:
        for length, copies in items:
            held[length] += times * copies
    assert all(length > packing.CAPACITY * packing.SMALL for length in held)
    assert {k: held[k] + left.get(k, 0) for k in counts} == counts
    assert sum(held.values()) >= 0.9 * large
    made = packing.plan(histogram)
    assert sum(times for times, _ in made) <= 1.005 * sum(length * n for length, n in histogram.items()) / 1024 + 2


# --- 8 licences


def test_licences_are_inherited_from_the_nearest_directory(spark):
    rows = [
        (1, "r/LICENSE", "x\nReleased under the MIT License."), (2, "r/a/COPYING.txt", "Licensed under the Apache License, Version 2.0."),
        (3, "r/a/b/f.txt", "nothing"), (4, "r/c/g.txt", "none"), (5, "q/h.txt", None), (6, None, "Licensed under CC BY-NC 4.0"),
        (7, "r/a/b/own.txt", "Licensed under CC BY 4.0"), (7, "r/a/b/own.txt", "Licensed under CC BY 4.0"), (8, "top", ""),
        (9, "r/a/b/v2.txt", "This work is licensed under the GNU General Public License, version 2."),
        (10, "r/z.txt", "I hereby grant no permission at all, says the licence of my driver"),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, p string, text string, licence string")
    got = Counter((r["doc_id"], r["licence"], r["origin"], r["inherited_from"], r["distance"]) for r in licences.scanned(df, F.col("p")).collect())
    assert got == Counter([
        (1, "MIT", "own", None, None), (2, "Apache-2.0", "own", None, None), (3, "Apache-2.0", "inherited", "r/a", 1),
        (4, "MIT", "inherited", "r", 1), (5, None, None, None, None), (6, "CC-BY-NC-4.0", "own", None, None),
        (7, "CC-BY-4.0", "own", None, None), (7, "CC-BY-4.0", "own", None, None), (8, None, None, None, None),
        (9, "GPL-2.0", "own", None, None), (10, "MIT", "inherited", "r", 0),
    ])
    assert licences.scanned(odd(spark), F.col("source")).count() == len(ROWS)
    assert licences.scanned(empty(spark), F.col("source")).count() == 0


def test_licences_of_headers_and_whole_files(spark):
    standard = licences.standard_texts()
    header = {licence: text for licence, text in reversed(standard) if len(text) < 1200}
    whole = {licence: text for licence, text in standard}
    prose = " ".join(f"filler{k % 50} words" for k in range(300))

    def comment(licence, mark):
        return "\n".join(mark + " " + header[licence][k:k + 70].replace("\n", " ") for k in range(0, len(header[licence]), 70)) + "\nimport os\n" + prose

    rows = [
        (1, "a/x.py", "# Copyright (C) 2020 Some One\n#\n" + comment("GPL-3.0", "#"), "GPL-3.0"), (2, "a/y.c", comment("LGPL-2.1", " *"), "LGPL-2.1"),
        (3, "b/LICENSE", whole["GPL-2.0"], "GPL-2.0"), (4, "c/COPYING", whole["AGPL-3.0"], "AGPL-3.0"), (5, "d/LICENSE.md", whole["MIT"], "MIT"),
        (6, "e/LICENSE", whole["BSD-2-Clause"], "BSD-2-Clause"), (7, "e/f/z.txt", prose, "BSD-2-Clause"), (8, "g/plain.txt", prose, None),
        (9, "h/LICENSE", whole["GPL-3.0"].replace("\n", "\r\n"), "GPL-3.0"), (10, "i/k.txt", whole["ISC"].replace("\n", " ").strip() + "\n\n" + prose, "ISC"),
        (11, "j/n.txt", "Subject to the terms of the Mozilla Public: This Source Code Form is v. 2.0", "MPL-2.0"),  # no cue word of old
    ]
    df = spark.createDataFrame([(i, p, t) for i, p, t, _ in rows], "doc_id long, p string, text string")
    got = {r["doc_id"]: r["licence"] for r in licences.scanned(df, F.col("p")).collect()}
    assert got == {i: licence for i, _, _, licence in rows}


def test_required_terms_miss_no_match():
    rng = random.Random(14)
    vectors = [licences._unit(line, {}, 1.0) for _, line in licences.NOTICES]
    terms = licences.required(vectors, {t: rng.random() for v in vectors for t in v}, 0.8)
    for vector in vectors:
        assert sum(w * w for t, w in vector.items() if t not in terms) < 0.64


# --- 9 language


def test_language_odd(spark):
    prototypes = language.learn(odd(spark))
    assert set(prototypes) == {"en", "fr"}
    rows = language.predicted(odd(spark), prototypes, "doc_id", "text").collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    nothing = language.learn(empty(spark))
    assert nothing == {} and {r["lang_pred"] for r in language.predicted(odd(spark), nothing).collect()} == {"und"}
    assert language.predicted(empty(spark), prototypes).count() == 0


def test_trigrams_over_strides(monkeypatch):
    profiles = language.Profiles()
    text = "Ab  c, dé!  f𝒳 gh" * 50
    whole = profiles.trigrams(text)
    monkeypatch.setattr(language, "STRIDE", 7)
    parts = profiles.trigrams(text)
    assert parts[0].tolist() == whole[0].tolist() and parts[1].tolist() == whole[1].tolist()


# --- 10 SimHash


def test_simhash_odd(spark):
    rows = sim.near_duplicates(odd(spark)).collect()
    order = in_order(ROWS)
    prints = [simhash(r[1]) for r in order]
    roots = defaultdict(list)
    for row, root in zip(order, linked(prints, 3)):
        roots[root].append(row[0])
    component = {root: min((i for i in ids if i is not None), default=None) for root, ids in roots.items()}
    expected = Counter((r[0], f"{p:016x}", component[k]) for r, p, k in zip(order, prints, linked(prints, 3)))
    assert Counter(tuple(r) for r in rows) == expected
    kept = sim.representatives(odd(spark))
    assert kept.dtypes == odd(spark).dtypes
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(component.values())
    assert sim.near_duplicates(empty(spark)).count() == 0 and sim.representatives(empty(spark)).count() == 0


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(9)
    for level in range(3):
        masks = sim.masks(3, level)
        assert len(masks) == 15
        for _ in range(500):
            flipped = sum(1 << b for b in rng.sample(range(64), rng.randrange(4)))
            assert any(m & flipped == 0 for m in masks)


def test_full_buckets_are_dealt_out_without_a_miss(spark):
    """A ball of fingerprints around one centre, as thousands of near copies make, with tiny buckets."""
    rng, centre = random.Random(10), 0x123456789ABCDEF0
    prints = list({centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 9))) for _ in range(300)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    distinct = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = components.components(sim.links(distinct, 3, bound=32))
    got = {r["node"]: r["root"] for r in roots.collect()}
    groups, expected = defaultdict(set), defaultdict(set)
    for p in signed:
        groups[got.get(p, p)].add(p)
    for p, root in zip(signed, linked(prints, 3)):
        expected[root].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))

"""The registered queries against their SQL twins or brute force, on the given small tables."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import defaultdict

import duckdb
import public_tokenizers
import pytest
from llm_data import chunked, cut, in_order, linked, passing, remaining, simhash, substrings, taken
from tokenizers import Tokenizer

from feedweave.llm import queries


@pytest.fixture(scope="module")
def documents(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()


def rows_of(spark, sf_dir, name, *columns):
    return [tuple(r) for r in queries.QUERIES[name](spark, sf_dir).select(*columns).collect()]


def ids_of(file, end, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_its_twin(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = connection.execute(queries.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted(tuple(repr(row[names.index(c)]) for c in columns) for row in result.fetchall())
    assert sorted(tuple(repr(row[c]) for c in columns) for row in df.collect()) == expected


def test_op1_stays_near_its_targets(spark, sf_dir):
    rows = rows_of(spark, sf_dir, "op1_mixing", "size", "source_size", "target", "taken")
    assert all(taken in (0, size, 2 * size) for size, _, _, taken in rows)
    sizes, words = defaultdict(int), defaultdict(int)
    largest = max(r[0] for r in rows)
    for size, whole, target, taken in rows:
        sizes[whole, target] += size
        words[whole, target] += taken
    for (whole, target), taken in words.items():
        assert target <= 2 * whole
        assert abs(taken - target * sizes[whole, target] / whole) <= largest
    assert sum(t for _, t in words) == pytest.approx(1.5 * sum(w for w, _ in words))


def test_op2_files_hold_what_the_tokenizer_gives(spark, sf_dir, documents):
    expected, start = [], 0
    for (doc_id, _, _), ids in zip(documents, ids_of("word_bpe_49k.json", 1, [d[1] for d in documents])):
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(rows_of(spark, sf_dir, "op2_token_ids", "doc_id", "start", "n_tokens", "ids_crc32")) == expected


def test_op3_removes_what_repeats_and_little_else(spark, sf_dir, documents):
    exact = {r[0]: r for r in substrings([d[:2] for d in documents], 100)}
    masks = cut([d[:2] for d in documents], 100)
    short = {d[0]: m for d, (_, _, m) in zip(documents, cut([d[:2] for d in documents], 80))}
    longest = {d[0]: max(map(len, bytes(m).split(b"\0"))) for d, (_, _, m) in zip(documents, masks)}
    rows = in_order(rows_of(spark, sf_dir, "op3_content_defined_chunks", "doc_id", "text_left", "n_bytes", "n_removed", "kept_sha256"))
    assert len(rows) == len(documents)
    texts, seen, lines = {d[0]: d[1] or "" for d in documents}, set(), set()
    for doc_id, left, n_bytes, removed, sha in rows:
        assert n_bytes == exact[doc_id][1] and n_bytes - removed >= len(left.encode())
        if longest[doc_id] >= 300:  # a passage of 50 words loses at most a chunk at each edge
            assert removed > 0, doc_id
        if not any(short[doc_id]):
            whole_lines = texts[doc_id] in seen or any(line in lines for line in texts[doc_id].split("\n"))
            assert removed == 0 or whole_lines and removed < 80 * len(texts[doc_id].split("\n"))
        seen.add(texts[doc_id])
        lines.update(texts[doc_id].split("\n"))


def test_op3_equals_brute_force(spark, sf_dir, documents):
    from feedweave.llm import chunks, substrings as subs

    gears = [int(x) >> 32 for x in subs._letters()]
    got = rows_of(spark, sf_dir, "op3_content_defined_chunks", "doc_id", "n_removed", "n_spans", "kept_sha256")
    assert in_order(got) == chunked([d[:2] for d in documents], gears, chunks.LEAST_RUN)
    copies = [d for k, d in enumerate(documents) if d[1] and d[1] in {e[1] for e in documents[:k]}]
    removed = {r[0]: r[1] for r in got}
    assert copies and all(removed[d[0]] == len(d[1].encode()) for d in copies if len(d[1].encode()) < chunks.LEAST or "\n" not in d[1])


def test_op4_compares_with_the_edited_and_the_next(spark, sf_dir, documents):
    found = {r[0]: r[1:] for r in rows_of(
        spark, sf_dir, "op4_imatch", "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )}
    by_text = defaultdict(set)
    for k, (doc_id, text, _) in enumerate(documents):
        following, half = documents[(k + 1) % len(documents)][1], len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        n_chars, sha, own, other, near_edited, near_next = found[doc_id]
        assert (n_chars, sha) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= near_edited <= 1 and 0 <= near_next <= 1
        assert near_edited == 1 or own != other
        by_text[text].add(own)
    assert all(len(prints) == 1 for prints in by_text.values())
    edited, following = zip(*((r[4], r[5]) for r in found.values()))
    assert sum(edited) > 10 * sum(following)


def test_op6_equals_brute_force(spark, sf_dir, documents):
    got = rows_of(spark, sf_dir, "op6_suffix_array_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert in_order(got) == substrings([d[:2] for d in documents], 100)


def test_op7_packs_all_ids_tightly(spark, sf_dir, documents):
    pieces, sequences, total = defaultdict(list), defaultdict(list), 0
    for doc_id, *rest in rows_of(spark, sf_dir, "op7_packing", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"):
        pieces[doc_id].append(rest)
        sequences[rest[4]].append((rest[5], rest[2]))
    for (doc_id, _, _), ids in zip(documents, ids_of("byte_bpe_50k.json", 2, [d[1] for d in documents])):
        total, at = total + len(ids), 0
        for k, (piece, start, length, checksum, _, _) in enumerate(sorted(pieces[doc_id])):
            assert (piece, start, checksum) == (k, at, crc(ids[at:at + length])) and (length == 1024 or k == 0)
            at += length
        assert at == len(ids)
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(sequences) <= 1.02 * total / 1024 + 2


def test_op9_tells_held_out_languages(spark, sf_dir, documents):
    found = {r[0]: r[1:] for r in rows_of(spark, sf_dir, "op9_language_id", "doc_id", "held_out", "lang_pred", "score")}
    assert len(found) == len(documents)
    right = []
    for doc_id, _, lang in documents:
        held_out, predicted, score = found[doc_id]
        assert held_out == (zlib.crc32(str(doc_id).encode()) % 4 == 2) and 0 <= score <= 1
        if held_out:
            right.append(predicted == lang)
    assert sum(right) / len(right) > 0.95


def test_op9_equals_brute_force(spark, sf_dir, documents):
    """Every trigram bound and bundled by itself, in whole numbers."""
    from collections import Counter

    import numpy as np

    from feedweave.llm import language

    signs = np.random.Generator(np.random.PCG64(language.SEED)).integers(0, 2, (language.SYMBOLS, language.DIMENSIONS)) * 2 - 1

    def symbol(c):
        if not c.isalpha():
            return 0
        return ord(c) - 96 if "a" <= c <= "z" else 27 + ((ord(c) * 2654435761 & 0xFFFFFFFF) >> 16) % (language.SYMBOLS - 27)

    def bundled(text):
        letters = [0]
        for c in text.lower():
            if symbol(c) or letters[-1]:
                letters.append(symbol(c))
        letters += [0] if letters[-1] else []
        total = np.zeros(language.DIMENSIONS, np.int64)
        for (a, b, c), n in Counter(zip(letters, letters[1:], letters[2:])).items():
            total += n * np.roll(signs[a], 2) * np.roll(signs[b], 1) * signs[c]
        return total

    vectors = {d[0]: bundled(d[1] or "") for d in documents}
    prototypes = {}
    for doc_id, _, lang in documents:
        if lang is not None and zlib.crc32(str(doc_id).encode()) % 4 != 2:
            prototypes[lang] = prototypes.get(lang, 0) + vectors[doc_id]
    found = {r[0]: r[1:] for r in rows_of(spark, sf_dir, "op9_language_id", "doc_id", "lang_pred", "score")}
    for doc_id, text, _ in documents:
        v = vectors[doc_id]
        if not any(c.isalpha() for c in text or ""):
            assert found[doc_id] == ("und", 0.0)
            continue
        cosines = {lang: float(v @ p) / (np.linalg.norm(v) * np.linalg.norm(p) or 1.0) for lang, p in prototypes.items()}
        predicted, score = found[doc_id]
        assert cosines[predicted] >= max(cosines.values()) - 1e-5
        assert abs(score - min(max(cosines[predicted], 0.0), 1.0)) < 1e-5


def test_op10_equals_brute_force(spark, sf_dir, documents):
    prints = [simhash(d[1]) for d in documents]
    roots = linked(prints, 3)
    expected = [(d[0], f"{p:016x}", documents[r][0]) for d, p, r in zip(documents, prints, roots)]
    assert sorted(rows_of(spark, sf_dir, "op10_simhash", "doc_id", "fingerprint", "component_id")) == expected


def test_pipeline_equals_brute_force(spark, sf_dir):
    """Every stage on what its predecessor kept; the packing may choose any places."""
    import corpus_pipeline

    rows = duckdb.sql(f"SELECT doc_id, text, source FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()
    kept = passing([(r[1], r[2]) for r in rows])
    rows = [r for r, k in zip(rows, kept) if k]
    roots = linked([simhash(r[1]) for r in rows], 3)
    rows = [r for k, r in enumerate(rows) if roots[k] == k]
    left = remaining([r[:2] for r in rows], 100)
    rows = [(r[0], text.decode("utf-8", "ignore"), r[2]) for r, text in zip(rows, left)]
    expected = []
    for (doc_id, _, _), copies, ids in zip(rows, taken(rows), ids_of("byte_bpe_50k.json", 2, [r[1] for r in rows])):
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        expected += copies * [(doc_id, k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(expected)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 1024


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).dtypes == docs.dtypes, name

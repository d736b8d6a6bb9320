"""I-Match document fingerprints on DataFrame functions alone.

The lexicon holds the terms whose inverse document frequency lies in a band. It is dealt at
random into ``subsets`` parts; a document's fingerprint has, for each part, a hash of the
sorted distinct terms it has of that part. Two documents are as like as the share of parts,
of those that either has terms of, in which their hashes agree; an edit spoils the parts of
the terms it touches and leaves the others.

Size of the lexicon: a term in the band occurs in at least a share e^-max_idf of all
documents, so there are at most e^max_idf times as many as a document has distinct terms on
average, however large the corpus is. Up to MOST_TERMS the lexicon, as a hash table of two
possible places per term, becomes a scalar that the tasks look terms up in; a larger one is
joined with the texts' terms.

Terms are counted over different texts. The band is widened for each text that has too few terms
of it, as the members of a large group of near copies have, until ENOUGH terms lie in it or all do:
downwards first, to more frequent terms, as those that an edit brings in are rare. So a text with a
term less than another has nearly the same terms. The lexicon holds the more frequent terms too,
which its bound covers; only texts that need rarer ones are joined with the counts.

Defined cases: NULL is an empty text; a text without any term is known by one hash; rows equal in id
and text are one document, and each of them comes back with its results; other texts of one id are
ordered by a hash, NULL ids first; other columns take no part; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from feedweave.llm.quality import let
from feedweave.llm.ranks import one_of_each, running_sums, written
from pyspark.sql import Column, DataFrame, functions as F

MIN_IDF, MAX_IDF = 4.0, 5.0
SUBSETS = 32
#: Terms that a text's band is widened to hold.
ENOUGH = 16
#: Terms that the lexicon's scalar may hold: 67 MB with up to eight places each.
MOST_TERMS = 1 << 19


def terms(text: Column) -> Column:
    """The distinct lower-case terms of a text: runs of letters and digits."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != ""))


def counted(docs: DataFrame, text: Column, max_idf: float = MAX_IDF) -> tuple[DataFrame, int]:
    """(h, df) of terms, by hash, and how many different texts there are; terms of one text only where these are in the band.

    All rows are counted where they are; of a repeated text one row is met again and takes what
    the others added.
    """
    texts = docs.select(text.alias("_text"), F.xxhash64(text).alias("_hash"))
    repeated = written(texts.groupBy("_hash").agg((F.count("*") - 1).alias("_extra")).filter("_extra > 0"), "imatch-repeated")
    extra = repeated.agg(F.sum("_extra")).first()[0] or 0
    n = docs.count() - extra

    def hashed(rows: DataFrame, amount: Column) -> DataFrame:
        return rows.select(amount.alias("amount"), F.explode(F.transform(terms(F.col("_text")), lambda t: F.xxhash64(t))).alias("h"))

    every = hashed(texts, F.lit(1).cast("long"))
    if extra:
        every = every.unionAll(hashed(one_of_each(texts.join(repeated, "_hash"), "_hash"), -F.col("_extra")))
    least = 1 if n <= math.exp(max_idf) else 2
    return every.groupBy("h").agg(F.sum("amount").alias("df")).filter(F.col("df") >= least), n


def _idf(df: Column, n: int) -> Column:
    return F.log(F.lit(float(n or 1)) / df)


def lexicon(counts: DataFrame, n: int, min_idf: float = MIN_IDF, max_idf: float = MAX_IDF) -> DataFrame:
    """(h, rank): the hashes of the terms in the band, of rank 0, and of more frequent ones, ranked by their count."""
    idf = _idf(F.col("df"), n)
    return counts.filter(idf <= max_idf).select("h", F.when(idf >= min_idf, 0).otherwise(F.col("df")).cast("long").alias("rank"))


def _places(h: Column | int, size: int):
    """The two places where a hash may stand in a table of ``size`` (a power of two) slots."""
    if isinstance(h, int):
        return h & (size - 1), (h >> 32) & (size - 1)
    return h.bitwiseAND(F.lit(size - 1)).cast("int"), F.shiftright(h, 32).bitwiseAND(F.lit(size - 1)).cast("int")


def hash_table(hashes: list[int]) -> list[int]:
    """Every hash at one of its two places, by moving those in the way (cuckoo hashing)."""
    size = 1 << max(len(hashes) * 4, 16).bit_length()
    while True:
        slots: list[int | None] = [None] * size
        for h in hashes:
            at = _places(h, size)[0]
            for _ in range(500):
                slots[at], h = h, slots[at]
                if h is None:
                    break
                a, b = _places(h, size)
                at = b if at == a else a
            else:
                break
        else:
            return [0 if h is None else h for h in slots]  # no term hashes to 0, or it is one more term
        size *= 2


def _known(hashes: Column, table: Column, ranks: Column, size: int) -> Column:
    """(rank, h) of the terms that the table holds."""

    def found(h: Column) -> Column:
        a, b = _places(h, size)
        rank = F.when(F.get(table, a) == h, F.get(ranks, a)).when(F.get(table, b) == h, F.get(ranks, b))
        return F.struct(rank.alias("rank"), h.alias("h"))

    return F.filter(F.transform(hashes, found), lambda x: x["rank"].isNotNull())


def _hashes(found: Column) -> Column:
    return F.transform(found, lambda t: F.xxhash64(t))


def _prints(used: Column, subsets: int) -> Column:
    """The hashes by part of the terms, which come as hashes themselves; one hash if there is no term."""

    def part(h: Column) -> Column:
        return F.pmod(F.xxhash64(h, F.lit(1)), F.lit(subsets))

    def by_part(kept: Column) -> Column:
        def one(k: Column) -> Column:
            mine = F.filter(kept, lambda x: x["k"] == k)
            return F.when(F.size(mine) > 0, F.xxhash64(F.transform(mine, lambda x: x["h"])))

        return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(subsets - 1).cast("long")), one)

    dealt = F.sort_array(F.transform(used, lambda h: F.struct(part(h).alias("k"), h.alias("h"))))
    return let(dealt, lambda x: F.when(F.size(x) > 0, by_part(x)).otherwise(F.array(F.xxhash64(F.lit("no term")))))


def _marked(hashes: Column, known: Callable[[Column], Column], subsets: int) -> Column:
    """(fp, few): the prints of a text that the lexicon has enough terms of; the terms of one that needs rarer ones."""

    def of(every: Column) -> Column:
        def made(some: Column) -> Column:
            within = F.size(F.filter(some, lambda x: x["rank"] == 0))
            enough = (F.size(some) >= ENOUGH) | (F.size(every) == F.size(some))
            used = F.transform(F.slice(some, F.lit(1), F.greatest(F.lit(ENOUGH), within)), lambda x: x["h"])
            return F.struct(F.when(enough, _prints(used, subsets)).alias("fp"), F.when(~enough, every).alias("few"))

        return let(F.array_sort(known(every)), made)

    return let(hashes, of)


def _widened(few: DataFrame, counts: DataFrame, n: int, min_idf: float, max_idf: float, subsets: int) -> DataFrame:
    """(key, name, fp) of texts (key, name, few): of each the ENOUGH terms that lie in the band or next to it."""
    each = few.select("_key", "_name", F.explode("few").alias("t"))
    held = each.join(counts, F.col("t") == F.col("h"), "left")
    idf = _idf(F.coalesce("df", F.lit(1)), n)
    within = idf.between(min_idf, max_idf)
    order = F.struct(
        F.when(within, 0).when(idf < min_idf, 1).otherwise(2).alias("side"), F.when(within, 0.0).otherwise(F.abs(idf - min_idf)).alias("off"), F.col("t"),
    )
    upto = F.greatest(F.lit(ENOUGH), F.sum(within.cast("int")).cast("int"))
    nearest = F.transform(F.slice(F.array_sort(F.collect_list(order)), 1, upto), lambda x: x["t"])
    chosen = held.groupBy("_key", "_name").agg(nearest.alias("used"))
    return chosen.select("_key", "_name", _prints(F.col("used"), subsets).alias("fp"))


def text_of(prints: Column) -> Column:
    """A fingerprint as text: the parts' hashes in hex, dots for parts without a term."""
    return F.array_join(F.transform(prints, lambda h: F.coalesce(F.lpad(F.lower(F.hex(h)), 16, "0"), F.lit("." * 16))), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of parts in which two fingerprints agree, of those that either has."""
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    either = F.size(F.filter(pairs, lambda p: p["a"].isNotNull() | p["b"].isNotNull()))
    both = F.size(F.filter(pairs, lambda p: p["a"] == p["b"]))
    return F.when(F.size(a) != F.size(b), F.lit(0.0)).otherwise(both / either)


def _joined(df: DataFrame, key: str, text: Column, words: DataFrame, name: str) -> DataFrame:
    """``df`` with the terms of a text that the lexicon holds, by a join: for lexicons that no task should hold."""
    each = df.select(F.col(key).alias("_key"), F.explode(_hashes(terms(text))).alias("h"))
    held = each.join(words, "h").groupBy("_key").agg(F.collect_list(F.struct("rank", "h")).alias(name))
    joined = df.join(held, F.col(key) == F.col("_key"), "left").drop("_key")
    return joined.withColumn(name, F.coalesce(name, F.array().cast("array<struct<rank: bigint, h: bigint>>")))


def fingerprints(
    df: DataFrame, texts: dict[str, Column], corpus: DataFrame, subsets: int = SUBSETS, key: str = "_at",
    keep: Sequence[str] = (), min_idf: float = MIN_IDF, max_idf: float = MAX_IDF,
) -> DataFrame:
    """``key``, whose values are unique, the columns ``keep``, and a fingerprint (an array of hashes) for each named text.

    The lexicon is that of ``corpus``' column text.
    """
    counts, n = counted(corpus, F.col("text"), max_idf)
    counts = written(counts, "imatch-counts", release=True)
    words = lexicon(counts, n, min_idf, max_idf)
    if words.count() > MOST_TERMS:
        wide = written(df, "imatch-texts")
        known = {}
        for k, (name, text) in enumerate(texts.items()):
            wide = _joined(wide, key, text, words, f"_held_{k}")
            known[name] = lambda found, held=F.col(f"_held_{k}"): held
    else:
        rank = dict(words.collect())
        table = hash_table(list(rank))
        ranks = [rank.get(h, 0) for h in table]
        stored = written(df.sparkSession.createDataFrame([(table, ranks)], "slots array<bigint>, ranks array<bigint>"), "imatch-table")
        wide = df.withColumn("_table", stored.select("slots").scalar()).withColumn("_ranks", stored.select("ranks").scalar())
        known = dict.fromkeys(texts, lambda hashes: _known(hashes, F.col("_table"), F.col("_ranks"), len(table)))
    made = [_marked(_hashes(terms(text)), known[name], subsets).alias(name) for name, text in texts.items()]
    first = written(wide.select(key, *keep, *made), "imatch-marked", release=True)
    few = reduce(DataFrame.unionAll, [
        first.filter(F.col(f"{name}.few").isNotNull()).select(F.col(key).alias("_key"), F.lit(k).alias("_name"), f"{name}.few") for k, name in enumerate(texts)
    ])
    more = written(_widened(few, counts, n, min_idf, max_idf, subsets), "imatch-widened", release=True)
    for k, name in enumerate(texts):
        own = more.filter(F.col("_name") == k).select("_key", F.col("fp").alias("_fp"))
        first = first.join(own, F.col(key) == F.col("_key"), "left").withColumn(name, F.coalesce(F.col(f"{name}.fp"), "_fp")).drop("_key", "_fp")
    return first


def edited_pairs(placed: DataFrame) -> DataFrame:
    """(_at, _next, doc_id, text, edited): every document, and its text with the next one's beginning as its second half."""
    ids = placed.select("_at", "doc_id", F.char_length("text").alias("n"), F.lit(1).alias("one"))
    order = written(running_sums(ids, [], ["_at"], ["one"], "imatch-order"), "imatch-ids")
    n = order.count()
    ahead = order.select(F.pmod(F.col("before_one") - 1, F.lit(max(n, 1))).alias("before_one"), F.col("_at").alias("_next"))
    links = order.join(ahead, "before_one").select(F.col("_at").alias("_for"), "doc_id", "_next", F.floor(F.col("n") / 2).cast("int").alias("half"))
    # Both joins shuffle the same two columns by the same key, so Spark shuffles the texts once.
    texts = placed.select("_at", "text")
    heads = texts.join(links, texts["_at"] == links["_next"]).select(
        "_for", "doc_id", "_next", F.substring("text", F.lit(1), F.col("half")).alias("_head"),
    )
    joined = texts.join(heads, texts["_at"] == heads["_for"])
    n_chars = F.char_length("text")
    kept = F.substring("text", F.lit(1), n_chars - F.floor(n_chars / 2).cast("int"))
    return joined.select("_at", "_next", "doc_id", "text", F.concat(kept, "_head").alias("edited"))


def _unique(whole: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``whole`` with _at, a number in the documents' order (the id itself if ids are unique), and (_at, doc_id) of repeated rows."""
    ids = whole.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    if not ids.groupBy("id").count().filter("id IS NULL OR count > 1").take(1):
        return whole.withColumn("_at", F.col("doc_id").cast("long")), None
    order = written(running_sums(ids.distinct().withColumn("one", F.lit(1)), [], ["id", "hash"], ["one"], "imatch-ties"), "imatch-order")
    same = F.col("_id").eqNullSafe(F.col("id")) & (F.col("_hash") == F.col("hash"))
    rows = whole.withColumns({"_id": F.col("doc_id").cast("long"), "_hash": F.xxhash64("text")})
    every = rows.join(order, same).select("doc_id", "text", F.col("before_one").alias("_at"))
    return one_of_each(every, "_at"), every.select("_at", "doc_id")


def compared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how like the edited text's and the next one's are.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    corpus = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    placed, every = _unique(whole)
    pairs = edited_pairs(placed).withColumns({
        "n_chars": F.char_length("text").cast("long"), "edited_sha256": F.sha2(F.col("edited"), 256),
    })
    kept = ["_next", "doc_id", "n_chars", "edited_sha256"]
    done = written(fingerprints(pairs, {"_own": F.col("text"), "_edited": F.col("edited")}, corpus, keep=kept, **options), "imatch-prints")
    if every is not None:  # each of the repeated rows
        done = done.drop("doc_id").join(every, "_at")
    following = one_of_each(done, "_at") if every is not None else done
    following = following.select(F.col("_at").alias("_next"), F.col("_own").alias("_theirs"))
    return done.join(following, "_next").select(
        "doc_id", "n_chars", "edited_sha256", text_of(F.col("_own")).alias("fingerprint"),
        text_of(F.col("_edited")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_edited")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_theirs")).alias("near_next"),
    )

"""Text mining on tables: n-grams, topic labels, TF-IDF (topics: ``topicmodel``)."""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import text as X
from ..session import release, stage
from .quantile import SLICE, order_statistics
from .topicmodel import MIN_DF, NGRAM_MAX

# Fixed value (must equal the reference's behaviour): grams in a label.
LABEL_TOP_GRAMS = 3
# Buckets of the gram counts, grams per key that a slice proposes, titles in a slice.
GRAM_BUCKETS, PROPOSED, SLICE_TITLES = 1 << 20, 16, 1024


def _pairs(b: pa.RecordBatch) -> tuple:
    """Every adjacent pair of a slice with columns ``key, _k, _w``: its row, its position, and which of the slice's different
    (key, pair) it is; of these the key's number, both words' numbers, the count and the bucket; and the keys and words."""
    keys, words = b.column(0).dictionary_encode(null_encoding="encode"), b.column(2)
    at = words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
    flat = words.flatten().dictionary_encode()
    size, word = np.diff(at), flat.indices.to_numpy()
    row = np.repeat(np.arange(b.num_rows), np.maximum(size - 1, 0))
    pos = np.arange(len(row)) - np.repeat(np.r_[0, np.cumsum(np.maximum(size - 1, 0))[:-1]], np.maximum(size - 1, 0))
    left, right = word[at[row] + pos].astype(np.int64), word[at[row] + pos + 1].astype(np.int64)
    n, key = max(1, len(flat.dictionary)), keys.indices.to_numpy().astype(np.int64)
    code, which, count = np.unique((key[row] * n + left) * n + right, return_inverse=True, return_counts=True)
    code, right = np.divmod(code, n)
    key, left = np.divmod(code, n)
    hashed = pd.util.hash_array(flat.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False).astype(np.uint64)
    seed = np.zeros(max(1, len(keys.dictionary)), np.uint64)
    seed[keys.indices.to_numpy()] = b.column(1).to_numpy().view(np.uint64)
    mixed = seed[key] * np.uint64(0x9E3779B97F4A7C15) + hashed[left] * np.uint64(0xC2B2AE3D27D4EB4F) + hashed[right]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    bucket = (mixed >> np.uint64(64 - GRAM_BUCKETS.bit_length() + 1)).astype(np.int64)
    return row, pos, which, key, left, right, count, bucket, keys.dictionary, flat.dictionary


def _slices(batches):
    for b in batches:
        for i in range(0, b.num_rows, SLICE_TITLES):
            yield b.slice(i, SLICE_TITLES)


def _joined(words: pa.Array, left: np.ndarray, right: np.ndarray) -> pa.Array:
    return pc.binary_join_element_wise(words.take(pa.array(left)), words.take(pa.array(right)), " ")


def _frequent(titles: DataFrame, key: str, top: int) -> tuple[np.ndarray, DataFrame, DataFrame]:
    """A count that no pair of the bucket exceeds, per bucket; per key a count ``_least`` that its ``top``-th pair reaches; and the keys
    (``_alone``) whose titles have one word at most.

    Every slice adds its pairs up by bucket, and proposes its commonest pairs of each key; what a pair's proposals add up
    to is at most its count.
    """
    kind = titles.schema[key].dataType

    def run(batches):
        total = np.zeros(GRAM_BUCKETS, np.int64)
        longest: dict = {}
        for b in _slices(batches):
            for k, n in zip(b.column(0).to_pylist(), pc.list_value_length(b.column(2)).to_pylist()):
                longest[k] = max(longest.get(k, 0), min(n, 2))
            _, _, _, of, left, right, count, bucket, keys, words = _pairs(b)
            if not len(count):
                continue
            total += np.bincount(bucket, count, GRAM_BUCKETS).astype(np.int64)
            order = np.lexsort((-count, of))
            starts = np.r_[0, np.flatnonzero(np.diff(of[order])) + 1]
            place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
            best = order[place < max(PROPOSED, top)]
            none = pa.nulls(len(best), pa.int32())
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(of[best])), _joined(words, left[best], right[best]), none, pa.array(count[best])], names=["k", "g", "bucket", "n"])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(used), to_arrow_type(kind)), pa.nulls(len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(total[used])],
                                         names=["k", "g", "bucket", "n"])
        some = len(longest)          # at bucket -1: the most words of a title, 2 for more
        yield pa.RecordBatch.from_arrays([pa.array([*longest], to_arrow_type(kind)), pa.nulls(some, pa.string()), pa.array([-1] * some, pa.int32()), pa.array([*longest.values()], pa.int64())],
                                         names=["k", "g", "bucket", "n"])
    found = stage(titles.select(key, "_k", "_w").mapInArrow(run, f"k {kind.simpleString()}, g string, bucket int, n long"), "gram_counts", "zstd")
    release(titles.sparkSession)
    sums = found.where("bucket >= 0").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()        # at most GRAM_BUCKETS rows
    most = np.zeros(GRAM_BUCKETS, np.int64)
    most[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    proposed = found.where("bucket IS NULL").groupBy("k", "g").agg(F.sum("n").alias("n"))
    pick = Window.partitionBy("k").orderBy(F.desc("n"), "g")
    least = (proposed.withColumn("_rn", F.row_number().over(pick)).where(F.col("_rn") <= top)
             .groupBy("k").agg(F.min("n").alias("_least"), F.count(F.lit(1)).alias("_of")).where(F.col("_of") == top).select("k", "_least"))
    alone = found.where("bucket = -1").groupBy("k").agg(F.max("n").alias("_most")).where("_most = 1").select(F.col("k").alias("_alone"))
    return most, stage(least, "gram_least"), stage(alone, "label_alone")


def _pair_counts(titles: DataFrame, key: str, order: tuple, top: int) -> DataFrame:
    """(key, g, _cnt, _first) of the pairs that may be among a key's ``top``: those whose bucket reaches ``_least``, counted exactly."""
    most, least, _ = _frequent(titles, key, top)
    return _counted(titles, key, order, most, least)


def _counted(titles: DataFrame, key: str, order: tuple, most: np.ndarray, least: DataFrame) -> DataFrame:
    shared = titles.sparkSession.sparkContext.broadcast(most)
    rows = titles.join(least, F.col(key).eqNullSafe(F.col("k")), "left").select(key, "_k", "_w", F.coalesce("_least", F.lit(0)).alias("_least"), *order)
    types = ", ".join(f"o{i} {titles.schema[c].dataType.simpleString()}" for i, c in enumerate(order))
    names = ["k", "g", "n", *(f"o{i}" for i in range(len(order))), "pos"]

    def run(batches):
        for b in _slices(batches):
            row, pos, which, of, left, right, count, bucket, keys, words = _pairs(b)
            least_of = np.zeros(max(1, len(keys)), np.int64)
            least_of[b.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy()] = b.column(3).to_numpy()
            wanted = shared.value[bucket] >= least_of[of]
            hit = np.flatnonzero(wanted[which]) if len(which) else which
            if not len(hit):
                continue
            # the first place of each pair: rows in their order, rows of equal order alike
            by = pa.table([b.column(4 + i) for i in range(len(order))], names=names[3:-1])
            sorted_ = pc.sort_indices(by, sort_keys=[(c, "ascending") for c in by.column_names], null_placement="at_start")
            s, moved = sorted_.to_numpy(), by.take(sorted_)
            differs = np.zeros(len(s), np.int64)
            for c in moved.columns:
                code = c.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
                differs[1:] |= code[1:] != code[:-1]
            rank = np.empty(len(s), np.int64)
            rank[s] = np.cumsum(differs)
            near = np.lexsort((pos[hit], rank[row[hit]], which[hit]))
            first = hit[near][np.r_[True, np.diff(which[hit][near]) != 0]]
            w = which[first]
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(of[w])), _joined(words, left[w], right[w]), pa.array(count[w]),
                 *[b.column(4 + i).take(pa.array(row[first])) for i in range(len(order))], pa.array(pos[first].astype(np.int64))], names=names)
    part = rows.mapInArrow(run, f"k {titles.schema[key].dataType.simpleString()}, g string, n long, {types}, pos long")
    return part.groupBy(F.col("k").alias(key), F.col("g").alias("_g")).agg(F.sum("n").alias("_cnt"), F.min(F.struct(*names[3:])).alias("_first"))


def topic_labels(videos: DataFrame, key: str = "topic_id", text: str = "title_clean",
                 order=("platform", "videoId"), top: int = LABEL_TOP_GRAMS, normalize: bool = True) -> DataFrame:
    """Most frequent bigrams over all of a topic's titles (ML-6).

    Falls back to unigrams only for a topic with no bigram at all.  Ties go
    to the gram seen first (title order, then position).  Returns
    (key, topic_label); a topic without any word gets ''.

    Titles are normalised and cut into words where they are read, once in each of two passes; neither they nor their words are written.
    Their pairs, nearly as many as words, are not shuffled: one pass adds
    them up in a fixed number of buckets, and a pair whose bucket holds fewer than its topic's ``top``-th pair has at least
    cannot be in the label; the second pass counts the others exactly.  Words are counted only for topics without a pair.
    """
    order = tuple(order)
    source = videos.select(key, *order, F.col(text).alias("_text"))        # no filter on the text: it would be worked out twice
    words = (X.with_nfc(source, "_text") if normalize else source).select(key, *order, X.words("_text").alias("_w"))
    titles = words.withColumn("_k", F.xxhash64(key))
    most, least, alone = _frequent(titles, key, top)
    counts = _counted(titles, key, order, most, least)
    if not alone.isEmpty():
        single = titles.join(alone, F.col(key).eqNullSafe(F.col("_alone")), "left_semi").where(F.size("_w") > 0)
        place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.lit(0).cast("long").alias("pos"))
        counts = counts.unionByName(single.groupBy(key, F.col("_w")[0].alias("_g")).agg(F.count("*").alias("_cnt"), F.min(place).alias("_first")))
    # WindowGroupLimit: at most ``top`` rows per topic leave each task
    pick = Window.partitionBy(key).orderBy(F.desc("_cnt"), F.asc("_first"))
    picked = counts.withColumn("_rn", F.row_number().over(pick)).where(F.col("_rn") <= top)
    labels = picked.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rn", "_g"))), lambda s: s["_g"]), ", ")
        .alias("topic_label"))
    keys = videos.select(key).distinct()
    return keys.join(labels, key, "left").select(key, F.coalesce("topic_label", F.lit("")).alias("topic_label"))


def count_terms(docs: DataFrame, doc_key: str, words: Column, singles: bool = True, pairs: bool = True) -> DataFrame:
    """(doc, term, n): how often each word and each adjacent pair stands in a document.

    A row's terms are counted in the task that reads the row; only documents in several rows are added up by an exchange.
    """
    kind = docs.schema[doc_key].dataType
    again = stage(docs.groupBy(doc_key).count().where("count > 1").select(F.col(doc_key).alias("_again")), "repeated_ids")

    def run(batches):
        for b in _slices(batches):
            at = b.column(1).offsets.to_numpy().astype(np.int64) - b.column(1).offsets[0].as_py()
            flat, size = b.column(1).flatten().dictionary_encode(), np.diff(at)
            word, n = flat.indices.to_numpy().astype(np.int64), max(1, len(flat.dictionary))
            if singles:
                code, count = np.unique(np.repeat(np.arange(b.num_rows), size) * n + word, return_counts=True)
                row, one = np.divmod(code, n)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), flat.dictionary.take(pa.array(one)), pa.array(count)], names=["k", "term", "n"])
            if pairs:
                less = np.maximum(size - 1, 0)
                row = np.repeat(np.arange(b.num_rows), less)
                left = np.repeat(at[:-1] - np.r_[0, np.cumsum(less)[:-1]], less) + np.arange(len(row))
                code, count = np.unique((row * n + word[left]) * n + word[left + 1], return_counts=True)
                code, right = np.divmod(code, n)
                row, left = np.divmod(code, n)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), _joined(flat.dictionary, left, right), pa.array(count)], names=["k", "term", "n"])

    def counted(some: DataFrame) -> DataFrame:
        return some.select(doc_key, words.alias("_w")).mapInArrow(run, f"k {kind.simpleString()}, term string, n long")
    if again.isEmpty():
        return counted(docs).withColumnRenamed("k", doc_key)
    same = F.col(doc_key).eqNullSafe(F.col("_again"))
    merged = counted(docs.join(again, same, "left_semi")).groupBy("k", "term").agg(F.sum("n").alias("n"))
    return counted(docs.join(again, same, "left_anti")).unionByName(merged).withColumnRenamed("k", doc_key)


def top_terms(counts: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` rows of (term, cnt, ...) with the largest counts, equal counts by term.

    The last count that gets in, and the last term of that count, are closed in on by counting, so nothing is
    sorted as a whole and at most ``quantile.SLICE`` values, or one count per next character, are ever collected.
    """
    n = counts.count()
    if n <= limit:
        return counts
    if limit <= 0:
        return counts.limit(0)
    rank = n - limit
    cut = order_statistics(counts, "cnt", n, [rank])[rank]
    above, tied = counts.where(F.col("cnt") > cut), counts.where(F.col("cnt") == cut)
    last = nth_term(tied, limit - above.count() - 1)
    return counts.where((F.col("cnt") > cut) | ((F.col("cnt") == cut) & (F.col("term") <= last)))


def nth_term(terms: DataFrame, n: int, most: int = SLICE) -> str:
    """The 0-based ``n``-th of distinct terms in their order (by UTF-8 bytes), one character closer at a time."""
    prefix, inside = "", terms.select("term")
    while inside.count() > most:
        heads = inside.groupBy(F.left("term", F.lit(len(prefix) + 1)).alias("head")).count().collect()    # one row a character
        for head in sorted(heads, key=lambda r: r["head"].encode()):
            if n < head["count"]:
                break
            n -= head["count"]
        if head["head"] == prefix:
            return prefix                      # the term that ends here
        prefix = head["head"]
        inside = inside.where(F.col("term").startswith(prefix))
    return sorted((r["term"] for r in inside.collect()), key=str.encode)[n]


# Fixed value: bytes of text in a slice of documents, whose terms are in work at once.
SLICE_BYTES = 8 << 20


def _doc_terms(t: pa.Table, pairs: bool) -> tuple:
    """Documents of a slice ``k, w`` and their terms: the keys; the different terms; per document and term its two numbers and the count."""
    keys, words = t.column("k").combine_chunks().dictionary_encode(null_encoding="encode"), t.column("w").combine_chunks()
    at = words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
    flat = words.flatten().dictionary_encode()
    word, n, size = flat.indices.to_numpy().astype(np.int64), max(1, len(flat.dictionary)), np.diff(at)
    doc = keys.indices.to_numpy().astype(np.int64)
    code, tf = np.unique(np.repeat(doc, size) * n + word, return_counts=True)
    docs, which = np.divmod(code, n)
    terms = flat.dictionary
    if pairs:
        less = np.maximum(size - 1, 0)
        left = np.repeat(at[:-1] - np.r_[0, np.cumsum(less)[:-1]], less) + np.arange(less.sum())
        code, more = np.unique((np.repeat(doc, less) * n + word[left]) * n + word[left + 1], return_counts=True)
        of, pair = np.divmod(code, n * n)
        pair, place = np.unique(pair, return_inverse=True)
        docs, which, tf = np.r_[docs, of], np.r_[which, place + len(terms)], np.r_[tf, more]
        terms = pa.concat_arrays([terms, _joined(terms, *np.divmod(pair, n))])
    return keys.dictionary, terms, docs, which, tf


def tfidf(docs: DataFrame, doc_key: str = "doc_id", text: str = "text", min_df: int = MIN_DF,
          ngram_max: int = NGRAM_MAX, max_features: int | None = None) -> DataFrame:
    """TF-IDF weights in long form (doc, term, weight) — the sklearn definition (ML-1).

    Every term in at least ``min_df`` documents, or with ``max_features`` so many of these that occur most (equal counts: in
    alphabetical order); idf = ln((1+n)/(1+df)) + 1, raw tf, rows
    L2-normalised.

    Documents are dealt into slices by their key.  A slice sends each of its terms once, not once per document, and gets the idf of each
    back by an exchange on the term (the vocabulary grows with the corpus); weights and norms are worked out in the slice, from its texts.
    """
    kind = docs.schema[doc_key].dataType
    total = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("bytes")).first()
    slices = 1 + (total.bytes or 0) // SLICE_BYTES
    dealt = (docs.select(F.col(doc_key).alias("k"), F.pmod(F.xxhash64(doc_key), F.lit(slices)).alias("s"), F.col(text).alias("t"))
             .repartition("s").select("s", "k", X.tokens("t").alias("w")))
    pairs = ngram_max >= 2

    def count(t: pa.Table) -> pa.Table:
        _, terms, _, which, tf = _doc_terms(t, pairs)
        s = pa.array(np.full(len(terms), t.column("s")[0].as_py()), pa.int64())
        return pa.table([s, terms, pa.array(np.bincount(which, minlength=len(terms)).astype(np.int64)),
                         pa.array(np.bincount(which, tf, len(terms)).astype(np.int64))], names=["s", "term", "df", "cnt"])
    found = stage(dealt.groupBy("s").applyInArrow(count, "s long, term string, df long, cnt long"), "slice_terms", "zstd")
    release(docs.sparkSession)
    weight = F.log((total.n + 1.0) / (F.col("df") + 1.0)) + 1.0
    if max_features is None:
        # one exchange by term; a term has one row a slice at most
        summed = found.select("s", "term", F.sum("df").over(Window.partitionBy("term")).alias("df")).where(F.col("df") >= min_df)
        idfs = summed.select("s", "term", weight.alias("idf"))
    else:
        stats = found.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cnt").alias("cnt")).where(F.col("df") >= min_df)
        # written, so that a small vocabulary is seen to be small and goes to the rows instead of the rows to it
        stats = stage(top_terms(stage(stats, "vocabulary"), max_features), "top_terms")
        idfs = found.select("s", "term").join(stats.select("term", weight.alias("idf")), "term").select("s", "term", "idf")
    known = stage(idfs, "slice_idf", "zstd")
    release(docs.sparkSession)
    names = [doc_key, "term", "weight"]

    def weigh(t: pa.Table, idfs: pa.Table) -> pa.Table:
        if not t.num_rows:
            return pa.table([pa.nulls(0, to_arrow_type(kind)), pa.nulls(0, pa.string()), pa.nulls(0, pa.float64())], names=names)
        keys, terms, of, which, tf = _doc_terms(t, pairs)
        place = pc.index_in(terms, value_set=idfs.column("term").combine_chunks()).fill_null(-1).to_numpy()
        idf_of = np.r_[idfs.column("idf").to_numpy(), 0.0][place]
        in_use = place[which] >= 0
        of, which = of[in_use], which[in_use]
        w = tf[in_use] * idf_of[which]
        norm = np.sqrt(np.bincount(of, w * w, len(keys)))
        return pa.table([keys.take(pa.array(of)), terms.take(pa.array(which)), pa.array(w / norm[of])], names=names)
    return dealt.groupBy("s").cogroup(known.groupBy("s")).applyInArrow(weigh, f"`{doc_key}` {kind.simpleString()}, term string, weight double")

"""Lexical retrieval for many queries at once.

Terms are counted as numbers in Arrow batches. The weights of a text are built inside its
row, and the row is spread by document for the norm. Where there are few
pairs of query and document, all that share a term are scored. Where there are many, the
best scores are found over postings with bounds (`top_scores`), and pairs that share only
frequent terms are not scored. A query batch that is proven small is broadcast to the postings; a larger one
meets them in a shuffled join on the term, in which every term is split over slices of the
corpus, so that a frequent term is never one task's work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrun.functions import text as tx
from quillrun.functions.arrays import run_lengths
from quillrun.operators import term_codes
from quillrun.operators.top_scores import PostingIndex
from quillrun.session import shared_folder
from quillrun.sources.tables import materialize

MAX_FEATURES = 20_000
# A query batch within both bounds is broadcast: at most two terms start at a
# character, so this bounds the rows as well as the bytes.
BROADCAST_QUERIES = 20_000
BROADCAST_CHARS = 1_000_000
# Slices of the corpus over which one term is split in the shuffled join.
TERM_SLICES = 32
# Up to so many pairs of query and document, scoring all of them is the shorter way.
DIRECT_PAIRS = 20_000_000
# Scores are compared at this many places, so that float noise cannot swap ties.
SCORE_PLACES = 9


def batch_is_small(queries: DataFrame, text: str) -> bool:
    """Measure a query batch against the broadcast bounds in one aggregate."""
    row = queries.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("chars")
    ).first()
    return row["n"] <= BROADCAST_QUERIES and row["chars"] <= BROADCAST_CHARS


def term_counts(texts: DataFrame, key: str, text: str, ngrams=(1, 2)) -> DataFrame:
    """``(key, term, tf)``; the terms of a text are counted inside its row.

    The texts are spread by key first, and the output stays partitioned by it.
    """
    counts = run_lengths(tx.terms(F.col(text), ngrams))
    return (
        texts.select(key, text)
        .repartition(key)
        .select(key, F.explode(counts).alias("_c"))
        .select(key, F.col("_c.value").alias("term"), F.col("_c.n").cast("long").alias("tf"))
    )


def stored_words(texts: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, text)`` with the words of every text, a space between them, stored once.

    What counts terms takes such a table with ``split=True`` and reads it as it is.
    """
    words = F.concat_ws(" ", tx.words(F.col(text)))
    return materialize(
        texts.select(key, words.alias(text)), shared_folder(texts.sparkSession, "words")
    )


def frequent_words(words: DataFrame, text: str, max_features: int) -> tuple[list[str], int] | None:
    """``(words, least)``: all words of stored words that can be in one of the ``max_features`` terms.

    A pair of words is no more frequent than either of them, so what is less frequent
    than the last of ``max_features`` words is in none of the terms. None says that more
    than twice as many words are as frequent as that one.
    """
    counts = (
        words.select(text)
        .mapInArrow(term_codes.count_words, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(2 * max_features + 1)
        .collect()
    )
    least = counts[max_features - 1]["n"] if len(counts) >= max_features else 1
    if len(counts) > 2 * max_features and counts[-1]["n"] == least:
        return None
    return [r["word"] for r in counts if r["n"] >= least], least


def _frequent_term_counts(
    stored: DataFrame, text: str, words: list[str], least: int, ngrams=(1, 2)
) -> DataFrame:
    """``(term, n, df)`` of all terms of the given words that occur ``least`` times."""
    spark = stored.sparkSession
    counts = (
        stored.select(text)
        .mapInArrow(
            lambda batches: term_codes.count_codes(batches, pa.array(words, pa.string()), ngrams),
            "code long, n long, df long",
        )
        .groupBy("code")
        .agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
        .filter(F.col("n") >= least)
    )
    names = spark.createDataFrame(pa.table({"place": range(len(words)), "word": words}))
    first, second = (F.broadcast(names).select(F.col("place").alias(c), F.col("word").alias("_" + c)) for c in "ab")
    return (
        counts.withColumn("a", F.expr(f"code div {len(words)} - 1"))
        .withColumn("b", F.col("code") % len(words))
        .join(first, "a", "left")
        .join(second, "b")
        .select(F.concat_ws(" ", "_a", "_b").alias("term"), "n", "df")
    )


def fit_tfidf(
    corpus: DataFrame,
    key: str,
    text: str,
    max_features: int = MAX_FEATURES,
    ngrams=(1, 2),
    split: bool = False,
) -> DataFrame:
    """Fitted space ``(term, n, df, idf)`` of the most frequent terms, stored once.

    Words are counted first; of the pairs, only those of words that are frequent enough
    are counted, as numbers. Where too many words are equally frequent, and where there
    are pairs alone, all terms are counted as strings.
    """
    n_docs = corpus.agg(F.count(F.lit(1)).cast("double").alias("n_docs")).scalar()
    corpus = corpus if split else stored_words(corpus, key, text)
    found = frequent_words(corpus, text, max_features) if ngrams[0] == 1 else None
    if found and found[0]:
        counts = _frequent_term_counts(corpus, text, *found, ngrams)
    else:
        counts = (
            term_counts(corpus, key, text, ngrams)
            .groupBy("term")
            .agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("df"))
        )
    kept = counts.orderBy(F.desc("n"), "term").limit(max_features)
    idf = F.log((n_docs + 1) / (F.col("df") + 1)) + 1
    return materialize(
        kept.select("term", "n", "df", idf.alias("idf")),
        shared_folder(corpus.sparkSession, "fitted"),
    )


def _weights_and_norms(
    texts: DataFrame, fitted: DataFrame, key: str, text: str, ngrams=(1, 2), split: bool = False
) -> DataFrame:
    """``(key, term, norm, weight)``; a text crosses the network as one row of numbers."""
    spark = texts.sparkSession
    space = [
        (r["term"].split(" "), r["term"], r["idf"])
        for r in fitted.select("term", "idf").collect()
        if r["term"].count(" ") < 2
    ]
    words = sorted({word for parts, _, _ in space for word in parts})
    place = {word: i for i, word in enumerate(words)}
    code = lambda parts: sum((place[w] + (i < len(parts) - 1)) * len(words) ** (len(parts) - 1 - i)
                             for i, w in enumerate(parts))
    space = sorted((code(parts), term, idf) for parts, term, idf in space)
    schema = T.StructType(
        [
            texts.schema[key],
            T.StructField("_terms", T.ArrayType(T.StructType().add("place", T.IntegerType()).add("w", T.DoubleType()))),
            T.StructField("_squares", T.DoubleType()),
        ]
    )
    names = spark.createDataFrame(
        pa.table(
            [pa.array(range(len(space)), pa.int32()), pa.array([t for _, t, _ in space], pa.string())],
            ["place", "term"],
        )
    )
    codes = np.array([c for c, _, _ in space], dtype=np.int64)
    idf = np.array([v for _, _, v in space], dtype=np.float64)

    def weigh(batches):
        if len(codes):
            known = pa.array(words, pa.string())
            yield from term_codes.weigh_codes(batches, known, codes, idf, ngrams, schema.names)

    norm = F.sqrt(F.sum("_squares").over(Window.partitionBy(key)))
    spaced = F.col(text) if split else F.concat_ws(" ", tx.words(F.col(text)))
    return (
        texts.select(key, spaced)
        .mapInArrow(weigh, schema)
        .select(key, "_terms", norm.alias("norm"))
        .select(key, "norm", F.inline("_terms"))
        .join(F.broadcast(names), "place")
        .select(key, "term", "norm", (F.col("w") / F.col("norm")).alias("weight"))
    )


def tfidf_weights(
    texts: DataFrame, fitted: DataFrame, key: str, text: str, ngrams=(1, 2), split: bool = False
) -> DataFrame:
    """``(key, term, weight)``: tf times idf, each text scaled to length 1.

    Terms outside the fitted space drop out. That space goes to all tasks.
    """
    return _weights_and_norms(texts, fitted, key, text, ngrams, split).drop("norm")


def _meet_on_term(doc_terms: DataFrame, query_terms: DataFrame, small: bool) -> DataFrame:
    """Join on the term: broadcast queries, or terms split over corpus slices."""
    if small:
        return doc_terms.join(F.broadcast(query_terms), "term")
    slices = F.sequence(F.lit(0), F.lit(TERM_SLICES - 1))
    return (
        doc_terms.withColumn(
            "_slice", F.pmod(F.xxhash64("doc_id"), F.lit(TERM_SLICES)).cast("int")
        )
        .join(query_terms.withColumn("_slice", F.explode(slices)), ["term", "_slice"])
        .drop("_slice")
    )


def cosine_scores(doc_weights: DataFrame, query_weights: DataFrame, small: bool) -> DataFrame:
    """``(query_id, doc_id, score)`` of all pairs that share a term."""
    pairs = _meet_on_term(
        doc_weights.select("doc_id", "term", F.col("weight").alias("wd")),
        query_weights.select("query_id", "term", F.col("weight").alias("wq")),
        small,
    )
    return pairs.groupBy("query_id", "doc_id").agg(
        F.sum(F.col("wq") * F.col("wd")).alias("score")
    )


def overlap_weights(texts: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, size, term, weight)``: distinct tokens, each set scaled to length 1.

    The products of two such weights add up to the shared tokens over the root of the
    product of both set sizes.
    """
    tokens = F.array_distinct(tx.space_tokens(F.col(text)))
    return (
        texts.select(key, tokens.alias("_tokens"))
        .select(key, F.size("_tokens").alias("size"), F.explode("_tokens").alias("term"))
        .withColumn("weight", 1 / F.sqrt(F.col("size").cast("double")))
    )


def top_k(scores: DataFrame, queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """Best ``k`` documents per query ``(query_id, rank, doc_id, score)``.

    Ties go to the lower document. Every query gets ``k`` rows while the corpus has
    as many: the first ``k`` documents join in at score 0, and that is enough, as
    fewer than ``k`` of them can be taken by better ones. ``queries`` holds
    ``query_id``, ``corpus`` holds ``doc_id``.
    """
    best_first = Window.partitionBy("query_id").orderBy(
        F.desc(F.round("score", SCORE_PLACES)), "doc_id"
    )
    found = scores.withColumn("rank", F.row_number().over(best_first)).filter(
        F.col("rank") <= k
    )
    first_docs = (
        corpus.select("doc_id")
        .orderBy("doc_id")
        .limit(k)
        .agg(F.collect_list("doc_id").alias("first_docs"))
        .scalar()
    )
    fill = queries.select(
        "query_id", F.explode(first_docs).alias("doc_id"), F.lit(0.0).alias("score")
    )
    merged = (
        found.select("query_id", "doc_id", "score")
        .unionByName(fill)
        .groupBy("query_id", "doc_id")
        .agg(F.max("score").alias("score"))
    )
    return (
        merged.withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "doc_id", "score")
    )


def retrieve(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 3,
    kind: str = "tfidf",
    key: str = "doc_id",
    query_key: str = "query_id",
    text: str = "text",
    max_features: int = MAX_FEATURES,
    small: bool | None = None,
    pruned: bool | None = None,
) -> DataFrame:
    """Best ``k`` documents of a corpus per query, by TF-IDF cosine or token overlap.

    ``small`` skips the measuring of the query batch when the caller knows it. ``pruned``
    says whether postings with bounds are used; by default, where there are more than
    ``DIRECT_PAIRS`` pairs of query and document. The rows are the same.
    """
    if pruned is None:
        pruned = corpus.count() * queries.count() > DIRECT_PAIRS
    if small is None:
        small = batch_is_small(queries, text)
    if kind == "tfidf":
        words = stored_words(corpus, key, text)
        fitted = fit_tfidf(words, key, text, max_features, split=True)
        docs = _weights_and_norms(words, fitted, key, text, split=True).withColumnRenamed("norm", "size")
        asked = tfidf_weights(queries, fitted, query_key, text)
    elif kind == "overlap":
        docs = overlap_weights(corpus.select(key, text).repartition(key), key, text)
        asked = overlap_weights(queries, query_key, text)
    else:
        raise ValueError("kind must be 'tfidf' or 'overlap'")
    docs, asked = docs.withColumnRenamed(key, "doc_id"), asked.withColumnRenamed(query_key, "query_id")
    scores = PostingIndex(docs, asked, small).best(k) if pruned else cosine_scores(docs, asked, small)
    return top_k(
        scores,
        queries.select(F.col(query_key).alias("query_id")),
        corpus.select(F.col(key).alias("doc_id")),
        k,
    )


def corpus_stats(corpus: DataFrame, fitted: DataFrame, kind: str = "tfidf") -> DataFrame:
    """One row: kind of retriever, documents, terms."""
    terms = fitted.agg(F.count(F.lit(1)).alias("n_terms")).scalar()
    return corpus.agg(F.count(F.lit(1)).alias("n_docs")).select(
        F.lit(kind).alias("kind"), "n_docs", terms.alias("n_terms")
    )

"""A next-token model by counting, and its loss on held-out text.

Context and target of a pair come from one text row, so building pairs needs no
shuffle. Pairs are counted on the map side before they meet anything else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.functions import text as tx
from quillrun.functions.arrays import let

CONTEXT = ["context", "target"]


def token_pairs(texts: DataFrame, text: str, n: int = 2) -> DataFrame:
    """``(context, target)``: each word with the ``n - 1`` words before it."""
    if n < 2:
        raise ValueError("n must be at least 2")
    width = n - 1

    def pairs(words: Column) -> Column:
        count = F.greatest(F.size(words) - width, F.lit(0))
        contexts = F.slice(words, F.lit(1), count)
        for shift in range(1, width):
            contexts = F.zip_with(
                contexts,
                F.slice(words, F.lit(shift + 1), count),
                lambda a, b: F.concat_ws(" ", a, b),
            )
        return F.zip_with(
            contexts,
            F.slice(words, F.lit(width + 1), count),
            lambda c, t: F.struct(c.alias("context"), t.alias("target")),
        )

    found = let(tx.words(F.col(text)), pairs)
    return texts.select(F.explode(found).alias("_p")).select("_p.context", "_p.target")


def count_pairs(texts: DataFrame, text: str, n: int = 2) -> DataFrame:
    """Distinct pairs with their counts."""
    return token_pairs(texts, text, n).groupBy(*CONTEXT).agg(F.count(F.lit(1)).alias("n_pair"))


def vocabulary_size(texts: DataFrame, text: str) -> DataFrame:
    """One row: number of different words."""
    return texts.select(F.explode(tx.words(F.col(text))).alias("word")).agg(
        F.count_distinct("word").alias("n_words")
    )


def fit_ngram_lm(texts: DataFrame, text: str, n: int = 2, k: float = 1.0) -> DataFrame:
    """Add-k model ``(context, target, n_pair, n_context, p)`` of the pairs seen.

    The total of a context is summed from its distinct pairs and joined back, so that
    a frequent context is never gathered in one task: its pairs are at most the
    vocabulary, and Spark splits that side of the join when it is skewed.
    """
    pairs = count_pairs(texts, text, n)
    contexts = pairs.groupBy("context").agg(F.sum("n_pair").alias("n_context"))
    words = vocabulary_size(texts, text).scalar()
    return pairs.join(contexts, "context").select(
        *CONTEXT,
        "n_pair",
        "n_context",
        ((F.col("n_pair") + k) / (F.col("n_context") + k * words)).alias("p"),
    )


def evaluate_ngram_lm(
    train: DataFrame, held_out: DataFrame, text: str, n: int = 2, k: float = 1.0
) -> DataFrame:
    """One row: held-out pairs, mean of ``-ln p``, perplexity.

    Held-out pairs are counted first, so each different pair is looked up once. A pair
    not seen in training has its context's count, or none, behind its probability.
    """
    seen = count_pairs(train, text, n)
    contexts = seen.groupBy("context").agg(F.sum("n_pair").alias("n_context"))
    words = vocabulary_size(train, text).scalar()
    asked = count_pairs(held_out, text, n).withColumnRenamed("n_pair", "n_asked")
    p = F.try_divide(
        F.coalesce("n_pair", F.lit(0)) + k, F.coalesce("n_context", F.lit(0)) + k * words
    )
    return (
        asked.join(seen, CONTEXT, "left")
        .join(contexts, "context", "left")
        .agg(
            F.coalesce(F.sum("n_asked"), F.lit(0)).alias("n_pairs"),
            (F.sum(-F.log(p) * F.col("n_asked")) / F.sum("n_asked")).alias("cross_entropy"),
        )
        .withColumn("perplexity", F.exp("cross_entropy"))
    )

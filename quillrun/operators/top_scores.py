"""Best scores of many queries without scoring every pair that shares a term.

Scores are sums, over shared terms, of query weight times document weight. Postings are
kept by term and block, a block being documents of about one size, with the largest
weight of every term in every block. A few documents that hold the rarest terms of a query
are scored first: their ``k``-th score is a threshold. In a block, the most frequent
terms whose bounds together stay below the threshold decide nothing on their own, so that
only postings of the other terms are joined; a block whose bounds all together stay below
it is not read at all. What can still reach the threshold is then scored in full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillrun.session import shared_folder
from quillrun.sources.tables import materialize

# Blocks hold documents whose sizes differ by less than a factor of 2 ** (1 / BLOCKS).
BLOCKS = 2
# Rare terms of a query, and documents for every wanted hit, that are scored first. They decide how much is left out later, never the result.
RARE_TERMS = 16
FIRST_DOCS = 2
# Slices of the corpus over which one term is split in a shuffled join.
TERM_SLICES = 32
# Scores this much below the threshold are kept: float noise, and ties after rounding.
SLACK = 1e-8


def _join(postings: DataFrame, asked: DataFrame, on: list[str], small: bool) -> DataFrame:
    """Postings with query rows: broadcast, or terms split over slices of the corpus."""
    if small:
        return postings.join(F.broadcast(asked), on)
    slices = F.sequence(F.lit(0), F.lit(TERM_SLICES - 1))
    own = F.pmod(F.xxhash64("doc_id"), F.lit(TERM_SLICES)).cast("int")
    return (
        postings.withColumn("_slice", own)
        .join(asked.withColumn("_slice", F.explode(slices)), [*on, "_slice"])
        .drop("_slice")
    )


class PostingIndex:
    """Postings of the terms that a batch of queries asks for, stored once.

    ``postings`` are ``(doc_id, size, term, weight)``, ``queries`` are ``(query_id, term,
    weight)``; weights are positive and sizes at least some positive number. ``small``
    says that the queries may be broadcast.
    """

    def __init__(self, postings: DataFrame, queries: DataFrame, small: bool):
        spark = postings.sparkSession
        self.small = small
        terms = queries.select("term").distinct()
        block = F.floor(F.log2("size") * BLOCKS).cast("int").alias("block")
        wanted = postings.join(F.broadcast(terms) if small else terms, "term", "left_semi")
        self.postings = materialize(
            wanted.select("doc_id", "term", block, "weight"), shared_folder(spark, "postings")
        )
        self.bounds = materialize(
            self.postings.groupBy("term", "block").agg(
                F.max("weight").alias("most"), F.count(F.lit(1)).alias("docs")
            ),
            shared_folder(spark, "posting-bounds"),
        )
        known = self.bounds.groupBy("term").agg(F.sum("docs").alias("docs"))
        asked = queries.select("query_id", "term", F.col("weight").alias("asked"))
        self.queries = materialize(asked.join(known, "term"), shared_folder(spark, "asked-terms"))

    def score(self, pairs: DataFrame) -> DataFrame:
        """``(query_id, doc_id, score)`` of the given pairs, over all shared terms."""
        return (
            pairs.join(self.postings.select("doc_id", "term", "weight"), "doc_id")
            .join(self.queries.select("query_id", "term", "asked"), ["query_id", "term"])
            .groupBy("query_id", "doc_id")
            .agg(F.sum(F.col("asked") * F.col("weight")).alias("score"))
        )

    def first_pairs(self, k: int) -> DataFrame:
        """Pairs scored first: documents with the largest weights of the rarest terms."""
        rarest = Window.partitionBy("query_id").orderBy("docs", "term")
        rare = self.queries.withColumn("_n", F.row_number().over(rarest)).filter(
            F.col("_n") <= RARE_TERMS
        )
        heaviest = Window.partitionBy("term").orderBy(F.desc("weight"), "doc_id")
        terms = rare.select("term").distinct()
        docs = (
            self.postings.join(F.broadcast(terms) if self.small else terms, "term", "left_semi")
            .withColumn("_n", F.row_number().over(heaviest))
            .filter(F.col("_n") <= FIRST_DOCS * k)
        )
        return rare.select("query_id", "term").join(docs.select("term", "doc_id"), "term").select(
            "query_id", "doc_id"
        ).distinct()

    def _kth(self, pairs: DataFrame, k: int) -> DataFrame:
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
        ranked = self.score(pairs).withColumn("_n", F.row_number().over(best))
        return ranked.filter(F.col("_n") == k).select("query_id", F.col("score").alias("least"))

    def thresholds(self, k: int) -> DataFrame:
        """``(query_id, least)``: the ``k``-th of the first scores, no row with fewer."""
        return self._kth(self.first_pairs(k), k)

    def raised(self, candidates: DataFrame, k: int) -> DataFrame:
        """Thresholds from the candidates that the joined terms alone put first."""
        best = Window.partitionBy("query_id").orderBy(F.desc("part"), "doc_id")
        first = candidates.withColumn("_n", F.row_number().over(best)).filter(
            F.col("_n") <= FIRST_DOCS * k
        )
        return self._kth(first.select("query_id", "doc_id"), k)

    def needed(self, thresholds: DataFrame) -> DataFrame:
        """``(query_id, term, block, asked, least, rest)``: what has to be joined.

        ``rest`` bounds what the terms that are not joined can add.
        """
        steps = (
            self.queries.select("query_id", "term", "asked")
            .join(self.bounds, "term")
            .join(thresholds, "query_id", "left")
            .withColumn("least", F.coalesce("least", F.lit(0.0)))
            .withColumn("_bound", F.col("asked") * F.col("most"))
        )
        own = Window.partitionBy("query_id", "block")
        up_to = own.orderBy(F.desc("docs"), "term").rowsBetween(Window.unboundedPreceding, 0)
        essential = F.col("_sum") >= F.col("least") - SLACK
        return (
            steps.withColumn("_sum", F.sum("_bound").over(up_to))
            .withColumn("rest", F.coalesce(F.max(F.when(~essential, F.col("_sum"))).over(own), F.lit(0.0)))
            .filter(essential)
            .select("query_id", "term", "block", "asked", "least", "rest")
        )

    def candidates(self, thresholds: DataFrame) -> DataFrame:
        """``(query_id, doc_id, part, least, rest)`` of all pairs that are looked at."""
        met = _join(self.postings, self.needed(thresholds), ["term", "block"], self.small)
        return met.groupBy("query_id", "doc_id").agg(
            F.sum(F.col("asked") * F.col("weight")).alias("part"),
            F.first("least").alias("least"),
            F.first("rest").alias("rest"),
        )

    def best(self, k: int) -> DataFrame:
        """``(query_id, doc_id, score)``: the best ``k`` of each query, ties included.

        Some others may be among them; all scores are exact.
        """
        spark = self.postings.sparkSession
        thresholds = materialize(self.thresholds(k), shared_folder(spark, "thresholds"))
        looked_at = self.candidates(thresholds).filter(
            F.col("part") + F.col("rest") >= F.col("least") - SLACK
        )
        kept = materialize(looked_at.drop("least"), shared_folder(spark, "candidates"))
        raised = materialize(self.raised(kept, k), shared_folder(spark, "thresholds"))
        possible = F.col("part") + F.col("rest") >= F.coalesce("least", F.lit(0.0)) - SLACK
        left = kept.join(raised, "query_id", "left").filter(possible)
        return self.score(left.select("query_id", "doc_id"))

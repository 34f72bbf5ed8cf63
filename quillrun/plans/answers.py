"""From queries to prompts and answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.operators import retrieval
from quillrun.operators.inference import predict
from quillrun.operators.shards import strided_shard
from quillrun.operators.positions import with_row_index

# The wording of the prompt.
PASSAGE_MARK = "- "
PASSAGE_GAP = "\n\n"
PROMPT_HEAD = "Answer the question concisely using the context.\nContext:\n"
PROMPT_QUESTION = "\n\nQuestion: "
PROMPT_TAIL = "\nAnswer:"


def contexts(
    hits: DataFrame, corpus: DataFrame, key: str, text: str, small: bool = False
) -> DataFrame:
    """``(query_id, context)``: the texts of a query's hits in rank order.

    ``small`` says that the hits are within the broadcast bound; then the corpus is
    scanned without a shuffle.
    """
    passages = corpus.select(F.col(key).alias("doc_id"), F.col(text).alias("_passage"))
    found = F.broadcast(hits) if small else hits
    ranked = F.sort_array(F.collect_list(F.struct("rank", "_passage")))
    marked = F.transform(ranked, lambda hit: F.concat(F.lit(PASSAGE_MARK), hit["_passage"]))
    return (
        passages.join(found.select("query_id", "rank", "doc_id"), "doc_id")
        .groupBy("query_id")
        .agg(F.array_join(marked, PASSAGE_GAP).alias("context"))
    )


def prompt(question: Column, context: Column) -> Column:
    """The fixed prompt around a context and a question."""
    return F.concat(
        F.lit(PROMPT_HEAD), context, F.lit(PROMPT_QUESTION), question, F.lit(PROMPT_TAIL)
    )


def build_prompts(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 3,
    kind: str = "tfidf",
    key: str = "doc_id",
    query_key: str = "query_id",
    text: str = "text",
    max_features: int = retrieval.MAX_FEATURES,
) -> DataFrame:
    """``(query_id, question, prompt)`` for one query or many."""
    small = retrieval.batch_is_small(queries, text)
    hits = retrieval.retrieve(
        corpus, queries, k, kind, key, query_key, text, max_features, small
    )
    few_hits = small and k * retrieval.BROADCAST_QUERIES <= retrieval.BROADCAST_CHARS
    found = contexts(hits, corpus, key, text, few_hits)
    asked = queries.select(F.col(query_key).alias("query_id"), F.col(text).alias("question"))
    return asked.join(found, "query_id", "left").select(
        "query_id",
        "question",
        prompt(F.col("question"), F.coalesce("context", F.lit(""))).alias("prompt"),
    )


def answer(
    corpus: DataFrame,
    queries: DataFrame,
    make_generator: Callable,
    k: int = 3,
    kind: str = "tfidf",
    batch_size: int = 4,
    **names: str,
) -> DataFrame:
    """Prompts with the answers of a caller's batch generator.

    ``make_generator()`` runs once per Python worker and returns a function from an
    array of prompts to an array of answers.
    """
    prompts = build_prompts(corpus, queries, k, kind, **names)
    return predict(prompts, make_generator, ["prompt"], "answer", "string", batch_size)


def shard_queries(
    queries: DataFrame, order: str, n_shards: int, batch_size: int = 4
) -> DataFrame:
    """Strided shard, and batch within the shard, of each query."""
    indexed = with_row_index(queries, order)
    return indexed.withColumns(
        {
            "shard": strided_shard(F.col("row_index"), n_shards),
            "batch_id": F.floor(F.floor(F.col("row_index") / n_shards) / batch_size).cast("long"),
        }
    ).drop("row_index")

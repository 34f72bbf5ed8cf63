"""Registered queries over retrieval and prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.functions import text as tx
from quillrun.operators import retrieval
from quillrun.plans.catalog import registry
from quillrun.plans import answers
from quillrun.plans.corpus_queries import SQL_SPACE_TOKENS, SQL_TERMS, SQL_WORDS
from quillrun.sources.tables import table

K = 3

QUERIES, ORACLES, register = registry()


def _corpus(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text")


def _asked(spark, folder):
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


SQL_TFIDF = f"""
doc_terms AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest({SQL_TERMS}) AS term
    FROM (SELECT doc_id, {SQL_WORDS} AS w FROM documents))
  GROUP BY doc_id, term
),
fitted AS (
  SELECT term, n, df, ln((1 + (SELECT count(*) FROM documents)) / (1.0 + df)::DOUBLE) + 1 AS idf
  FROM (SELECT term, sum(tf)::BIGINT AS n, count(*) AS df FROM doc_terms GROUP BY term
        ORDER BY n DESC, term LIMIT {retrieval.MAX_FEATURES})
),
doc_raw AS (
  SELECT doc_id, term, tf * idf AS w FROM doc_terms JOIN fitted USING (term)
),
doc_weights AS (
  SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM doc_raw
)
"""

SQL_ASKED = f"""
query_raw AS (
  SELECT query_id, term, count(*) * any_value(idf) AS w FROM (
    SELECT item_id AS query_id, unnest({SQL_TERMS}) AS term
    FROM (SELECT item_id, {SQL_WORDS} AS w FROM benchmark)) JOIN fitted USING (term)
  GROUP BY query_id, term
),
query_weights AS (
  SELECT query_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY query_id)) AS weight
  FROM query_raw
),
tfidf_scores AS (
  SELECT query_id, doc_id, sum(q.weight * d.weight) AS score
  FROM query_weights q JOIN doc_weights d USING (term) GROUP BY query_id, doc_id
)
"""

SQL_OVERLAP = f"""
doc_tokens AS (
  SELECT doc_id, len(t) AS nd, unnest(t) AS token
  FROM (SELECT doc_id, list_distinct({SQL_SPACE_TOKENS}) AS t FROM documents)
),
query_tokens AS (
  SELECT query_id, len(t) AS nq, unnest(t) AS token
  FROM (SELECT item_id AS query_id, list_distinct({SQL_SPACE_TOKENS}) AS t FROM benchmark)
),
overlap_scores AS (
  SELECT query_id, doc_id, count(*) / sqrt(any_value(nq)::DOUBLE * any_value(nd)) AS score
  FROM query_tokens JOIN doc_tokens USING (token) GROUP BY query_id, doc_id
)
"""


def _hits_sql(scores: str, hits: str) -> str:
    """All pairs, missing scores as 0, best k per query."""
    return f"""
{hits} AS (
  SELECT query_id, rank, doc_id, score FROM (
    SELECT query_id, doc_id, coalesce(score, 0) AS score,
      row_number() OVER (PARTITION BY query_id
                         ORDER BY round(coalesce(score, 0), 9) DESC, doc_id) AS rank
    FROM (SELECT item_id AS query_id, doc_id FROM benchmark, documents)
    LEFT JOIN {scores} USING (query_id, doc_id))
  WHERE rank <= {K}
)
"""


SQL_TFIDF_HITS = f"{SQL_TFIDF}, {SQL_ASKED}, {_hits_sql('tfidf_scores', 'tfidf_hits')}"
SQL_OVERLAP_HITS = f"{SQL_OVERLAP}, {_hits_sql('overlap_scores', 'overlap_hits')}"


def _hits(df):
    return df.select(
        "query_id",
        F.col("rank").cast("long").alias("rank"),
        "doc_id",
        F.round("score", 6).alias("score"),
    )


SQL_PAIR = f"""
WITH turns AS (
  SELECT conv_id, turn, list_distinct({SQL_SPACE_TOKENS}) AS t FROM conversations
)
SELECT q.conv_id, q.turn, round(CASE WHEN len(q.t) * len(d.t) > 0 THEN
  len(list_intersect(q.t, d.t)) / sqrt(len(q.t)::DOUBLE * len(d.t)) ELSE 0 END, 6) AS score
FROM turns q JOIN turns d ON d.conv_id = q.conv_id AND d.turn = q.turn + 1
"""


@register("q_35_overlap_pair", SQL_PAIR)
def overlap_pair(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    replies = turns.select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply")
    )
    score = tx.overlap_score(F.col("text"), F.col("reply"))
    return turns.join(replies, ["conv_id", "turn"]).select(
        "conv_id", "turn", F.round(score, 6).alias("score")
    )


@register(
    "q_36_overlap_top_k",
    f"WITH {SQL_OVERLAP_HITS} SELECT query_id, rank, doc_id, round(score, 6) AS score "
    "FROM overlap_hits",
)
def overlap_top_k(spark, folder):
    return _hits(
        retrieval.retrieve(_corpus(spark, folder), _asked(spark, folder), K, "overlap")
    )


@register(
    "q_37_tfidf_fit",
    f"WITH {SQL_TFIDF} SELECT term, n, df, round(idf, 6) AS idf FROM fitted",
)
def tfidf_fit(spark, folder):
    return retrieval.fit_tfidf(_corpus(spark, folder), "doc_id", "text").withColumn(
        "idf", F.round("idf", 6)
    )


@register(
    "q_38_tfidf_documents",
    f"WITH {SQL_TFIDF} SELECT doc_id, term, round(weight, 6) AS weight FROM doc_weights",
)
def tfidf_documents(spark, folder):
    words = retrieval.stored_words(_corpus(spark, folder), "doc_id", "text")
    fitted = retrieval.fit_tfidf(words, "doc_id", "text", split=True)
    return retrieval.tfidf_weights(words, fitted, "doc_id", "text", split=True).withColumn(
        "weight", F.round("weight", 6)
    )


@register(
    "q_39_tfidf_queries",
    f"WITH {SQL_TFIDF}, {SQL_ASKED} SELECT query_id, term, round(weight, 6) AS weight "
    "FROM query_weights",
)
def tfidf_queries(spark, folder):
    fitted = retrieval.fit_tfidf(_corpus(spark, folder), "doc_id", "text")
    return retrieval.tfidf_weights(
        _asked(spark, folder), fitted, "query_id", "text"
    ).withColumn("weight", F.round("weight", 6))


@register(
    "q_40_cosine",
    f"WITH {SQL_TFIDF}, {SQL_ASKED} SELECT query_id, count(*) AS n_pairs, "
    "round(sum(score), 4) AS total, round(max(score), 6) AS largest "
    "FROM tfidf_scores GROUP BY query_id",
)
def cosine(spark, folder):
    words = retrieval.stored_words(_corpus(spark, folder), "doc_id", "text")
    asked = _asked(spark, folder)
    fitted = retrieval.fit_tfidf(words, "doc_id", "text", split=True)
    scores = retrieval.cosine_scores(
        retrieval.tfidf_weights(words, fitted, "doc_id", "text", split=True),
        retrieval.tfidf_weights(asked, fitted, "query_id", "text"),
        retrieval.batch_is_small(asked, "text"),
    )
    return scores.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.round(F.sum("score"), 4).alias("total"),
        F.round(F.max("score"), 6).alias("largest"),
    )


@register(
    "q_41_tfidf_top_k",
    f"WITH {SQL_TFIDF_HITS} SELECT query_id, rank, doc_id, round(score, 6) AS score "
    "FROM tfidf_hits",
)
def tfidf_top_k(spark, folder):
    return _hits(retrieval.retrieve(_corpus(spark, folder), _asked(spark, folder), K, "tfidf"))


@register(
    "q_42_retrieve_kinds",
    f"WITH {SQL_TFIDF_HITS}, {SQL_OVERLAP_HITS} "
    "SELECT 'tfidf' AS kind, query_id, rank, doc_id, round(score, 6) AS score FROM tfidf_hits "
    "UNION ALL "
    "SELECT 'overlap', query_id, rank, doc_id, round(score, 6) FROM overlap_hits",
)
def retrieve_kinds(spark, folder):
    corpus, asked = _corpus(spark, folder), _asked(spark, folder)
    small = retrieval.batch_is_small(asked, "text")
    kinds = [
        _hits(retrieval.retrieve(corpus, asked, K, kind, small=small)).withColumn(
            "kind", F.lit(kind)
        )
        for kind in ("tfidf", "overlap")
    ]
    return kinds[0].unionByName(kinds[1])


SQL_CONTEXT = """
found AS (
  SELECT query_id, string_agg(concat('- ', text), chr(10) || chr(10) ORDER BY rank) AS context
  FROM {hits} JOIN documents USING (doc_id) GROUP BY query_id
)
"""
SQL_PROMPT = (
    "concat('Answer the question concisely using the context.', chr(10), 'Context:', chr(10), "
    "context, chr(10), chr(10), 'Question: ', text, chr(10), 'Answer:')"
)


@register(
    "q_43_context",
    f"WITH {SQL_OVERLAP_HITS}, {SQL_CONTEXT.format(hits='overlap_hits')} "
    "SELECT query_id, context FROM found",
)
def context(spark, folder):
    corpus, asked = _corpus(spark, folder), _asked(spark, folder)
    small = retrieval.batch_is_small(asked, "text")
    hits = retrieval.retrieve(corpus, asked, K, "overlap", small=small)
    return answers.contexts(hits, corpus, "doc_id", "text", small)


@register(
    "q_44_prompt",
    f"WITH {SQL_OVERLAP_HITS}, {SQL_CONTEXT.format(hits='overlap_hits')} "
    f"SELECT query_id, text AS question, {SQL_PROMPT} AS prompt "
    "FROM found JOIN benchmark ON item_id = query_id",
)
def prompt(spark, folder):
    return answers.build_prompts(_corpus(spark, folder), _asked(spark, folder), K, "overlap")


@register(
    "q_45_answer_batches",
    f"WITH {SQL_TFIDF_HITS}, {SQL_CONTEXT.format(hits='tfidf_hits')}, "
    "placed AS (SELECT item_id AS query_id, text, row_number() OVER (ORDER BY item_id) - 1 AS i "
    "FROM benchmark) "
    f"SELECT query_id, i % 4 AS shard, (i // 4) // 4 AS batch_id, {SQL_PROMPT} AS prompt "
    "FROM found JOIN placed USING (query_id)",
)
def answer_batches(spark, folder):
    asked = _asked(spark, folder)
    prompts = answers.build_prompts(_corpus(spark, folder), asked, K, "tfidf")
    placed = answers.shard_queries(asked.select("query_id"), "query_id", 4, batch_size=4)
    return prompts.join(placed, "query_id").select(
        "query_id", F.col("shard").cast("long").alias("shard"), "batch_id", "prompt"
    )


@register(
    "q_46_corpus_stats",
    f"WITH {SQL_TFIDF} SELECT 'tfidf' AS kind, (SELECT count(*) FROM documents) AS n_docs, "
    "(SELECT count(*) FROM fitted) AS n_terms",
)
def corpus_stats(spark, folder):
    corpus = _corpus(spark, folder)
    return retrieval.corpus_stats(corpus, retrieval.fit_tfidf(corpus, "doc_id", "text"))

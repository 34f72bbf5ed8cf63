"""Registered queries over models, inference and evaluation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quillrun.functions import arrays
from quillrun.operators import evaluation, inference, language_model, learn
from quillrun.operators.shards import split_name
from quillrun.plans.catalog import registry
from quillrun.plans.corpus_queries import QUALITY_NAMES, SHARES, SQL_WORDS, TOXIC_NAMES
from quillrun.sources.tables import table

QUERIES, ORACLES, register = registry()


def _docs(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text", "lang")


def _texts(spark, folder):
    """Documents for costly work on each row."""
    return _docs(spark, folder)


SQL_SPLIT = (
    "CASE WHEN h < 'cccd' THEN 'train' WHEN h < 'e666' THEN 'validation' ELSE 'test' END AS split"
)


def _split_sql(key: str, source: str, accurate: str) -> str:
    return (
        f"SELECT split, count(*) AS n_rows, true AS known_classes, {accurate} AS accurate FROM "
        f"(SELECT {SQL_SPLIT} FROM (SELECT substring(md5({key}::VARCHAR), 1, 4) AS h FROM {source})) "
        "GROUP BY split"
    )


def _by_split(scored, classes, predicted: str, label: str, bars: dict[str, float]):
    """Rows of each split, whether all classes are known ones, and whether enough are right.

    ``classes`` are the labels there are. Of a split in ``bars`` at least that share must be
    right, and no less than its most frequent class has; NULL says that nothing is asked.
    """
    known = classes.select(F.col(label).alias(predicted)).distinct().withColumn("_known", F.lit(True))
    by_class = (
        scored.join(known, predicted, "left")
        .groupBy("split", label)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count_if(F.col(predicted) == F.col(label)).alias("_right"),
            F.every(F.coalesce("_known", F.lit(False))).alias("_all_known"),
        )
    )
    bar = F.coalesce(*(F.when(F.col("split") == k, F.lit(v)) for k, v in bars.items()))
    n, right = F.sum("_n"), F.sum("_right")
    return by_class.groupBy("split").agg(
        n.alias("n_rows"),
        F.every("_all_known").alias("known_classes"),
        F.when(F.max(bar).isNotNull(), (right >= F.max("_n")) & (right / n >= F.max(bar))).alias(
            "accurate"
        ),
    )


@register("q_47_text_classifier", _split_sql("doc_id", "documents", "true"))
def text_classifier(spark, folder):
    """Trained on the train split, applied to all documents, measured on every split."""
    docs = _texts(spark, folder).withColumn("split", split_name(F.col("doc_id"), SHARES))
    _, scored = learn.fit_and_classify(
        docs, "text", "lang", F.col("split") == "train", ["doc_id", "split", "lang"]
    )
    return _by_split(scored, docs, "predicted", "lang", dict.fromkeys(SHARES, 0.9))


@register(
    "q_48_transfer_head",
    _split_sql("vec_id", "embeddings", "CASE WHEN split = 'train' THEN true END"),
)
def transfer_head(spark, folder):
    """A head on given vectors, trained on the train split, applied to every split.

    The labels of these vectors are drawn at random, so accuracy is asked of the rows
    that the head was fitted to alone: no less than the most frequent class would give.
    """
    vectors = table(spark, folder, "embeddings").withColumn(
        "split", split_name(F.col("vec_id"), SHARES)
    )
    model = learn.fit_head(vectors.filter(F.col("split") == "train"), "embedding", "label")
    scored = learn.predict_head(model, vectors, "embedding", ["split", "label"])
    return _by_split(scored, vectors, "prediction", "label", {"train": 0.0})


def _pairs_sql(source: str, name: str) -> str:
    return (
        f"{name} AS (SELECT context, target, count(*) AS n_pair FROM (SELECT "
        "unnest(w[:-2]) AS context, unnest(w[2:]) AS target FROM "
        f"(SELECT {SQL_WORDS} AS w FROM {source}) WHERE len(w) > 1) GROUP BY context, target)"
    )


def _words_sql(source: str) -> str:
    return f"(SELECT count(DISTINCT t) FROM (SELECT unnest({SQL_WORDS}) AS t FROM {source}))"


@register(
    "q_49_ngram_model",
    f"WITH {_pairs_sql('documents', 'pairs')}, contexts AS (SELECT context, "
    "sum(n_pair)::BIGINT AS n_context FROM pairs GROUP BY context) "
    "SELECT context, target, n_pair, n_context, round((n_pair + 1.0::DOUBLE) / "
    f"(n_context + 1.0::DOUBLE * {_words_sql('documents')}), 9) AS p "
    "FROM pairs JOIN contexts USING (context)",
)
def ngram_model(spark, folder):
    return language_model.fit_ngram_lm(_texts(spark, folder), "text").withColumn(
        "p", F.round("p", 9)
    )


@register(
    "q_50_perplexity",
    "WITH parts AS (SELECT text, substring(md5(doc_id::VARCHAR), 1, 4) AS h FROM documents), "
    "train AS (SELECT text FROM parts WHERE h < 'cccd'), "
    "held AS (SELECT text FROM parts WHERE h >= 'e666'), "
    f"{_pairs_sql('train', 'seen')}, {_pairs_sql('held', 'asked')}, "
    "contexts AS (SELECT context, sum(n_pair) AS n_context FROM seen GROUP BY context), "
    "scored AS (SELECT a.n_pair AS n, (coalesce(s.n_pair, 0) + 1.0::DOUBLE) / "
    f"(coalesce(n_context, 0) + {_words_sql('train')})::DOUBLE AS p FROM asked a "
    "LEFT JOIN seen s USING (context, target) LEFT JOIN contexts USING (context)), "
    "loss AS (SELECT sum(n)::BIGINT AS n_pairs, sum(-ln(p) * n) / sum(n) AS ce FROM scored) "
    "SELECT n_pairs, round(ce, 6) AS cross_entropy, round(exp(ce), 4) AS perplexity FROM loss",
)
def perplexity(spark, folder):
    docs = _texts(spark, folder).withColumn("split", split_name(F.col("doc_id"), SHARES))
    parts = [docs.filter(F.col("split") == s).select("text") for s in ("train", "test")]
    return language_model.evaluate_ngram_lm(*parts, "text").select(
        "n_pairs",
        F.round("cross_entropy", 6).alias("cross_entropy"),
        F.round("perplexity", 4).alias("perplexity"),
    )


@register(
    "q_52_arg_max",
    "SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS prediction, label "
    " FROM embeddings",
)
def arg_max(spark, folder):
    return table(spark, folder, "embeddings").select(
        "vec_id", arrays.arg_max(F.col("embedding")).cast("long").alias("prediction"), "label"
    )


CLASSES, WIDTH = 10, 64


@register(
    "q_53_batch_inference",
    f"""
WITH scored AS (
  SELECT vec_id, list_transform(range({CLASSES}), lambda c: list_sum(list_transform(range({WIDTH}),
    lambda j: embedding[j + 1]::DOUBLE * ((c * 7 + j * 3) % 11 - 5)::DOUBLE / 10.0::DOUBLE)))
    AS scores
  FROM embeddings
)
SELECT vec_id, list_position(scores, list_max(scores)) - 1 AS prediction,
  round(list_max(scores), 6) AS best_score
FROM scored
""",
)
def batch_inference(spark, folder):
    """Scores of a linear layer whose weights follow a rule, made once per worker."""

    def linear_model():
        c, j = np.arange(CLASSES)[:, None], np.arange(WIDTH)[None, :]
        weights = ((c * 7 + j * 3) % 11 - 5) / 10.0
        return lambda batch: batch.astype(np.float64) @ weights.T

    scored = inference.predict(
        table(spark, folder, "embeddings").select("vec_id", "embedding"),
        linear_model,
        ["embedding"],
        "scores",
        "array<double>",
        batch_size=64,
        shapes=[[WIDTH]],
    )
    return scored.select(
        "vec_id",
        arrays.arg_max(F.col("scores")).cast("long").alias("prediction"),
        F.round(F.array_max("scores"), 6).alias("best_score"),
    )


@register(
    "q_54_accuracy",
    "SELECT count(*) FILTER (WHERE quality = 1 - toxic) AS n_correct, count(*) AS n_total, "
    "round(count(*) FILTER (WHERE quality = 1 - toxic) / greatest(count(*), 1)::DOUBLE, 6) "
    "AS accuracy FROM labels",
)
def accuracy(spark, folder):
    labels = table(spark, folder, "labels").withColumn("gold", 1 - F.col("toxic"))
    return evaluation.accuracy(labels, "quality", "gold").withColumn(
        "accuracy", F.round("accuracy", 6)
    )


@register(
    "q_55_sharded_evaluation",
    "WITH ranks AS (SELECT user_id % 8 AS rank, "
    "count(*) FILTER (WHERE event_type IN ('click', 'purchase'))::DOUBLE AS correct, "
    "count(*)::DOUBLE AS total, (count(*) * 128)::DOUBLE AS tokens, sum(value) / 1000 AS seconds "
    "FROM events GROUP BY 1) "
    "SELECT sum(correct) AS correct, sum(total) AS total, sum(tokens) AS tokens, "
    "round(max(seconds), 6) AS wall_seconds, "
    "round(sum(correct) / greatest(sum(total), 1), 6) AS global_accuracy, "
    "round(sum(total) / greatest(max(seconds), 1e-9), 4) AS global_samples_per_sec, "
    "round(sum(tokens) / greatest(max(seconds), 1e-9), 4) AS global_tokens_per_sec FROM ranks",
)
def sharded_evaluation(spark, folder):
    counts = evaluation.per_rank_counts(
        table(spark, folder, "events"),
        F.pmod("user_id", F.lit(8)),
        F.col("event_type").isin("click", "purchase"),
        F.lit(128),
        F.col("value") / 1000,
    )
    places = {
        "wall_seconds": 6,
        "global_accuracy": 6,
        "global_samples_per_sec": 4,
        "global_tokens_per_sec": 4,
    }
    return evaluation.reduce_ranks(counts).withColumns(
        {c: F.round(c, n) for c, n in places.items()}
    )


@register(
    "q_56_prediction_report",
    "SELECT doc_id, concat(replace(substring(text, 1, 80), chr(10), ' '), ' ...') AS preview, "
    "(['low', 'high'])[quality + 1] AS gold, (['clean', 'toxic'])[toxic + 1] AS pred "
    "FROM documents JOIN labels USING (doc_id) "
    "ORDER BY md5(concat('42:', doc_id)), doc_id LIMIT 3",
)
def prediction_report(spark, folder):
    named = (
        _docs(spark, folder)
        .join(table(spark, folder, "labels"), "doc_id")
        .withColumns(
            {
                "gold": arrays.class_name(F.col("quality"), QUALITY_NAMES),
                "pred": arrays.class_name(F.col("toxic"), TOXIC_NAMES),
            }
        )
    )
    return evaluation.prediction_report(named, "doc_id", "text", "gold", "pred")


SQL_EPOCHS = (
    "WITH epochs AS (SELECT day(ts) AS epoch, count(*) AS n_rows, "
    "avg((value > 50)::INT::DOUBLE) AS accuracy FROM events GROUP BY day(ts))"
)


def _epochs(spark, folder):
    return evaluation.epoch_metrics(
        table(spark, folder, "events"), F.dayofmonth("ts").cast("long"), F.col("value") > 50
    )


@register(
    "q_57_epoch_metrics",
    f"{SQL_EPOCHS} SELECT epoch, n_rows, round(accuracy, 6) AS accuracy FROM epochs",
)
def epoch_metrics(spark, folder):
    return _epochs(spark, folder).withColumn("accuracy", F.round("accuracy", 6))


@register(
    "q_57b_best_epoch",
    f"{SQL_EPOCHS} SELECT round(max(accuracy), 6) AS best_accuracy, "
    "arg_max(epoch, (accuracy, -epoch)) AS best_epoch, "
    "round(arg_max(accuracy, epoch), 6) AS last_accuracy, max(epoch) AS last_epoch FROM epochs",
)
def best_epoch(spark, folder):
    return evaluation.best_epoch(_epochs(spark, folder)).withColumns(
        {c: F.round(c, 6) for c in ("best_accuracy", "last_accuracy")}
    )


@register(
    "q_96_map_batches",
    "SELECT doc_id, length(text) AS n_chars, length(text) - length(replace(text, ' ', '')) "
    "AS n_spaces FROM documents",
)
def map_batches(spark, folder):
    def count_characters(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "doc_id": frame["doc_id"],
                "n_chars": frame["text"].str.len(),
                "n_spaces": frame["text"].str.count(" "),
            }
        )

    docs = _docs(spark, folder).select("doc_id", "text")
    return inference.map_batches(
        docs, count_characters, "doc_id bigint, n_chars bigint, n_spaces bigint", batch_size=64
    )


@register(
    "q_97_batched_metric",
    "SELECT round(count(*) FILTER (WHERE quality = 1 - toxic) / count(*)::DOUBLE, 6) AS accuracy "
    "FROM labels",
)
def batched_metric(spark, folder):
    def add_batch(frame: pd.DataFrame) -> dict[str, float]:
        hits = (frame["quality"] == frame["gold"]).sum()
        return {"correct": float(hits), "total": float(len(frame))}

    labels = table(spark, folder, "labels").select(
        "quality", (1 - F.col("toxic")).alias("gold")
    )
    ratio = F.round(F.col("correct") / F.greatest(F.col("total"), F.lit(1.0)), 6)
    return inference.batched_metric(
        labels, add_batch, ["correct", "total"], ratio, "accuracy", batch_size=64
    )

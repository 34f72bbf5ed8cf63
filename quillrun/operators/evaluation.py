"""Accuracy, sharded reductions and prediction reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.functions import text as tx
from quillrun.operators.slices import sample_n

# The floors of a count and of a time in a quotient.
LEAST_COUNT = 1
LEAST_SECONDS = 1e-9


def accuracy(df: DataFrame, predicted: str, gold: str, by: Sequence[str] = ()) -> DataFrame:
    """Correct, total and their quotient, 0 for no rows."""
    hit = F.count_if(F.col(predicted) == F.col(gold))
    return (
        df.groupBy(*by)
        .agg(hit.alias("n_correct"), F.count(F.lit(1)).alias("n_total"))
        .withColumn(
            "accuracy", F.col("n_correct") / F.greatest(F.col("n_total"), F.lit(LEAST_COUNT))
        )
    )


def per_rank_counts(
    df: DataFrame, rank: Column, correct: Column, tokens: Column, seconds: Column
) -> DataFrame:
    """What each rank counts: correct, total, tokens, and its time."""
    return df.groupBy(rank.alias("rank")).agg(
        F.sum(correct.cast("double")).alias("correct"),
        F.count(F.lit(1)).cast("double").alias("total"),
        F.sum(tokens.cast("double")).alias("tokens"),
        F.sum(seconds.cast("double")).alias("seconds"),
    )


def reduce_ranks(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sums of counts and the longest time over ranks, then the rates."""
    total = F.greatest(F.col("total"), F.lit(float(LEAST_COUNT)))
    wall = F.greatest(F.col("wall_seconds"), F.lit(LEAST_SECONDS))
    sums = counts.groupBy(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("correct", "total", "tokens")],
        F.coalesce(F.max("seconds"), F.lit(0.0)).alias("wall_seconds"),
    )
    return sums.withColumns(
        {
            "global_accuracy": F.col("correct") / total,
            "global_samples_per_sec": total / wall,
            "global_tokens_per_sec": F.col("tokens") / wall,
        }
    )


def prediction_report(
    df: DataFrame, key: str, text: str, gold: str, predicted: str, n: int = 3, seed: int = 42
) -> DataFrame:
    """A few sampled rows with a preview and both class names."""
    return sample_n(df, n, key, seed).select(
        key,
        tx.preview(F.col(text)).alias("preview"),
        F.col(gold).alias("gold"),
        F.col(predicted).alias("pred"),
    )


def epoch_metrics(df: DataFrame, epoch: Column, correct: Column) -> DataFrame:
    """Accuracy per epoch."""
    return df.groupBy(epoch.alias("epoch")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(correct.cast("double")).alias("accuracy")
    )


def best_epoch(metrics: DataFrame) -> DataFrame:
    """One row: best accuracy with its first epoch, and the last epoch's accuracy."""
    return metrics.agg(
        F.max("accuracy").alias("best_accuracy"),
        F.max_by("epoch", F.struct(F.col("accuracy"), -F.col("epoch"))).alias("best_epoch"),
        F.max_by("accuracy", "epoch").alias("last_accuracy"),
        F.max("epoch").alias("last_epoch"),
    )

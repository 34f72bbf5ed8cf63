"""Exact percentiles without a group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillrun.operators.positions import with_ranges


def exact_percentiles(
    df: DataFrame,
    values: Sequence[str],
    shares: Mapping[str, float],
    by: Sequence[str] = (),
    n_ranges: int | None = None,
) -> DataFrame:
    """Percentiles with linear interpolation: ``(by, metric, n, <share name>...)``.

    Equal values are counted first, ranges of values are summed, and only the values
    at the wanted places are kept. The largest sort is one range of one group.
    """
    ranges = [f"_range_{i}" for i in range(len(values))]
    ranged = with_ranges(df.select(*by, *values), list(values), ranges, n_ranges)
    metrics = F.array(
        *[
            F.struct(
                F.lit(v).alias("metric"),
                F.col(r).alias("_range"),
                F.col(v).cast("double").alias("_value"),
            )
            for v, r in zip(values, ranges)
        ]
    )
    group = [*by, "metric"]
    counted = (
        ranged.select(*by, F.explode(metrics).alias("_m"))
        .select(*by, "_m.*")
        .filter(F.col("_value").isNotNull())
        .groupBy(*group, "_range", "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_range")
    starts = (
        counted.groupBy(*group, "_range")
        .agg(F.sum("_n").alias("_size"))
        .select(
            *group,
            "_range",
            (F.sum("_size").over(earlier) - F.col("_size")).alias("_start"),
            F.sum("_size").over(whole).alias("n"),
        )
    )
    inside = Window.partitionBy(*group, "_range").orderBy("_value")
    placed = (
        counted.withColumn("_upto", F.sum("_n").over(inside))
        .join(starts, [*group, "_range"])
        .withColumns(
            {
                "_first": F.col("_start") + F.col("_upto") - F.col("_n"),
                "_after": F.col("_start") + F.col("_upto"),
            }
        )
    )
    aggregates = []
    for name, share in shares.items():
        place = (F.col("n") - 1) * F.lit(float(share))
        low = F.floor(place)
        high = F.least(low + 1, F.col("n") - 1)
        for end, at in (("low", low), ("high", high)):
            hit = (F.col("_first") <= at) & (at < F.col("_after"))
            aggregates.append(F.max(F.when(hit, F.col("_value"))).alias(f"_{name}_{end}"))
    found = placed.groupBy(*group, "n").agg(*aggregates)
    results = []
    for name, share in shares.items():
        place = (F.col("n") - 1) * F.lit(float(share))
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        results.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return found.select(*group, "n", *results)


def quick_percentiles(
    df: DataFrame,
    values: Sequence[str],
    shares: Mapping[str, float],
    by: Sequence[str] = (),
    accuracy: int = 10_000,
) -> DataFrame:
    """The same shape from sketches, with an error of at most ``n / accuracy`` places."""
    metrics = F.array(
        *[
            F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("_value"))
            for v in values
        ]
    )
    long = df.select(*by, F.explode(metrics).alias("_m")).select(*by, "_m.*")
    return (
        long.filter(F.col("_value").isNotNull())
        .groupBy(*by, "metric")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[
                F.percentile_approx("_value", share, accuracy).alias(name)
                for name, share in shares.items()
            ],
        )
    )

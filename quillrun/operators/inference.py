"""Batched inference and user functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def predict(
    df: DataFrame,
    make_model: Callable,
    inputs: Sequence[str],
    output: str,
    output_type: str,
    batch_size: int = 64,
    shapes: Sequence[Sequence[int] | None] | None = None,
) -> DataFrame:
    """Add the predictions of a model that is loaded once per Python worker.

    ``make_model()`` returns a function over NumPy batches of at most ``batch_size``
    rows. ``shapes`` gives the shape of array inputs, for example ``[[64]]``.
    """
    score = predict_batch_udf(
        make_model,
        return_type=T.DataType.fromDDL(output_type),
        batch_size=batch_size,
        input_tensor_shapes=list(shapes) if shapes else None,
    )
    return df.withColumn(output, score(*[F.col(c) for c in inputs]))


def map_batches(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    batch_size: int = 1000,
) -> DataFrame:
    """Apply a function to pandas batches of at most ``batch_size`` rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                yield fn(frame.iloc[start : start + batch_size].reset_index(drop=True))

    return df.mapInPandas(run, schema)


def batched_metric(
    df: DataFrame,
    add_batch: Callable[[pd.DataFrame], dict[str, float]],
    sums: Sequence[str],
    compute: Column,
    name: str,
    batch_size: int = 1000,
) -> DataFrame:
    """A user metric fed batch by batch.

    ``add_batch`` turns a batch into partial sums, Spark adds them up, and
    ``compute`` is an expression over the totals. No task sees more than one batch.
    """

    def partial(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([add_batch(frame)], columns=list(sums)).astype("float64")

    schema = ", ".join(f"{s} double" for s in sums)
    totals = map_batches(df, partial, schema, batch_size).agg(
        *[F.coalesce(F.sum(s), F.lit(0.0)).alias(s) for s in sums]
    )
    return totals.select(compute.alias(name))

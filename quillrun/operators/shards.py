"""Shards, batches, step counts and splits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.operators.positions import with_row_index


def strided_shard(index: Column, n_shards: int) -> Column:
    """Shard ``index mod n_shards``."""
    return F.pmod(index, F.lit(n_shards)).cast("int")


def contiguous_shard(index: Column, n_rows: Column, n_shards: int) -> Column:
    """Shard of a balanced split into ranges, the first shards one row larger."""
    size = F.floor(n_rows / n_shards)
    larger = n_rows - size * n_shards
    edge = larger * (size + 1)
    early = F.floor(index / (size + 1))
    late = larger + F.floor((index - edge) / F.greatest(size, F.lit(1)))
    return F.when(index < edge, early).otherwise(late).cast("int")


def shard_strided(df: DataFrame, order: str, n_shards: int) -> DataFrame:
    return with_row_index(df, order).withColumn(
        "shard", strided_shard(F.col("row_index"), n_shards)
    )


def shard_contiguous(df: DataFrame, order: str, n_shards: int) -> DataFrame:
    return (
        with_row_index(df, order, total="_n")
        .withColumn("shard", contiguous_shard(F.col("row_index"), F.col("_n"), n_shards))
        .drop("_n")
    )


def assign_batches(
    df: DataFrame, order: str, batch_size: int, drop_last: bool = False
) -> DataFrame:
    """Batch number and place in the batch; a short last batch may be dropped.

    The row count tells which batch is short, so no second pass counts the batches.
    """
    batched = with_row_index(df, order, total="_n").withColumns(
        {
            "batch_id": F.floor(F.col("row_index") / batch_size).cast("long"),
            "pos_in_batch": F.pmod("row_index", F.lit(batch_size)).cast("int"),
        }
    )
    if drop_last:
        batched = batched.filter((F.col("batch_id") + 1) * batch_size <= F.col("_n"))
    return batched.drop("_n", "row_index")


def step_plan(
    df: DataFrame, per_rank_batch: int, world: int, accumulation: int = 1, epochs: int = 1
) -> DataFrame:
    """One row: global batch, steps per epoch, steps in all."""
    global_batch = per_rank_batch * world * accumulation
    steps = F.ceil(F.col("n_rows") / global_batch)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(global_batch).cast("long").alias("global_batch"),
        steps.cast("long").alias("steps_per_epoch"),
        (steps * epochs).cast("long").alias("total_steps"),
    )


def split_name(key: Column, shares: Mapping[str, float]) -> Column:
    """Named split of a row, decided by the hash of its key alone.

    The first four hex digits of the hash are compared with the cumulated shares,
    so a row keeps its split when others come or go.
    """
    head = F.substring(F.md5(key.cast("string").cast("binary")), 1, 4)
    names, reached, result = list(shares), 0.0, None
    for name in names[:-1]:
        reached += shares[name]
        test = head < F.lit(f"{round(reached * 0x10000):04x}")
        result = F.when(test, name) if result is None else result.when(test, name)
    last = F.lit(names[-1])
    return last if result is None else result.otherwise(last)


def split_rows(df: DataFrame, key: str, shares: Mapping[str, float]) -> DataFrame:
    return df.withColumn("split", split_name(F.col(key), shares))

"""Prefix sums of array columns, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sums are made in blocks, so that no array is copied once for each element.
BLOCK = 256


def _running(lengths: Column) -> Column:
    return F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all")),
        lambda s, x: F.struct(
            (s["sum"] + x).cast("int").alias("sum"),
            F.concat(s["all"], F.array(s["sum"])).alias("all"),
        ),
        lambda s: s["all"],
    )


def prefix_sums(lengths: Column) -> Column:
    """Sum of all elements before each one."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size(lengths) / BLOCK), F.lit(1)).cast("int") - 1),
        lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)),
    )
    starts = _running(
        F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: (s + x).cast("int")))
    )
    return F.flatten(
        F.zip_with(blocks, starts, lambda b, s: F.transform(_running(b), lambda v: v + s))
    )

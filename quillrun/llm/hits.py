"""Helpers of both vector searches: usable vectors, bounded samples, best hits."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column, zero: bool) -> Column:
    """No null, no null or non-finite component; with ``zero`` false, not all zero."""
    inf = float("inf")
    good = vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)
    )
    if not zero:
        good = good & F.exists(vector, lambda x: x != 0)
    return F.coalesce(good, F.lit(False))


def numbers(n: int) -> Column:
    """A row for each of 0 to ``n - 1``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def padded(rows: list, dimension: int, kind) -> np.ndarray:
    """Vectors as rows of one matrix, short ones filled with zeros."""
    out = np.zeros((len(rows), dimension), dtype=kind)
    for at, row in enumerate(rows):
        out[at, : len(row)] = row
    return out


def sample(df: DataFrame, key: str, vector: str, rows: int) -> list[list]:
    """At most ``rows`` vectors, by the order of a hash of their key."""
    chosen = df.orderBy(F.xxhash64(key), key).select(vector).limit(rows)
    return [r[0] for r in chosen.toLocalIterator()]


def hit_rows(asked: pd.DataFrame, part: str, found: list[list[tuple]]) -> pd.DataFrame:
    """``(id, part, hits)`` of queries that one part was searched for."""
    hits = [[{"neg": n, "id": i} for n, i in own] for own in found]
    return pd.DataFrame(
        {
            "id": asked["id"],
            part: asked[part],
            "hits": pd.Series(hits, index=asked.index, dtype=object),
        }
    )


def lengthened(x: np.ndarray, most: float) -> np.ndarray:
    """Vectors with one component more, that gives all of them the norm ``most``.

    Of such vectors, the one with the largest inner product with a query (whose added
    component is 0) is the nearest one.
    """
    more = np.sqrt(np.maximum(0.0, most**2 - (x * x).sum(axis=1)))
    return np.hstack([x, more[:, None]])


def merge_hits(hits: DataFrame, query: str, parts: str, n_parts: int, k: int) -> DataFrame:
    """``(query, hits)``: the first ``k`` of all arrays of a query, 64 arrays at a time.

    ``hits`` are arrays of structs whose order is the wanted one. No row ever gathers
    more than 64 arrays of ``k``, however many parts there are.
    """
    while True:
        n_parts = -(-n_parts // 64)
        hits = (
            hits.groupBy(query, F.floor(F.col(parts) / 64).alias(parts))
            .agg(F.flatten(F.collect_list("hits")).alias("hits"))
            .select(query, parts, F.slice(F.array_sort("hits"), 1, k).alias("hits"))
        )
        if n_parts <= 1:
            return hits.select(query, "hits")


def ranked(merged: DataFrame, query: str, key: str, score: Column, kind: str) -> DataFrame:
    """One row per hit: ``(query, rank, key, score)``, rank from 1."""
    return merged.select(query, F.posexplode("hits").alias("rank", "hit")).select(
        query,
        (F.col("rank") + 1).alias("rank"),
        F.col("hit.id").alias(key),
        score.cast(kind).alias("score"),
    )

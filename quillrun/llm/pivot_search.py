"""Exact nearest vectors by integer inner product, over a pivot-distance index."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrun.llm.hits import (
    hit_rows,
    lengthened,
    merge_hits,
    numbers,
    padded,
    ranked,
    sample,
    usable,
)
from quillrun.llm.storage import stored

BINS = 256
#: Relative slack of bounds, for the rounding of distances.
SLACK = 1e-6


def choose_pivots(vectors: np.ndarray, pivots: int, rounds: int = 5) -> np.ndarray:
    """Centres of a bounded sample by Lloyd's rounds from its first distinct rows."""
    if not len(vectors):
        return np.zeros((1, vectors.shape[1]))
    _, first = np.unique(vectors, axis=0, return_index=True)
    centres = vectors[np.sort(first)[:pivots]]
    for _ in range(rounds):
        nearest = _distances(vectors, centres).argmin(axis=1)
        centres = np.array(
            [
                vectors[nearest == k].mean(axis=0) if (nearest == k).any() else centres[k]
                for k in range(len(centres))
            ]
        )
    return centres


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0.0))


class Rings:
    """Where the annuli around every pivot begin and end, and the blocks of each.

    Made of the counts of rows per pivot and bin of distance, at most ``BINS`` a pivot:
    neighbouring bins join until they hold ``rows`` rows; a bin that holds more is dealt
    out to several blocks.
    """

    def __init__(self, counts: dict[tuple[int, int], int], pivots: int, width: float, rows: int):
        self.width, self.pivots = width, pivots
        rings, self.of = [], np.zeros((pivots, BINS), dtype=np.int64)
        for pivot in range(pivots):
            held, low = 0, 0
            for bin_ in range(BINS):
                held += counts.get((pivot, bin_), 0)
                self.of[pivot, bin_] = len(rings)
                if held >= rows or bin_ == BINS - 1:
                    rings.append((pivot, low, bin_ + 1, max(1, -(-held // rows))))
                    held, low = 0, bin_ + 1
        table = np.array(rings, dtype=np.int64)
        self.pivot, self.low, self.high, self.blocks = table.T
        self.first = np.concatenate([[0], np.cumsum(self.blocks)[:-1]])
        self.n_blocks = int(self.blocks.sum())

    def bin(self, distance: np.ndarray) -> np.ndarray:
        return np.clip((distance / self.width).astype(np.int64), 0, BINS - 1)

    def block(self, pivot: np.ndarray, distance: np.ndarray, salt: np.ndarray) -> np.ndarray:
        ring = self.of[pivot, self.bin(distance)]
        return self.first[ring] + salt % self.blocks[ring]

    def nearest_possible(self, distances: np.ndarray) -> np.ndarray:
        """For a query's distances to the pivots, a lower bound to all rows of each ring."""
        d = distances[self.pivot]
        low = self.low * self.width
        high = np.where(self.high == BINS, np.inf, self.high * self.width)
        return np.maximum(0.0, np.maximum(low - d, d - high))


def best_of_block(q_ids, queries, ids, vectors, k: int) -> list[list[tuple[int, int]]]:
    """For each query the ``k`` best ``(-score, id)``, without its own id."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0))
    bound *= max(1, vectors.shape[1])
    if bound * max(1, len(ids)) < 2**52:
        scores = (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
        # One number for score and place: equal scores go to the smaller id.
        keyed = scores * len(ids) + np.arange(len(ids) - 1, -1, -1)
    else:
        scores = queries @ vectors.T
        keyed = None
    found = []
    for at, own in enumerate(q_ids):
        low, high = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
        take = min(len(ids), k + int(high - low))
        if keyed is None:
            places = np.argsort(-scores[at], kind="stable")[:take]
        else:
            places = np.argpartition(-keyed[at], take - 1)[:take] if take else np.empty(0, int)
            places = places[np.argsort(-keyed[at, places])]
        places = [p for p in places.tolist() if not low <= p < high][:k]
        found.append([(-int(scores[at, p]), int(ids[p])) for p in places])
    return found


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    key: str = "vec_id",
    vector: str = "vector",
    pivots: int = 32,
    sample_rows: int = 2_048,
    block_rows: int = 1_024,
    query_rows: int = 1_024,
) -> DataFrame:
    """``(query_id, rank, key, score)``: the ``k`` largest inner products of each query.

    Components are whole numbers; sums must fit a 64-bit integer. Candidates are all rows
    but those with the query's own key. Ties go to the smaller key.

    Vectors get one component more, so that the largest inner product is the smallest
    distance. Rows are keyed by their nearest pivot and the distance to it, and cut into
    annuli of about ``block_rows`` rows; equal distances are dealt out to several blocks.
    A query first searches the block it falls in itself. Its ``k``-th score there bounds
    the distance of better ones, so that in order of the triangle inequality's lower
    bounds only the annuli up to it are searched. Pivots are fitted on ``sample_rows``
    rows at most; this decides how much is pruned, never the result.

    Vectors that are null or have null or non-finite components take no part, neither as
    queries; short vectors count as filled with zeros. Repeated rows are candidates each;
    of queries with one key the first counts. No queries or no rows give no rows.
    """
    spark = vectors.sparkSession
    good = lambda df: df.select(
        F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")
    ).filter(usable(F.col("v"), zero=True) & F.col("id").isNotNull())
    rows = good(vectors)
    asked = good(queries).groupBy("id").agg(F.min("v").alias("v"))
    squares = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    known = rows.agg(F.max(squares("v")), F.max(F.size("v")), F.count("*")).first()
    most, dimension = float(known[0] or 0.0) ** 0.5, int(known[1] or 0)
    asked_of = asked.agg(F.max(F.size("v")), F.count("*")).first()
    dimension = max(dimension, int(asked_of[0] or 0))
    slices = -(-max(1, asked_of[1]) // query_rows)

    taught = padded(sample(rows, "id", "v", sample_rows), dimension, np.float64)
    centres = choose_pivots(lengthened(taught, most), pivots)
    width = max(2 * most / BINS, 1e-12)

    def near(matrix: np.ndarray, query: bool) -> np.ndarray:
        more = np.hstack([matrix, np.zeros((len(matrix), 1))]) if query else lengthened(matrix, most)
        return _distances(more, centres)

    def locate(query: bool):
        def run(batches):
            for batch in batches:
                all_ = padded(batch.column(1).to_pylist(), dimension, np.float64)
                d = near(all_, query)
                pivot = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:2],
                        pa.array(pivot, pa.int64()),
                        pa.array(d[np.arange(len(d)), pivot], pa.float64()),
                    ],
                    ["id", "v", "pivot", "distance"],
                )

        return run

    kind = rows.schema["id"].dataType.simpleString()
    located = f"id {kind}, v array<double>, pivot long, distance double"
    placed = stored(rows.mapInArrow(locate(False), located))
    counts = {
        (r[0], r[1]): r[2]
        for r in placed.groupBy(
            "pivot", F.least(F.floor(F.col("distance") / width), F.lit(BINS - 1)).alias("bin")
        )
        .count()
        .collect()  # pivots times bins at most
    }
    rings = Rings(counts, len(centres), width, block_rows)

    def with_block(df: DataFrame) -> DataFrame:
        @F.pandas_udf("long")
        def block(pivot: pd.Series, distance: pd.Series, salt: pd.Series) -> pd.Series:
            return pd.Series(rings.block(pivot.to_numpy(), distance.to_numpy(), salt.to_numpy()))

        salt = F.pmod(F.xxhash64("id"), F.lit(1 << 31))
        return df.withColumn("block", block("pivot", "distance", salt))

    stocked = stored(with_block(placed).select("block", "id", "v"))
    first = with_block(asked.mapInArrow(locate(True), located)).select("block", "id", "v")
    sliced = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(slices)).alias("slice")
    copies = stocked.select("block", numbers(slices).alias("slice"), "id", "v")
    hit = f"array<struct<neg: long, id: {kind}>>"

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = best_of_block(
            left["id"].to_numpy(),
            padded(left["v"].tolist(), dimension, np.int64),
            right["id"].to_numpy(),
            padded(right["v"].tolist(), dimension, np.int64),
            k,
        )
        if "floor" in left:
            found = [
                [h for h in own if -h[0] >= low]
                for own, low in zip(found, left["floor"].tolist(), strict=True)
            ]
        return hit_rows(left, "block", found)

    def searched(asks: DataFrame) -> DataFrame:
        return (
            asks.groupBy("block", "slice")
            .cogroup(copies.groupBy("block", "slice"))
            .applyInPandas(search, f"id {kind}, block long, hits {hit}")
        )

    begun = stored(searched(first.select("block", sliced, "id", "v")))

    def expand(batches):
        for batch in batches:
            matrix = padded(batch.column("v").to_pylist(), dimension, np.float64)
            distances = near(matrix, True)
            square = (matrix * matrix).sum(axis=1)
            blocks, floors = [], []
            for at, (own, hits) in enumerate(
                zip(batch.column("block").to_pylist(), batch.column("hits").to_pylist(), strict=True)
            ):
                bounds = rings.nearest_possible(distances[at])
                full = len(hits) >= k
                floor = -hits[k - 1]["neg"] if full else -(1 << 63)
                reach = np.inf
                if full:
                    reach = np.sqrt(max(0.0, square[at] + most**2 - 2.0 * floor))
                    reach += SLACK * (1.0 + most + square[at] ** 0.5)
                order = np.argsort(bounds, kind="stable")
                order = order[: np.searchsorted(bounds[order], reach, "right")]
                chosen = [
                    b
                    for r in order.tolist()
                    for b in range(int(rings.first[r]), int(rings.first[r] + rings.blocks[r]))
                    if b != own
                ]
                blocks.append(chosen)
                floors.append(floor)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("v"),
                    pa.array(floors, pa.int64()),
                    pa.array(blocks, pa.list_(pa.int64())),
                ],
                ["id", "v", "floor", "blocks"],
            )

    rest = (
        begun.join(asked, "id")
        .select("id", "v", "block", "hits")
        .mapInArrow(expand, f"id {kind}, v array<double>, floor long, blocks array<long>")
        .select(F.explode("blocks").alias("block"), sliced, "id", "v", "floor")
    )
    merged = merge_hits(
        begun.unionByName(searched(rest)).filter("size(hits) > 0"), "id", "block", rings.n_blocks, k
    ).withColumnRenamed("id", "query_id")
    return ranked(merged, "query_id", key, -F.col("hit.neg"), "long")

"""Approximate nearest vectors by the order in which they see a set of pivots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrun.llm.hits import (
    lengthened,
    merge_hits,
    numbers,
    padded,
    ranked,
    sample,
    usable,
)


def choose_pivots(vectors: np.ndarray, pivots: int) -> np.ndarray:
    """The first rows of a sample that are not almost another one already chosen."""
    chosen: list[int] = []
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1), 1e-300)[:, None]
    for at in range(len(vectors)):
        if len(chosen) == pivots:
            break
        if not chosen or (unit[chosen] @ unit[at]).max() < 0.9:
            chosen.append(at)
    return vectors[chosen]


def places(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """For each vector the place of every pivot in its order of nearness."""
    nearness = 2 * x @ pivots.T - (pivots * pivots).sum(axis=1)
    order = np.argsort(-nearness, axis=1, kind="stable")
    out = np.empty_like(order)
    np.put_along_axis(out, order, np.arange(len(pivots))[None], axis=1)
    return out.astype(np.int16)


class Shard:
    """The inverted files of a part of the rows: one for each pivot.

    A row is posted, with the place of the pivot in its order, in the files of the
    ``posted`` pivots nearest to it, and in no others.
    """

    def __init__(
        self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, most: float, posted: int
    ):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.posted = ids[order], vectors[order], posted
        seen = places(lengthened(self.vectors, most), pivots)
        row, pivot = np.nonzero(seen < posted)
        by_pivot = np.argsort(pivot, kind="stable")
        self.rows, self.place = row[by_pivot], seen[row, pivot][by_pivot].astype(np.int32)
        self.begins = np.searchsorted(pivot[by_pivot], np.arange(len(pivots) + 1))

    def search(self, own, query: np.ndarray, seen: np.ndarray, read: int, share: float, k: int, refine: int):
        """The best ``(-score, id)`` of the rows that order the pivots most alike.

        Reads the files of the ``read`` pivots nearest to the query. A posting adds how
        much closer than ``posted`` places apart both orders have its pivot: the footrule
        distance, where a pivot that a row is not posted under counts ``posted``. The
        ``share`` of the rows with the least distance, ``refine * k`` at least, ties
        included, are compared by inner product.
        """
        near = np.argsort(seen, kind="stable")[:read]
        alike = np.zeros(len(self.ids), np.int32)
        for place, pivot in enumerate(near.tolist()):
            file = slice(self.begins[pivot], self.begins[pivot + 1])
            alike[self.rows[file]] += np.maximum(0, self.posted - np.abs(self.place[file] - place))
        take = min(len(self.ids), max(refine * k, int(np.ceil(share * len(self.ids)))))
        bar = np.partition(alike, len(alike) - take)[len(alike) - take]
        chosen = np.flatnonzero((alike >= bar) & (self.ids != own))
        # Row by row in one order, so that equal vectors get equal scores.
        scores = (self.vectors[chosen] * query).sum(axis=1) + 0.0
        best = np.lexsort((self.ids[chosen], -scores))[:k]
        return [(-float(scores[b]), self.ids[chosen[b]].item()) for b in best]


def nearest_by_permutation(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
    pivots: int = 256,
    posted: int = 96,
    read: int = 64,
    share: float = 0.2,
    refine: int = 8,
    sample_rows: int = 2_048,
    shard_rows: int = 16_384,
) -> DataFrame:
    """``(query_id, rank, key, score)``: ``k`` rows of large inner product per query.

    Every row is represented by its ``posted`` nearest pivots in their order, and posted
    in the files of these; files are kept by shards of about ``shard_rows`` rows. A query
    reads the files of the ``read`` pivots nearest to it, ranks rows by footrule distance
    and compares the best ``share`` of each shard, ``refine * k`` rows at least, by the
    exact inner product of the original vectors in double precision. Ties go to the
    smaller key. Pivots come from ``sample_rows`` rows at most; every row is indexed.
    Rows are shuffled once: queries are sent to the shards and stream past each of them.

    Vectors that are null, zero, or have null or non-finite components take no part,
    neither as queries; short vectors count as filled with zeros. Candidates are all rows
    but those with the query's own key; repeated rows are candidates each; of queries
    with one key the least vector counts. Fewer candidates than ``k`` are all returned.
    No queries or rows give no rows.
    """
    good = lambda df: df.select(
        F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")
    ).filter(usable(F.col("v"), zero=False) & F.col("id").isNotNull())
    rows = good(vectors)
    asked = good(queries).groupBy("id").agg(F.min("v").alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    known = rows.agg(F.max(squares), F.max(F.size("v")), F.count("*")).first()
    most = float(known[0] or 0.0) ** 0.5
    dimension = max(int(known[1] or 0), int(asked.agg(F.max(F.size("v"))).first()[0] or 0))
    shards = max(1, -(-known[2] // shard_rows))
    taught = padded(sample(rows, "id", "v", sample_rows), dimension, np.float64)
    centres = choose_pivots(lengthened(taught, most), pivots)
    kind = rows.schema["id"].dataType.simpleString()

    stock = rows.select(F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"), F.lit(0).alias("asks"), "id", "v")
    asks = asked.select(numbers(shards).alias("shard"), F.lit(1).alias("asks"), "id", "v")
    records = stock.unionByName(asks).repartition("shard").sortWithinPartitions("shard", "asks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each shard the rows come first, then the queries."""
        at, parts, shard = None, [], None
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            number = batch.column("shard").to_numpy(zero_copy_only=False)
            asking = batch.column("asks").to_numpy(zero_copy_only=False)
            matrix = padded(batch.column("v").to_pylist(), dimension, np.float64)
            out: list[list] = [[], [], []]
            cuts = np.flatnonzero(np.diff(number) != 0) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(number)], strict=True):
                if number[begin] != at:
                    at, parts, shard = number[begin], [], None
                first = begin + int(np.searchsorted(asking[begin:end], 1))
                if first > begin:
                    parts.append((ids[begin:first], matrix[begin:first]))
                if first == end:
                    continue
                if shard is None and parts:
                    shard = Shard(*map(np.concatenate, zip(*parts, strict=True)), centres, most, posted)
                    parts = []
                if shard is None:
                    continue
                own = matrix[first:end]
                seen = places(np.hstack([own, np.zeros((len(own), 1))]), centres)
                for name, query, order in zip(ids[first:end], own, seen, strict=True):
                    found = shard.search(name, query, order, read, share, k, refine)
                    if found:
                        out[0].append(name)
                        out[1].append(int(at))
                        out[2].append([{"neg": n, "id": i} for n, i in found])
            if out[0]:
                id_type = batch.column("id").type
                hit = pa.list_(pa.struct([("neg", pa.float64()), ("id", id_type)]))
                types = (id_type, pa.int64(), hit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(out, types, strict=True)], ["id", "shard", "hits"]
                )

    hits = records.mapInArrow(search, f"id {kind}, shard long, hits array<struct<neg: double, id: {kind}>>")
    merged = merge_hits(hits, "id", "shard", shards, k)
    return ranked(
        merged.withColumnRenamed("id", "query_id"), "query_id", key, -F.col("hit.neg") + 0.0, "double"
    )

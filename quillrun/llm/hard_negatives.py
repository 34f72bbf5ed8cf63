"""Hard negatives by a vertical scan of vector columns with bounds (BOND).

Rows lie in blocks, one matrix row per dimension. An anchor reads the dimensions in the
order of its own magnitudes. What the remaining ones can still add, from the least and
largest value of each in the block, bounds every score from both sides, and the bitmap of
candidates shrinks until only exact scores inside the asked windows are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrun.llm.hits import merge_hits, numbers, padded, usable
from quillrun.llm.storage import stored

#: Dimensions read between two looks at the bounds.
STEP = 8
LOW, HIGH = -(1 << 63), (1 << 63) - 1


class Block:
    """Vectors of whole numbers, a row per dimension, in the order of their ids."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.columns = np.ascontiguousarray(vectors[order].T)
        self.least = self.columns.min(axis=1, initial=0)
        self.most = self.columns.max(axis=1, initial=0)
        # Sums of products that doubles hold exactly are made with doubles.
        self.reach = np.maximum(-self.least, self.most).astype(np.float64)
        self.doubles = self.columns.astype(np.float64)

    def exact_in_doubles(self, query: np.ndarray) -> bool:
        return float(np.abs(query).astype(np.float64) @ self.reach) < 2**52


def scan(
    block: Block, query: np.ndarray, alive: np.ndarray, windows: list[tuple[int, int]], k: int
) -> list[list[tuple[int, int]]]:
    """For each window ``(low, high)`` the ``k`` best ``(-score, id)`` among ``alive``.

    ``alive`` is a bitmap over the rows of the block. A row leaves it as soon as, for
    every window, it cannot fall inside, or ``k`` rows certain to be inside are better.
    """
    exact = block.exact_in_doubles(query)
    columns = block.doubles if exact else block.columns
    q = query.astype(columns.dtype)
    order = np.argsort(-np.abs(q), kind="stable")
    ends = np.stack([q * block.least, q * block.most])[:, order].astype(columns.dtype)
    still = lambda side: np.concatenate([np.cumsum(side[::-1])[::-1], [0]])
    rest_low, rest_high = still(ends.min(axis=0)), still(ends.max(axis=0))
    places = np.flatnonzero(alive)
    score = np.zeros(len(places), columns.dtype)
    for begin in range(0, len(order), STEP):
        if not len(places):
            break
        dims = order[begin : begin + STEP]
        whole = len(places) == columns.shape[1]
        score = score + q[dims] @ (columns[dims] if whole else columns[dims][:, places])
        low, high = score + rest_low[begin + len(dims)], score + rest_high[begin + len(dims)]
        keep = np.zeros(len(places), bool)
        for least, most in windows:
            sure = low[(low >= least) & (high <= most)]
            if len(sure) >= k:
                least = max(least, np.partition(sure, len(sure) - k)[len(sure) - k])
            keep |= (high >= least) & (low <= most)
        if not keep.all():
            places, score = places[keep], score[keep]
    found = []
    for least, most in windows:
        inside = np.flatnonzero((score >= least) & (score <= most))
        best = inside[np.argsort(-score[inside], kind="stable")[:k]]
        found.append(
            [(-int(s), i) for s, i in zip(score[best], block.ids[places[best]].tolist(), strict=True)]
        )
    return found


def _whole(column: pa.Array, dimension: int) -> np.ndarray:
    """Vectors of a batch as a matrix, short ones filled with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths == dimension).all():
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
    return padded(column.to_pylist(), dimension, np.int64)


def _scanned(records: DataFrame, dimension: int, same: bool, k: int, kind: str) -> DataFrame:
    """``(anchor, window, block, hits)`` of records sorted by block, its rows before anchors.

    A task holds the rows of one block; anchors stream past them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, block = None, [], None
        for batch in batches:
            ids, labels = batch.column("id").to_pylist(), batch.column("label").to_pylist()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            windows = batch.column("windows").to_pylist()
            blocks = batch.column("block").to_numpy(zero_copy_only=False)
            vectors = _whole(batch.column("v"), dimension)
            out: list[list] = [[], [], [], []]
            cuts = np.flatnonzero(np.diff(blocks) != 0) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(blocks)], strict=True):
                if blocks[begin] != at:
                    at, parts, block = blocks[begin], [], None
                first = begin + int(np.searchsorted(asks[begin:end], 1))
                if first > begin:
                    parts.append((ids[begin:first], labels[begin:first], vectors[begin:first]))
                if first < end and block is None and parts:
                    block = Block(
                        np.array([i for p in parts for i in p[0]]),
                        np.array([x for p in parts for x in p[1]]),
                        np.concatenate([p[2] for p in parts]),
                    )
                    parts = []
                for row in range(first, end) if block is not None else ():
                    own = block.labels == labels[row]
                    alive = own & (block.ids != ids[row]) if same else ~own
                    asked = [(w["least"], w["most"]) for w in windows[row]]
                    hits = scan(block, vectors[row], alive, asked, k)
                    for w, found in enumerate(hits):
                        if found:
                            out[0].append(ids[row])
                            out[1].append(w)
                            out[2].append(int(at))
                            out[3].append([{"neg": n, "id": i} for n, i in found])
            if out[0]:
                id_type = batch.column("id").type
                hit = pa.list_(pa.struct([("neg", pa.int64()), ("id", id_type)]))
                types = (id_type, pa.int32(), pa.int64(), hit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(out, types, strict=True)],
                    ["anchor", "window", "block", "hits"],
                )

    return records.mapInArrow(
        run, f"anchor {kind}, window int, block long, hits array<struct<neg: long, id: {kind}>>"
    )


def _records(rows: DataFrame, asks: DataFrame) -> DataFrame:
    """Rows of blocks and the anchors sent to them, sorted so that a block's rows lead."""
    none = F.lit(None).cast("array<struct<least: long, most: long>>")
    both = rows.select("block", F.lit(0).alias("asks"), "id", "label", "v", none.alias("windows")).unionByName(
        asks.select("block", F.lit(1).alias("asks"), "id", "label", "v", "windows")
    )
    return both.repartition("block").sortWithinPartitions("block", "asks")


def _blocks(label_count: int | None, rows: int) -> int:
    return max(1, -(-int(label_count or 0) // rows))


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 10,
    least_percent: int = 30,
    most_percent: int = 90,
    key: str = "vec_id",
    vector: str = "vector",
    label: str = "label",
    block_rows: int = 16_384,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    An anchor's positives are the first ``positives`` other rows of its label by integer
    inner product, its negatives for one of them the first ``negatives`` rows of other
    labels with ``least_percent * positive <= 100 * negative <= most_percent * positive``.
    Higher scores come first, ties by smaller key. Rows of the anchor's own key are never
    its positives. Repeated rows count each; of anchors with one key the first counts.

    Rows whose key, label or vector is null, or with a null or non-finite component, take
    no part. Components are whole numbers and sums must fit 64 bits; short vectors count
    as filled with zeros. Empty tables, and anchors without positives, give no rows.

    Rows of a label are dealt out to blocks of about ``block_rows``, so that a label with
    most of the rows is many tasks; an anchor goes to the blocks of its label, then, with
    its windows, to blocks that all rows are dealt out to. Rows are shuffled once for
    each of both searches, whatever the number of anchors.
    """
    kind = vectors.schema[key].dataType.simpleString()
    good = lambda df: df.select(
        F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v")
    ).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v"), zero=True))
    whole = F.transform("v", lambda x: x.cast("long")).alias("v")
    rows = stored(good(vectors).select("id", "label", whole))
    asked = good(anchors).groupBy("id").agg(F.min(F.struct("label", whole)).alias("a"))
    asked = stored(asked.select("id", "a.label", "a.v"))
    size = rows.agg(F.max(F.size("v")), F.count("*")).first()
    longest = asked.agg(F.max(F.size("v"))).first()
    dimension = max(int(size[0] or 0), int(longest[0] or 0))
    dealt = F.xxhash64("id", F.lit(3))

    def windows(least, most):
        return F.struct(least.cast("long").alias("least"), most.cast("long").alias("most"))

    # Blocks of a label: its hash and a number below its count over the block size.
    of_label = rows.groupBy("label").agg(F.ceil(F.count("*") / block_rows).alias("blocks"))
    named = F.xxhash64("label", F.col("part")).alias("block")
    own = rows.join(of_label, "label").withColumn("part", F.pmod(dealt, "blocks"))
    sent = asked.join(of_label, "label").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    sent = sent.withColumn("windows", F.array(windows(F.lit(LOW), F.lit(HIGH))))
    found = _scanned(
        _records(own.withColumn("block", named), sent.withColumn("block", named)), dimension, True, positives, kind
    )
    # Parts of an anchor are merged by number; hashes of blocks serve as that.
    n_blocks = _blocks(size[1], block_rows)
    found = found.select("anchor", F.pmod("block", F.lit(n_blocks)).alias("block"), "hits")
    best = stored(merge_hits(found, "anchor", "block", n_blocks, positives).withColumnRenamed("anchor", "id"))

    # Bounds in decimals, where products with percents cannot overflow.
    inside = F.transform(
        "hits",
        lambda h: windows(
            F.ceil(F.negative(h["neg"]).cast("decimal(20,0)") * least_percent / 100),
            F.floor(F.negative(h["neg"]).cast("decimal(20,0)") * most_percent / 100),
        ),
    )
    with_windows = asked.join(best, "id").withColumn("windows", inside)
    everywhere = with_windows.withColumn("block", numbers(n_blocks))
    stock = rows.withColumn("block", F.pmod(dealt, F.lit(n_blocks)))
    far = _scanned(_records(stock, everywhere), dimension, False, negatives, kind)
    far = far.select(F.struct("anchor", "window").alias("pair"), "block", "hits")
    merged = merge_hits(far, "pair", "block", n_blocks, negatives)
    positive = best.select(
        F.col("id").alias("anchor"), F.posexplode("hits").alias("window", "positive")
    )
    hits = merged.select("pair.anchor", "pair.window", F.posexplode("hits").alias("rank", "hit"))
    return hits.join(positive, ["anchor", "window"]).select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive.id").alias("positive_id"),
        (F.col("rank") + 1).alias("rank"),
        F.col("hit.id").alias("negative_id"),
        F.negative("positive.neg").alias("positive_score"),
        F.negative("hit.neg").alias("negative_score"),
    )

"""Packing documents into fixed-length sequences, shortest pack first."""

from __future__ import annotations

from bisect import insort
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillrun.llm import byte_bpe
from quillrun.llm.storage import in_slices, stored, texts

PIECES = "{key} {kind}, start long, length long, doc_tokens long, ids binary"


def token_pieces(
    docs: DataFrame,
    path: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
) -> DataFrame:
    """``(key, start, length, doc_tokens, ids)``: every document cut at full sequences.

    A document is its ids and then ``end_id``; ``ids`` holds those of the piece as
    little-endian uint32 bytes. All pieces but the last are ``capacity`` long. A null or
    empty text is one piece with ``end_id`` alone; rows with the same key, null or not,
    stay documents of their own; an empty table gives no rows.
    """
    docs = texts(docs, key, text)
    schema = PIECES.format(key=key, kind=docs.schema[key].dataType.simpleString())

    def cut(batches):
        encode_all = byte_bpe.from_json(path, pattern).encode_all
        end = np.asarray([end_id], dtype="<u4").tobytes()
        for batch in in_slices(batches):
            rows, starts, lengths, totals, parts = [], [], [], [], []
            for row, encoded in enumerate(encode_all(batch.column(1).to_pylist())):
                ids = encoded + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(len(part) // 4)
                    totals.append(total)
                    parts.append(part)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array(parts, pa.binary()),
                ],
                [key, "start", "length", "doc_tokens", "ids"],
            )

    return docs.mapInArrow(cut, schema)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Packing patterns ``(count, lengths)`` for a histogram ``length -> number``.

    Lengths are placed longest first, each into the open patterns with the most room;
    what finds no room opens patterns of its own, with as many as fit. Only counts are
    updated: one step serves all packs of a pattern, so that the work follows the number
    of different lengths, not of documents. A length adds three patterns at most.
    """
    rooms: list[int] = []  # sorted, each once
    open_packs: dict[int, list[tuple[int, list[int]]]] = {}
    full: list[tuple[int, list[int]]] = []

    def keep(count: int, pattern: list[int], room: int) -> None:
        if room == 0:
            full.append((count, pattern))
            return
        if room not in open_packs:
            open_packs[room] = []
            insort(rooms, room)
        open_packs[room].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and rooms and rooms[-1] >= length:
            room = rooms[-1]
            count, pattern = open_packs[room].pop()
            if not open_packs[room]:
                del open_packs[room]
                rooms.pop()
            used = min(count, left)
            if used < count:
                keep(count - used, pattern, room)
            keep(used, [*pattern, length], room - length)
            left -= used
        fits = capacity // length
        for count, copies in ((left // fits, fits), (1, left % fits)):
            if count and copies:
                keep(count, [length] * copies, capacity - copies * length)
    return full + [entry for packs in open_packs.values() for entry in packs]


def segments(patterns: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """For each length, which ranks go to which sequences, as arrays sorted by both.

    Equal lengths of a pattern are one entry, so there are at most as many entries as
    patterns times the square root of twice the capacity.
    """
    rows, served, sequence = [], {}, 0
    for count, pattern in patterns:
        offset = 0
        for length in sorted(set(pattern)):
            copies = pattern.count(length)
            first = served.get(length, 0)
            rows.append((length, first, copies, sequence, offset))
            served[length] = first + copies * count
            offset += copies * length
        sequence += count
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "copies", "sequence", "offset"), columns, strict=True))


def pack(pieces: DataFrame, key: str = "doc_id", capacity: int = 2048) -> DataFrame:
    """Pieces with the ``sequence_id`` they go to and their ``offset`` in it.

    ``pieces`` has ``key``, ``start`` and ``length`` (1 to ``capacity``); other columns
    are carried along. The histogram of lengths (``capacity`` rows at most) is all that
    reaches the driver. Ranks within a length are made of ranks within groups of about
    the square root of all rows and of the sizes of earlier groups, so that a length
    with most of the rows is many tasks. Pieces of one length are interchangeable: ties
    fall in the order of a hash, then of key and start. No rows give no rows.
    """
    pieces = stored(pieces)
    spark = pieces.sparkSession
    histogram = {
        r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    }
    plan = segments(shortest_pack_first(histogram, capacity))
    group_rows = max(256, isqrt(sum(histogram.values())))
    groups = spark.createDataFrame(
        [(n, -(-c // group_rows)) for n, c in histogram.items()], "length long, groups_ long"
    )
    dealt = (
        pieces.join(F.broadcast(groups), "length")  # as many rows as lengths
        .withColumn("group_", F.pmod(F.xxhash64(key, "start"), "groups_"))
        .drop("groups_")
    )
    earlier = Window.partitionBy("length").orderBy("group_")
    sizes = (
        dealt.groupBy("length", "group_")
        .agg(F.count("*").alias("n"))
        .select(
            "length",
            "group_",
            F.coalesce(
                F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("before_"),
        )
    )
    inside = Window.partitionBy("length", "group_").orderBy(key, "start")
    ranked = (
        dealt.withColumn("rank_", F.row_number().over(inside).cast("long") - 1)
        .join(sizes, ["length", "group_"])
        .withColumn("rank_", F.col("rank_") + F.col("before_"))
        .drop("group_", "before_")
    )
    starts = (plan["length"] << 40) + plan["first"]

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(), rank.to_numpy()
        at = np.searchsorted(starts, (n << 40) + r, side="right") - 1
        turn = r - plan["first"][at]
        copies = plan["copies"][at]
        return pd.DataFrame(
            {
                "sequence_id": plan["sequence"][at] + turn // copies,
                "offset": plan["offset"][at] + turn % copies * n,
            }
        )

    return ranked.withColumn("place_", place("length", "rank_")).select(
        *pieces.columns, "place_.sequence_id", "place_.offset"
    )


def sequences(packed: DataFrame, capacity: int = 2048, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, n_tokens, ids)``: pieces with ids put together and padded.

    A sequence gathers at most ``capacity`` pieces; ``ids`` are little-endian uint32
    bytes of exactly ``capacity`` ids.
    """
    padding = F.unhex(F.lit(np.full(capacity, pad_id, dtype="<u4").tobytes().hex()))
    return (
        packed.groupBy("sequence_id")
        .agg(
            F.sum("length").alias("n_tokens"),
            F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"),
        )
        .select(
            "sequence_id",
            "n_tokens",
            F.substring(
                F.concat(
                    F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")),
                    padding,
                ),
                1,
                4 * capacity,
            ).alias("ids"),
        )
    )

"""Byte-level BPE encoding of whole texts in overlapping chunks, and decoding."""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrun.llm import byte_bpe
from quillrun.llm.storage import in_slices, texts

#: A contraction is the longest pre-token that its first character may turn out to be.
LONGEST_CHOICE = 4


def boundaries(text: str, pattern: regex.Pattern, low: int, high: int) -> list[int]:
    """Starts of pre-tokens between ``low`` and ``high`` that more text cannot change.

    Every pre-token is found from its start alone, looking ahead only. One that ends
    before the text ends is final, but for its last characters, which a contraction
    might need.
    """
    found, end = [], len(text)
    for match in pattern.finditer(text):
        start = match.start()
        if start > high or start > end - LONGEST_CHOICE:
            break
        if start >= low:
            found.append(start)
    return found


def _chunks(docs: DataFrame, text: str, chunk: int, overlap: int) -> DataFrame:
    """Rows ``(doc_, no, begin, part)``: chunk ``no`` starts at ``no * chunk``."""
    last = F.floor((F.length(text) - 1) / chunk).cast("int")
    return docs.select(
        "doc_", F.explode(F.sequence(F.lit(0), last)).alias("no"), F.col(text).alias("text_")
    ).select(
        "doc_",
        "no",
        (F.col("no") * chunk).alias("begin"),
        F.col("text_").substr(F.col("no") * chunk + 1, F.lit(chunk + overlap)).alias("part"),
    )


def cut_points(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``(doc_, cuts)``: places where a text can be cut between true pre-tokens.

    Each chunk is pre-tokenised alone. Where the boundaries of a chunk and of the next
    one meet inside their overlap, both go on alike from there, so the first common one
    is a true boundary, given that the earlier chunk was in step itself: cuts behind the
    first seam without a common boundary are not used.
    """

    def mark(batches):
        compiled = regex.compile(pattern)
        for batch in in_slices(batches):
            heads, tails = [], []
            for text in batch.column("part").to_pylist():
                found = boundaries(text, compiled, 0, chunk + overlap)
                heads.append([b for b in found if b <= overlap])
                tails.append([b - chunk for b in found if b >= chunk])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_"),
                    batch.column("no"),
                    pa.array(heads, pa.list_(pa.int32())),
                    pa.array(tails, pa.list_(pa.int32())),
                ],
                ["doc_", "no", "heads", "tails"],
            )

    marked = chunks.select("doc_", "no", "part").mapInArrow(
        mark, "doc_ binary, no int, heads array<int>, tails array<int>"
    )
    in_order = Window.partitionBy("doc_").orderBy("no")
    seams = marked.select(
        "doc_",
        "no",
        F.array_min(F.array_intersect("tails", F.lead("heads").over(in_order))).alias("meet"),
        F.lead("no").over(in_order).alias("next"),
    ).filter("next IS NOT NULL")
    return seams.groupBy("doc_").agg(
        F.sort_array(F.collect_list(F.struct("next", "meet"))).alias("seams")
    ).select(
        "doc_",
        F.aggregate(
            "seams",
            F.struct(F.lit(True).alias("good"), F.array().cast("array<int>").alias("cuts")),
            lambda s, x: F.struct(
                (s["good"] & x["meet"].isNotNull()).alias("good"),
                F.when(
                    s["good"] & x["meet"].isNotNull(),
                    F.concat(s["cuts"], F.array(x["next"] * chunk + x["meet"])),
                ).otherwise(s["cuts"]).alias("cuts"),
            ),
            lambda s: s["cuts"],
        ).alias("cuts"),
    )


def _joined(parts: str) -> Column:
    """Binary ``ids`` of an array of structs, in order, in one pass."""
    return F.unhex(F.array_join(F.transform(parts, lambda p: F.hex(p["ids"])), ""))


def _encoded(df: DataFrame, text: str, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """The rows with ``ids`` in place of their text, and what these decode to."""
    kept = [c for c in df.columns if c != text]
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)
    more = ["ids", "decoded"] if decoded else ["ids"]

    def run(batches):
        bpe = byte_bpe.from_tiktoken(path, pattern)
        for batch in in_slices(batches):
            ids = list(bpe.encode_all(batch.column(text).to_pylist()))
            columns = [ids, map(bpe.decode, ids)] if decoded else [ids]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(c, pa.binary()) for c in columns)],
                [*kept, *more],
            )

    return df.mapInArrow(run, ", ".join([kinds, *(f"{c} binary" for c in more)]))


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    chunk: int = 32_768,
    overlap: int = 1_024,
    decoded: bool = False,
) -> DataFrame:
    """``(key, ids)`` of every row: ids as little-endian uint32 bytes, no special ones.

    With ``decoded``, a column of that name has the raw bytes that the ids decode to.

    Texts up to a chunk are encoded where they are read. Longer ones are cut into
    chunks that overlap, pre-tokenised in parallel, stitched, and their pieces encoded
    in parallel; the pieces of a document meet only for the last step. Equal rows (key
    and text) are encoded once there and counted. A null or empty text gives no ids.
    Rows that repeat, or share a null key, keep a row each; an empty table gives no
    rows; further columns are not read.
    """
    docs = texts(docs, key, text)
    short = _encoded(docs.filter(F.length(text) <= chunk), text, path, pattern, decoded)
    name = F.coalesce(F.concat(F.lit("+"), F.col(key).cast("string")), F.lit("-"))
    long = (
        docs.filter(F.length(text) > chunk)
        .groupBy(F.unhex(F.sha2(F.concat(name, F.lit(" "), F.col(text)), 256)).alias("doc_"))
        .agg(
            F.first(key).alias(key), F.first(text).alias(text), F.count("*").alias("copies")
        )
    )
    chunks = _chunks(long, text, chunk, overlap).repartition("doc_", "no")
    starts = F.concat(F.array(F.lit(0)), F.coalesce("cuts", F.array().cast("array<int>")))
    pieces = (
        long.join(cut_points(chunks, pattern, chunk, overlap), "doc_", "left")
        .select("doc_", text, starts.alias("starts"))
        .select("doc_", text, "starts", F.posexplode("starts").alias("no", "begin"))
        .select(
            "doc_",
            "no",
            F.col(text)
            .substr(
                F.col("begin") + 1,
                F.coalesce(F.get("starts", F.col("no") + 1), F.length(text)) - F.col("begin"),
            )
            .alias("piece"),
        )
        .repartition("doc_", "no")
    )
    whole = (
        _encoded(pieces, "piece", path, pattern)
        .groupBy("doc_")
        .agg(F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("parts"))
        .select("doc_", _joined("parts").alias("ids"))
    )
    rows = (
        long.select("doc_", key, "copies")
        .join(whole, "doc_")
        .select(key, "ids", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    )
    long_rows = rows.select(key, "ids")
    if decoded:
        long_rows = decode(long_rows, path, pattern)
    return short.unionByName(long_rows)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with the raw bytes of their ids put together; null ids give null."""

    def run(batches):
        read = byte_bpe.from_tiktoken(path, pattern).decode
        for batch in in_slices(batches):
            values = batch.column(ids).to_pylist()
            bytes_ = pa.array([None if v is None else read(v) for v in values], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, bytes_], [*batch.schema.names, out])

    kinds = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return df.mapInArrow(run, f"{kinds}, `{out}` binary")

"""Repeated lines across documents, in DataFrame functions.

Keys of lines are cut into ranges, sorted inside a range by key, then document and
position, and read as a stream: the first documents of a key decide about all others. The
answer is a bitmap of kept lines for each document; no text is shuffled to find it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrun.llm.storage import stored, texts

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STRIPPED = " \t\n\x0b\x0c\r"
#: Rows of one key are dealt out to so many ranges at least, whatever the key.
SLICES = 64
#: Lines of a bitmap word.
WORD = 64


def line_key(line: Column) -> Column:
    """White space (ASCII) stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER)


def _version(text: str) -> Column:
    """Tells texts of one key apart, so that rows are found again."""
    return F.xxhash64(F.lit(7), F.col(text))


def lines_of(docs: DataFrame, key: str, text: str, least_chars: int) -> DataFrame:
    """``(high, low, slice, doc, version, pos)`` of every line that is long enough.

    A key is known by two hashes of 64 bits. Slices are dealt by row, not by what it
    holds, so that neither a frequent line nor a repeated document stays in one place.
    """
    row = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SLICES)).cast("int")
    lines = docs.select(
        F.col(key).alias("doc"),
        _version(text).alias("version"),
        row.alias("slice"),
        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"),
    ).filter(F.col("doc").isNotNull() & (F.length("line") >= least_chars))
    keyed = lines.withColumn("line", line_key(F.col("line")))
    return keyed.filter(F.length("line") >= least_chars).select(
        F.xxhash64("line").alias("high"),
        F.xxhash64(F.lit(1), "line").alias("low"),
        "slice",
        "doc",
        "version",
        "pos",
    )


def keep_bitmaps(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_chars: int = 20,
    least_docs: int = 3,
) -> DataFrame:
    """``(key, version, keep)`` of every text that loses lines, once for equal rows.

    A line whose key has at least ``least_chars`` code points and is found in at least
    ``least_docs`` documents is dropped, except from the document with the largest
    ``key``, which keeps all its lines of that key. ``keep`` is a compressed bitmap:
    ``(word, bits)`` by word, a bit for each of 64 lines, words of kept lines alone left
    out. Texts without dropped lines have no row.

    Null and empty texts are one empty line, which is kept. Rows with a null key are no
    documents: they neither lose lines nor count. Rows with one key are one document.
    Empty tables give no rows. Other columns play no part.
    """
    docs = texts(docs, key, text)
    at = ("high", "low", "slice")
    sorted_ = (
        lines_of(docs, key, text, least_chars)
        .repartitionByRange(*at)
        .sortWithinPartitions(*at, F.desc("doc"), "pos")
    )
    # The stream of a slice: which rows are the first of their document, of which document.
    stream = Window.partitionBy(*at).orderBy(F.desc("doc"), "pos")
    before = F.lag("doc").over(stream)
    marked = sorted_.withColumn("new", (before.isNull() | (before != F.col("doc"))).cast("int"))
    read = stored(
        marked.withColumn("nth", F.sum("new").over(stream.rowsBetween(Window.unboundedPreceding, 0)))
    )
    heads = read.filter((F.col("new") == 1) & (F.col("nth") <= least_docs))
    # Of each slice the first documents are enough, for the count and for the largest.
    common = (
        heads.groupBy("high", "low")
        .agg(
            F.collect_set("doc").alias("docs"),
            F.collect_set("slice").alias("slices"),
        )
        .filter(F.size("docs") >= least_docs)
        .select("high", "low", F.array_max("docs").alias("keeper"), F.explode("slices").alias("slice"))
    )
    dropped = read.join(common, list(at)).filter("doc < keeper")
    words = (
        dropped.groupBy("doc", "version", F.floor(F.col("pos") / WORD).cast("int").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, pos % {WORD})")).alias("bits"))
        .groupBy("doc", "version")
        .agg(F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("keep"))
    )
    return words.withColumnRenamed("doc", key)


def kept_lines(lines: Column, keep: Column) -> Column:
    """The lines whose bit is set; all of them where there is no bitmap."""
    known = F.map_from_entries(keep)
    all_ = F.lit(-1).cast("long")
    bit = lambda bits, k: F.call_function("shiftright", bits, k).bitwiseAND(F.lit(1))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / WORD).cast("int")),
        lambda w: F.struct(
            F.coalesce(F.try_element_at(known, w), all_).alias("bits"),
            F.slice(lines, w * WORD + 1, F.lit(WORD)).alias("lines"),
        ),
    )
    left = F.transform(
        blocks, lambda b: F.filter(b["lines"], lambda _, k: bit(b["bits"], k) == 1)
    )
    return F.when(keep.isNull(), lines).otherwise(F.flatten(left))


def n_dropped(keep: Column) -> Column:
    """How many lines a bitmap leaves out."""
    return F.coalesce(
        F.aggregate(
            keep, F.lit(0).cast("long"), lambda s, w: s + F.bit_count(F.bitwise_not(w["bits"]))
        ),
        F.lit(0).cast("long"),
    )


def without_repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", **bounds: int
) -> DataFrame:
    """``(key, n_lines, n_dropped, text)`` of every row; bounds as in `keep_bitmaps`.

    Each text is joined with its bitmap and keeps its other lines, joined by line ends.
    """
    found = keep_bitmaps(docs, key, text, **bounds)
    rows = texts(docs, key, text).withColumn("version", _version(text))
    lines = F.split(text, "\n", -1)
    return rows.join(found, [key, "version"], "left").select(
        key,
        F.size(lines).cast("long").alias("n_lines"),
        n_dropped(F.col("keep")).alias("n_dropped"),
        F.array_join(kept_lines(lines, F.col("keep")), "\n").alias(text),
    )

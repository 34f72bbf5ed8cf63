"""Vocabularies and token tables for training.

Texts are taken apart and cut where they are read; what crosses the network are the
tokens that are kept, spread by text and window. All later steps of a window (join to a
vocabulary, put together again) then stay in its partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrun.functions import text as tx

# The ids before the vocabulary, and the target that a loss ignores.
PAD_ID = 0
UNKNOWN_ID = 1
FIRST_TERM_ID = 2
IGNORE_ID = -100


def fit_vocab(
    texts: DataFrame,
    text: str,
    max_features: int = 20_000,
    ngrams: tuple[int, int] = (1, 1),
) -> DataFrame:
    """The most frequent terms ``(term, term_id, n)``, ids by term.

    Counts are combined on the map side, so a frequent term costs one row per task.
    The ids need one ordered pass over at most ``max_features`` rows.
    """
    counts = (
        texts.select(F.explode(tx.terms(F.col(text), ngrams)).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    kept = counts.orderBy(F.desc("n"), "term").limit(max_features)
    place = F.row_number().over(Window.orderBy("term")) - 1
    return kept.select("term", (place + FIRST_TERM_ID).cast("int").alias("term_id"), "n")


def _looked_up(tokens: DataFrame, vocab: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, input_ids)`` of rows ``(keys, tokens)``; unknown terms get their own id."""
    exploded = tokens.repartition(*keys).select(
        *keys, F.posexplode_outer("tokens").alias("pos", "term")
    )
    found = exploded.join(vocab.select("term", "term_id"), "term", "left").withColumn(
        "term_id", F.coalesce("term_id", F.lit(UNKNOWN_ID))
    )
    pairs = F.sort_array(
        F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "term_id")))
    )
    return found.groupBy(*keys).agg(F.transform(pairs, lambda p: p["term_id"]).alias("input_ids"))


def encode_variable(
    texts: DataFrame, vocab: DataFrame, key: str, text: str, max_len: int | None = None
) -> DataFrame:
    """Token ids ``(key, input_ids)`` in text order, without padding.

    ``max_len`` cuts the tokens before anything is shuffled. Texts without a word keep
    an empty array. Whether the vocabulary is broadcast is left to the optimizer, which
    knows the row limit it was fitted with.
    """
    tokens = tx.words(F.col(text))
    if max_len is not None:
        tokens = F.slice(tokens, 1, max_len)
    return _looked_up(texts.select(key, tokens.alias("tokens")), vocab, [key])


def encode_windows(
    texts: DataFrame, vocab: DataFrame, key: str, text: str, max_len: int, overlap: int = 0
) -> DataFrame:
    """``(key, chunk, input_ids, attention_mask)``: whole texts as padded windows.

    A window starts every ``max_len`` tokens and holds ``overlap`` tokens of the next
    one as well, so that with an overlap of one every token but a text's last has its
    successor in the same window. A text without a word is one empty window.
    """
    tokens = texts.select(key, tx.words(F.col(text)).alias("_all"))
    last = F.greatest(F.ceil((F.size("_all") - overlap) / max_len), F.lit(1)) - 1
    cut = tokens.select(key, "_all", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("chunk"))
    windows = cut.select(
        key,
        "chunk",
        F.slice("_all", F.col("chunk") * max_len + 1, F.lit(max_len + overlap)).alias("tokens"),
    )
    return pad_ids(_looked_up(windows, vocab, [key, "chunk"]), max_len + overlap)


def pad_ids(encoded: DataFrame, max_len: int, pad_id: int = PAD_ID) -> DataFrame:
    """Pad on the right to ``max_len`` and add the attention mask."""
    n = F.size("input_ids")
    padding = F.array_repeat(F.lit(pad_id), F.lit(max_len) - n)
    mask = F.concat(
        F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(max_len) - n)
    )
    return encoded.withColumns(
        {"input_ids": F.concat("input_ids", padding), "attention_mask": mask}
    )


def encode(
    texts: DataFrame,
    vocab: DataFrame,
    key: str,
    text: str,
    max_len: int,
    pad_id: int = PAD_ID,
) -> DataFrame:
    """Fixed-length token table ``(key, input_ids, attention_mask)``, longer texts cut."""
    return pad_ids(encode_variable(texts, vocab, key, text, max_len), max_len, pad_id)


def is_encoded(df: DataFrame) -> bool:
    """True for a table that already holds token ids and a mask."""
    return {"input_ids", "attention_mask"} <= set(df.columns)


def real_tokens(mask: Column) -> Column:
    """Number of real tokens under a mask."""
    return F.size(F.filter(mask, lambda m: m == 1))


def causal_pairs(encoded: DataFrame, *keys: str) -> DataFrame:
    """Rows ``(keys, pos, token, target)``: each real token with the one after it."""
    n = real_tokens(F.col("attention_mask"))
    count = F.greatest(n - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice("input_ids", F.lit(1), count),
        F.slice("input_ids", F.lit(2), count),
        lambda a, b: F.struct(a.alias("token"), b.alias("target")),
    )
    return encoded.select(*keys, F.posexplode(pairs).alias("pos", "pair")).select(
        *keys, "pos", "pair.token", "pair.target"
    )


def position_ids(encoded: DataFrame, *keys: str, mask: str = "attention_mask") -> DataFrame:
    """Running sum of a mask minus one, not below zero: ``(keys, position_ids)``.

    Works for any mask, in the row itself.
    """
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))

    def step(state: Column, m: Column) -> Column:
        total = (state["sum"] + m).cast("int")
        place = F.greatest(total - 1, F.lit(0))
        return F.struct(total.alias("sum"), F.concat(state["out"], F.array(place)).alias("out"))

    placed = F.aggregate(mask, start, step, lambda s: s["out"])
    return encoded.select(*keys, placed.alias("position_ids"))


def word_account(texts: DataFrame, text: str, max_len: int, new_tokens: int = 16) -> DataFrame:
    """``token_account`` of the windows of whole texts, from word counts alone."""
    n = F.size(tx.words(F.coalesce(F.col(text), F.lit(""))))
    windows = F.greatest(F.ceil(n / max_len), F.lit(1))
    counted = texts.select(n.alias("n"), windows.alias("windows"))
    real = F.coalesce(F.sum("n"), F.lit(0)).cast("long")
    rows = F.coalesce(F.sum("windows"), F.lit(0)).cast("long")
    return counted.agg(
        rows.alias("n_rows"),
        real.alias("real_tokens"),
        (rows * max_len).alias("padded_tokens"),
        (real + rows * new_tokens).alias("with_generated"),
    )


def token_account(encoded: DataFrame, new_tokens: int = 16) -> DataFrame:
    """One row: texts, real tokens, padded tokens, input plus generated tokens."""
    real = F.sum(real_tokens(F.col("attention_mask")))
    n_rows = F.count(F.lit(1))
    return encoded.agg(
        n_rows.alias("n_rows"),
        F.coalesce(real, F.lit(0)).cast("long").alias("real_tokens"),
        F.coalesce(F.sum(F.size("input_ids")), F.lit(0)).cast("long").alias("padded_tokens"),
        (F.coalesce(real, F.lit(0)) + n_rows * new_tokens).cast("long").alias("with_generated"),
    )

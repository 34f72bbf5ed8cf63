"""Registered queries over texts: scans, slices, shards, encodings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrun.functions import arrays, text as tx
from quillrun.operators import encoding, shards, slices
from quillrun.operators.positions import with_row_index
from quillrun.plans.catalog import registry
from quillrun.sources.tables import labeled_texts, table

MAX_LEN = 128
VOCAB = 20_000
SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}

QUERIES, ORACLES, register = registry()


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    """Document texts for costly work on each row."""
    return _docs(spark, folder).select("doc_id", "text")


def _digest(tokens) -> list:
    """Length, distinct count and hash of a token array: one short row per text."""
    return [
        F.size(tokens).cast("long").alias("n_tokens"),
        F.size(F.array_distinct(tokens)).cast("long").alias("n_distinct"),
        F.md5(F.array_join(tokens, " ").cast("binary")).alias("digest"),
    ]


@register(
    "q_01_labeled_scan",
    "SELECT d.doc_id AS id, d.text AS text, l.quality AS label "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def labeled_scan(spark, folder):
    return labeled_texts(
        _docs(spark, folder), table(spark, folder, "labels"), "doc_id", "text", "quality"
    )


SQL_LINES = r"""
lines AS (
  SELECT key, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS line_no
  FROM (SELECT key, string_split_regex(regexp_replace(text, '(\r\n|\r|\n)\z', ''),
                                       '\r\n|\r|\n') AS parts
        FROM src WHERE length(text) > 0)
)
"""


@register(
    "q_02_line_scan",
    f"WITH src AS (SELECT doc_id AS key, text FROM documents), {SQL_LINES} "
    "SELECT key AS doc_id, line_no::BIGINT AS line_no, line FROM lines",
)
def line_scan(spark, folder):
    lines = slices.explode_lines(_texts(spark, folder), "text")
    return lines.withColumn("line_no", F.col("line_no").cast("long"))


@register(
    "q_04_query_lines",
    f"WITH src AS (SELECT item_id AS key, text FROM benchmark), {SQL_LINES}, "
    "kept AS (SELECT key, line_no, trim(line) AS line FROM lines WHERE trim(line) <> '') "
    "SELECT row_number() OVER (ORDER BY key, line_no) - 1 AS query_id, key AS item_id, "
    "line AS question FROM kept",
)
def query_lines(spark, folder):
    source = table(spark, folder, "benchmark").select("item_id", "text")
    kept = slices.query_lines(source, "text")
    return with_row_index(kept, ["item_id", "line_no"], "query_id").select(
        "query_id", "item_id", F.col("line").alias("question")
    )


@register(
    "q_11_columns",
    "SELECT doc_id AS id, text, lang AS label FROM documents",
)
def columns(spark, folder):
    kept = slices.keep_columns(_docs(spark, folder), ["doc_id", "text", "lang"], others=True)
    lean = slices.drop_columns(kept, ["source", "n_chars"])
    return slices.rename_columns(lean, {"doc_id": "id", "lang": "label"})


@register(
    "q_12_passage_text",
    "SELECT doc_id, trim(concat(coalesce(source, ''), ' - ', text), ' -') AS passage "
    "FROM documents",
)
def passage_text(spark, folder):
    return _docs(spark, folder).select(
        "doc_id", tx.passage_text(F.col("source"), F.col("text")).alias("passage")
    )


@register(
    "q_13_first_rows",
    "SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT 64",
)
def first_rows(spark, folder):
    return slices.head_n(_docs(spark, folder).select("doc_id", "lang", "text"), 64, "doc_id")


@register(
    "q_13b_dry_run_rows",
    "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 2000",
)
def dry_run_rows(spark, folder):
    return slices.dry_run_head(_docs(spark, folder).select("doc_id", "lang"), 5000, "doc_id")


@register(
    "q_14_row_index",
    "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM documents",
)
def row_index(spark, folder):
    return with_row_index(_docs(spark, folder).select("doc_id"), "doc_id")


@register(
    "q_14b_event_order",
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM events",
)
def event_order(spark, folder):
    events = table(spark, folder, "events").select("ts", "event_id")
    return with_row_index(events, ["ts", "event_id"]).select("event_id", "row_index")


SQL_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
SQL_SPACE_TOKENS = (
    r"list_filter(string_split(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), ' '), "
    r"lambda t: t <> '')"
)


@register(
    "q_15_non_empty",
    f"SELECT doc_id, len({SQL_WORDS})::BIGINT AS n_words FROM documents "
    f"WHERE len({SQL_WORDS}) > 0",
)
def non_empty(spark, folder):
    counted = _texts(spark, folder).select("doc_id", tx.words(F.col("text")).alias("words"))
    return slices.non_empty(counted, F.col("words")).select(
        "doc_id", F.size("words").cast("long").alias("n_words")
    )


QUALITY_NAMES = ["low", "high"]
TOXIC_NAMES = ["clean", "toxic"]


@register(
    "q_16_class_names",
    "SELECT doc_id, (['low', 'high'])[quality + 1] AS gold, "
    "(['clean', 'toxic'])[toxic + 1] AS pred FROM labels",
)
def class_names(spark, folder):
    return table(spark, folder, "labels").select(
        "doc_id",
        arrays.class_name(F.col("quality"), QUALITY_NAMES).alias("gold"),
        arrays.class_name(F.col("toxic"), TOXIC_NAMES).alias("pred"),
    )


@register(
    "q_16b_class_table",
    "SELECT s_suppkey, n_name AS class_name FROM supplier "
    "LEFT JOIN nation ON s_nationkey = n_nationkey",
)
def class_table(spark, folder):
    classes = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("class_id"), F.col("n_name").alias("class_name")
    )
    suppliers = table(spark, folder, "supplier")
    return slices.decode_classes(suppliers, classes, "s_nationkey", "class_name").select(
        "s_suppkey", "class_name"
    )


@register(
    "q_17_preview",
    "SELECT doc_id, concat(replace(substring(text, 1, 80), chr(10), ' '), ' ...') AS preview "
    "FROM documents",
)
def preview(spark, folder):
    return _docs(spark, folder).select("doc_id", tx.preview(F.col("text")).alias("preview"))


@register(
    "q_18_sample",
    "SELECT doc_id, lang FROM documents ORDER BY md5(concat('42:', doc_id)), doc_id LIMIT 3",
)
def sample(spark, folder):
    return slices.sample_n(_docs(spark, folder).select("doc_id", "lang"), 3, "doc_id")


@register(
    "q_19_repeat",
    "SELECT item_id, text, copy_no::BIGINT AS copy_no FROM benchmark, range(1, 5) r(copy_no)",
)
def repeat(spark, folder):
    return slices.repeat_rows(table(spark, folder, "benchmark"), 4).withColumn(
        "copy_no", F.col("copy_no").cast("long")
    )


@register(
    "q_20_strided_shard",
    "SELECT doc_id, i AS row_index, i % 8 AS shard FROM "
    "(SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)",
)
def strided_shard(spark, folder):
    sharded = shards.shard_strided(_docs(spark, folder).select("doc_id"), "doc_id", 8)
    return sharded.withColumn("shard", F.col("shard").cast("long"))


@register(
    "q_21_contiguous_shard",
    "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index, "
    "ntile(7) OVER (ORDER BY doc_id) - 1 AS shard FROM documents",
)
def contiguous_shard(spark, folder):
    sharded = shards.shard_contiguous(_docs(spark, folder).select("doc_id"), "doc_id", 7)
    return sharded.withColumn("shard", F.col("shard").cast("long"))


@register(
    "q_22_batches",
    "SELECT doc_id, i // 16 AS batch_id, i % 16 AS pos_in_batch FROM "
    "(SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)",
)
def batches(spark, folder):
    batched = shards.assign_batches(_docs(spark, folder).select("doc_id"), "doc_id", 16)
    return batched.withColumn("pos_in_batch", F.col("pos_in_batch").cast("long"))


@register(
    "q_22b_full_batches",
    "SELECT doc_id, i // 48 AS batch_id, i % 48 AS pos_in_batch FROM "
    "(SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) "
    "QUALIFY count(*) OVER (PARTITION BY i // 48) = 48",
)
def full_batches(spark, folder):
    batched = shards.assign_batches(
        _docs(spark, folder).select("doc_id"), "doc_id", 48, drop_last=True
    )
    return batched.withColumn("pos_in_batch", F.col("pos_in_batch").cast("long"))


@register(
    "q_23_step_plan",
    "SELECT count(*) AS n_rows, 64::BIGINT AS global_batch, "
    "ceil(count(*) / 64.0)::BIGINT AS steps_per_epoch, "
    "(3 * ceil(count(*) / 64.0))::BIGINT AS total_steps FROM documents",
)
def step_plan(spark, folder):
    return shards.step_plan(_docs(spark, folder), 8, 2, accumulation=4, epochs=3)


@register(
    "q_24_split",
    "SELECT doc_id, CASE WHEN h < 'cccd' THEN 'train' WHEN h < 'e666' THEN 'validation' "
    "ELSE 'test' END AS split FROM "
    "(SELECT doc_id, substring(md5(doc_id::VARCHAR), 1, 4) AS h FROM documents)",
)
def split(spark, folder):
    return shards.split_rows(_docs(spark, folder).select("doc_id"), "doc_id", SHARES)


@register(
    "q_25_normalize",
    r"SELECT doc_id, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS norm_text "
    "FROM documents",
)
def normalize(spark, folder):
    return _texts(spark, folder).select("doc_id", tx.normalize(F.col("text")).alias("norm_text"))


def _digest_sql(tokens: str, source: str = "documents", key: str = "doc_id") -> str:
    return (
        f"SELECT {key}, len(t)::BIGINT AS n_tokens, len(list_distinct(t))::BIGINT AS n_distinct, "
        f"md5(array_to_string(t, ' ')) AS digest FROM (SELECT {key}, {tokens} AS t FROM {source})"
    )


@register("q_26a_space_tokens", _digest_sql(SQL_SPACE_TOKENS))
def space_tokens(spark, folder):
    return _texts(spark, folder).select("doc_id", *_digest(tx.space_tokens(F.col("text"))))


@register("q_26b_words", _digest_sql(SQL_WORDS))
def words(spark, folder):
    return _texts(spark, folder).select("doc_id", *_digest(tx.words(F.col("text"))))


SQL_VOCAB = f"""
vocab AS (
  SELECT term, row_number() OVER (ORDER BY term) + 1 AS term_id, n FROM (
    SELECT term, count(*) AS n FROM (SELECT unnest({SQL_WORDS}) AS term FROM documents)
    GROUP BY term ORDER BY n DESC, term LIMIT {VOCAB})
)
"""


def _vocab(spark, folder) -> DataFrame:
    return encoding.fit_vocab(_texts(spark, folder), "text", VOCAB)


@register(
    "q_27_vocab",
    f"WITH {SQL_VOCAB} SELECT term, term_id::BIGINT AS term_id, n FROM vocab",
)
def vocab(spark, folder):
    return _vocab(spark, folder).withColumn("term_id", F.col("term_id").cast("long"))


def _ids_sql(source: str, key: str, cap: str = "") -> str:
    """Token ids of each text of a table, in order, unknown words as 1."""
    return f"""
tokens AS (
  SELECT {key}, unnest(w) AS term, generate_subscripts(w, 1) - 1 AS pos
  FROM (SELECT {key}, {SQL_WORDS}{cap} AS w FROM {source})
),
ids AS (
  SELECT {key}, pos, coalesce(term_id, 1) AS id FROM tokens LEFT JOIN vocab USING (term)
),
encoded AS (
  SELECT {key}, coalesce(n, 0) AS n, coalesce(ids, '') AS ids FROM {source} LEFT JOIN (
    SELECT {key}, count(*) AS n, string_agg(id::VARCHAR, ' ' ORDER BY pos) AS ids
    FROM ids GROUP BY {key}) USING ({key})
)
"""


def _encoded(spark, folder) -> DataFrame:
    return encoding.encode(
        _docs(spark, folder), _vocab(spark, folder), "doc_id", "text", MAX_LEN
    )


def _joined(column: str):
    return F.array_join(F.col(column).cast("array<string>"), " ").alias(column)


@register(
    "q_28_encode",
    f"WITH {SQL_VOCAB}, {_ids_sql('documents', 'doc_id', f'[:{MAX_LEN}]')} "
    f"SELECT doc_id, trim(concat(ids, repeat(' 0', {MAX_LEN} - n))) AS input_ids, "
    f"trim(concat(repeat(' 1', n), repeat(' 0', {MAX_LEN} - n))) AS attention_mask FROM encoded",
)
def encode(spark, folder):
    return _encoded(spark, folder).select(
        "doc_id", _joined("input_ids"), _joined("attention_mask")
    )


@register(
    "q_29_encode_variable",
    f"WITH {SQL_VOCAB}, {_ids_sql('benchmark', 'item_id')} "
    "SELECT item_id, n AS n_tokens, ids AS input_ids FROM encoded",
)
def encode_variable(spark, folder):
    encoded = encoding.encode_variable(
        table(spark, folder, "benchmark"),
        _vocab(spark, folder),
        "item_id",
        "text",
    )
    return encoded.select(
        "item_id", F.size("input_ids").cast("long").alias("n_tokens"), _joined("input_ids")
    )


SQL_TARGETS = (
    f"WITH {SQL_VOCAB}, {_ids_sql('documents', 'doc_id')}, targets AS (SELECT * FROM (SELECT doc_id, "
    "pos, id AS token, lead(id) OVER (PARTITION BY doc_id ORDER BY pos) AS target FROM ids) "
    "WHERE target IS NOT NULL) "
)


def _windows(spark, folder, overlap: int = 0) -> DataFrame:
    return encoding.encode_windows(
        _docs(spark, folder), _vocab(spark, folder), "doc_id", "text", MAX_LEN, overlap
    )


@register("q_30_causal_pairs", SQL_TARGETS + "SELECT doc_id, pos, token, target FROM targets")
def causal_pairs(spark, folder):
    pairs = encoding.causal_pairs(_windows(spark, folder, 1), "doc_id", "chunk")
    place = F.col("chunk") * MAX_LEN + F.col("pos")
    return pairs.withColumn("pos", place).select(
        "doc_id", *[F.col(c).cast("long") for c in ("pos", "token", "target")]
    )


@register(
    "q_30b_causal_labels",
    SQL_TARGETS
    + f", chunks AS (SELECT doc_id, pos // {MAX_LEN} AS chunk, count(*) AS m, "
    "string_agg(target::VARCHAR, ' ' ORDER BY pos) AS t FROM targets GROUP BY ALL) "
    "SELECT doc_id, coalesce(chunk, 0)::BIGINT AS chunk, trim(concat(coalesce(t, ''), "
    f"repeat(' -100', {MAX_LEN} - coalesce(m, 0)))) AS labels "
    "FROM documents LEFT JOIN chunks USING (doc_id)",
)
def causal_labels(spark, folder):
    n_real = encoding.real_tokens(F.col("attention_mask"))
    labels = arrays.next_token_labels(F.col("input_ids"), n_real, encoding.IGNORE_ID)
    return (
        _windows(spark, folder, 1)
        .withColumn("labels", F.slice(labels, 1, MAX_LEN))
        .select("doc_id", F.col("chunk").cast("long"), _joined("labels"))
    )


SQL_WINDOWS = (
    f"SELECT doc_id, n, unnest(range(greatest(1, ceil(n / {MAX_LEN}))::BIGINT)) AS chunk "
    f"FROM (SELECT doc_id, len({SQL_WORDS}) AS n FROM documents)"
)


@register(
    "q_31_position_ids",
    f"SELECT doc_id, chunk, array_to_string(list_transform(range({MAX_LEN}), lambda i: "
    f"greatest(least(i, least({MAX_LEN}, n - chunk * {MAX_LEN}) - 1), 0)), ' ') AS position_ids "
    f"FROM ({SQL_WINDOWS})",
)
def position_ids(spark, folder):
    placed = encoding.position_ids(_windows(spark, folder), "doc_id", "chunk")
    return placed.select("doc_id", F.col("chunk").cast("long"), _joined("position_ids"))


@register(
    "q_32_token_account",
    f"SELECT count(*) AS n_rows, sum(least({MAX_LEN}, n - chunk * {MAX_LEN}))::BIGINT AS "
    f"real_tokens, (count(*) * {MAX_LEN})::BIGINT AS padded_tokens, (sum(least({MAX_LEN}, "
    f"n - chunk * {MAX_LEN})) + count(*) * 16)::BIGINT AS with_generated FROM ({SQL_WINDOWS})",
)
def token_account(spark, folder):
    return encoding.word_account(_docs(spark, folder), "text", MAX_LEN, new_tokens=16)


SQL_TERMS = (
    "list_concat(w, list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])))"
)


@register(
    "q_33_ngrams",
    _digest_sql(SQL_TERMS, f"(SELECT doc_id, {SQL_WORDS} AS w FROM documents)"),
)
def ngrams(spark, folder):
    return _texts(spark, folder).select("doc_id", *_digest(tx.terms(F.col("text"))))

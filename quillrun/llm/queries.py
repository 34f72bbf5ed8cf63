"""Registered queries of the operators for training data."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from quillrun.llm import (
    bpe_codec,
    chat,
    collocations,
    hard_negatives,
    hits,
    line_dedup,
    near_dup,
    packing,
    pages,
    permutation_index,
    pivot_search,
    quality,
    secrets,
    token_counts,
)
from quillrun.sources.tables import table

QUERIES: dict = {}
ORACLES: dict = {}
SEQUENCE = 2048
QUALITY_BAR = 0.3


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


@register("op1_packing")
def packed_documents(spark, folder):
    pieces = packing.token_pieces(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        capacity=SEQUENCE,
    )
    light = pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return packing.pack(light, capacity=SEQUENCE)


@register("op3_token_counts")
def token_count_report(spark, folder):
    return token_counts.token_counts(
        table(spark, folder, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        limit=SEQUENCE,
    )


@register("op8_bpe_codec")
def encoded_documents(spark, folder):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = bpe_codec.encode(
        table(spark, folder, "documents"), path, public_tokenizers.PATTERN, decoded=True
    )
    return both.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register("op4_secret_scan")
def secret_scan(spark, folder):
    found = secrets.find_secrets(table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS),
        F.sha2(secrets.written("base"), 256).alias("base_sha256"),
        secrets.written("spans").alias("spans"),
    )


@register("op6_near_duplicates")
def near_duplicate_documents(spark, folder):
    return near_dup.near_duplicates(table(spark, folder, "documents"), words=4, percent=80)


def _extra_conversation(spark):
    """Conversation -7, whose texts hold control strings of other templates."""
    return spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )


@register("op9_chat_windows")
def chat_window_digests(spark, folder):
    said = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    back = chat.read_back(chat.chat_windows(said.unionByName(_extra_conversation(spark))))
    turns = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@register("op10_quality")
def quality_scores(spark, folder):
    """Learned from labelled documents whose remainder is not 0, applied to all."""
    fold = lambda: F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels").filter(fold() != 0))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_BAR).cast("int").alias("predicted"),
    )


@register("op7_page_text")
def page_text(spark, folder):
    return pages.main_text(table(spark, folder, "pages")).withColumn(
        "n_chars", F.length("text").cast("long")
    )


def _whole_vectors(rows):
    """Components as whole numbers; a vector with one that is not finite is null."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * 256)
    floors = F.transform("scaled", lambda x: F.floor(x).cast("double"))
    return rows.withColumn("scaled", scaled).select(
        *(c for c in rows.columns if c != "embedding"),
        F.when(hits.usable(F.col("scaled"), zero=True), floors).alias("vector"),
    )


#: Usable vectors as lists of whole numbers, for twins.
WHOLE_VECTORS = """
    SELECT vec_id, label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
"""


@register(
    "op2_exact_top_k",
    f"""
    WITH v AS ({WHOLE_VECTORS}),
    scored AS (
        SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.v, v.v)::BIGINT AS score
        FROM v AS q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
    ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
        FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def exact_neighbours(spark, folder):
    whole = _whole_vectors(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return pivot_search.exact_top_k(whole, whole.filter("vec_id % 50 = 0"), k=5)


@register("op5_permutation_index")
def near_neighbours(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return permutation_index.nearest_by_permutation(rows, rows.filter("vec_id % 20 = 0"), k=20)


@register(
    "op13_line_dedup",
    """
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    lines AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS pos
        FROM docs),
    keyed AS (
        SELECT *, translate(
            trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM lines),
    repeated AS (
        SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    marked AS (
        SELECT doc_id, pos, line, coalesce(doc_id < keeper, false) AS dropped
        FROM keyed LEFT JOIN repeated USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), ''))
               AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def documents_without_repeated_lines(spark, folder):
    cleaned = line_dedup.without_repeated_lines(table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@register(
    "op12_hard_negatives",
    f"""
    WITH v AS (
        SELECT vec_id, v,
               CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
        FROM ({WHOLE_VECTORS}) WHERE label IS NOT NULL),
    scored AS (
        SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
               list_dot_product(a.v, v.v)::BIGINT AS score
        FROM v AS a JOIN v ON v.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    ranked AS (
        SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, positive_id
                                  ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
        FROM positives AS p JOIN scored AS s ON s.anchor_id = p.anchor_id
        WHERE NOT s.same AND 30 * positive_score <= 100 * s.score
          AND 100 * s.score <= 90 * positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    FROM ranked WHERE rank <= 10
    """,
)
def hard_negative_rows(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = _whole_vectors(rows.withColumn("label", moved))
    return hard_negatives.hard_negatives(whole, whole.filter("vec_id % 100 = 0"))


@register(
    "op11_collocations",
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    split AS (
        SELECT lang, [x FOR x IN string_split_regex(piece, '[ \t]+') IF x <> ''] AS w FROM pieces),
    runs AS (
        SELECT lang, unnest(range(1, len(w) + 1)) AS start, w FROM split),
    counts AS (
        SELECT lang, array_to_string(list_slice(w, start, start + k - 1), ' ') AS phrase, k,
               count(*) AS f
        FROM runs, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE start + k - 1 <= len(w)
        GROUP BY ALL),
    total AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
    candidates AS (SELECT * FROM counts WHERE k > 1 AND f >= 30),
    words AS (SELECT *, string_split(phrase, ' ') AS w FROM candidates),
    longer AS (
        SELECT lang, array_to_string(list_slice(w, b, b + l - 1), ' ') AS phrase, max(f) AS covered
        FROM words, (SELECT unnest([2, 3]) AS l), (SELECT unnest([1, 2, 3]) AS b)
        WHERE l < k AND b + l - 1 <= k GROUP BY ALL),
    kept AS (
        SELECT words.* FROM words LEFT JOIN longer USING (lang, phrase)
        WHERE covered IS NULL OR 100 * covered < 80 * f),
    cuts AS (
        SELECT kept.*, c, array_to_string(list_slice(w, 1, c), ' ') AS one,
               array_to_string(list_slice(w, c + 1, k), ' ') AS two
        FROM kept, (SELECT unnest([1, 2, 3]) AS c) WHERE c < k),
    scored AS (
        SELECT cuts.lang, cuts.phrase, cuts.f AS a, x.f AS l, y.f AS r, c,
               ((2000000::HUGEINT * cuts.f) // (x.f + y.f))::BIGINT AS score
        FROM cuts JOIN counts AS x ON x.lang = cuts.lang AND x.phrase = one
                  JOIN counts AS y ON y.lang = cuts.lang AND y.phrase = two),
    worst AS (
        SELECT * FROM scored
        QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
    ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst)
    SELECT lang, rank, phrase, a, l, r, n, score
    FROM ranked JOIN total USING (lang) WHERE rank <= 2000
    """,
)
def collocation_ranking(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))

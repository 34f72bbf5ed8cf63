"""Documents to training sequences: quality, near-duplicates, secrets, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrun.llm import near_dup, packing, quality, secrets
from quillrun.llm.storage import rewritten
from quillrun.sources.tables import table

#: Documents with a lower score are rejected.
QUALITY_BAR = 0.3
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
SEQUENCE = 2048


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject."""
    labels = table(spark, sf_dir, "labels")
    scored = quality.score(docs, quality.fit(docs, labels), out="score_")
    return scored.filter(F.col("score_") >= QUALITY_BAR).select(*docs.columns)


def single_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Rows without an id stay. Equal rows with one id are one document; an id whose rows
    fall into several groups stays if it is kept in one of them.
    """
    found = near_dup.near_duplicates(docs, words=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    kept = found.filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.filter("doc_id IS NULL")).select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark, ``n_chars`` that of the new text."""
    return secrets.redact_secrets(docs).withColumn(
        "n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in training sequences."""
    pieces = packing.token_pieces(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        capacity=SEQUENCE,
    )
    light = pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return packing.pack(light, capacity=SEQUENCE)


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", single_documents),
    ("secrets", without_secrets),
    ("packing", packed),
]
#: No stage but the third could be written in SQL; the tests hold them to plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each over all that the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = rewritten(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}

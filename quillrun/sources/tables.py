"""Parquet tables, labelled texts and materialised datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABELED_TEXT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.IntegerType()),
    ]
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder of Parquet files."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_labeled(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Labelled texts ``(id, text, label)`` of one split.

    Splits are partition folders (``split=train``), so only one of them is listed
    and read.
    """
    schema = T.StructType([*LABELED_TEXT.fields, T.StructField("split", T.StringType())])
    return (
        spark.read.schema(schema)
        .parquet(path)
        .filter(F.col("split") == split)
        .select("id", "text", "label")
    )


def labeled_texts(
    texts: DataFrame, labels: DataFrame, key: str, text: str, label: str
) -> DataFrame:
    """Texts with the label of the same key; texts without a label drop out."""
    return texts.select(F.col(key).alias("id"), F.col(text).alias("text")).join(
        labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label")), "id"
    )


def materialize(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write a prepared dataset once and read it from there afterwards."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

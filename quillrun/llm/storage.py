"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _shared_folder(spark: SparkSession) -> None:
    """Makes ``checkpoint()`` usable: the folder of ``spark.checkpoint.dir``.

    Where that setting is absent, the warehouse stands in, which executors share too.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        context.setCheckpointDir(folder or f"{warehouse}/_shared")


def stored(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder; survives a lost executor."""
    _shared_folder(df.sparkSession)
    return df.checkpoint()


def rewritten(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet in the shared folder and read from there."""
    spark = df.sparkSession
    _shared_folder(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, text)`` alone, null text as the empty one; other columns stay behind."""
    return df.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text))


def in_slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a worker holds few texts at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)

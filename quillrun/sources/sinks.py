"""Writers for reports and per-rank logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A report or run description as JSON lines."""
    df.write.mode(mode).json(path)


def write_rank_text(
    df: DataFrame, path: str, rank: str = "rank", line: str = "line", truncate: bool = False
) -> None:
    """Log lines as text, one folder per rank; appended unless ``truncate``.

    Lines are gathered by rank first, so that each task does not open a file for every
    rank; a rank with very many lines is split again over several tasks.
    """
    mode = "overwrite" if truncate else "append"
    lines = df.select(F.col(rank).alias("rank"), F.col(line).alias("value"))
    lines.hint("rebalance", "rank").write.partitionBy("rank").mode(mode).text(path)

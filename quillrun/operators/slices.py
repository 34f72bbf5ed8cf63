"""Column choice, filters, slices, samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.functions import text as tx


def keep_columns(df: DataFrame, columns: Sequence[str], others: bool = False) -> DataFrame:
    """Keep the named columns first; ``others`` lets the rest follow."""
    rest = [c for c in df.columns if c not in columns] if others else []
    return df.select(*columns, *rest)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def explode_lines(df: DataFrame, column: str) -> DataFrame:
    """One row per line of a text column, blank lines kept."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.posexplode(tx.lines(F.col(column))).alias("line_no", "line"))


def query_lines(df: DataFrame, column: str) -> DataFrame:
    """Trimmed, non-empty lines of a text column."""
    line = F.regexp_replace("line", rf"^{tx.WHITE_SPACE}|{tx.WHITE_SPACE}$", "")
    return explode_lines(df, column).withColumn("line", line).filter(F.length("line") > 0)


def non_empty(df: DataFrame, tokens: Column) -> DataFrame:
    """Rows whose token array is not empty."""
    return df.filter(F.size(tokens) > 0)


def head_n(df: DataFrame, n: int, order: str | Sequence[str]) -> DataFrame:
    """The first ``n`` rows of an order."""
    keys = [order] if isinstance(order, str) else list(order)
    return df.orderBy(*keys).limit(n)


def dry_run_head(df: DataFrame, subset: int, order: str, cap: int = 2000) -> DataFrame:
    """The first ``subset`` rows, at most ``cap`` of them."""
    return head_n(df, min(subset, cap), order)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows that look random but repeat for the same seed."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    return df.withColumn("_draw", draw).orderBy("_draw", key).limit(n).drop("_draw")


def repeat_rows(df: DataFrame, times: int, name: str = "copy_no") -> DataFrame:
    """Each row ``times`` times, with the number of the copy."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(times))))


def decode_classes(df: DataFrame, classes: DataFrame, label: str, name: str) -> DataFrame:
    """Class names from a dimension table ``(class_id, class_name)``.

    Catalyst broadcasts the dimension when its size allows it.
    """
    names = classes.select(F.col("class_id").alias("_class"), F.col("class_name").alias(name))
    return df.join(names, F.col(label) == F.col("_class"), "left").drop("_class")

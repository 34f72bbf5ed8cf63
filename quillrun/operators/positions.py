"""Places of rows in a global order, without a single-task sort.

An order is cut into ranges at approximate quantiles of its leading key. Where the
cuts fall only decides how even the ranges are, never the result: rows are placed
inside their range, and the sizes of the earlier ranges are added.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrun.session import shuffle_width

MAX_RANGES = 10_000


def range_count(df: DataFrame) -> int:
    """Ranges per order: a few per shuffle partition, bounded."""
    return max(1, min(MAX_RANGES, 4 * shuffle_width(df.sparkSession)))


def _as_double(df: DataFrame, key: str) -> Column:
    kind = df.schema[key].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        number = F.unix_micros(F.col(key).cast("timestamp"))
    elif isinstance(kind, T.NumericType):
        number = F.col(key)
    else:
        raise TypeError(f"leading order key {key!r} must be numeric or a time, not {kind}")
    # Adding zero makes one value of both zeros, as the sort order has it.
    return F.coalesce(number.cast("double") + F.lit(0.0), F.lit(float("nan")))


def _cuts(wide: DataFrame, columns: Sequence[str], n: int) -> list[list[float]]:
    """Quantiles of several columns in one pass; a frequent value repeats among them."""
    if n < 2:
        return [[] for _ in columns]
    shares = [i / n for i in range(1, n)]
    found = wide.select(*columns).approxQuantile(list(columns), shares, 1 / (2 * n))
    return [[c for c in cuts if math.isfinite(c)] for cuts in found]


def _bucketed(
    wide: DataFrame, columns: Sequence[str], cuts: Sequence[Sequence[float]], outputs: Sequence[str]
) -> DataFrame:
    splits = [[-math.inf, *(sorted(set(c)) or [0.0]), math.inf] for c in cuts]
    ranged = Bucketizer(
        splitsArray=splits, inputCols=list(columns), outputCols=list(outputs), handleInvalid="keep"
    ).transform(wide)
    return ranged.withColumns({o: F.col(o).cast("int") for o in outputs}).drop(*columns)


def with_ranges(
    df: DataFrame, keys: Sequence[str], outputs: Sequence[str], n_ranges: int | None = None
) -> DataFrame:
    """Add for each key the number of the range it falls in, rising with the key.

    NULL and NaN share the last range. Only the cut points, at most ``n_ranges``
    numbers per key, come back to the driver.
    """
    doubles = [f"_double_{i}" for i in range(len(keys))]
    wide = df.withColumns({d: _as_double(df, k) for d, k in zip(doubles, keys)})
    cuts = _cuts(wide, doubles, n_ranges or range_count(df))
    return _bucketed(wide, doubles, cuts, outputs)


#: Bytes of a string that one number holds, and how many numbers are made of a string.
CHUNK_BYTES, CHUNKS = 6, 3
#: Numbers of an order that may cut a frequent value further.
MAX_LEVELS = 6
#: Codes of values that are no numbers; both stand behind all numbers.
NOT_A_NUMBER, MISSING = 1_000_000_000, 1_000_000_001


def _levels(df: DataFrame, keys: Sequence[str]) -> list[tuple[Column, bool]]:
    """The order as numbers, each with whether equal numbers are equal keys so far.

    A string is its first bytes as whole numbers that keep the order; the number also
    says whether more follows. The list ends before a key that no number can stand for.
    """
    found: list[tuple[Column, bool]] = []
    for key in keys:
        kind = df.schema[key].dataType
        if isinstance(kind, T.StringType):
            size = F.octet_length(key)
            for chunk in range(CHUNKS):
                part = F.substring(F.col(key).cast("binary"), chunk * CHUNK_BYTES + 1, CHUNK_BYTES)
                number = F.conv(F.rpad(F.hex(part), 2 * CHUNK_BYTES, "0"), 16, 10).cast("double")
                left = F.greatest(
                    F.least(size - chunk * CHUNK_BYTES, F.lit(CHUNK_BYTES + 1)), F.lit(0)
                )
                found.append((number * 8 + left, True))
        elif isinstance(kind, (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType)):
            known = F.when(F.col(key).isNotNull(), _as_double(df, key))
            found.append((known, not isinstance(kind, T.DecimalType)))
        else:
            break
    return found[:MAX_LEVELS]


def _isolating(cuts: Sequence[float], exact: bool) -> tuple[list[float], dict[float, int]]:
    """Sorted cut points, and the values that hold several quantiles with their number.

    Such a value is cut off on both sides, so that its range holds nothing else.
    """
    hot = {v: m for v, m in Counter(cuts).items() if m > 1 and exact and abs(v) < 2**53}
    return sorted({*cuts, *(math.nextafter(v, math.inf) for v in hot)}), hot


def _cut_code(number: Column, cuts: Column) -> Column:
    """How many of the sorted cuts are at or below a number, found in two steps."""
    step = F.ceil(F.sqrt(F.size(cuts).cast("double"))).cast("int")
    below = lambda c: c <= number
    coarse = F.filter(cuts, lambda c, i: ((i + 1) % step == 0) & below(c))
    passed = F.size(coarse) * step
    fine = F.filter(F.slice(cuts, passed + 1, F.greatest(step, F.lit(1))), below)
    return passed + F.size(fine)


def _coded(number: Column, code: Column) -> Column:
    return (
        F.when(number.isNull(), F.lit(MISSING))
        .when(F.isnan(number), F.lit(NOT_A_NUMBER))
        .otherwise(code)
        .cast("int")
    )


def _with_order_ranges(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Add ``_range`` of the order's first number and ``_part``, an array, within it.

    A value that holds several quantiles gets a range of its own, which is cut at the
    quantiles of the next number among the rows of that value alone, into as many parts
    as it holds quantiles, and so on; NULL and NaN are values like any other. So a
    frequent value is not one task, however the keys go together. Only cut points come
    back to the driver, about ``2 n`` for each number of the order.
    """
    levels = _levels(df, keys)
    if not levels:
        raise TypeError(f"order key {keys[0]!r} must be a number, a time or a string")
    number, exact = levels[0]
    wide = df.withColumn("_number", number)
    held = wide.agg(
        F.count(F.lit(1)),
        F.count_if(F.col("_number").isNull()),
        F.count_if(F.isnan("_number")),
    ).first()
    cuts = _cuts(wide, ["_number"], n)[0]
    points, hot = _isolating(cuts, exact)
    coded = _bucketed(
        wide.withColumn("_code", F.col("_number")), ["_code"], [points], ["_range"]
    ).withColumn("_range", _coded(F.col("_number"), F.col("_range")))
    open_ = {(bisect_right(points, v),): m for v, m in hot.items()} if points else {}
    for code, rows in ((MISSING, held[1]), (NOT_A_NUMBER, held[2])):
        share = math.ceil(rows * n / max(1, held[0]))
        if share > 1:
            open_[(code,)] = share
    coded, path = coded.drop("_number"), ["_range"]
    for number, exact in levels[1:]:
        if not open_:
            break
        coded, open_, path = _cut_further(coded, number, exact, open_, path)
    parts = F.array(*path[1:]) if path[1:] else F.array().cast("array<int>")
    return coded.withColumn("_part", parts).drop(*path[1:])


def _cut_further(
    coded: DataFrame, number: Column, exact: bool, open_: dict[tuple, int], path: list[str]
) -> tuple[DataFrame, dict[tuple, int], list[str]]:
    """The next number's codes for the rows of frequent values, 0 for all others."""
    spark = coded.sparkSession
    kinds = ", ".join(f"{p} int" for p in path)
    wide = coded.withColumn("_number", number)
    finite = F.when(~F.isnan("_number"), F.col("_number"))
    found: dict[tuple, tuple] = {}
    # Few values hold many quantiles: with two sizes of requests, answers stay few too.
    few = {k: m for k, m in open_.items() if m <= 16}
    many = {k: m for k, m in open_.items() if m > 16}
    for group, shares in ((few, 16), (many, max(many.values(), default=0))):
        if not group:
            continue
        wanted = spark.createDataFrame(list(group), kinds)
        answers = (
            wide.join(F.broadcast(wanted), path)  # at most as many rows as ranges
            .groupBy(*path)
            .agg(
                F.percentile_approx(
                    finite, [i / shares for i in range(1, shares)], 20 * shares
                ).alias("cuts"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(F.col("_number").isNull()).alias("missing"),
                F.count_if(F.isnan("_number")).alias("nan"),
            )
            .collect()
        )
        for row in answers:
            key = tuple(row[p] for p in path)
            take = group[key]
            cuts = [row.cuts[round(i * shares / take) - 1] for i in range(1, take)] if row.cuts else []
            found[key] = ([c for c in cuts if math.isfinite(c)], row.rows, row.missing, row.nan)
    name = f"_level_{len(path)}"
    rows, still = [], {}
    for key, (cuts, total, missing, nan) in found.items():
        points, hot = _isolating(cuts, exact)
        rows.append((*key, points))
        for value, m in hot.items():
            still[(*key, bisect_right(points, value))] = m
        for code, held in ((MISSING, missing), (NOT_A_NUMBER, nan)):
            share = math.ceil(held * open_[key] / total)
            if share > 1:
                still[(*key, code)] = share
    table = spark.createDataFrame(rows, f"{kinds}, _points array<double>")
    cut = (
        wide.join(F.broadcast(table), path, "left")  # at most as many points as ranges, twice
        .withColumn(
            name,
            F.when(F.col("_points").isNull(), F.lit(0)).otherwise(
                _coded(F.col("_number"), _cut_code(F.col("_number"), F.col("_points")))
            ),
        )
        .drop("_points", "_number")
    )
    return cut, still, [*path, name]


def with_row_index(
    df: DataFrame,
    order: str | Sequence[str],
    name: str = "row_index",
    total: str | None = None,
    n_ranges: int | None = None,
) -> DataFrame:
    """Dense 0-based place of each row in a total order.

    ``order`` must be unique over the rows and led by a number, a time or a string; NULL
    goes last. One shuffle of the rows by range, one small count per range; the broadcast
    side has a few times ``n_ranges`` rows. The input is read once for the cuts, again for
    each number of the order that has to cut frequent values further, once for the
    sizes and once for the rows. ``total`` names a column for the row count.
    """
    keys = [order] if isinstance(order, str) else list(order)
    part = ["_range", "_part"]
    ranged = _with_order_ranges(df, keys, n_ranges or range_count(df))
    sizes = ranged.groupBy(*part).agg(F.count(F.lit(1)).alias("_size"))
    in_order = Window.orderBy(*part)
    starts = sizes.select(
        *part,
        (F.sum("_size").over(in_order) - F.col("_size")).alias("_start"),
        F.sum("_size").over(Window.partitionBy()).alias("_total"),
    )
    inside = Window.partitionBy(*part).orderBy(*[F.col(k).asc_nulls_last() for k in keys])
    placed = ranged.withColumn("_place", F.row_number().over(inside))
    columns = [
        *df.columns,
        (F.col("_start") + F.col("_place") - 1).cast("long").alias(name),
    ]
    if total:
        columns.append(F.col("_total").alias(total))
    return placed.join(F.broadcast(starts), part).select(*columns)


def with_previous(
    df: DataFrame,
    by: Sequence[str],
    order: str | Sequence[str],
    value: str,
    name: str,
    n_ranges: int | None = None,
) -> DataFrame:
    """The value of the row before, within a group that may be arbitrarily large.

    A group is cut into ranges of its order, frequent values further by the keys after
    it; the first row of a range takes the last value of the nearest earlier range of
    its group.
    """
    keys = [order] if isinstance(order, str) else list(order)
    ranged = _with_order_ranges(df, keys, n_ranges or range_count(df))
    part = [*by, "_range", "_part"]
    in_order = [F.col(k).asc_nulls_last() for k in keys]
    inside = Window.partitionBy(*part).orderBy(*in_order)
    placed = ranged.withColumns(
        {
            "_lag": F.lag(value).over(inside),
            "_place": F.row_number().over(inside),
        }
    )
    carried = (
        placed.groupBy(*part)
        .agg(F.max_by(value, "_place").alias("_last"))
        .withColumn("_carry", F.lag("_last").over(Window.partitionBy(*by).orderBy("_range", "_part")))
        .drop("_last")
    )
    named = {c: f"_of_{i}" for i, c in enumerate(part)}
    carried = carried.withColumnsRenamed(named)
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(o)) for c, o in named.items()))
    previous = F.when(F.col("_place") == 1, F.col("_carry")).otherwise(F.col("_lag"))
    return placed.join(carried, same, "left").select(*df.columns, previous.alias(name))

"""Array functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row.

    Lambda variables are bound to a result; a Column used twice would be computed
    twice wherever the expression holds a higher-order function.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def run_lengths(values: Column) -> Column:
    """Distinct values of an array with their counts, as ``(value, n)`` entries.

    Sorting brings equal values together; the counts are the gaps between the places
    where a new value starts. No row leaves its task for this.
    """

    def gaps(ordered: Column) -> Column:
        n = F.size(ordered)
        places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(
            F.array().cast("array<int>")
        )
        new = F.filter(
            places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
        )
        return let(
            new,
            lambda starts: F.zip_with(
                starts,
                F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts), F.lit(1))),
                         F.when(n > 0, F.array(n)).otherwise(F.array().cast("array<int>"))),
                lambda a, b: F.struct(F.get(ordered, a).alias("value"), (b - a).alias("n")),
            ),
        )

    return let(F.sort_array(values), gaps)


def arg_max(scores: Column) -> Column:
    """0-based place of the largest score; the first one wins a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def class_name(label: Column, names: Sequence[str]) -> Column:
    """Name of a 0-based class id, NULL outside the list."""
    return F.get(F.array(*[F.lit(name) for name in names]), label.cast("int"))


def next_token_labels(ids: Column, n_real: Column, ignore: int = -100) -> Column:
    """For place t the token at t+1; places whose target is padding get ``ignore``."""
    return let(
        n_real,
        lambda n: F.transform(
            ids, lambda _, t: F.when(t + 1 < n, F.get(ids, t + 1)).otherwise(F.lit(ignore))
        ),
    )

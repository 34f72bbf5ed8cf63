"""Functions that take log lines apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillrun.functions import formats
from quillrun.functions.arrays import let


def pairs(line: Column) -> Column:
    """``key=value`` pairs of a line as a map; the last one of a key wins."""

    def as_map(found: Column) -> Column:
        keys = found["keys"]
        entries = F.zip_with(
            keys, found["values"], lambda k, v: F.struct(k.alias("key"), v.alias("value"))
        )
        latest = F.filter(
            entries,
            lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]),
        )
        return F.map_from_entries(latest)

    found = F.struct(
        F.regexp_extract_all(line, F.lit(formats.PAIR), F.lit(1)).alias("keys"),
        F.regexp_extract_all(line, F.lit(formats.PAIR), F.lit(2)).alias("values"),
    )
    return let(found, as_map)


def number(pair_map: Column, key: str) -> Column:
    """A value of a pair map as a number, NULL when absent or not numeric."""
    return F.try_element_at(pair_map, F.lit(key)).try_cast("double")


def last_number(line: Column, key: str) -> Column:
    """The number behind the last ``key=`` of a line, without building a map."""
    return F.regexp_extract(line, rf"(?:^|.*[^\w.]){key}=(\S+)", 1).try_cast("double")


def named_value(tokens: Column, name: str, default: str) -> Column:
    """The rest of the last token that starts with ``name=``."""
    mark = f"{name}="
    found = F.filter(tokens, lambda t: F.startswith(t, F.lit(mark)))
    rest = F.substring(F.try_element_at(found, F.lit(-1)), len(mark) + 1, 1_000_000)
    return F.coalesce(rest, F.lit(default))

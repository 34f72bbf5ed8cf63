"""From log lines to typed records.

Input is a table of lines with any other columns (``job``, ``file``, ``pos``, ``ts``),
which every record keeps. All matches of a line count; ``hit`` numbers those of one kind.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.functions import formats
from quillrun.functions import lines as ln
from quillrun.functions import text as tx

# Fields of each kind of record, in the order of the groups of its pattern.
KINDS: dict[str, tuple[str, dict[str, str]]] = {
    "rank": (formats.RANK, {"rank": "int", "world_size": "int"}),
    "rendezvous": (
        formats.RENDEZVOUS,
        {"nnodes": "int", "nproc_per_node": "int", "node_rank": "int", "endpoint": "string"},
    ),
    "sanity": (
        formats.SANITY,
        {
            "host": "string",
            "python": "string",
            "torch": "string",
            "tfm": "string",
            "numpy": "string",
            "datasets": "string",
            "root": "string",
        },
    ),
    "step": (
        formats.STEP,
        {
            "rank": "int",
            "step": "bigint",
            "step_ms": "double",
            "samples_per_sec": "double",
            "tokens_per_sec": "double",
        },
    ),
    "runtime": (formats.RUNTIME, {"train_runtime_sec": "double"}),
    "evaluation": (formats.EVALUATION, {"accuracy": "double"}),
    "inference": (
        formats.INFERENCE,
        {"accuracy": "double", "samples_per_sec": "double", "tokens_per_sec": "double"},
    ),
    "failure": (formats.FAILURE, {"signature": "string"}),
    "phase": (formats.PHASE, {"phase": "string", "seconds": "double"}),
    "host_step": (
        formats.HOST_STEP,
        {"host": "string", "rank": "int", "step": "bigint", "seconds": "double"},
    ),
    "pipeline_step": (
        formats.PIPELINE_STEP,
        {"epoch": "bigint", "step": "bigint", "loss": "double", "seconds": "double"},
    ),
}


def _typed(match: Column, pattern: str, fields: Mapping[str, str]) -> list[Column]:
    return [
        F.regexp_extract(match, pattern, group).try_cast(kind).alias(name)
        for group, (name, kind) in enumerate(fields.items(), start=1)
    ]


def records(lines: DataFrame, kind: str) -> DataFrame:
    """Records of one kind, one row per match."""
    pattern, fields = KINDS[kind]
    keep = [c for c in lines.columns if c != "line"]
    matches = F.regexp_extract_all("line", F.lit(pattern), F.lit(0))
    return lines.select(*keep, F.posexplode(matches).alias("hit", "_match")).select(
        *keep, "hit", *_typed(F.col("_match"), pattern, fields)
    )


def _as_entry(kind: str):
    def entry(match: Column, hit: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), hit.alias("hit"), match.alias("match"))

    return entry


def all_records(lines: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """All records of the given kinds in one pass: ``(..., kind, hit, match)``.

    Meant to be written once, partitioned by ``kind``; :func:`of_kind` then reads
    the records of one kind without touching the log lines again.
    """
    keep = [c for c in lines.columns if c != "line"]
    found = [
        F.transform(
            F.regexp_extract_all("line", F.lit(KINDS[kind][0]), F.lit(0)),
            _as_entry(kind),
        )
        for kind in kinds or list(KINDS)
    ]
    return lines.select(*keep, F.explode(F.concat(*found)).alias("_r")).select(*keep, "_r.*")


def of_kind(matches: DataFrame, kind: str) -> DataFrame:
    """Typed records of one kind out of :func:`all_records`."""
    pattern, fields = KINDS[kind]
    keep = [c for c in matches.columns if c not in ("kind", "match")]
    return matches.filter(F.col("kind") == kind).select(
        *keep, *_typed(F.col("match"), pattern, fields)
    )


def pair_records(lines: DataFrame) -> DataFrame:
    """``key=value`` lines of training steps: ``(..., rank, step, pairs)``."""
    keep = [c for c in lines.columns if c != "line"]
    return lines.filter(F.col("line").rlike(formats.RANK_STEP)).select(
        *keep,
        F.regexp_extract("line", formats.RANK_STEP, 1).try_cast("int").alias("rank"),
        F.regexp_extract("line", formats.RANK_STEP, 2).try_cast("bigint").alias("step"),
        ln.pairs(F.col("line")).alias("pairs"),
    )


def training_curve(lines: DataFrame) -> DataFrame:
    """Loss, gradient norm, learning rate and epoch by rank and step."""
    keep = [c for c in lines.columns if c != "line"]
    values = [
        ln.last_number(F.col("line"), key).alias(key)
        for key in ("loss", "grad_norm", "learning_rate", "epoch")
    ]
    return (
        lines.filter(F.col("line").rlike(formats.RANK_STEP))
        .select(
            *keep,
            F.regexp_extract("line", formats.RANK_STEP, 1).try_cast("int").alias("rank"),
            F.regexp_extract("line", formats.RANK_STEP, 2).try_cast("bigint").alias("step"),
            *values,
        )
        .filter(F.col("loss").isNotNull())
    )


def dictionary_records(lines: DataFrame) -> DataFrame:
    """Dictionaries that a trainer prints, ``(..., hit, found)`` with a VARIANT each.

    Any keys will do, and each value keeps the type it was written with; ``nan`` and
    ``inf`` are texts there. What is no dictionary after all gives no row.
    """
    keep = [c for c in lines.columns if c != "line"]
    matches = F.regexp_extract_all("line", F.lit(formats.DICTIONARY), F.lit(0))
    rules = {
        r"\bTrue\b(?=[,}])": "true",
        r"\bFalse\b(?=[,}])": "false",
        r"\bNone\b(?=[,}])": "null",
        r"(?<=: )(-?(?:nan|inf))(?=[,}])": '"$1"',
    }
    json = F.translate("_match", "'", '"')
    for pattern, put in rules.items():
        json = F.regexp_replace(json, pattern, put)
    return (
        lines.filter(F.col("line").contains("{'"))
        .select(*keep, F.posexplode(matches).alias("hit", "_match"))
        .select(*keep, "hit", F.try_parse_json(json).alias("found"))
        .filter("found IS NOT NULL")
    )


def dictionary_values(found: DataFrame) -> DataFrame:
    """``(..., hit, key, value, number)``: one row per entry of a dictionary.

    ``value`` is the entry as text, ``number`` as a number where it is one.
    """
    keep = [c for c in found.columns if c != "found"]
    entries = F.col("found").cast("map<string,variant>")
    number = F.try_variant_get("_value", "$", "double")
    return found.select(*keep, F.explode(entries).alias("key", "_value")).select(
        *keep,
        "key",
        F.try_variant_get("_value", "$", "string").alias("value"),
        F.when(F.schema_of_variant("_value") != "BOOLEAN", number).alias("number"),
    )


def dictionary_schema(found: DataFrame) -> str:
    """The keys of all dictionaries with the types that hold all their values."""
    return found.agg(F.schema_of_variant_agg("found")).first()[0]


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key; a partial aggregate, no sort."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
        .select(*keys, "_last.*")
    )


def preflight_records(lines: DataFrame) -> DataFrame:
    """Hosts with what they could see: ``(..., host, proj, pkgs)``, blank lines skipped."""
    keep = [c for c in lines.columns if c != "line"]
    tokens = F.split(F.btrim(F.regexp_replace("line", tx.WHITE_SPACE, " ")), " ")
    parts = lines.select(*keep, tokens.alias("_t")).filter(F.get("_t", F.lit(0)) != "")
    rest = F.slice("_t", F.lit(2), F.size("_t"))
    return parts.select(
        *keep,
        F.get("_t", F.lit(0)).alias("host"),
        ln.named_value(rest, "proj", formats.PREFLIGHT_MISSING).alias("proj"),
        ln.named_value(rest, "pkgs", formats.PREFLIGHT_MISSING).alias("pkgs"),
    )


def sorted_excerpt(lines: DataFrame, pattern: str, n: int = 30) -> DataFrame:
    """The last ``n`` of the distinct matching lines in sorted order."""
    kept = lines.filter(F.col("line").rlike(pattern)).select("line").distinct()
    return kept.orderBy(F.desc("line")).limit(n).orderBy("line")


def first_excerpt(lines: DataFrame, pattern: str, order: list[str], n: int = 200) -> DataFrame:
    """The first ``n`` matching lines in file order."""
    return lines.filter(F.col("line").rlike(pattern)).orderBy(*order).limit(n)

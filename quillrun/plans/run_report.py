"""The whole report of one or many jobs as a long table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.operators import run_records as rec
from quillrun.operators import run_reports as rep
from quillrun.session import shared_folder

REPORT_KINDS = ["rank", "rendezvous", "sanity", "step", "runtime", "evaluation", "inference",
                "failure"]


def store_records(lines: DataFrame, folder: str | None = None) -> DataFrame:
    """Parse all lines once and keep the matches, partitioned by kind.

    The log is read a single time; each section of a report then reads only the
    files of its own kind. Rebalancing splits a frequent kind over tasks and joins
    the rare ones, so that files are neither huge nor many. Without ``folder`` they
    go to the shared folder.
    """
    spark = lines.sparkSession
    path = folder or shared_folder(spark, "run-records")
    matches = rec.all_records(lines, REPORT_KINDS)
    matches.hint("rebalance", "kind").write.mode("overwrite").partitionBy("kind").parquet(path)
    return spark.read.schema(matches.schema).parquet(path)


def _rows(df: DataFrame, section: str, key: Column, value: Column) -> DataFrame:
    return df.select(
        "job",
        F.lit(section).alias("section"),
        key.alias("key"),
        value.cast("double").alias("value"),
    )


def _columns(df: DataFrame, section: str, names: dict[str, str]) -> DataFrame:
    """One row per named column of a one-row-per-job table."""
    entries = F.array(
        *[
            F.struct(F.lit(key).alias("key"), F.col(column).cast("double").alias("value"))
            for column, key in names.items()
        ]
    )
    wide = df.select("job", F.lit(section).alias("section"), F.explode(entries).alias("_e"))
    return wide.select("job", "section", "_e.key", "_e.value")


def run_report(
    lines: DataFrame,
    preflight: DataFrame | None = None,
    folder: str | None = None,
    runs: DataFrame | None = None,
) -> DataFrame:
    """``(job, section, key, value)`` for all jobs of ``lines(job, file, pos, line)``.

    ``runs(job)`` adds a verdict for jobs whose logs hold no known line.
    """
    stored = store_records(lines, folder)
    by = ["job"]
    ranks, rendezvous = rec.of_kind(stored, "rank"), rec.of_kind(stored, "rendezvous")
    failures = rec.of_kind(stored, "failure")
    configs = F.format_string(
        "nnodes=%d nproc_per_node=%d endpoint=%s", "nnodes", "nproc_per_node", "endpoint"
    )
    percentiles = rep.step_percentiles(rec.of_kind(stored, "step"), by)
    parts = [
        _rows(rep.rendezvous_configs(rendezvous, by), "RDZV", configs, F.lit(1)),
        _columns(
            rep.rank_coverage(ranks, by),
            "RANKS",
            {"min_rank": "min", "max_rank": "max", "n_ranks": "count"},
        ),
        _rows(
            rep.world_sizes(ranks, by),
            "WORLD",
            F.col("world_size").cast("string"),
            F.col("n_seen"),
        ),
        _rows(
            rep.version_drift(rec.of_kind(stored, "sanity"), by),
            "DRIFT",
            F.concat_ws("=", "component", "version"),
            F.col("n_hosts"),
        ),
        *[
            _rows(percentiles, "THROUGHPUT", F.concat_ws("_", "metric", F.lit(share)), F.col(share))
            for share in rep.SHARES
        ],
        _columns(
            rep.runtime_range(rec.of_kind(stored, "runtime"), by),
            "RUNTIME",
            {"min_runtime": "min", "max_runtime": "max"},
        ),
        _columns(
            rep.best_and_last(rec.of_kind(stored, "evaluation"), by),
            "EVAL",
            {"best_accuracy": "best", "last_accuracy": "last"},
        ),
        _columns(
            rep.last_inference(rec.of_kind(stored, "inference"), by),
            "INFER",
            {c: c for c in ("accuracy", "samples_per_sec", "tokens_per_sec")},
        ),
        _rows(rep.failures_by_file(failures, by), "FAILURES", F.col("file"), F.col("n_hits")),
        _columns(
            rep.verdict(rendezvous, ranks, failures, by, runs),
            "VERDICT",
            {"n_missing": "missing", "n_failures": "failures", "passed": "pass"},
        ),
    ]
    if preflight is not None:
        totals = rep.preflight_totals(rec.preflight_records(preflight), by)
        parts.append(_columns(totals, "PREFLIGHT", {"n_ready": "ready", "n_hosts": "hosts"}))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def _texts(df: DataFrame, section: str, key: Column, text: Column) -> DataFrame:
    return df.select("job", F.lit(section).alias("section"), key.alias("key"), text.alias("text"))


def run_report_details(
    lines: DataFrame, preflight: DataFrame | None = None, folder: str | None = None
) -> DataFrame:
    """``(job, section, key, text)``: what the report says in words, for all jobs.

    Whether rendezvous records and world sizes agree, which ranks are missing, the versions
    and the preflight state of every host, and the first failures with how many follow.
    """
    stored = store_records(lines, folder)
    by = ["job"]
    ranks, failures = rec.of_kind(stored, "rank"), rec.of_kind(stored, "failure")
    said = lambda bad: F.when(bad, "inconsistent").otherwise("consistent")
    sizes = rep.world_sizes(ranks, by).groupBy(*by).agg(F.count(F.lit(1)).alias("n_sizes"))
    samples = rep.failure_samples(failures, by)
    versions = F.concat_ws(
        " ", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in [*rep.COMPONENTS, "root"]]
    )
    more = samples.filter("place = 1 AND n_more > 0")
    parts = [
        _texts(
            rep.rendezvous_status(rec.of_kind(stored, "rendezvous"), by),
            "RDZV",
            F.lit("configs"),
            said(F.col("inconsistent")),
        ),
        _texts(sizes, "RANKS", F.lit("world sizes"), said(F.col("n_sizes") > 1)),
        _texts(rep.missing_summary(ranks, by), "RANKS", F.lit("missing"), F.col("shown")),
        _texts(
            rep.latest_sanity(rec.of_kind(stored, "sanity"), by), "SANITY", F.col("host"), versions
        ),
        _texts(
            samples,
            "FAILURES",
            F.col("place").cast("string"),
            F.concat_ws(": ", "file", "signature"),
        ),
        _texts(more, "FAILURES", F.lit("more"), F.format_string("(+%d more)", "n_more")),
    ]
    if preflight is not None:
        status = rep.preflight_status(rec.preflight_records(preflight), by)
        seen = F.format_string("proj=%s pkgs=%s -> %s", "proj", "pkgs", "status")
        parts.append(_texts(status, "PREFLIGHT", F.col("host"), seen))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report

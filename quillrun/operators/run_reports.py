"""From run records to reports.

Every report takes ``by``, the columns that tell runs apart (``["job"]``), or none
for one run. Groups are aggregated on the map side first; lists are cut to the few
entries a report shows before anything is gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrun.functions import formats
from quillrun.operators.percentiles import exact_percentiles
from quillrun.operators.positions import with_previous
from quillrun.operators.run_records import latest

# How much of a list a report shows, and which shares it reports.
SHOWN_RANKS = 15
SHOWN_FILES = 5
SHOWN_FAILURES = 8
SHARES = {"p50": 0.50, "p95": 0.95}
STEP_METRICS = ["step_ms", "samples_per_sec", "tokens_per_sec"]
COMPONENTS = ["python", "torch", "tfm", "numpy", "datasets"]
READY = "OK"
NOT_READY = "STAGED/MISSING"


def first_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], n: int, name: str
) -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1.

    Within groups Spark drops rows beyond ``n`` before the shuffle; without groups it
    is a plain top-n.
    """
    if by:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return df.withColumn(name, place).filter(F.col(name) <= n)
    place = F.row_number().over(Window.orderBy(*order))
    return df.orderBy(*order).limit(n).withColumn(name, place)


def rendezvous_configs(rendezvous: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct configurations; the node rank is not part of one."""
    return rendezvous.select(*by, "nnodes", "nproc_per_node", "endpoint").distinct()


def rendezvous_status(rendezvous: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of configurations and whether they disagree."""
    n = F.count(F.lit(1))
    return (
        rendezvous_configs(rendezvous, by)
        .groupBy(*by)
        .agg(n.alias("n_configs"), (n > 1).alias("inconsistent"))
    )


def rank_coverage(ranks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lowest and highest rank seen, and how many different ones."""
    return ranks.groupBy(*by).agg(
        F.min("rank").alias("min_rank"),
        F.max("rank").alias("max_rank"),
        F.count_distinct("rank").alias("n_ranks"),
    )


def world_sizes(ranks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Observations per world size."""
    return ranks.groupBy(*by, "world_size").agg(F.count(F.lit(1)).alias("n_seen"))


def missing_gaps(ranks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stretches ``(low, high)`` of ranks below the world size that never showed up.

    Only where the world size is unique. The work follows the ranks seen, whatever size
    a log line names.
    """
    seen = ranks.groupBy(*by, "rank").agg(
        F.min("world_size").alias("_low"), F.max("world_size").alias("_high")
    )
    whole = Window.partitionBy(*by)
    sized = (
        seen.withColumns({"_low": F.min("_low").over(whole), "_high": F.max("_high").over(whole)})
        .filter((F.col("_low") == F.col("_high")) & (F.col("_high") > 0))
        .withColumn("_size", F.col("_high").cast("long"))
        .withColumn(
            "_at",
            F.least(F.greatest(F.coalesce(F.col("rank").cast("long"), F.lit(-1)), F.lit(-1)), "_size"),
        )
        .select(*by, "_at", "_size")
        .distinct()
    )
    order = whole.orderBy("_at")
    placed = sized.withColumns(
        {
            "_before": F.coalesce(F.lag("_at").over(order), F.lit(-1)),
            "_last": F.lead("_at").over(order).isNull(),
        }
    )
    gap = lambda low, high: F.struct(low.alias("low"), high.alias("high"))
    gaps = F.array(
        gap(F.col("_before") + 1, F.col("_at") - 1),
        gap(F.when(F.col("_last"), F.col("_at") + 1), F.col("_size") - 1),
    )
    return placed.select(*by, F.inline(gaps)).filter("low <= high")


def missing_ranks(ranks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Ranks below the world size that never showed up, where that size is unique."""
    step = 10_000
    starts = F.explode(F.sequence("low", "high", F.lit(step).cast("long")))
    return (
        missing_gaps(ranks, by)
        .select(*by, "high", starts.alias("_from"))
        .select(
            *by,
            F.explode(
                F.sequence("_from", F.least(F.col("high"), F.col("_from") + step - 1))
            ).alias("rank"),
        )
    )


def missing_summary(ranks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of missing ranks and the first of them as text, ``...`` when there are more."""
    gaps = missing_gaps(ranks, by)
    counts = gaps.groupBy(*by).agg(F.sum(F.col("high") - F.col("low") + 1).alias("n_missing"))
    missing = gaps.select(
        *by,
        F.explode(
            F.sequence("low", F.least(F.col("high"), F.col("low") + SHOWN_RANKS - 1))
        ).alias("rank"),
    )
    if not by:
        counts = counts.filter("n_missing IS NOT NULL")
    numbers = F.transform(
        F.sort_array(F.collect_list("rank")), lambda r: r.cast("string")
    )
    shown = (
        first_rows(missing, by, ["rank"], SHOWN_RANKS, "_place")
        .groupBy(*by)
        .agg(F.array_join(numbers, ", ").alias("_shown"))
    )
    tail = F.when(F.col("n_missing") > SHOWN_RANKS, " ...").otherwise("")
    text = F.concat("_shown", tail).alias("shown")
    if by:
        return counts.join(shown, list(by)).select(*by, "n_missing", text)
    return counts.withColumn("_shown", shown.select("_shown").scalar()).select("n_missing", text)


def latest_sanity(sanity: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The last sanity record of each host, in file and line order."""
    return latest(sanity, [*by, "host"], ["file", "pos", "hit"]).select(
        *by, "host", *COMPONENTS, "root"
    )


def version_drift(sanity: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Components with more than one version: each version with its host count."""
    versions = (
        latest_sanity(sanity, by)
        .unpivot(list(by), COMPONENTS, "component", "version")
        .groupBy(*by, "component", "version")
        .agg(F.count(F.lit(1)).alias("n_hosts"))
    )
    each = F.count(F.lit(1)).over(Window.partitionBy(*by, "component"))
    return versions.withColumn("_n", each).filter(F.col("_n") > 1).drop("_n")


def preflight_status(preflight: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The last record of each host with its verdict."""
    ready = (F.col("proj") == "ok") & (F.col("pkgs") == "ok")
    return latest(preflight, [*by, "host"], ["file", "pos"]).select(
        *by, "host", "proj", "pkgs", F.when(ready, READY).otherwise(NOT_READY).alias("status")
    )


def preflight_totals(preflight: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Ready hosts and all hosts."""
    return (
        preflight_status(preflight, by)
        .groupBy(*by)
        .agg(
            F.count_if(F.col("status") == READY).alias("n_ready"),
            F.count(F.lit(1)).alias("n_hosts"),
        )
    )


def step_percentiles(steps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Median and 95th percentile of step time and throughput."""
    return exact_percentiles(steps, STEP_METRICS, SHARES, by)


def derived_throughput(
    steps: DataFrame, batch_size: int, world: int | Column, seq_len: int
) -> DataFrame:
    """Samples and tokens per second from step times; a step of no time has no rate."""
    world = F.lit(world) if isinstance(world, int) else world
    samples = F.try_divide(world * batch_size, F.col("step_ms") / 1000.0)
    return steps.withColumns(
        {"derived_samples_per_sec": samples, "derived_tokens_per_sec": samples * seq_len}
    )


def runtime_range(runtimes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return runtimes.groupBy(*by).agg(
        F.min("train_runtime_sec").alias("min_runtime"),
        F.max("train_runtime_sec").alias("max_runtime"),
    )


def best_and_last(
    evaluations: DataFrame, by: Sequence[str] = (), order: Sequence[str] = ("file", "pos", "hit")
) -> DataFrame:
    """Best accuracy and the last one in file and line order."""
    return evaluations.groupBy(*by).agg(
        F.max("accuracy").alias("best_accuracy"),
        F.max_by("accuracy", F.struct(*order)).alias("last_accuracy"),
        F.count(F.lit(1)).alias("n_evaluations"),
    )


def last_inference(inferences: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The last inference record in file and line order."""
    fields = ["accuracy", "samples_per_sec", "tokens_per_sec"]
    return (
        inferences.groupBy(*by)
        .agg(F.max_by(F.struct(*fields), F.struct("file", "pos", "hit")).alias("_last"))
        .select(*by, "_last.*")
    )


def failures_by_file(
    failures: DataFrame, by: Sequence[str] = (), top: int = SHOWN_FILES
) -> DataFrame:
    """Files with most failure signatures, ties by file name."""
    counts = failures.groupBy(*by, "file").agg(F.count(F.lit(1)).alias("n_hits"))
    return first_rows(counts, by, [F.desc("n_hits"), "file"], top, "place")


def failure_samples(
    failures: DataFrame,
    by: Sequence[str] = (),
    n: int = SHOWN_FAILURES,
    order: Sequence[str] = ("file", "pos", "hit"),
) -> DataFrame:
    """The first failures in file and line order, with how many follow."""
    totals = failures.groupBy(*by).agg(F.count(F.lit(1)).alias("_all"))
    shown = first_rows(failures, by, list(order), n, "place").select(
        *by, "place", "file", "signature"
    )
    more = F.greatest(F.col("_all") - n, F.lit(0)).alias("n_more")
    if by:
        return shown.join(totals, list(by)).select(*by, "place", "file", "signature", more)
    return shown.withColumn("_all", totals.scalar()).select("place", "file", "signature", more)


def verdict(
    rendezvous: DataFrame,
    ranks: DataFrame,
    failures: DataFrame,
    by: Sequence[str] = (),
    runs: DataFrame | None = None,
) -> DataFrame:
    """Whether a run is complete and clean, with the facts behind it.

    A run passes when a rendezvous and ranks were seen, with one world size, no rank
    below it missing, and no failure signature. The facts come as counts under a
    name, so runs without one of them need no outer join. ``runs`` adds runs that may
    have left no record at all.
    """

    def fact(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).withColumn("_fact", F.lit(name))

    facts = [
        fact(rendezvous, "n_rendezvous"),
        fact(ranks.select(*by, "rank").distinct(), "n_ranks"),
        fact(ranks.select(*by, "world_size").distinct(), "n_world_sizes"),
        missing_gaps(ranks, by)
        .groupBy(*by)
        .agg(F.coalesce(F.sum(F.col("high") - F.col("low") + 1), F.lit(0)).alias("_n"))
        .withColumn("_fact", F.lit("n_missing")),
        fact(failures, "n_failures"),
    ]
    if runs is not None:
        facts.append(fact(runs.select(*by).distinct(), "n_runs"))
    union = facts[0]
    for other in facts[1:]:
        union = union.unionByName(other)
    names = ["n_rendezvous", "n_ranks", "n_world_sizes", "n_missing", "n_failures"]
    table = union.groupBy(*by).agg(
        *[
            F.coalesce(F.max(F.when(F.col("_fact") == n, F.col("_n"))), F.lit(0)).alias(n)
            for n in names
        ]
    )
    passed = (
        (F.col("n_rendezvous") > 0)
        & (F.col("n_ranks") > 0)
        & (F.col("n_world_sizes") == 1)
        & (F.col("n_missing") == 0)
        & (F.col("n_failures") == 0)
    )
    return table.withColumn("passed", passed)


def training_seconds(phases: DataFrame, by: Sequence[str] = ("job",)) -> DataFrame:
    """Training time of a run: the slowest rank's."""
    return (
        phases.filter(F.col("phase") == formats.TRAINING_PHASE)
        .groupBy(*by)
        .agg(F.max("seconds").alias("train_seconds"))
    )


def time_summary(
    runs: DataFrame, phases: DataFrame, meta: DataFrame, wall: DataFrame, missing: str = "NA"
) -> DataFrame:
    """One row and one line of text per run of ``runs(job)``.

    A missing training time prints as ``missing``, a missing description as ``?``,
    and a missing wall time is left out.
    """
    joined = (
        runs.select("job")
        .join(training_seconds(phases), "job", "left")
        .join(meta.select("job", "nnodes", "dataset"), "job", "left")
        .join(wall.select("job", "wall_seconds"), "job", "left")
    )

    def known(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit("?"))

    label = F.format_string(
        "N=%2s  dataset=%6s  job=%s", known("nnodes"), known("dataset"), known("job")
    )
    seconds = F.format_string("%.2fs", "train_seconds")
    train = F.when(F.col("train_seconds").isNotNull(), seconds).otherwise(F.lit(missing))
    wall_part = F.coalesce(F.format_string("  wall=%ds", "wall_seconds"), F.lit(""))
    wall_text = F.when(F.col("wall_seconds").isNotNull(), wall_part).otherwise(F.lit(""))
    line = F.concat(F.format_string("%-40s train=", label), train, wall_text)
    return joined.withColumn("summary", line)


def wall_status(start: Column, end: Column, return_code: Column) -> list[Column]:
    """Seconds between two epoch times, and success or failure by return code."""
    return [
        (end - start).alias("wall_seconds"),
        F.when(return_code == 0, "success").otherwise("failed").alias("status"),
    ]


def scaling(times: DataFrame) -> DataFrame:
    """Speed-up and efficiency per node count against the smallest one.

    ``times`` holds ``(nnodes, train_seconds)`` rows of runs; runs of one node count
    are averaged.
    """
    mean = (
        times.filter(F.col("nnodes").isNotNull() & F.col("train_seconds").isNotNull())
        .groupBy("nnodes")
        .agg(F.avg("train_seconds").alias("mean_seconds"), F.count(F.lit(1)).alias("n_runs"))
    )
    first_time = mean.agg(F.min_by("mean_seconds", "nnodes")).scalar()
    first_nodes = mean.agg(F.min("nnodes")).scalar()
    speedup = F.try_divide(first_time, F.col("mean_seconds"))
    efficiency = F.try_divide(speedup * first_nodes, F.col("nnodes"))
    return mean.withColumns({"speedup": speedup, "efficiency": efficiency})


def phase_breakdown(phases: DataFrame, by: Sequence[str] = ("job",)) -> DataFrame:
    """Seconds per known phase as columns, of all other phases, and of all, per run and rank."""
    names = {p: p.lower().replace(" ", "_") for p in formats.PHASES}
    other = ~F.coalesce(F.col("phase").isin(formats.PHASES), F.lit(False))
    return phases.groupBy(*by, "rank").agg(
        *(F.sum(F.when(F.col("phase") == p, F.col("seconds"))).alias(n) for p, n in names.items()),
        F.sum(F.when(other, F.col("seconds"))).alias("other_seconds"),
        F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("total_seconds"),
    )


def slowest_rank(breakdown: DataFrame, by: Sequence[str] = ("job",)) -> DataFrame:
    """The rank with the largest total per run, ties to the lower rank."""
    order = F.struct(F.col("total_seconds"), -F.col("rank"))
    return breakdown.groupBy(*by).agg(
        F.max_by("rank", order).alias("slowest_rank"),
        F.max("total_seconds").alias("slowest_seconds"),
    )


def _curve_order(curve: DataFrame) -> list[str]:
    """Steps in order, equal ones by where they stand in the log."""
    return ["step", *(c for c in ("file", "pos") if c in curve.columns)]


def curve_ends(curve: DataFrame, by: Sequence[str] = ("job", "rank")) -> DataFrame:
    """First and last loss by step, and the number of points."""
    place = F.struct(*_curve_order(curve))
    return curve.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.min("step").alias("first_step"),
        F.max("step").alias("last_step"),
        F.min_by("loss", place).alias("first_loss"),
        F.max_by("loss", place).alias("last_loss"),
    )


def curve_changes(curve: DataFrame, by: Sequence[str] = ("job", "rank")) -> DataFrame:
    """Change of the loss since the step before, for curves of any length."""
    stepped = with_previous(curve, list(by), _curve_order(curve), "loss", "_before")
    return stepped.withColumn("loss_change", F.col("loss") - F.col("_before")).drop("_before")

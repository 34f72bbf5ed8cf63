"""Log lines rendered from the event table, for queries that parse them back.

Each event becomes one line of a run: the user is the job, and the event type says
what the line reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.functions import formats

RANKS = 8


def _pick(number: Column, n: int, *choices: Column) -> Column:
    result = None
    for i, choice in enumerate(choices[:-1]):
        test = F.pmod(number, F.lit(n)) == i
        result = F.when(test, choice) if result is None else result.when(test, choice)
    return result.otherwise(choices[-1])


def _base(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("job"),
        F.col("event_id").alias("pos"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.pmod("event_id", F.lit(RANKS)).cast("int").alias("r"),
        F.col("event_id").alias("e"),
        F.col("user_id").alias("u"),
        F.col("value").alias("v"),
        "event_type",
    )


def run_lines(events: DataFrame) -> DataFrame:
    """``(job, file, pos, ts, line)``: banners, steps, results and failures."""
    e, u, v, r = (F.col(c) for c in "euvr")
    world = _pick(u, 3, F.when(e % 2 == 0, 4).otherwise(8), F.lit(8), F.lit(32))
    rank = F.format_string("[RANK %d] WORLD_SIZE=%d", r, world)
    node = F.when(u % 7 == 0, e % 6).otherwise(u % 5)
    rendezvous = F.format_string(
        "torchrun: nnodes=%d nproc_per_node=4 node_rank=%d rdzv=node%d:29500",
        u % 2 + 2,
        e % 4,
        node,
    )
    sanity = F.format_string(
        "NODE n%d OK -> PY 3.11.%d torch 9.1.%d tfm 8.20.3 numpy 7.5.%d datasets 6.0.1 "
        "root /run/%s",
        e % 5,
        u % 2,
        e % 3,
        F.floor(e / 4) % 2,
        "job",
    )
    bar = F.when(e % 5 == 0, " 31%|xxx       | 5/16 [00:03<00:07, 1.50it/s]").otherwise("")
    step = F.format_string(
        "%s[rank %d | step %d] step_ms=%.2f samples_per_sec=%.2f tokens_per_sec=%.2f",
        bar,
        r,
        e,
        v,
        v + 100,
        (v + 100) * 128,
    )
    result = _pick(
        e,
        3,
        F.format_string("[RANK %d] TRAIN_RUNTIME_SEC=%.3f", r, v),
        F.when(e % 2 == 0, F.format_string("EVAL accuracy=%.5f", v / 1000)).otherwise(
            F.format_string(
                "[rank %d | step %d] eval_loss=0.1 eval_accuracy=%.5f epoch=1.0", r, e, v / 1000
            )
        ),
        F.format_string(
            "[RANK 0] INFER global_accuracy=%.4f global_samples_per_sec=%d.5 "
            "global_tokens_per_sec=%d.0",
            e % 1000 / 1000,
            e,
            e * 128,
        ),
    )
    failure = F.when(u % 4 == 1, F.format_string("note: retry %d", e)).otherwise(
        _pick(
            e,
            4,
            F.lit("Traceback (most recent call last):"),
            F.lit("RuntimeError: Address already in use"),
            F.lit("rendezvous timed out"),
            F.lit("OSError: read Error"),
        )
    )
    line = (
        F.when(F.col("event_type") == "view", rank)
        .when(F.col("event_type") == "click", step)
        .when(F.col("event_type") == "purchase", result)
        .when(F.col("event_type") == "error", failure)
        .otherwise(F.when(e % 2 == 0, rendezvous).otherwise(sanity))
    )
    file = F.format_string("train.%s.%d.out", "job", "r")
    return _base(events).select("job", file.alias("file"), "pos", "ts", line.alias("line"))


def pair_lines(events: DataFrame) -> DataFrame:
    """``(pos, line)``: one ``key=value`` training line per event."""
    line = F.format_string(
        "[rank %d | step %d] loss=%.4f grad_norm=%.2f learning_rate=%.6f epoch=%.3f",
        F.col("r"),
        F.col("e"),
        F.col("v") / 100,
        F.col("v"),
        F.lit(0.000321),
        F.col("e") % 1000 / 1000,
    )
    return _base(events).select("pos", line.alias("line"))


def phase_lines(events: DataFrame) -> DataFrame:
    """``(job, rank, line)``: one phase timing per event; every tenth job never trains."""
    names = F.array(*[F.lit(p) for p in formats.PHASES])
    phase = F.get(names, F.pmod("e", F.lit(len(formats.PHASES))).cast("int"))
    shown = F.when((F.col("u") % 10 == 9) & (phase == formats.TRAINING_PHASE), F.lit("Evaluation"))
    line = F.format_string("[%s] %.2f sec", F.coalesce(shown, phase), F.col("v"))
    rank = F.pmod(F.floor(F.col("e") / 5), F.lit(RANKS)).cast("int")
    return _base(events).select("job", rank.alias("rank"), line.alias("line"))


def host_step_lines(events: DataFrame) -> DataFrame:
    """``(pos, line)``: one host step line per event."""
    line = F.format_string(
        "[n%d] rank=%d step %d %.3fs", F.col("u"), F.col("r"), F.col("e"), F.col("v")
    )
    return _base(events).select("pos", line.alias("line"))


def dictionary_lines(events: DataFrame) -> DataFrame:
    """``(job, pos, line)``: what a trainer prints, a dictionary behind a progress bar."""
    e, v = F.col("e"), F.col("v")
    step = F.format_string(
        "{'loss': %.4f, 'grad_norm': %s, 'learning_rate': 0.000321, 'epoch': %.3f}",
        v / 100,
        F.when(e % 10 == 7, F.lit("nan")).otherwise(F.format_string("%.2f", v)),
        e % 1000 / 1000,
    )
    last = F.format_string(
        "{'train_runtime': %.2f, 'train_samples_per_second': %d, 'host': 'n%d', 'done': %s}",
        v,
        e,
        F.col("u"),
        F.when(e % 2 == 0, "True").otherwise("None"),
    )
    line = F.concat(F.lit(" 31%|xxx       | 5/16 "), F.when(F.col("event_type") == "click", step).otherwise(last))
    return _base(events).select("job", "pos", line.alias("line"))


def pipeline_step_lines(events: DataFrame) -> DataFrame:
    """``(job, pos, line)``: one line of a pipeline's training loop per event."""
    line = F.format_string(
        "rank 3: ep=%d step=%d loss=%.4f (+%.1fs)", F.col("e") % 3, F.col("e"), F.col("v") / 100,
        F.col("r").cast("double"),
    )
    return _base(events).select("job", "pos", line.alias("line"))


def preflight_lines(events: DataFrame) -> DataFrame:
    """``(job, file, pos, line)``: what a host could see, by event; one part may lack."""
    seen = F.when(F.col("v") > 20, "ok").otherwise("missing")
    parts = _pick(
        F.col("e"),
        3,
        F.format_string("proj=%s pkgs=ok", seen),
        F.lit("proj=ok pkgs=ok"),
        F.format_string("pkgs=%s", seen),
    )
    line = F.concat(F.format_string("n%d ", F.col("e") % 40), parts)
    file = F.format_string("preflight.%s.txt", "job")
    return _base(events).select("job", file.alias("file"), "pos", line.alias("line"))


def run_facts(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Descriptions ``(job, nnodes, dataset)`` and wall times per job; some lack."""
    u = F.col("user_id")
    runs = events.groupBy("user_id").agg(
        F.unix_seconds(F.min("ts").cast("timestamp")).alias("t_start"),
        F.unix_seconds(F.max("ts").cast("timestamp")).alias("t_end"),
    )
    described = u % 6 != 5
    meta = runs.select(
        u.cast("string").alias("job"),
        F.when(described, _pick(u, 3, F.lit(5), F.lit(10), F.lit(20))).alias("nnodes"),
        F.when(described & (u % 4 != 0), F.format_string("ds%d", u % 5)).alias("dataset"),
    )
    wall = runs.select(
        u.cast("string").alias("job"),
        F.when(u % 5 != 3, F.col("t_end") - F.col("t_start")).alias("wall_seconds"),
    )
    return meta, wall

import random

import pytest
from pyspark.sql import functions as F

from quillrun.functions import formats
from quillrun.functions import lines as ln
from quillrun.operators import run_records as rec
from quillrun.operators import run_reports as rep
from quillrun.plans.run_report import run_report

CLEAN = [
    "torchrun: nnodes=1 nproc_per_node=2 node_rank=0 rdzv=n1:29500",
    "[RANK 0] WORLD_SIZE=2",
    "[RANK 1] WORLD_SIZE=2",
    "NODE n1 OK -> PY 3.11.1 torch 9.1.1 tfm 8.20.3 numpy 7.5.4 datasets 6.0.1 root /x",
    "[rank 0 | step 1] step_ms=10.00 samples_per_sec=100.00 tokens_per_sec=12800.00",
    " 8%|# | 2/9 [00:01][rank 1 | step 1] step_ms=20.00 samples_per_sec=50.00 tokens_per_sec=6400.00",
    "[RANK 0] TRAIN_RUNTIME_SEC=25.000",
    "EVAL accuracy=0.2500",
    "[rank 0 | step 2] eval_loss=1.2 eval_accuracy=0.5 epoch=1.0",
    "[RANK 0] INFER global_accuracy=0.8730 global_samples_per_sec=1234.5 global_tokens_per_sec=158016.0",
]
VARIANTS = {
    "clean": CLEAN,
    "no_rendezvous": CLEAN[1:],
    "no_ranks": [CLEAN[0], *CLEAN[3:]],
    "two_worlds": [*CLEAN, "[RANK 1] WORLD_SIZE=4"],
    "missing_rank": [line for line in CLEAN if line != "[RANK 1] WORLD_SIZE=2"],
    "failed": [*CLEAN, "RuntimeError: Address already in use, timed out"],
    "silent": ["nothing of note"],
}


@pytest.fixture(scope="module")
def lines(spark):
    data = [
        (job, f"x.{job}.0.out", i, line)
        for job, text in VARIANTS.items()
        for i, line in enumerate(text)
    ]
    return spark.createDataFrame(data, "job string, file string, pos int, line string")


def records(lines, kind, job="clean"):
    return rec.records(lines.filter(F.col("job") == job), kind)


def test_records_of_each_kind(lines, rows):
    assert rows(records(lines, "rank"), "rank", "world_size") == [(0, 2), (1, 2)]
    assert rows(records(lines, "rendezvous"), "nnodes", "nproc_per_node", "node_rank", "endpoint") == [
        (1, 2, 0, "n1:29500")
    ]
    assert rows(records(lines, "sanity"), "host", "python", "datasets", "root") == [
        ("n1", "3.11.1", "6.0.1", "/x")
    ]
    assert rows(records(lines, "step"), "rank", "step_ms") == [(0, 10.0), (1, 20.0)]
    assert rows(records(lines, "runtime"), "train_runtime_sec") == [(25.0,)]
    assert rows(records(lines, "evaluation"), "accuracy") == [(0.25,), (0.5,)]
    assert rows(records(lines, "inference"), "accuracy", "tokens_per_sec") == [(0.873, 158016.0)]
    assert rows(records(lines, "failure", "failed"), "hit", "signature") == [
        (0, "RuntimeError"), (1, "Address already in use"), (2, "timed out"),
    ]


def test_one_pass_gives_the_same_records(lines):
    matches = rec.all_records(lines)
    for kind in rec.KINDS:
        direct = rec.records(lines, kind)
        assert rec.of_kind(matches, kind).select(direct.columns).exceptAll(direct).count() == 0
        assert rec.of_kind(matches, kind).count() == direct.count()


def test_lines_that_look_alike_give_nothing(spark):
    texts = [
        "[RANK 0] INFER global_accuracy=NA",
        "PY 3.11 torch 2 tfm 4 ds 2",
        "[rank 0 | step 1] loss=1.3802 grad_norm=1.44",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "line string")
    for kind in ("inference", "sanity", "step"):
        assert rec.records(df, kind).count() == 0


def test_verdict_clauses(lines):
    kinds = [rec.records(lines, k) for k in ("rendezvous", "rank", "failure")]
    by_job = rep.verdict(*kinds, ["job"], lines.select("job")).collect()
    assert {r.job: r.passed for r in by_job} == {job: job == "clean" for job in VARIANTS}
    one = rep.verdict(*[records(lines, k) for k in ("rendezvous", "rank", "failure")]).collect()
    assert [r.passed for r in one] == [True]
    silent = rep.verdict(*[records(lines, k, "silent") for k in ("rendezvous", "rank", "failure")])
    assert [r.passed for r in silent.collect()] == [False]


def test_missing_ranks_show_fifteen(spark):
    seen = spark.createDataFrame([("a", 3, 40), ("b", 0, 2), ("b", 1, 2), ("c", 0, 2), ("c", 0, 3)],
                                 "job string, rank int, world_size int")
    got = {r.job: r for r in rep.missing_summary(seen, ["job"]).collect()}
    assert set(got) == {"a"}
    expected = [r for r in range(40) if r != 3]
    assert got["a"].n_missing == 39
    assert got["a"].shown == ", ".join(map(str, expected[:15])) + " ..."
    single = rep.missing_summary(seen.filter("job = 'a'").drop("job")).collect()
    assert single[0].n_missing == 39 and single[0].shown == got["a"].shown


def test_drift_and_last_sanity(spark):
    def line(host, torch, numpy):
        return (f"NODE {host} OK -> PY 3.11.1 torch {torch} tfm 4 numpy {numpy} datasets 2 root /x",)

    data = [line("n1", "2.0", "1.0"), line("n2", "2.1", "1.0"), line("n1", "2.2", "1.0")]
    df = spark.createDataFrame([("f", i, *d) for i, d in enumerate(data)], "file string, pos int, line string")
    drift = {(r.component, r.version, r.n_hosts) for r in rep.version_drift(rec.records(df, "sanity")).collect()}
    assert drift == {("torch", "2.1", 1), ("torch", "2.2", 1)}


def test_preflight(spark, rows):
    data = ["n1 proj=ok pkgs=ok", "n2 proj=ok", "", "n3 pkgs=ok proj=missing", "n3 proj=ok pkgs=ok"]
    df = spark.createDataFrame([("p", i, d) for i, d in enumerate(data)], "file string, pos int, line string")
    found = rec.preflight_records(df)
    assert rows(rep.preflight_status(found), "host", "proj", "pkgs", "status") == [
        ("n1", "ok", "ok", "OK"),
        ("n2", "ok", "missing", "STAGED/MISSING"),
        ("n3", "ok", "ok", "OK"),
    ]
    total = rep.preflight_totals(found).first()
    assert (total.n_ready, total.n_hosts) == (2, 3)


def test_failures_top_files_and_samples(spark, rows):
    data = [(f"f{i % 7}", i, 0, "ERROR") for i in range(30)] + [("f0", 99, 0, "Timed out")]
    df = spark.createDataFrame(data, "file string, pos int, hit int, signature string")
    top = rep.failures_by_file(df).orderBy("place").collect()
    assert [(r.file, r.n_hits) for r in top] == [("f0", 6), ("f1", 5), ("f2", 4), ("f3", 4), ("f4", 4)]
    shown = rep.failure_samples(df).orderBy("place").collect()
    assert [r.file for r in shown] == ["f0"] * 6 + ["f1"] * 2
    assert {r.n_more for r in shown} == {23}


def test_last_means_file_then_line(lines):
    row = rep.best_and_last(records(lines, "evaluation")).first()
    assert (row.best_accuracy, row.last_accuracy) == (0.5, 0.5)
    assert rep.last_inference(records(lines, "inference")).first().accuracy == 0.873


def test_pairs_last_key_wins(spark):
    line = "x=0 [rank 1 | step 7] loss=1.347 grad_norm=0.47 loss=1.2 bad=1.2.3"
    df = spark.createDataFrame([(line,)], "line string")
    row = df.select(
        ln.pairs(F.col("line")).alias("m"),
        ln.last_number(F.col("line"), "loss").alias("loss"),
        ln.last_number(F.col("line"), "norm").alias("norm"),
        ln.number(ln.pairs(F.col("line")), "bad").alias("bad"),
    ).first()
    assert row.m == {"x": "0", "loss": "1.2", "grad_norm": "0.47", "bad": "1.2.3"}
    assert (row.loss, row.norm, row.bad) == (1.2, None, None)


def test_training_curve_ends_and_changes(spark):
    draw = random.Random(5)
    losses = {(rank, step): draw.random() for rank in (0, 1) for step in range(1, 40)}
    data = [
        (f"bar[rank {r} | step {s}] loss={v} grad_norm=1.0 learning_rate=4e-4 epoch=0.1",)
        for (r, s), v in losses.items()
    ] + [("[rank 0 | step 40] step_ms=1.0",)]
    curve = rec.training_curve(spark.createDataFrame(data, "line string"))
    ends = {r["rank"]: r for r in rep.curve_ends(curve, ["rank"]).collect()}
    assert ends[0].n_points == 39 and ends[1].last_loss == losses[1, 39]
    for r in rep.curve_changes(curve, ["rank"]).collect():
        before = losses.get((r["rank"], r.step - 1))
        expected = None if before is None else losses[r["rank"], r.step] - before
        assert r.loss_change == expected


def test_curves_of_jobs_are_apart_and_ties_go_by_place(spark):
    rows = [("a", 0, 1, 5.0, 0), ("b", 0, 1, 99.0, 0), ("a", 0, 1, 4.0, 1), ("a", 0, 2, 3.0, 2)]
    curve = spark.createDataFrame(
        rows, "job string, rank int, step long, loss double, pos long"
    ).withColumn("file", F.lit("f"))
    got = {(r.job, r.pos): r.loss_change for r in rep.curve_changes(curve).collect()}
    assert got == {("a", 0): None, ("a", 1): -1.0, ("a", 2): -1.0, ("b", 0): None}
    ends = {r.job: (r.first_loss, r.last_loss) for r in rep.curve_ends(curve).collect()}
    assert ends == {"a": (5.0, 3.0), "b": (99.0, 99.0)}


def test_a_malformed_world_size_costs_nothing(spark):
    size = 2147483647
    rows = [("x", 0, size), ("x", 3, size), ("x", 7, size), ("y", 9, 4), ("z", 0, 1), ("v", 0, 2), ("v", 1, 3)]
    seen = spark.createDataFrame(rows, "job string, rank int, world_size int")
    got = {r.job: (r.n_missing, r.shown) for r in rep.missing_summary(seen, ["job"]).collect()}
    shown = [i for i in range(1, 20) if i not in (3, 7)][:15]
    assert got == {"x": (size - 3, ", ".join(map(str, shown)) + " ..."), "y": (4, "0, 1, 2, 3")}
    small = rep.missing_ranks(seen.filter("job = 'y'"), ["job"])
    assert sorted(r["rank"] for r in small.collect()) == [0, 1, 2, 3]


def test_all_phases_count_in_the_total(spark):
    data = [("j", 1, "Training", 1.0), ("j", 1, "Checkpoint", 100.0), ("j", 0, "Training", 5.0)]
    found = rep.phase_breakdown(
        spark.createDataFrame(data, "job string, rank int, phase string, seconds double")
    )
    got = {r["rank"]: (r.training, r.other_seconds, r.total_seconds) for r in found.collect()}
    assert got == {1: (1.0, 100.0, 101.0), 0: (5.0, None, 5.0)}
    assert rep.slowest_rank(found).first().slowest_rank == 1


def test_time_summary_text(spark):
    runs = spark.createDataFrame([("1",), ("2",)], "job string")
    phases = spark.createDataFrame(
        [("1", "Training", 10.5), ("1", "Training", 12.0), ("2", "Tokenization", 1.0)],
        "job string, phase string, seconds double",
    )
    meta = spark.createDataFrame([("1", 8, "medium")], "job string, nnodes int, dataset string")
    wall = spark.createDataFrame([("1", 90)], "job string, wall_seconds long")
    got = {r.job: r.summary for r in rep.time_summary(runs, phases, meta, wall).collect()}
    assert got["1"] == f"{'N= 8  dataset=medium  job=1':<40} train=12.00s  wall=90s"
    assert got["2"] == f"{'N= ?  dataset=     ?  job=2':<40} train=NA"


def test_scaling_against_the_smallest(spark):
    times = spark.createDataFrame([(10, 60.0), (5, 100.0), (5, 120.0), (20, 55.0), (None, 1.0)],
                                  "nnodes int, train_seconds double")
    got = {r.nnodes: r for r in rep.scaling(times).collect()}
    assert got[5].speedup == 1.0 and got[5].efficiency == 1.0
    assert got[10].speedup == pytest.approx(110 / 60)
    assert got[20].efficiency == pytest.approx(2.0 * 5 / 20)


def test_derived_throughput_without_time(spark):
    steps = spark.createDataFrame([(500.0,), (0.0,)], "step_ms double")
    got = rep.derived_throughput(steps, 8, 2, 128).collect()
    assert (got[0].derived_samples_per_sec, got[0].derived_tokens_per_sec) == (32.0, 4096.0)
    assert got[1].derived_samples_per_sec is None


def test_phase_breakdown(spark):
    names = formats.PHASES
    data = [("j", r, p, float(r + i)) for r in (0, 1) for i, p in enumerate(names)]
    found = rep.phase_breakdown(
        spark.createDataFrame(data, "job string, rank int, phase string, seconds double")
    )
    row = rep.slowest_rank(found).first()
    assert (row.slowest_rank, row.slowest_seconds) == (1, 15.0)


def test_wall_status(spark):
    df = spark.createDataFrame([(10, 25, 0), (5, 6, 1)], "a long, b long, rc int")
    got = df.select(*rep.wall_status(F.col("a"), F.col("b"), F.col("rc"))).collect()
    assert [tuple(r) for r in got] == [(15, "success"), (1, "failed")]


def test_excerpts(spark):
    data = [(i, f"[RANK {i % 5}] WORLD_SIZE=5") for i in range(20)] + [(99, " [RANK 9] x")]
    df = spark.createDataFrame(data, "pos int, line string")
    got = [r.line for r in rec.sorted_excerpt(df, formats.EXCERPT_RANKS, 3).collect()]
    assert got == [f"[RANK {i}] WORLD_SIZE=5" for i in (2, 3, 4)]
    first = rec.first_excerpt(df, formats.EXCERPT_RANKS, ["pos"], 2).collect()
    assert [r.pos for r in first] == [0, 1]


def test_whole_report(lines, tmp_path):
    report = run_report(lines, folder=str(tmp_path / "records"), runs=lines.select("job"))
    got = {(r.job, r.section, r.key): r.value for r in report.collect()}
    assert got["clean", "RANKS", "count"] == 2.0
    assert got["clean", "THROUGHPUT", "step_ms_p50"] == 15.0
    assert got["clean", "VERDICT", "pass"] == 1.0
    assert got["failed", "VERDICT", "failures"] == 3.0
    assert got["silent", "VERDICT", "pass"] == 0.0
    assert got["clean", "RDZV", "nnodes=1 nproc_per_node=2 endpoint=n1:29500"] == 1.0

"""Dictionaries that trainers print, pipeline steps, many jobs at once, details in words."""

from quillrun.operators import run_records as rec
from quillrun.plans.run_report import run_report_details
from quillrun.sources import run_files

LINES = [
    " 8%|8 | 10/125 [00:07<00:56]{'loss': 1.347, 'grad_norm': 0.47, 'learning_rate': 0.00046, 'epoch': 0.08}",
    "{'train_runtime': 25.0008, 'train_steps_per_second': 5.0, 'steps': 125}{'loss': nan, 'note': None, 'ok': True}",
    "{'loss': -inf, 'name': 'a True, None, nan'}",
    "no dictionary {here} {'broken': } {'also': broken}",
    "[rank 0 | step 10] loss=1.347",
    None,
    "x ep=0 step=10 loss=9.1234 (+12.5s) y ep=1 step=20 loss=nan (+0.5s)",
]


def lines_of(spark):
    return spark.createDataFrame([("j", n, x) for n, x in enumerate(LINES)], "job string, pos int, line string")


def test_dictionaries_keep_keys_and_types(spark):
    found = rec.dictionary_records(lines_of(spark))
    values = {(r.pos, r.hit, r.key): (r.value, r.number) for r in rec.dictionary_values(found).collect()}
    assert values[0, 0, "loss"] == ("1.347", 1.347)
    assert values[1, 0, "steps"] == ("125", 125.0)
    assert values[1, 1, "note"] == (None, None)
    assert values[1, 1, "ok"] == ("true", None)
    text, number = values[1, 1, "loss"]
    assert text == "nan" and (number is None or number != number)
    assert values[2, 0, "name"][1] is None
    assert {p for p, _, _ in values} == {0, 1, 2}
    schema = rec.dictionary_schema(found)
    assert "train_runtime" in schema and "loss" in schema


def test_pipeline_steps(spark):
    rows = rec.records(lines_of(spark), "pipeline_step").orderBy("hit").collect()
    assert [(r.epoch, r.step, r.seconds) for r in rows] == [(0, 10, 12.5), (1, 20, 0.5)]
    assert rows[0].loss == 9.1234 and rows[1].loss != rows[1].loss


def test_many_jobs_in_one_scan(spark, tmp_path):
    for name, text in {
        "train.7.0.out": "a\n", "train.8.1.out": "b\nc\n", "train.78.0.out": "not asked\n", "other.txt": "x\n"
    }.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "preflight.7.txt").write_text("n1 proj=ok pkgs=ok\n")
    (tmp_path / "preflight.8.txt").write_text("n2 proj=ok\n")
    got = run_files.read_logs(spark, str(tmp_path), ["7", "8", "9", "7"]).collect()
    assert sorted((r.job, r.file, r.line) for r in got) == [
        ("7", "train.7.0.out", "a"), ("8", "train.8.1.out", "b"), ("8", "train.8.1.out", "c")
    ]
    seen = run_files.read_preflight(spark, str(tmp_path), ["7", "8"]).collect()
    assert sorted((r.job, r.line.split()[0]) for r in seen) == [("7", "n1"), ("8", "n2")]


def test_details_in_words(spark):
    log = [
        ("j", "f", 1, "torchrun: nnodes=2 nproc_per_node=1 node_rank=0 rdzv=a:1"),
        ("j", "f", 2, "torchrun: nnodes=2 nproc_per_node=1 node_rank=1 rdzv=b:1"),
        ("j", "f", 3, "[RANK 0] WORLD_SIZE=3"),
        *[("j", "f", 10 + n, "RuntimeError: x") for n in range(10)],
    ]
    preflight = [("j", "p", 1, "n1 proj=ok pkgs=ok"), ("j", "p", 2, "n2 proj=ok")]
    schema = "job string, file string, pos long, line string"
    report = run_report_details(
        spark.createDataFrame(log, schema), spark.createDataFrame(preflight, schema)
    ).collect()
    said = {(r.section, r.key): r.text for r in report}
    assert said["RDZV", "configs"] == "inconsistent"
    assert said["RANKS", "world sizes"] == "consistent"
    assert said["RANKS", "missing"] == "1, 2"
    assert said["FAILURES", "1"] == "f: RuntimeError" and said["FAILURES", "more"] == "(+2 more)"
    assert said["PREFLIGHT", "n2"].endswith("STAGED/MISSING") and said["PREFLIGHT", "n1"].endswith("OK")

import json

import pytest
from pyspark.sql import functions as F

from quillrun.operators import encoding
from quillrun.sources import run_files, sinks, tables


def write(path, text, binary=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text) if binary else path.write_bytes(text.encode())
    return str(path)


def test_line_rules(spark, tmp_path):
    path = write(tmp_path / "a.out", "x\ry\nz\n\n")
    assert [r.line for r in run_files.read_lines(spark, path).orderBy("pos").collect()] == [
        "x", "y", "z", "",
    ]
    assert run_files.read_lines(spark, path, sep="\n").count() == 3
    open_end = write(tmp_path / "b.out", "p\r\nq")
    assert [r.line for r in run_files.read_lines(spark, open_end).orderBy("pos").collect()] == ["p", "q"]


def test_undecodable_bytes_are_replaced(spark, tmp_path):
    path = write(tmp_path / "a.out", b"ok \xff end\n", binary=True)
    assert run_files.read_lines(spark, path).first().line == "ok � end"


def test_line_numbers_over_many_blocks(spark, tmp_path):
    text = "\n".join(f"line {i}" for i in range(5000))
    path = write(tmp_path / "big.txt", text)
    other = write(tmp_path / "small.txt", "line 0\nline 1\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = run_files.read_lines(spark, [path, other])
        assert lines.select("pos.block").distinct().count() > 3
        numbered = run_files.with_line_numbers(lines).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(numbered) == 5002
    assert all(r.line == f"line {r.line_no}" for r in numbered)


def test_queries_file(spark, tmp_path):
    path = write(tmp_path / "q.txt", "  first one \n\n\t\nsecond\n   \nthird")
    got = run_files.read_queries(spark, path).orderBy("query_id").collect()
    assert [(r.query_id, r.text) for r in got] == [(0, "first one"), (1, "second"), (2, "third")]


def test_corpus_encoded_or_raw(spark, tmp_path):
    path = write(tmp_path / "raw.txt", "aa bb\n\naa cc dd\n")
    with pytest.raises(ValueError):
        run_files.read_corpus(spark, path, max_len=3)
    encoded = run_files.read_corpus(spark, path, max_len=3, fit_terms=100)
    assert encoding.is_encoded(encoded)
    assert sorted(r.input_ids for r in encoded.collect()) == [[0, 0, 0], [2, 3, 0], [2, 4, 5]]
    stored = tables.materialize(encoded, str(tmp_path / "stored"))
    again = run_files.read_corpus(spark, str(tmp_path / "stored"), max_len=3)
    assert again.exceptAll(stored).count() == 0 and again.count() == 3
    raw = spark.createDataFrame([(1, "aa bb")], "id long, text string")
    tables.materialize(raw, str(tmp_path / "raw_table"))
    row = run_files.read_corpus(spark, str(tmp_path / "raw_table"), max_len=3, fit_terms=9).first()
    assert (row.id, row.input_ids) == (1, [2, 3, 0])


def test_labeled_scan_reads_one_split(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "a", 0, "train"), (2, "b", 1, "test")], "id long, text string, label int, split string"
    )
    df.write.partitionBy("split").parquet(str(tmp_path / "news"))
    got = tables.read_labeled(spark, str(tmp_path / "news"), "test")
    assert [tuple(r) for r in got.collect()] == [(2, "b", 1)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_logs_by_job(spark, tmp_path):
    write(tmp_path / "tiny.7.n1.0.out", "b1\n")
    write(tmp_path / "tiny.7.n0.0.out", "a1\na2\n")
    write(tmp_path / "tiny.8.n0.0.out", "other\n")
    got = run_files.read_logs(spark, str(tmp_path), "7").orderBy("file", "pos").collect()
    assert [(r.job, r.file, r.line) for r in got] == [
        ("7", "tiny.7.n0.0.out", "a1"),
        ("7", "tiny.7.n0.0.out", "a2"),
        ("7", "tiny.7.n1.0.out", "b1"),
    ]
    with pytest.raises(FileNotFoundError):
        run_files.read_logs(spark, str(tmp_path), "9")
    assert run_files.read_preflight(spark, str(tmp_path), "7").count() == 0


def test_run_meta_prefers_final_and_survives_bad_files(spark, tmp_path):
    full = {"job_id": 1, "nnodes": 8, "lr": "5e-5", "seq_len": 768}
    write(tmp_path / "1" / "meta.json", json.dumps(full))
    write(tmp_path / "1" / "meta.final.json", json.dumps({**full, "status": "success", "wall_seconds": 90}))
    write(tmp_path / "2" / "meta.json", json.dumps({"job_id": "2", "nnodes": "4", "lr": 0.1}, indent=2))
    write(tmp_path / "3" / "meta.final.json", "{ broken")
    write(tmp_path / "3" / "meta.json", json.dumps({"job_id": "3"}))
    (tmp_path / "4").mkdir()
    folders = [str(tmp_path / str(i)) for i in range(1, 5)]
    got = {r.run: r for r in run_files.read_run_meta(spark, folders).collect()}
    assert (got["1"].status, got["1"].wall_seconds, got["1"].lr) == ("success", 90, 5e-5)
    assert (got["2"].nnodes, got["2"].lr, got["2"].status) == (4, 0.1, None)
    assert (got["3"].job_id, got["3"].nnodes) == ("3", None)
    assert got["4"].job_id is None
    none = run_files.read_run_meta(spark, folders[3:]).collect()
    assert len(none) == 1


def test_folders_of_one_name_stay_apart(spark, tmp_path):
    for side, nodes in (("a", 2), ("b", 3)):
        write(tmp_path / side / "83 71" / "meta.json", json.dumps({"nnodes": nodes, "host": side, "n": {"x": 1}}))
        write(tmp_path / side / "83 71" / "wallclock_seconds.txt", str(nodes * 10))
        write(tmp_path / side / "83 71" / "timing_rank0.log", "[Training] 1.00 sec")
    folders = [f"{tmp_path}/{s}/83 71" for s in ("a", "b")]
    meta = run_files.read_run_meta(spark, [*folders, folders[0] + "/"]).collect()
    assert sorted((r.run, r.nnodes, r.others["host"], r.others["n"]) for r in meta) == [
        ("83 71", 2, "a", '{"x":1}'), ("83 71", 3, "b", '{"x":1}')
    ]
    wall = run_files.read_wall(spark, folders).collect()
    assert sorted((r.run, r.wall_seconds) for r in wall) == [("83 71", 20), ("83 71", 30)]
    lines = run_files.read_timings(spark, folders).collect()
    assert {r.job for r in lines} == {"83 71"} and len({r.path for r in lines}) == 2


def test_wall_clock_files(spark, tmp_path):
    write(tmp_path / "1" / "wallclock_seconds.txt", " 120\n")
    write(tmp_path / "2" / "wallclock_seconds.txt", "12.5\n")
    write(tmp_path / "3" / "wallclock_seconds.txt", "")
    (tmp_path / "4").mkdir()
    folders = [str(tmp_path / str(i)) for i in range(1, 5)]
    got = {r.run: r.wall_seconds for r in run_files.read_wall(spark, folders).collect()}
    assert got == {"1": 120, "2": None, "3": None, "4": None}


def test_timing_files(spark, tmp_path):
    write(tmp_path / "5" / "timing_rank0.log", "Timings (sec)\n[Training] 10.50 sec\n")
    write(tmp_path / "5" / "timing_rank11.log", "Timings (sec)\n[Training] 12.00 sec\n")
    got = run_files.read_timings(spark, [str(tmp_path / "5")])
    assert {(r.job, r["rank"]) for r in got.collect()} == {("5", 0), ("5", 11)}
    assert got.count() == 4


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(0, "a"), (1, "b")], "rank int, line string")
    path = str(tmp_path / "logs")
    sinks.write_rank_text(df, path, truncate=True)
    sinks.write_rank_text(df.filter("rank = 1"), path)
    back = spark.read.text(path)
    assert back.filter(F.col("rank") == 1).count() == 2 and back.count() == 3
    sinks.write_rank_text(df, path, truncate=True)
    assert spark.read.text(path).count() == 2
    report = str(tmp_path / "report")
    sinks.write_json(df, report)
    sinks.write_json(df, report)
    assert spark.read.json(report).count() == 2

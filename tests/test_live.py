from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from quillrun.streaming import live

START = datetime(2024, 1, 1, 10, 0, tzinfo=timezone.utc)


def step(minute, rank, ms):
    line = f"[rank {rank} | step {minute}] step_ms={ms:.2f} samples_per_sec=8.00 tokens_per_sec=64.00"
    return ("j", f"j.{rank}.out", START + timedelta(minutes=minute), line)


def failure(minute, rank):
    return ("j", f"j.{rank}.out", START + timedelta(minutes=minute), "OSError: read Error")


def arrive(spark, folder, *batch):
    spark.createDataFrame(list(batch), live.LINE_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "lines")


def run(result, tmp_path):
    query = live.append_to_parquet(result, str(tmp_path / "rows"), str(tmp_path / "state"))
    query.awaitTermination()


def stored(spark, tmp_path, *columns):
    rows = spark.read.parquet(str(tmp_path / "rows")).select(*columns).collect()
    return sorted(tuple(r) for r in rows)


def test_closed_windows_and_a_late_line(spark, folder, tmp_path):
    def stream():
        return live.live_throughput(live.stream_lines(spark, folder), "1 minute", "5 minutes")

    arrive(spark, folder, step(0, 0, 10), step(0, 0, 30), step(1, 1, 5))
    run(stream(), tmp_path)
    assert stored(spark, tmp_path, "rank") == []
    arrive(spark, folder, step(20, 0, 1))
    run(stream(), tmp_path)
    assert stored(spark, tmp_path, "rank", "n_steps", "mean_step_ms") == [(0, 2, 20.0), (1, 1, 5.0)]
    arrive(spark, folder, step(0, 0, 999), step(21, 0, 1), step(40, 0, 1))
    run(stream(), tmp_path)
    got = stored(spark, tmp_path, "n_steps", "mean_step_ms")
    assert got == [(1, 1.0), (1, 1.0), (1, 5.0), (2, 20.0)]


def test_batch_and_stream_agree_on_failures(spark, folder, tmp_path):
    batch = [failure(m, m % 3) for m in range(9)] + [step(m, 0, 1) for m in range(9)]
    arrive(spark, folder, *batch[:6])
    arrive(spark, folder, *batch[6:])
    query = (
        live.live_failures(live.stream_lines(spark, folder, files_per_batch=1))
        .writeStream.outputMode("complete").format("memory").queryName("failures_seen")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    seen = {(r.file, r.n_failures) for r in spark.table("failures_seen").collect()}
    assert seen == {(f"j.{i}.out", 6) for i in range(3)}
    table = spark.createDataFrame(batch, live.LINE_SCHEMA)
    assert {(r.file, r.n_failures) for r in live.live_failures(table).collect()} == seen


def test_sliding_monitor(spark, folder):
    arrive(spark, folder, step(1, 0, 10), step(6, 0, 50), failure(7, 0))
    query = (
        live.polling_monitor(live.stream_lines(spark, folder))
        .writeStream.outputMode("update").format("memory").queryName("monitor_seen")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = spark.table("monitor_seen").orderBy("start").collect()
    assert [(r.n_steps, r.last_step, r.slowest_ms, r.n_failures) for r in rows] == [
        (1, 1, 10.0, 0), (2, 6, 50.0, 2), (1, 6, 50.0, 2),
    ]


def test_failure_windows(spark, folder, tmp_path):
    arrive(spark, folder, failure(0, 0), failure(1, 0), failure(2, 1), step(90, 0, 1))
    run(live.live_failure_windows(live.stream_lines(spark, folder)), tmp_path)
    assert stored(spark, tmp_path, "file", "n_failures") == [("j.0.out", 4), ("j.1.out", 2)]
    hours = spark.read.parquet(str(tmp_path / "rows")).select(F.hour("start")).distinct()
    assert hours.count() == 1


def test_several_steps_on_a_line_all_count(spark):
    job, file, ts, first = step(1, 0, 1)
    line = first + " 8%|#  | [rank 0 | step 2] step_ms=9.00 samples_per_sec=8.00 tokens_per_sec=64.00"
    lines = spark.createDataFrame([(job, file, ts, line)], live.LINE_SCHEMA)
    row = live.polling_monitor(lines, "10 minutes", "10 minutes").first()
    assert (row.n_steps, row.last_step, row.slowest_ms) == (2, 2, 9.0)

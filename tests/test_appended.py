"""Lines appended to open files, and the state of jobs with their silence."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from quillrun.streaming import appended, job_state, live

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def logs(tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    return folder


def drain(spark, logs, tmp_path, **options):
    """Runs the stream over what is there, then stops; the checkpoint stays."""
    query = (
        appended.stream_appended(spark, str(logs), **options)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "rows"))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "rows")).select("job", "file", "at", "line").collect()
    return sorted(tuple(r) for r in rows)


def test_nothing_is_lost_or_repeated(spark, logs, tmp_path):
    log = logs / "train.7.0.out"
    log.write_bytes(b"one\ntwo\r\nhal")
    (logs / "notes.txt").write_text("not a log\n")
    first = [("7", log.name, 0, "one"), ("7", log.name, 4, "two")]
    assert drain(spark, logs, tmp_path) == first
    with log.open("ab") as f:
        f.write("f\n\nfünf\n".encode())
    (logs / "train.8.1.out").write_text("other\n")
    second = sorted([*first, ("7", log.name, 9, "half"), ("7", log.name, 14, ""), ("7", log.name, 15, "fünf"),
                     ("8", "train.8.1.out", 0, "other")])
    assert drain(spark, logs, tmp_path) == second
    assert drain(spark, logs, tmp_path) == second


def test_files_cut_short_or_replaced_start_anew(spark, logs, tmp_path):
    log = logs / "train.7.0.out"
    log.write_text("a\nb\nc\n")
    drain(spark, logs, tmp_path)
    log.write_text("d\n")
    drain(spark, logs, tmp_path)
    log.write_text("x\ny\nz\nzz\n")  # longer than before, with other bytes
    lines = [line for *_, line in drain(spark, logs, tmp_path)]
    assert sorted(lines) == ["a", "b", "c", "d", "x", "y", "z", "zz"]


@pytest.mark.parametrize("piece_bytes", [1, 7, 1000])
def test_pieces_of_a_long_file(logs, piece_bytes):
    lines = [("x" * (n % 23)) for n in range(200)]
    (logs / "l.1.0.out").write_text("\n".join(lines) + "\nopen")
    reader = appended.AppendedLinesReader(str(logs), "*.out", piece_bytes)
    pieces = reader.partitions({}, reader.latestOffset())
    rows = [r for p in pieces for batch in reader.read(p) for r in batch.to_pylist()]
    assert [r["line"] for r in rows] == lines
    assert len({r["at"] for r in rows}) == len(lines)


def test_reader_without_files(logs):
    (logs / "l.1.0.out").write_text("no line end yet")
    reader = appended.AppendedLinesReader(str(logs), "*.out", 10)
    assert reader.latestOffset() == {}
    assert appended.AppendedLinesReader(str(logs / "none"), "*", 10).latestOffset() == {}


START = datetime(2024, 1, 1, 10, 0, tzinfo=timezone.utc)


def line(job, minute, text):
    return (job, f"x.{job}.0.out", START + timedelta(minutes=minute), text)


def step(n, ms):
    return f"[rank 0 | step {n}] step_ms={ms:.2f} samples_per_sec=8.00 tokens_per_sec=64.00"


def test_state_and_silence(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    folder = str(tmp_path / "lines")
    batches = [
        [line("a", 0, step(1, 5)), line("b", 0, step(1, 7)), line("a", 1, "OSError: read")],
        [line("b", 30, step(2, 3))],
        [line("b", 31, "nothing")],
        [line("a", 32, step(9, 4))],
    ]
    try:
        seen = []
        for n, batch in enumerate(batches):
            spark.createDataFrame(batch, live.LINE_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
            query = (
                job_state.live_job_states(live.stream_lines(spark, folder))
                .writeStream.outputMode("update")
                .foreachBatch(lambda df, _: seen.extend(map(tuple, df.withColumn("last_seen", F.minute("last_seen")).collect())))
                .option("checkpointLocation", str(tmp_path / "state"))
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
        assert ("a", 1, 1, 5.0, 1, 1, True) in seen  # silent while b goes on
        assert [r for r in seen if r[0] == "b"][-1] == ("b", 2, 2, 7.0, 0, 31, False)
        assert seen[-1] == ("a", 2, 9, 5.0, 1, 32, False)
        assert not any(r[-1] for r in seen if r[0] == "b")
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    table = spark.createDataFrame([r for b in batches[:3] for r in b], live.LINE_SCHEMA)
    states = {r.job: r for r in job_state.job_states(table).collect()}
    assert states["a"].silent and not states["b"].silent
    assert (states["a"].n_steps, states["a"].n_failures, states["b"].slowest_ms) == (1, 1, 7.0)

"""The latest state of every job, and its silence."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quillrun.operators import run_records as rec

STATE = "n_steps long, last_step long, slowest_ms double, n_failures long, seen_ms long"
OUTPUT = (
    "job string, n_steps long, last_step long, slowest_ms double, n_failures long, "
    "last_seen timestamp, silent boolean"
)


def marked_lines(lines: DataFrame) -> DataFrame:
    """``(job, ts, n_steps, last_step, slowest_ms, n_failures)`` of each line."""
    pattern = F.lit(rec.KINDS["step"][0])
    numbers = lambda group, kind: F.transform(
        F.regexp_extract_all("line", pattern, F.lit(group)), lambda x: x.try_cast(kind)
    )
    return lines.select(
        "job",
        "ts",
        numbers(2, "bigint").alias("_steps"),
        numbers(3, "double").alias("_times"),
        F.regexp_count("line", F.lit(rec.KINDS["failure"][0])).cast("long").alias("n_failures"),
    ).select(
        "job",
        "ts",
        F.size(F.array_compact("_steps")).cast("long").alias("n_steps"),
        F.array_max("_steps").alias("last_step"),
        F.array_max("_times").alias("slowest_ms"),
        "n_failures",
    )


def job_states(lines: DataFrame, silence: str = "10 minutes") -> DataFrame:
    """The state of each job after all lines of a batch.

    ``silent`` says that its last line is more than ``silence`` older than the newest
    line of all jobs.
    """
    newest = lines.agg(F.max("ts")).scalar()
    states = marked_lines(lines).groupBy("job").agg(
        F.sum("n_steps").alias("n_steps"),
        F.max("last_step").alias("last_step"),
        F.max("slowest_ms").alias("slowest_ms"),
        F.sum("n_failures").alias("n_failures"),
        F.max("ts").alias("last_seen"),
    )
    return states.withColumn(
        "silent", F.col("last_seen") + F.expr(f"INTERVAL {silence}") < newest
    )


def _largest(a, b):
    return b if a is None else a if b is None else max(a, b)


class JobMonitor(StatefulProcessor):
    """One value of state and one timer for each job."""

    def __init__(self, silence_ms: int):
        self.silence_ms = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", STATE)

    def _row(self, job, state, silent: bool) -> Row:
        from datetime import datetime, timezone

        steps, last, slowest, failures, seen = state
        # Rows carry times in the zone of the process.
        at = datetime.fromtimestamp(seen / 1000, timezone.utc).astimezone().replace(tzinfo=None)
        return Row(
            job=job, n_steps=steps, last_step=last, slowest_ms=slowest, n_failures=failures,
            last_seen=at, silent=silent,
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = tuple(self.state.get()) if self.state.exists() else (0, None, None, 0, None)
        steps, last, slowest, failures, seen = state
        for row in rows:
            steps, failures = steps + row.n_steps, failures + row.n_failures
            last, slowest = _largest(last, row.last_step), _largest(slowest, row.slowest_ms)
            seen = _largest(seen, row.seen_ms)
        self.state.update((steps, last, slowest, failures, seen))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(seen + self.silence_ms)
        yield self._row(key[0], (steps, last, slowest, failures, seen), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield self._row(key[0], tuple(self.state.get()), True)


def live_job_states(
    lines: DataFrame, silence_seconds: int = 600, lateness: str = "1 minute"
) -> DataFrame:
    """A row for each job whenever lines of it arrive, and one more when it falls silent.

    The row says all that is known of the job so far. Once the watermark, which other
    jobs drive, is ``silence_seconds`` past the last line of a job, a row with ``silent``
    comes out. State is one row for each job. Needs the RocksDB state store
    (``spark.sql.streaming.stateStore.providerClass``).
    """
    marked = marked_lines(lines.withWatermark("ts", lateness))
    rows = marked.withColumn("seen_ms", F.unix_millis("ts"))
    return rows.groupBy("job").transformWithState(
        JobMonitor(silence_seconds * 1000), OUTPUT, "Update", "EventTime"
    )

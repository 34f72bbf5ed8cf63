"""Jobs over log lines as they are appended.

Every function works on a batch and on a stream; on a stream the watermark bounds
the state and decides which late lines are dropped. Lines carry no time of their
own, so they come with the time ``ts`` at which they were written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quillrun.operators import run_records as rec

LINE_SCHEMA = T.StructType(
    [
        T.StructField("job", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("line", T.StringType()),
    ]
)


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Log lines from Parquet files as they arrive in a folder."""
    return (
        spark.readStream.schema(LINE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def _windowed(df: DataFrame, lateness: str | None) -> DataFrame:
    return df.withWatermark("ts", lateness) if lateness and df.isStreaming else df


def live_throughput(
    lines: DataFrame, width: str = "1 minute", lateness: str | None = "10 minutes"
) -> DataFrame:
    """Steps and mean rates per rank and tumbling window."""
    steps = rec.records(_windowed(lines, lateness), "step")
    return (
        steps.groupBy(F.window("ts", width), "rank")
        .agg(
            F.count(F.lit(1)).alias("n_steps"),
            F.avg("step_ms").alias("mean_step_ms"),
            F.avg("samples_per_sec").alias("mean_samples_per_sec"),
            F.avg("tokens_per_sec").alias("mean_tokens_per_sec"),
        )
        .select("window.start", "window.end", "rank", "n_steps", "mean_step_ms",
                "mean_samples_per_sec", "mean_tokens_per_sec")
    )


def polling_monitor(
    lines: DataFrame,
    width: str = "10 minutes",
    slide: str = "5 minutes",
    lateness: str | None = "10 minutes",
) -> DataFrame:
    """State of each job in sliding windows: steps, last step, slowest step, failures."""
    pattern = F.lit(rec.KINDS["step"][0])  # a line with progress bars may hold several
    numbers = lambda group, kind: F.transform(
        F.regexp_extract_all("line", pattern, F.lit(group)), lambda x: x.try_cast(kind)
    )
    marked = _windowed(lines, lateness).select(
        "job",
        "ts",
        numbers(2, "bigint").alias("steps"),
        numbers(3, "double").alias("times"),
        F.regexp_count("line", F.lit(rec.KINDS["failure"][0])).alias("failures"),
    )
    return (
        marked.groupBy(F.window("ts", width, slide), "job")
        .agg(
            F.sum(F.size(F.array_compact("steps"))).cast("long").alias("n_steps"),
            F.max(F.array_max("steps")).alias("last_step"),
            F.max(F.array_max("times")).alias("slowest_ms"),
            F.sum("failures").alias("n_failures"),
        )
        .select("window.start", "window.end", "job", "n_steps", "last_step", "slowest_ms",
                "n_failures")
    )


def live_failures(lines: DataFrame) -> DataFrame:
    """Failure signatures per file so far; the state grows with files, not lines."""
    return rec.records(lines, "failure").groupBy("job", "file").agg(
        F.count(F.lit(1)).alias("n_failures")
    )


def live_failure_windows(
    lines: DataFrame, width: str = "1 hour", lateness: str | None = "10 minutes"
) -> DataFrame:
    """Failure signatures per file and window, for sinks that only append."""
    return (
        rec.records(_windowed(lines, lateness), "failure")
        .groupBy(F.window("ts", width), "job", "file")
        .agg(F.count(F.lit(1)).alias("n_failures"))
        .select("window.start", "window.end", "job", "file", "n_failures")
    )


def append_to_parquet(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run a windowed stream over what has arrived and append its closed windows."""
    return (
        result.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

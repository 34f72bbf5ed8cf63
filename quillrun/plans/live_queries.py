"""Registered queries over live logs: batch runs, and real streams to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.plans.catalog import registry
from quillrun.plans import rendering
from quillrun.plans.run_log_queries import SQL_EVENTS
from quillrun.session import shared_folder
from quillrun.sources.tables import table
from quillrun.streaming import job_state, live

QUERIES, ORACLES, register = registry()


def _lines(spark, folder):
    return rendering.run_lines(table(spark, folder, "events"))


def _streamed(spark, folder, job):
    """Run a job over the event file as a stream and read what it appended."""
    events = (
        spark.readStream.schema(table(spark, folder, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(folder)
    )
    result = job(rendering.run_lines(events))
    path = shared_folder(spark, "live")
    query = live.append_to_parquet(result, f"{path}/rows", f"{path}/state")
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{path}/rows")


def _shown(df, *rounded):
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("start", "end")}
    shown = df.withColumns(times).withColumnsRenamed({"start": "w_start", "end": "w_end"})
    return shown.withColumns({c: F.round(c, 8) for c in rounded})


RATES = ("mean_step_ms", "mean_samples_per_sec", "mean_tokens_per_sec")


def _throughput_sql(width: str, closed: bool) -> str:
    end = "s + INTERVAL 1 " + width
    where = f"WHERE {end} <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE" if closed else ""
    return f"""
WITH {SQL_EVENTS.rstrip()}
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS w_start, strftime({end}, '%Y-%m-%d %H:%M:%S') AS w_end,
  rank, count(*) AS n_steps, round(avg(step_ms), 8) AS mean_step_ms,
  round(avg(samples_per_sec), 8) AS mean_samples_per_sec,
  round(avg(tokens_per_sec), 8) AS mean_tokens_per_sec
FROM (SELECT *, date_trunc('{width}', ts) AS s FROM steps) {where} GROUP BY s, rank
"""


def _as_rows(df):
    return _shown(df, *RATES).withColumn("rank", F.col("rank").cast("long"))


@register("q_93_live_throughput", _throughput_sql("minute", closed=False))
def live_throughput(spark, folder):
    return _as_rows(live.live_throughput(_lines(spark, folder)))


@register("q_93b_throughput_stream", _throughput_sql("hour", closed=True))
def throughput_stream(spark, folder):
    rows = _streamed(spark, folder, lambda lines: live.live_throughput(lines, "1 hour"))
    return _as_rows(rows)


@register(
    "q_94_polling_monitor",
    f"""
WITH {SQL_EVENTS.rstrip()},
placed AS (
  SELECT job, ts, unnest([time_bucket(INTERVAL 5 MINUTE, ts),
    time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE]) AS s,
    CASE WHEN t = 'click' THEN pos END AS step, CASE WHEN t = 'click' THEN v END AS step_ms,
    CASE WHEN t = 'error' AND u % 4 <> 1 THEN 1 + pos % 2 ELSE 0 END AS failures
  FROM e
)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS w_start,
  strftime(s + INTERVAL 10 MINUTE, '%Y-%m-%d %H:%M:%S') AS w_end, job,
  count(step) AS n_steps, max(step)::DOUBLE AS last_step, max(step_ms) AS slowest_ms,
  sum(failures)::BIGINT AS n_failures
FROM placed GROUP BY s, job
""",
)
def polling_monitor(spark, folder):
    rows = _shown(live.polling_monitor(_lines(spark, folder)))
    return rows.withColumn("last_step", F.col("last_step").cast("double"))


@register(
    "q_94b_job_states",
    f"""
WITH {SQL_EVENTS.rstrip()},
states AS (
  SELECT job, count(*) FILTER (WHERE t = 'click') AS n_steps,
    max(pos) FILTER (WHERE t = 'click') AS last_step, max(v) FILTER (WHERE t = 'click') AS slowest_ms,
    coalesce(sum(1 + pos % 2) FILTER (WHERE t = 'error' AND u % 4 <> 1), 0)::BIGINT AS n_failures,
    max(ts) AS last_seen
  FROM e GROUP BY job
)
SELECT job, n_steps, last_step, slowest_ms, n_failures,
  strftime(last_seen, '%Y-%m-%d %H:%M:%S') AS last_seen,
  last_seen + INTERVAL 6 HOUR < (SELECT max(ts) FROM e) AS silent
FROM states
""",
)
def job_states(spark, folder):
    states = job_state.job_states(_lines(spark, folder), "6 hours")
    return states.withColumn("last_seen", F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss"))


@register(
    "q_95_live_failures",
    f"WITH {SQL_EVENTS.rstrip()} SELECT job, file, count(*) AS n_failures FROM failures "
    "GROUP BY job, file",
)
def live_failures(spark, folder):
    return live.live_failures(_lines(spark, folder))


@register(
    "q_95b_failure_stream",
    f"""
WITH {SQL_EVENTS.rstrip()}
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS w_start,
  strftime(s + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS w_end, job, file, count(*) AS n_failures
FROM (SELECT *, date_trunc('hour', ts) AS s FROM failures)
WHERE s + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
GROUP BY s, job, file
""",
)
def failure_stream(spark, folder):
    return _shown(_streamed(spark, folder, live.live_failure_windows))

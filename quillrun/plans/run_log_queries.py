"""Registered queries over run logs: parse rendered lines, then report.

The twins read the event columns the lines were rendered from.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.functions import formats
from quillrun.functions import lines as ln
from quillrun.operators import run_records as rec
from quillrun.operators import run_reports as rep
from quillrun.plans.catalog import registry
from quillrun.plans import rendering
from quillrun.plans.run_report import run_report, run_report_details
from quillrun.sources.tables import table

QUERIES, ORACLES, register = registry()


def _events(spark, folder):
    return table(spark, folder, "events")


def _many(spark, folder):
    """Events for costly work on each row."""
    return _events(spark, folder)


def _lines(spark, folder):
    return rendering.run_lines(_many(spark, folder))


def _records(spark, folder, kind):
    return rec.records(_lines(spark, folder), kind)


SQL_EVENTS = """
e AS (
  SELECT event_id AS pos, user_id AS u, user_id::VARCHAR AS job, event_id % 8 AS r, ts,
    concat('train.', user_id, '.', event_id % 8, '.out') AS file, event_type AS t, value AS v
  FROM events
),
ranks AS (
  SELECT job, file, pos, r AS rank, CASE u % 3 WHEN 0 THEN
    (CASE WHEN pos % 2 = 0 THEN 4 ELSE 8 END) WHEN 1 THEN 8 ELSE 32 END::BIGINT AS world_size
  FROM e WHERE t = 'view'
),
rendezvous AS (
  SELECT job, file, pos, u % 2 + 2 AS nnodes, 4::BIGINT AS nproc_per_node, pos % 4 AS node_rank,
    concat('node', CASE WHEN u % 7 = 0 THEN pos % 6 ELSE u % 5 END, ':29500') AS endpoint
  FROM e WHERE t = 'signup' AND pos % 2 = 0
),
sanity AS (
  SELECT job, file, pos, concat('n', pos % 5) AS host, concat('3.11.', u % 2) AS python,
    concat('9.1.', pos % 3) AS torch, '8.20.3' AS tfm, concat('7.5.', pos // 4 % 2) AS numpy,
    '6.0.1' AS datasets, concat('/run/', job) AS root
  FROM e WHERE t = 'signup' AND pos % 2 = 1
),
steps AS (
  SELECT job, file, pos, ts, r AS rank, pos AS step, v AS step_ms,
    round(v + 100, 2) AS samples_per_sec, round((v + 100) * 128, 2) AS tokens_per_sec
  FROM e WHERE t = 'click'
),
runtimes AS (
  SELECT job, file, pos, v AS train_runtime_sec FROM e WHERE t = 'purchase' AND pos % 3 = 0
),
evaluations AS (
  SELECT job, file, pos, round(v / 1000, 5) AS accuracy FROM e
  WHERE t = 'purchase' AND pos % 3 = 1
),
inferences AS (
  SELECT job, file, pos, (pos % 1000 / 1000.0)::DOUBLE AS accuracy,
    (pos + 0.5)::DOUBLE AS samples_per_sec, (pos * 128)::DOUBLE AS tokens_per_sec
  FROM e WHERE t = 'purchase' AND pos % 3 = 2
),
failures AS (
  SELECT job, file, pos, ts, unnest(hits) AS signature, generate_subscripts(hits, 1) - 1 AS hit
  FROM (SELECT *, CASE pos % 4 WHEN 0 THEN ['Traceback']
      WHEN 1 THEN ['RuntimeError', 'Address already in use']
      WHEN 2 THEN ['timed out'] ELSE ['OSError', 'Error'] END AS hits
    FROM e WHERE t = 'error' AND u % 4 <> 1)
),
preflight AS (
  SELECT job, pos, concat('n', pos % 40) AS host,
    CASE pos % 3 WHEN 0 THEN (CASE WHEN v > 20 THEN 'ok' ELSE 'missing' END)
      WHEN 1 THEN 'ok' ELSE 'missing' END AS proj,
    CASE pos % 3 WHEN 2 THEN (CASE WHEN v > 20 THEN 'ok' ELSE 'missing' END)
      ELSE 'ok' END AS pkgs
  FROM e
),
phases AS (
  SELECT job, (pos // 5) % 8 AS rank, CASE WHEN u % 10 = 9 AND pos % 5 = 3 THEN 'Evaluation'
    ELSE (['Dataset load', 'Tokenization', 'Trainer setup', 'Training', 'Model save'])[pos % 5 + 1]
    END AS phase, v AS seconds
  FROM e
),
latest_sanity AS (
  SELECT job, host, arg_max(python, (file, pos)) AS python, arg_max(torch, (file, pos)) AS torch,
    arg_max(tfm, (file, pos)) AS tfm, arg_max(numpy, (file, pos)) AS numpy,
    arg_max(datasets, (file, pos)) AS datasets, arg_max(root, (file, pos)) AS root
  FROM sanity GROUP BY job, host
),
versions AS (
  SELECT job, component, version, count(*) AS n_hosts FROM (
    SELECT job, 'python' AS component, python AS version FROM latest_sanity
    UNION ALL SELECT job, 'torch', torch FROM latest_sanity
    UNION ALL SELECT job, 'tfm', tfm FROM latest_sanity
    UNION ALL SELECT job, 'numpy', numpy FROM latest_sanity
    UNION ALL SELECT job, 'datasets', datasets FROM latest_sanity)
  GROUP BY job, component, version
),
drift AS (
  SELECT * FROM versions QUALIFY count(*) OVER (PARTITION BY job, component) > 1
),
unique_worlds AS (
  SELECT job, min(world_size) AS w FROM ranks GROUP BY job
  HAVING min(world_size) = max(world_size)
),
missing AS (
  SELECT job, rank FROM (SELECT job, unnest(range(0, w)) AS rank FROM unique_worlds)
  ANTI JOIN ranks USING (job, rank)
),
preflight_status AS (
  SELECT job, host, arg_max(proj, pos) AS proj, arg_max(pkgs, pos) AS pkgs
  FROM preflight GROUP BY job, host
),
jobs AS (SELECT DISTINCT job FROM e),
verdicts AS (
  SELECT job, coalesce(a.n, 0) AS n_rendezvous, coalesce(b.n, 0) AS n_ranks,
    coalesce(b.w, 0) AS n_world_sizes, coalesce(c.n, 0) AS n_missing, coalesce(d.n, 0) AS n_failures
  FROM jobs
  LEFT JOIN (SELECT job, count(*) AS n FROM rendezvous GROUP BY job) a USING (job)
  LEFT JOIN (SELECT job, count(DISTINCT rank) AS n, count(DISTINCT world_size) AS w
             FROM ranks GROUP BY job) b USING (job)
  LEFT JOIN (SELECT job, count(*) AS n FROM missing GROUP BY job) c USING (job)
  LEFT JOIN (SELECT job, count(*) AS n FROM failures GROUP BY job) d USING (job)
),
judged AS (
  SELECT *, n_rendezvous > 0 AND n_ranks > 0 AND n_world_sizes = 1 AND n_missing = 0
    AND n_failures = 0 AS passed
  FROM verdicts
),
file_failures AS (
  SELECT job, file, count(*) AS n_hits,
    row_number() OVER (PARTITION BY job ORDER BY count(*) DESC, file) AS place
  FROM failures GROUP BY job, file
),
run_facts AS (
  SELECT user_id AS u, user_id::VARCHAR AS job, floor(epoch(min(ts)))::BIGINT AS t_start,
    floor(epoch(max(ts)))::BIGINT AS t_end,
    CASE WHEN user_id % 6 <> 5 THEN ([5, 10, 20])[user_id % 3 + 1] END::BIGINT AS nnodes,
    CASE WHEN user_id % 6 <> 5 AND user_id % 4 <> 0 THEN concat('ds', user_id % 5) END AS dataset
  FROM events GROUP BY user_id
),
training AS (
  SELECT job, max(seconds) AS train_seconds FROM phases WHERE phase = 'Training' GROUP BY job
)
"""


def _sql(select: str) -> str:
    return f"WITH {SQL_EVENTS.rstrip()} {select}"


def _long(df, *columns):
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


@register(
    "q_34_pair_lines",
    "SELECT event_id AS pos, event_id % 8 AS rank, event_id AS step, round(value / 100, 4) AS loss,"
    " value AS grad_norm, 0.000321::DOUBLE AS learning_rate, (event_id % 1000 / 1000.0)::DOUBLE "
    "AS epoch, 4::BIGINT AS n_pairs FROM events",
)
def pair_lines(spark, folder):
    found = rec.pair_records(rendering.pair_lines(_many(spark, folder)))
    keys = ["loss", "grad_norm", "learning_rate", "epoch"]
    return found.select(
        "pos",
        F.col("rank").cast("long").alias("rank"),
        "step",
        *[ln.number(F.col("pairs"), k).alias(k) for k in keys],
        F.size("pairs").cast("long").alias("n_pairs"),
    )


SQL_DICTIONARIES = """
WITH d AS (SELECT user_id::VARCHAR AS job, event_id AS e, value AS v, event_type = 'click' AS step
  FROM events)
SELECT job, e AS pos, 'loss' AS key, round(v / 100, 4) AS number, NULL AS text FROM d WHERE step
UNION ALL SELECT job, e, 'grad_norm', CASE WHEN e % 10 <> 7 THEN v END,
  CASE WHEN e % 10 = 7 THEN 'nan' END FROM d WHERE step
UNION ALL SELECT job, e, 'learning_rate', 0.000321, NULL FROM d WHERE step
UNION ALL SELECT job, e, 'epoch', e % 1000 / 1000.0, NULL FROM d WHERE step
UNION ALL SELECT job, e, 'train_runtime', v, NULL FROM d WHERE NOT step
UNION ALL SELECT job, e, 'train_samples_per_second', e, NULL FROM d WHERE NOT step
UNION ALL SELECT job, e, 'host', NULL, concat('n', job) FROM d WHERE NOT step
UNION ALL SELECT job, e, 'done', NULL, CASE WHEN e % 2 = 0 THEN 'true' END FROM d WHERE NOT step
"""


@register(
    "q_34b_trainer_dictionaries",
    f"SELECT job, pos, key, round(number::DOUBLE, 6) AS number, text FROM ({SQL_DICTIONARIES})",
)
def trainer_dictionaries(spark, folder):
    found = rec.dictionary_records(rendering.dictionary_lines(_many(spark, folder)))
    number = F.when(~F.isnan("number"), F.round("number", 6))
    values = rec.dictionary_values(found).withColumn("number", number)
    text = F.when(F.col("number").isNull(), F.col("value"))
    return values.select("job", "pos", "key", "number", text.alias("text"))


@register(
    "q_68b_pipeline_steps",
    "SELECT user_id::VARCHAR AS job, event_id AS pos, event_id % 3 AS epoch, event_id AS step, "
    "round(value / 100, 4) AS loss, (event_id % 8)::DOUBLE AS seconds FROM events",
)
def pipeline_steps(spark, folder):
    lines = rendering.pipeline_step_lines(_many(spark, folder))
    return rec.records(lines, "pipeline_step").drop("hit")


@register("q_58_rank_banner", _sql("SELECT job, file, pos, rank, world_size FROM ranks"))
def rank_banner(spark, folder):
    found = _records(spark, folder, "rank").select("job", "file", "pos", "rank", "world_size")
    return _long(found, "rank", "world_size")


@register(
    "q_59_rendezvous_banner",
    _sql("SELECT job, pos, nnodes, nproc_per_node, node_rank, endpoint FROM rendezvous"),
)
def rendezvous_banner(spark, folder):
    numbers = ["nnodes", "nproc_per_node", "node_rank"]
    found = _records(spark, folder, "rendezvous").select("job", "pos", *numbers, "endpoint")
    return _long(found, *numbers)


@register(
    "q_60_sanity_latest",
    _sql("SELECT job, host, python, torch, tfm, numpy, datasets, root FROM latest_sanity"),
)
def sanity_latest(spark, folder):
    return rep.latest_sanity(_records(spark, folder, "sanity"), ["job"])


@register(
    "q_61_step_lines",
    _sql("SELECT job, pos, rank, step, step_ms, samples_per_sec, tokens_per_sec FROM steps"),
)
def step_lines(spark, folder):
    found = _records(spark, folder, "step").select("job", "pos", "rank", "step", *rep.STEP_METRICS)
    return _long(found, "rank")


@register("q_62_runtime_lines", _sql("SELECT job, pos, train_runtime_sec FROM runtimes"))
def runtime_lines(spark, folder):
    return _records(spark, folder, "runtime").select("job", "pos", "train_runtime_sec")


@register("q_63_eval_lines", _sql("SELECT job, pos, accuracy FROM evaluations"))
def eval_lines(spark, folder):
    return _records(spark, folder, "evaluation").select("job", "pos", "accuracy")


@register(
    "q_64_inference_lines",
    _sql("SELECT job, pos, accuracy, samples_per_sec, tokens_per_sec FROM inferences"),
)
def inference_lines(spark, folder):
    return _records(spark, folder, "inference").select(
        "job", "pos", "accuracy", "samples_per_sec", "tokens_per_sec"
    )


@register("q_65_failure_lines", _sql("SELECT job, pos, hit, signature FROM failures"))
def failure_lines(spark, folder):
    found = _records(spark, folder, "failure").select("job", "pos", "hit", "signature")
    return _long(found, "hit")


@register("q_66_preflight_latest", _sql("SELECT job, host, proj, pkgs FROM preflight_status"))
def preflight_latest(spark, folder):
    found = rec.preflight_records(rendering.preflight_lines(_many(spark, folder)))
    return rep.preflight_status(found, ["job"]).drop("status")


def _phases(spark, folder):
    return rec.records(rendering.phase_lines(_many(spark, folder)), "phase")


@register("q_67_phase_lines", _sql("SELECT job, rank, phase, seconds FROM phases"))
def phase_lines(spark, folder):
    return _long(_phases(spark, folder).select("job", "rank", "phase", "seconds"), "rank")


@register(
    "q_68_host_steps",
    "SELECT event_id AS pos, concat('n', user_id) AS host, event_id % 8 AS rank, "
    "event_id AS step, value AS seconds FROM events",
)
def host_steps(spark, folder):
    found = rec.records(rendering.host_step_lines(_many(spark, folder)), "host_step")
    return _long(found.select("pos", "host", "rank", "step", "seconds"), "rank")


SQL_LINES = """
lines AS (
  SELECT file, pos, printf('[RANK %d] WORLD_SIZE=%d', rank, world_size) AS line FROM ranks
  UNION ALL
  SELECT file, pos, printf('[RANK %d] TRAIN_RUNTIME_SEC=%.3f', pos % 8, train_runtime_sec)
  FROM runtimes
  UNION ALL
  SELECT file, pos, printf('[RANK 0] INFER global_accuracy=%.4f global_samples_per_sec=%d.5 '
    || 'global_tokens_per_sec=%d.0', accuracy, pos, pos * 128) FROM inferences
),
training_lines AS (
  SELECT pos, printf('[rank %d | step %d] step_ms=%.2f samples_per_sec=%.2f '
    || 'tokens_per_sec=%.2f', rank, step, step_ms, samples_per_sec, tokens_per_sec) AS line
  FROM steps WHERE pos % 5 <> 0
  UNION ALL
  SELECT pos, printf('[rank %d | step %d] eval_loss=0.1 eval_accuracy=%.5f epoch=1.0',
    pos % 8, pos, accuracy) FROM evaluations WHERE pos % 2 = 1
)
"""


@register(
    "q_69_excerpt_ranks",
    f"WITH {SQL_EVENTS}, {SQL_LINES} SELECT DISTINCT line FROM lines ORDER BY line DESC LIMIT 30",
)
def excerpt_ranks(spark, folder):
    return rec.sorted_excerpt(_lines(spark, folder), formats.EXCERPT_RANKS)


@register(
    "q_69b_excerpt_training",
    f"WITH {SQL_EVENTS}, {SQL_LINES} SELECT pos, line FROM training_lines ORDER BY pos LIMIT 200",
)
def excerpt_training(spark, folder):
    return rec.first_excerpt(_lines(spark, folder), formats.EXCERPT_TRAINING, ["pos"]).select(
        "pos", "line"
    )


@register(
    "q_70_rendezvous_status",
    _sql(
        "SELECT job, count(*) AS n_configs, count(*) > 1 AS inconsistent FROM "
        "(SELECT DISTINCT job, nnodes, nproc_per_node, endpoint FROM rendezvous) GROUP BY job"
    ),
)
def rendezvous_status(spark, folder):
    return rep.rendezvous_status(_records(spark, folder, "rendezvous"), ["job"])


@register(
    "q_71_rank_coverage",
    _sql(
        "SELECT job, min(rank) AS min_rank, max(rank) AS max_rank, count(DISTINCT rank) AS n_ranks "
        "FROM ranks GROUP BY job"
    ),
)
def rank_coverage(spark, folder):
    found = rep.rank_coverage(_records(spark, folder, "rank"), ["job"])
    return _long(found, "min_rank", "max_rank")


@register(
    "q_72_world_sizes",
    _sql("SELECT world_size, count(*) AS n_seen FROM ranks GROUP BY world_size"),
)
def world_sizes(spark, folder):
    return _long(rep.world_sizes(_records(spark, folder, "rank")), "world_size").orderBy(
        "world_size"
    )


@register(
    "q_73_missing_ranks",
    _sql(
        "SELECT job, n_missing, concat(shown, CASE WHEN n_missing > 15 THEN ' ...' ELSE '' END) "
        "AS shown FROM (SELECT job, count(*) AS n_missing, "
        "array_to_string(list_sort(list(rank))[:15], ', ') AS shown FROM missing GROUP BY job)"
    ),
)
def missing_ranks(spark, folder):
    return rep.missing_summary(_records(spark, folder, "rank"), ["job"])


@register(
    "q_74_version_drift",
    _sql("SELECT job, component, version, n_hosts FROM drift"),
)
def version_drift(spark, folder):
    return rep.version_drift(_records(spark, folder, "sanity"), ["job"])


@register(
    "q_75_preflight_summary",
    _sql(
        "SELECT job, count(*) FILTER (WHERE proj = 'ok' AND pkgs = 'ok') AS n_ready, "
        "count(*) AS n_hosts FROM preflight_status GROUP BY job"
    ),
)
def preflight_summary(spark, folder):
    found = rec.preflight_records(rendering.preflight_lines(_many(spark, folder)))
    return rep.preflight_totals(found, ["job"])


def _percentile_sql(by: str = "") -> str:
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    parts = [
        f"SELECT {by}'{m}' AS metric, count(*) AS n, round(quantile_cont({m}, 0.5), 6) AS p50, "
        f"round(quantile_cont({m}, 0.95), 6) AS p95 FROM steps {group}"
        for m in rep.STEP_METRICS
    ]
    return _sql(" UNION ALL ".join(parts))


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@register("q_76_step_percentiles", _percentile_sql())
def step_percentiles(spark, folder):
    return _rounded(rep.step_percentiles(_records(spark, folder, "step")), "p50", "p95")


@register("q_76b_job_percentiles", _percentile_sql("job, "))
def job_percentiles(spark, folder):
    return _rounded(rep.step_percentiles(_records(spark, folder, "step"), ["job"]), "p50", "p95")


@register(
    "q_77_derived_throughput",
    _sql(
        "SELECT job, step, round(s, 4) AS derived_samples_per_sec, "
        "round(s * 128, 4) AS derived_tokens_per_sec "
        "FROM (SELECT job, step, 8 * 2 / (nullif(step_ms, 0) / 1000) AS s FROM steps)"
    ),
)
def derived_throughput(spark, folder):
    found = rep.derived_throughput(_records(spark, folder, "step"), 8, 2, 128)
    names = ["derived_samples_per_sec", "derived_tokens_per_sec"]
    return found.select("job", "step", *[F.round(n, 4).alias(n) for n in names])


@register(
    "q_78_runtime_range",
    _sql(
        "SELECT job, min(train_runtime_sec) AS min_runtime, max(train_runtime_sec) AS max_runtime "
        "FROM runtimes GROUP BY job"
    ),
)
def runtime_range(spark, folder):
    return rep.runtime_range(_records(spark, folder, "runtime"), ["job"])


@register(
    "q_79_last_inference",
    _sql(
        "SELECT job, arg_max(accuracy, (file, pos)) AS accuracy, "
        "arg_max(samples_per_sec, (file, pos)) AS samples_per_sec, "
        "arg_max(tokens_per_sec, (file, pos)) AS tokens_per_sec FROM inferences GROUP BY job"
    ),
)
def last_inference(spark, folder):
    return rep.last_inference(_records(spark, folder, "inference"), ["job"])


@register(
    "q_80_failure_files",
    _sql("SELECT job, place, file, n_hits FROM file_failures WHERE place <= 5"),
)
def failure_files(spark, folder):
    return _long(rep.failures_by_file(_records(spark, folder, "failure"), ["job"]), "place")


@register(
    "q_80b_failure_samples",
    _sql(
        "SELECT place, file, signature, greatest(n - 8, 0) AS n_more FROM (SELECT file, signature, "
        "row_number() OVER (ORDER BY file, pos, hit) AS place, count(*) OVER () AS n "
        "FROM failures) WHERE place <= 8"
    ),
)
def failure_samples(spark, folder):
    return _long(rep.failure_samples(_records(spark, folder, "failure")), "place")


@register(
    "q_81_verdict",
    _sql(
        "SELECT job, n_rendezvous, n_ranks, n_world_sizes, n_missing, n_failures, passed "
        "FROM judged"
    ),
)
def verdict(spark, folder):
    return rep.verdict(
        *[_records(spark, folder, kind) for kind in ("rendezvous", "rank", "failure")],
        ["job"],
        _lines(spark, folder).select("job"),
    )


SQL_REPORT = """
SELECT job, section, key, round(value::DOUBLE, 6) AS value FROM (
  SELECT DISTINCT job, 'RDZV' AS section, printf('nnodes=%d nproc_per_node=%d endpoint=%s',
    nnodes, nproc_per_node, endpoint) AS key, 1::DOUBLE AS value FROM rendezvous
  UNION ALL SELECT job, 'RANKS', 'min', min(rank) FROM ranks GROUP BY job
  UNION ALL SELECT job, 'RANKS', 'max', max(rank) FROM ranks GROUP BY job
  UNION ALL SELECT job, 'RANKS', 'count', count(DISTINCT rank) FROM ranks GROUP BY job
  UNION ALL SELECT job, 'WORLD', world_size::VARCHAR, count(*) FROM ranks GROUP BY job, world_size
  UNION ALL SELECT job, 'DRIFT', concat(component, '=', version), n_hosts FROM drift
  UNION ALL SELECT job, 'THROUGHPUT', 'step_ms_p50', quantile_cont(step_ms, 0.5)
    FROM steps GROUP BY job
  UNION ALL SELECT job, 'THROUGHPUT', 'step_ms_p95', quantile_cont(step_ms, 0.95)
    FROM steps GROUP BY job
  UNION ALL SELECT job, 'THROUGHPUT', 'samples_per_sec_p50', quantile_cont(samples_per_sec, 0.5)
    FROM steps GROUP BY job
  UNION ALL SELECT job, 'THROUGHPUT', 'samples_per_sec_p95', quantile_cont(samples_per_sec, 0.95)
    FROM steps GROUP BY job
  UNION ALL SELECT job, 'THROUGHPUT', 'tokens_per_sec_p50', quantile_cont(tokens_per_sec, 0.5)
    FROM steps GROUP BY job
  UNION ALL SELECT job, 'THROUGHPUT', 'tokens_per_sec_p95', quantile_cont(tokens_per_sec, 0.95)
    FROM steps GROUP BY job
  UNION ALL SELECT job, 'RUNTIME', 'min', min(train_runtime_sec) FROM runtimes GROUP BY job
  UNION ALL SELECT job, 'RUNTIME', 'max', max(train_runtime_sec) FROM runtimes GROUP BY job
  UNION ALL SELECT job, 'EVAL', 'best', max(accuracy) FROM evaluations GROUP BY job
  UNION ALL SELECT job, 'EVAL', 'last', arg_max(accuracy, (file, pos)) FROM evaluations
    GROUP BY job
  UNION ALL SELECT job, 'INFER', 'accuracy', arg_max(accuracy, (file, pos)) FROM inferences
    GROUP BY job
  UNION ALL SELECT job, 'INFER', 'samples_per_sec', arg_max(samples_per_sec, (file, pos))
    FROM inferences GROUP BY job
  UNION ALL SELECT job, 'INFER', 'tokens_per_sec', arg_max(tokens_per_sec, (file, pos))
    FROM inferences GROUP BY job
  UNION ALL SELECT job, 'FAILURES', file, n_hits FROM file_failures WHERE place <= 5
  UNION ALL SELECT job, 'VERDICT', 'missing', n_missing FROM judged
  UNION ALL SELECT job, 'VERDICT', 'failures', n_failures FROM judged
  UNION ALL SELECT job, 'VERDICT', 'pass', passed::INT FROM judged
  UNION ALL SELECT job, 'PREFLIGHT', 'ready',
    count(*) FILTER (WHERE proj = 'ok' AND pkgs = 'ok') FROM preflight_status GROUP BY job
  UNION ALL SELECT job, 'PREFLIGHT', 'hosts', count(*) FROM preflight_status GROUP BY job
)
"""


@register("q_82_run_report", _sql(SQL_REPORT))
def whole_report(spark, folder):
    events = _many(spark, folder)
    report = run_report(
        rendering.run_lines(events).drop("ts"),
        rendering.preflight_lines(events),
        runs=events.select(F.col("user_id").cast("string").alias("job")),
    )
    return report.withColumn("value", F.round("value", 6))


SQL_DETAILS = """
SELECT job, 'RDZV' AS section, 'configs' AS key,
  CASE WHEN count(DISTINCT (nnodes, nproc_per_node, endpoint)) > 1 THEN 'inconsistent'
    ELSE 'consistent' END AS text FROM rendezvous GROUP BY job
UNION ALL SELECT job, 'RANKS', 'world sizes',
  CASE WHEN count(DISTINCT world_size) > 1 THEN 'inconsistent' ELSE 'consistent' END
  FROM ranks GROUP BY job
UNION ALL SELECT job, 'RANKS', 'missing',
  concat(array_to_string(list_sort(list(rank))[:15], ', '), CASE WHEN count(*) > 15 THEN ' ...' ELSE '' END)
  FROM missing GROUP BY job
UNION ALL SELECT job, 'SANITY', host, concat('python=', python, ' torch=', torch, ' tfm=', tfm,
  ' numpy=', numpy, ' datasets=', datasets, ' root=', root) FROM latest_sanity
UNION ALL SELECT job, 'PREFLIGHT', host, concat('proj=', proj, ' pkgs=', pkgs, ' -> ',
  CASE WHEN proj = 'ok' AND pkgs = 'ok' THEN 'OK' ELSE 'STAGED/MISSING' END) FROM preflight_status
UNION ALL SELECT job, 'FAILURES', place::VARCHAR, concat(file, ': ', signature) FROM placed_failures
  WHERE place <= 8
UNION ALL SELECT job, 'FAILURES', 'more', concat('(+', count(*) - 8, ' more)') FROM placed_failures
  GROUP BY job HAVING count(*) > 8
"""
SQL_PLACED = """,
placed_failures AS (
  SELECT job, file, signature, row_number() OVER (PARTITION BY job ORDER BY file, pos, hit) AS place
  FROM failures
)
"""


@register(
    "q_82b_run_report_details", f"WITH {SQL_EVENTS.rstrip()}{SQL_PLACED}{SQL_DETAILS}"
)
def report_details(spark, folder):
    events = _many(spark, folder)
    return run_report_details(
        rendering.run_lines(events).drop("ts"), rendering.preflight_lines(events)
    )


@register(
    "q_83_time_summary",
    _sql(
        "SELECT job, train_seconds, nnodes::DOUBLE AS nnodes, dataset, "
        "wall_seconds::DOUBLE AS wall_seconds, concat(printf('%-40s', printf('N=%2s  dataset=%6s  job=%s', "
        "coalesce(nnodes::VARCHAR, '?'), coalesce(dataset, '?'), job)), ' train=', "
        "coalesce(printf('%.2fs', train_seconds), 'NA'), "
        "coalesce(printf('  wall=%ds', wall_seconds), '')) AS summary FROM (SELECT *, "
        "CASE WHEN u % 5 <> 3 THEN t_end - t_start END AS wall_seconds FROM run_facts "
        "LEFT JOIN training USING (job))"
    ),
)
def time_summary(spark, folder):
    events = _events(spark, folder)
    meta, wall = rendering.run_facts(events)
    runs = events.select(F.col("user_id").cast("string").alias("job")).distinct()
    found = rep.time_summary(runs, _phases(spark, folder), meta, wall)
    return found.withColumns({c: F.col(c).cast("double") for c in ("nnodes", "wall_seconds")})


@register(
    "q_84_wall_status",
    "SELECT user_id, floor(epoch(max(ts)))::BIGINT - floor(epoch(min(ts)))::BIGINT AS "
    "wall_seconds, CASE WHEN count(*) FILTER (WHERE event_type = 'error' AND value > 150) = 0 "
    "THEN 'success' ELSE 'failed' END AS status FROM events GROUP BY user_id",
)
def wall_status(spark, folder):
    failed = (F.col("event_type") == "error") & (F.col("value") > 150)
    runs = (
        _events(spark, folder)
        .groupBy("user_id")
        .agg(
            F.unix_seconds(F.min("ts").cast("timestamp")).alias("t_start"),
            F.unix_seconds(F.max("ts").cast("timestamp")).alias("t_end"),
            F.count_if(failed).alias("return_code"),
        )
    )
    return runs.select(
        "user_id", *rep.wall_status(F.col("t_start"), F.col("t_end"), F.col("return_code"))
    )


@register(
    "q_85_scaling",
    _sql(
        ", means AS (SELECT nnodes, avg(train_seconds) AS m, count(*) AS n_runs FROM run_facts "
        "JOIN training USING (job) WHERE nnodes IS NOT NULL GROUP BY nnodes), "
        "base AS (SELECT min(nnodes) AS n0, arg_min(m, nnodes) AS m0 FROM means) "
        "SELECT nnodes, round(m, 6) AS mean_seconds, n_runs, round(m0 / m, 6) AS speedup, "
        "round(m0 / m * n0 / nnodes, 6) AS efficiency FROM means, base"
    ),
)
def scaling(spark, folder):
    meta, _ = rendering.run_facts(_events(spark, folder))
    times = rep.training_seconds(_phases(spark, folder)).join(meta, "job")
    found = _rounded(rep.scaling(times), "mean_seconds", "speedup", "efficiency")
    return _long(found, "nnodes")


SQL_BREAKDOWN = """, broken AS (
  SELECT job, rank,
    sum(seconds) FILTER (WHERE phase = 'Dataset load') AS dataset_load,
    sum(seconds) FILTER (WHERE phase = 'Tokenization') AS tokenization,
    sum(seconds) FILTER (WHERE phase = 'Trainer setup') AS trainer_setup,
    sum(seconds) FILTER (WHERE phase = 'Training') AS training,
    sum(seconds) FILTER (WHERE phase = 'Model save') AS model_save,
    sum(seconds) FILTER (WHERE phase NOT IN ('Dataset load', 'Tokenization',
      'Trainer setup', 'Training', 'Model save')) AS other_seconds,
    coalesce(sum(seconds), 0) AS total_seconds
  FROM phases GROUP BY job, rank
)
"""


@register(
    "q_86_phase_breakdown",
    _sql(
        SQL_BREAKDOWN
        + "SELECT job, rank, round(dataset_load, 6) AS dataset_load, "
        "round(tokenization, 6) AS tokenization, round(trainer_setup, 6) AS trainer_setup, "
        "round(training, 6) AS training, round(model_save, 6) AS model_save, "
        "round(other_seconds, 6) AS other_seconds, "
        "round(total_seconds, 6) AS total_seconds FROM broken"
    ),
)
def phase_breakdown(spark, folder):
    names = [p.lower().replace(" ", "_") for p in formats.PHASES]
    found = rep.phase_breakdown(_phases(spark, folder))
    return _long(_rounded(found, *names, "other_seconds", "total_seconds"), "rank")


@register(
    "q_86b_slowest_rank",
    _sql(
        SQL_BREAKDOWN
        + "SELECT job, arg_max(rank, (round(total_seconds, 6), -rank)) AS slowest_rank, "
        "max(round(total_seconds, 6)) AS slowest_seconds FROM broken GROUP BY job"
    ),
)
def slowest_rank(spark, folder):
    found = _rounded(rep.phase_breakdown(_phases(spark, folder)), "total_seconds")
    return _long(rep.slowest_rank(found), "slowest_rank")


def _curve(spark, folder):
    return rec.training_curve(rendering.pair_lines(_many(spark, folder)))


@register(
    "q_87_curve_ends",
    "SELECT event_id % 8 AS rank, count(*) AS n_points, min(event_id) AS first_step, "
    "max(event_id) AS last_step, round(arg_min(value / 100, event_id), 4) AS first_loss, "
    "round(arg_max(value / 100, event_id), 4) AS last_loss FROM events GROUP BY event_id % 8",
)
def curve_ends(spark, folder):
    return _long(rep.curve_ends(_curve(spark, folder), ["rank"]), "rank")


@register(
    "q_87b_curve_changes",
    "SELECT event_id AS step, event_id % 8 AS rank, round(round(value / 100, 4) - "
    "round(lag(value) OVER (PARTITION BY event_id % 8 ORDER BY event_id) / 100, 4), 6) "
    "AS loss_change FROM events",
)
def curve_changes(spark, folder):
    found = rep.curve_changes(_curve(spark, folder), ["rank"]).select("step", "rank", "loss_change")
    return _long(_rounded(found, "loss_change"), "rank")

"""Registered queries over node lists, rendered from the supplier table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.operators import inventory
from quillrun.plans.catalog import registry
from quillrun.sources.tables import table

QUERIES, ORACLES, register = registry()


def capacity_lines(spark, folder):
    """``(seq, line)``: one node per supplier; some are short, malformed or down."""
    s, n = F.col("s_suppkey"), F.col("s_nationkey")
    partition = F.when(n % 7 == 3, F.format_string("GPU%d", n)).otherwise(
        F.format_string("Part%d", n % 6)
    )
    star = F.when(n % 6 == 0, "*").otherwise("")
    counts = F.when(s % 11 == 5, F.lit("n/a")).otherwise(
        F.format_string("%d/%d/0/16", 16 - s % 9, s % 9)
    )
    state = F.when(s % 13 == 4, "DOWN*").otherwise("idle")
    line = F.when(s % 17 == 3, F.format_string("%s%s node%d", partition, star, s)).otherwise(
        F.format_string("%s%s  node%d %s %s", partition, star, s, counts, state)
    )
    return table(spark, folder, "supplier").select(s.alias("seq"), line.alias("line"))


SQL_NODES = """
WITH nodes AS (
  SELECT s_suppkey AS seq,
    CASE WHEN s_nationkey % 7 = 3 THEN concat('gpu', s_nationkey)
      ELSE concat('part', s_nationkey % 6) END AS partition,
    concat('node', s_suppkey) AS node, 16 - s_suppkey % 9 AS alloc, s_suppkey % 9 AS idle,
    0::BIGINT AS other, 16::BIGINT AS total,
    CASE WHEN s_suppkey % 13 = 4 THEN 'down*' ELSE 'idle' END AS state
  FROM supplier WHERE s_suppkey % 17 <> 3 AND s_suppkey % 11 <> 5
),
idle AS (
  SELECT * FROM nodes WHERE state <> 'down*' AND idle > 0 AND NOT contains(partition, 'gpu')
),
ranked AS (
  SELECT partition, sum(idle)::BIGINT AS idle_cpus, count(*) AS n_nodes, min(seq) AS first_seq
  FROM idle GROUP BY partition
),
best AS (
  SELECT partition, least(greatest(n_nodes - 1, 1), 20) AS wanted FROM ranked
  ORDER BY idle_cpus DESC, first_seq LIMIT 1
),
chosen AS (
  SELECT partition, row_number() OVER (ORDER BY seq) AS place, node, idle, total, wanted
  FROM idle JOIN best USING (partition)
)
"""
NUMBERS = ("alloc", "idle", "other", "total")


def _long(df, *columns):
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


def _nodes(spark, folder):
    return inventory.node_rows(capacity_lines(spark, folder))


@register("q_88_node_rows", f"{SQL_NODES} SELECT * FROM nodes")
def node_rows(spark, folder):
    return _long(_nodes(spark, folder), *NUMBERS)


@register("q_89_idle_nodes", f"{SQL_NODES} SELECT * FROM idle")
def idle_nodes(spark, folder):
    return _long(inventory.idle_nodes(_nodes(spark, folder)), *NUMBERS)


@register(
    "q_90_partition_ranking",
    f"{SQL_NODES} SELECT * FROM ranked ORDER BY idle_cpus DESC, first_seq",
)
def partition_ranking(spark, folder):
    return inventory.rank_partitions(inventory.idle_nodes(_nodes(spark, folder)))


@register(
    "q_91_node_choice",
    f"{SQL_NODES} SELECT partition, place, node, idle, total FROM chosen WHERE place <= wanted",
)
def node_choice(spark, folder):
    chosen = inventory.choose_nodes(inventory.idle_nodes(_nodes(spark, folder)))
    return _long(chosen, "place", "idle", "total")


def _inventory(spark, folder):
    s, n = F.col("s_suppkey"), F.col("s_nationkey")
    line = F.format_string("node%d  %d gpu:%d part%d extra", s, F.lit(16), n % 3, n % 6)
    return inventory.inventory_rows(
        table(spark, folder, "supplier").select(line.alias("line"))
    )


@register(
    "q_92_inventory_rows",
    "SELECT concat('node', s_suppkey) AS node, '16' AS cpus, concat('gpu:', s_nationkey % 3) "
    "AS gres, concat('part', s_nationkey % 6, ' extra') AS partition FROM supplier",
)
def inventory_rows(spark, folder):
    return _inventory(spark, folder)


@register(
    "q_92b_inventory_sets",
    "SELECT 'node' AS kind, concat('node', s_suppkey) AS name FROM supplier UNION "
    "SELECT 'partition', concat('part', s_nationkey % 6, ' extra') FROM supplier",
)
def inventory_sets(spark, folder):
    return inventory.inventory_sets(_inventory(spark, folder))

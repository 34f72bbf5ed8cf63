"""Node lists: capacity, ranking, choice of nodes, inventory sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrun.functions import text as tx
from quillrun.operators.run_reports import first_rows

# What makes a node unusable, and how many nodes are asked for at most.
DOWN = "down"
ACCELERATOR = "gpu"
MAX_NODES = 20


def _parts(line: str, limit: int = -1):
    return F.split(F.btrim(F.regexp_replace(line, tx.WHITE_SPACE, " ")), " ", limit)


def node_rows(lines: DataFrame) -> DataFrame:
    """``(seq, partition, node, alloc, idle, other, total, state)`` from ``(seq, line)``.

    Lines read ``partition node alloc/idle/other/total state``; short lines and lines
    with malformed counts drop out.
    """
    counts = F.split(F.get("_p", F.lit(2)), "/")
    numbers = {
        name: F.get("_c", F.lit(i)).try_cast("int")
        for i, name in enumerate(["alloc", "idle", "other", "total"])
    }
    split = (
        lines.select("seq", _parts("line").alias("_p"))
        .filter(F.size("_p") >= 4)
        .withColumn("_c", counts)
        .filter(F.size("_c") == 4)
    )
    rows = split.select(
        "seq",
        F.lower(F.btrim(F.get("_p", F.lit(0)), F.lit("*"))).alias("partition"),
        F.get("_p", F.lit(1)).alias("node"),
        *[number.alias(name) for name, number in numbers.items()],
        F.lower(F.get("_p", F.lit(3))).alias("state"),
    )
    return rows.dropna(subset=list(numbers))


def idle_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes that are up, have idle CPUs, and are not in an accelerator partition."""
    return nodes.filter(
        ~F.contains("state", F.lit(DOWN))
        & (F.col("idle") > 0)
        & ~F.contains("partition", F.lit(ACCELERATOR))
    )


def rank_partitions(idle: DataFrame) -> DataFrame:
    """Partitions by idle CPUs, ties in order of first appearance."""
    return (
        idle.groupBy("partition")
        .agg(
            F.sum("idle").alias("idle_cpus"),
            F.count(F.lit(1)).alias("n_nodes"),
            F.min("seq").alias("first_seq"),
        )
        .orderBy(F.desc("idle_cpus"), "first_seq")
    )


def choose_nodes(idle: DataFrame, max_nodes: int = MAX_NODES) -> DataFrame:
    """Nodes of the best partition in input order: all but one, at most ``max_nodes``.

    Only ``max_nodes`` rows are ever numbered.
    """
    best = rank_partitions(idle).limit(1).select("partition", "n_nodes")
    wanted = F.least(F.greatest(F.col("n_nodes") - 1, F.lit(1)), F.lit(max_nodes))
    candidates = idle.join(F.broadcast(best), "partition")
    return (
        first_rows(candidates, [], ["seq"], max_nodes, "place")
        .filter(F.col("place") <= wanted)
        .select("partition", "place", "node", "idle", "total")
    )


def inventory_rows(lines: DataFrame) -> DataFrame:
    """``(node, cpus, gres, partition)`` from ``(line)``; the fourth field takes the rest."""
    text = F.regexp_replace("line", rf"^{tx.WHITE_SPACE}", "")
    parts = lines.select(F.split(text, tx.WHITE_SPACE, 4).alias("_p")).filter(F.size("_p") == 4)
    return parts.select(
        *[
            F.get("_p", F.lit(i)).alias(name)
            for i, name in enumerate(["node", "cpus", "gres", "partition"])
        ]
    )


def inventory_sets(rows: DataFrame) -> DataFrame:
    """Distinct nodes and partitions as ``(kind, name)`` rows."""
    return rows.unpivot([], ["node", "partition"], "kind", "name").distinct()

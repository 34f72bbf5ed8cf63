from quillrun.operators import inventory

LINES = [
    "Batch* n1 0/4/0/4 idle",
    "batch n2 2/2/0/4 mixed",
    "batch n3 0/4/0/4 DOWN*",
    "gpuA n4 0/8/0/8 idle",
    "short n5",
    "batch n6 a/b/c/d idle",
    "batch n7 1/2/3 idle",
    "  wide   n8   0/6/0/6   idle~ extra",
    "full n9 4/0/0/4 alloc",
]


def nodes(spark, lines=LINES):
    df = spark.createDataFrame(list(enumerate(lines)), "seq long, line string")
    return inventory.node_rows(df)


def test_node_rows_skip_bad_lines(spark):
    got = nodes(spark).orderBy("seq").collect()
    assert [r.node for r in got] == ["n1", "n2", "n3", "n4", "n8", "n9"]
    assert (got[0].partition, got[0].idle, got[2].state) == ("batch", 4, "down*")


def test_idle_nodes_and_ranking(spark):
    idle = inventory.idle_nodes(nodes(spark))
    assert [r.node for r in idle.orderBy("seq").collect()] == ["n1", "n2", "n8"]
    ranked = inventory.rank_partitions(idle).collect()
    assert [(r.partition, r.idle_cpus) for r in ranked] == [("batch", 6), ("wide", 6)]


def test_node_choice(spark):
    idle = inventory.idle_nodes(nodes(spark))
    assert [r.node for r in inventory.choose_nodes(idle).collect()] == ["n1"]
    many = nodes(spark, [f"p m{i} 0/1/0/1 idle" for i in range(30)])
    chosen = inventory.choose_nodes(many, max_nodes=7).orderBy("place").collect()
    assert [r.node for r in chosen] == [f"m{i}" for i in range(7)]
    single = nodes(spark, ["p m0 0/1/0/1 idle"])
    assert inventory.choose_nodes(single).count() == 1
    assert inventory.choose_nodes(nodes(spark, ["x"])).count() == 0


def test_inventory_rows_and_sets(spark):
    lines = ["n1 16 gpu:1 batch", " n2  8  (null)  debug night", "bad 3 x"]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    rows = inventory.inventory_rows(df)
    assert {tuple(r) for r in rows.collect()} == {
        ("n1", "16", "gpu:1", "batch"), ("n2", "8", "(null)", "debug night"),
    }
    sets = {tuple(r) for r in inventory.inventory_sets(rows).collect()}
    assert ("partition", "debug night") in sets and len(sets) == 4

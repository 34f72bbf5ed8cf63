import random

import pytest
from pyspark.sql import functions as F

from quillrun.operators import positions, shards
from quillrun.operators.percentiles import exact_percentiles, quick_percentiles


@pytest.mark.parametrize("n_ranges", [1, 2, 7, 40])
def test_row_index_is_dense(spark, n_ranges):
    keys = random.Random(1).sample(range(10**12), 300)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    got = {
        r.k: (r.row_index, r.n)
        for r in positions.with_row_index(df, "k", total="n", n_ranges=n_ranges).collect()
    }
    assert got == {k: (i, 300) for i, k in enumerate(sorted(keys))}


def test_row_index_with_skewed_leading_key_and_nulls(spark):
    data = [(5, i) for i in range(200)] + [(None, 1000), (float("inf"), 1), (-3.5, 2)]
    df = spark.createDataFrame([(None if a is None else float(a), b) for a, b in data],
                               "a double, b long")
    placed = positions.with_row_index(df, ["a", "b"], n_ranges=8).orderBy("row_index").collect()
    assert [r.row_index for r in placed] == list(range(203))
    assert placed[0].a == -3.5 and placed[-1].a is None and placed[-2].a == float("inf")
    assert [r.b for r in placed[1:201]] == list(range(200))


def test_a_frequent_leading_value_is_cut_by_the_next_key(spark):
    data = [(7, i) for i in range(300)] + [(i, 5000 + i) for i in range(300) if i != 7]
    random.Random(4).shuffle(data)
    df = spark.createDataFrame(data, "a long, b long").repartition(4)
    ranged = positions._with_order_ranges(df, ["a", "b"], 20)
    sizes = [r["count"] for r in ranged.groupBy("_range", "_part").count().collect()]
    assert max(sizes) < 120 and sum(sizes) == len(data)
    placed = positions.with_row_index(df, ["a", "b"], n_ranges=20).collect()
    got = [(r.a, r.b) for r in sorted(placed, key=lambda r: r.row_index)]
    assert got == sorted(data)
    assert sorted(r.row_index for r in placed) == list(range(len(data)))


def test_both_zeros_are_one_value(spark):
    data = [(z, i) for i in range(40) for z in (-0.0, 0.0)] + [(-1.0, 1), (1.0, 1)]
    data = [(a, i) for i, (a, _) in enumerate(data)]
    df = spark.createDataFrame(data, "a double, b long")
    placed = positions.with_row_index(df, ["a", "b"], n_ranges=8).collect()
    got = [r.b for r in sorted(placed, key=lambda r: r.row_index)]
    assert got == [80, *range(80), 81]


def test_row_index_of_empty_and_time_keys(spark):
    empty = spark.createDataFrame([], "k long")
    assert positions.with_row_index(empty, "k").count() == 0
    df = spark.range(20).select(F.timestamp_seconds(-F.col("id")).alias("t"), "id")
    got = [r.id for r in positions.with_row_index(df, "t", n_ranges=3).orderBy("row_index").collect()]
    assert got == list(range(19, -1, -1))
    with pytest.raises(TypeError):
        positions.with_row_index(spark.createDataFrame([(True,)], "s boolean"), "s")


def group_sizes(df, keys, n):
    ranged = positions._with_order_ranges(df, keys, n)
    return [r["count"] for r in ranged.groupBy("_range", "_part").count().collect()]


@pytest.mark.parametrize("share", [0.05, 0.5])
@pytest.mark.parametrize("hot", [500.0, None, float("nan")])
def test_no_group_is_large_when_keys_rise_together(spark, share, hot):
    n_hot = int(20_000 * share)
    rows = [(float(i), i) for i in range(20_000 - n_hot)]
    rows += [(hot, i) for i in range(500, 500 + n_hot)]
    df = spark.createDataFrame(rows, "a double, b long").repartition(4, "b")
    sizes = group_sizes(df, ["a", "b"], 40)
    assert max(sizes) <= 3 * 20_000 / 40 and sum(sizes) == 20_000


def test_the_third_key_cuts_what_the_second_leaves(spark):
    rows = [(1, 2, i) for i in range(9_000)] + [(1, i, i) for i in range(1_000)]
    df = spark.createDataFrame(rows, "a long, b long, c long").repartition(4, "c")
    assert max(group_sizes(df, ["a", "b", "c"], 20)) <= 3 * 10_000 / 20
    placed = positions.with_row_index(df, ["a", "b", "c"], n_ranges=20).collect()
    got = [tuple(r)[:3] for r in sorted(placed, key=lambda r: r.row_index)]
    assert got == sorted(rows) and sorted(r.row_index for r in placed) == list(range(10_000))


def test_string_orders(spark):
    draw = random.Random(9)
    names = ["doc-%09d" % draw.randrange(10**9) for _ in range(3000)]
    names += ["en"] * 2000 + ["", "e", "en\0", "en\0\0", "z", "é", "日本", "doc-", "doc-000"]
    rows = [(s, i) for i, s in enumerate(names)] + [(None, -i) for i in range(1000)]
    df = spark.createDataFrame(rows, "s string, i long").repartition(4, "i")
    assert max(group_sizes(df, ["s", "i"], 30)) <= 3 * len(rows) / 30
    placed = positions.with_row_index(df, ["s", "i"], n_ranges=30).collect()
    got = [(r.s, r.i) for r in sorted(placed, key=lambda r: r.row_index)]
    assert got == sorted(rows, key=lambda r: (r[0] is None, (r[0] or "").encode(), r[1]))


def test_previous_value_of_frequent_steps_and_null_groups(spark):
    rows = [(g, 7 if i % 3 else i, i) for g in ("a", None) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, step long, i long").repartition(3, "i")
    got = positions.with_previous(df, ["g"], ["step", "i"], "i", "before", 12).collect()
    assert len(got) == 1200
    for g in ("a", None):
        own = sorted((s, i) for h, s, i in rows if h == g)
        before = {i: b for (_, i), b in zip(own, [None, *(i for _, i in own)])}
        assert {r.i: r.before for r in got if r.g == g} == before


def test_large_keys_that_share_a_double(spark):
    base = 2**60
    df = spark.createDataFrame([(base + i,) for i in range(100)], "k long")
    got = positions.with_row_index(df, "k", n_ranges=5).collect()
    assert all(r.k - base == r.row_index for r in got)


@pytest.mark.parametrize("n_rows,n_shards", [(22, 8), (3, 5), (16, 4), (1, 1), (100, 7)])
def test_contiguous_shards_are_balanced(spark, n_rows, n_shards):
    sharded = shards.shard_contiguous(spark.range(n_rows), "id", n_shards)
    got = [r.shard for r in sharded.orderBy("id").collect()]
    sizes = [n_rows // n_shards + (1 if i < n_rows % n_shards else 0) for i in range(n_shards)]
    assert got == [i for i, size in enumerate(sizes) for _ in range(size)]


def test_strided_shards_partition_the_table(spark):
    sharded = shards.shard_strided(spark.range(50).repartition(3), "id", 4)
    assert {(r.id, r.shard) for r in sharded.collect()} == {(i, i % 4) for i in range(50)}


def test_batches(spark):
    df = spark.range(10)
    kept = shards.assign_batches(df, "id", 4).orderBy("id").collect()
    assert [(r.batch_id, r.pos_in_batch) for r in kept] == [(i // 4, i % 4) for i in range(10)]
    assert shards.assign_batches(df, "id", 4, drop_last=True).count() == 8
    assert shards.assign_batches(spark.range(8), "id", 4, drop_last=True).count() == 8


def test_step_plan_of_the_published_run(spark):
    row = shards.step_plan(spark.range(2000), 8, 2).first()
    assert (row.global_batch, row.steps_per_epoch, row.total_steps) == (16, 125, 125)


def test_splits_are_stable_and_complete(spark):
    shares = {"train": 0.7, "validation": 0.2, "test": 0.1}
    small = shards.split_rows(spark.range(500), "id", shares)
    large = shards.split_rows(spark.range(1000), "id", shares)
    assert small.join(large, ["id", "split"]).count() == 500
    counts = {r.split: r["count"] for r in large.groupBy("split").count().collect()}
    assert sum(counts.values()) == 1000
    assert abs(counts["train"] - 700) < 60 and abs(counts["test"] - 100) < 40


@pytest.mark.parametrize("n_ranges", [1, 3, 16])
def test_previous_value_crosses_ranges(spark, n_ranges):
    df = spark.createDataFrame(
        [("a", s, float(s * s)) for s in range(60)] + [("b", s, 1.0) for s in (3, 50)],
        "g string, step long, v double",
    )
    got = positions.with_previous(df, ["g"], "step", "v", "before", n_ranges).collect()
    before = {(r.g, r.step): r.before for r in got}
    assert len(before) == 62
    assert all(before["a", s] == (float((s - 1) ** 2) if s else None) for s in range(60))
    assert before["b", 3] is None and before["b", 50] == 1.0


def linear_percentile(values, share):
    ordered = sorted(values)
    place = (len(ordered) - 1) * share
    low = int(place)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (place - low)


@pytest.mark.parametrize("n_ranges", [1, 5, 64])
def test_exact_percentiles(spark, n_ranges):
    draw = random.Random(3)
    data = [("hot", draw.choice([1.0, 2.5, draw.random() * 9]), float(i)) for i in range(400)]
    data += [("cold", 4.0, None), ("cold", 8.0, 2.0)]
    df = spark.createDataFrame(data, "g string, x double, y double").repartition(6)
    shares = {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0}
    got = {
        (r.g, r.metric): r for r in exact_percentiles(df, ["x", "y"], shares, ["g"], n_ranges).collect()
    }
    for g in ("hot", "cold"):
        for i, metric in ((1, "x"), (2, "y")):
            values = [row[i] for row in data if row[0] == g and row[i] is not None]
            row = got[g, metric]
            assert row.n == len(values)
            for name, share in shares.items():
                assert row[name] == pytest.approx(linear_percentile(values, share), abs=1e-12)
    rough = quick_percentiles(df, ["x"], shares, ["g"]).filter("g = 'hot'").first()
    assert rough.n == 400

"""Hard negatives against a plain search."""

import numpy as np
import pytest

from quillrun.llm import hard_negatives
from quillrun.llm.queries import QUERIES

SCHEMA = "vec_id long, label int, vector array<double>, id string, v int, block int, windows string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "w") for r in rows], SCHEMA)


def usable(row):
    vec_id, label, vector = row
    return None not in (vec_id, label, vector) and all(x is not None and np.isfinite(x) for x in vector)


def brute(rows, anchors, positives=5, negatives=10, least=30, most=90):
    rows = [(i, c, [int(x) for x in v]) for i, c, v in filter(usable, rows)]
    first = {}
    for i, c, v in filter(usable, anchors):
        first[i] = min(first.get(i, (c, list(map(int, v)))), (c, list(map(int, v))))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a, (label, vector) in first.items():
        scored = sorted((-score(vector, v), i, c) for i, c, v in rows)
        for p, pid, _ in [s for s in scored if s[2] == label and s[1] != a][:positives]:
            inside = [(s, i) for s, i, c in scored if c != label and least * -p <= 100 * -s <= most * -p]
            out += [(a, pid, n + 1, i, -p, -s) for n, (s, i) in enumerate(inside[:negatives])]
    return sorted(out)


def found(df):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def random_rows(n, seed, dimension=12, labels=4):
    draw = np.random.default_rng(seed)
    return [
        (i, int(draw.integers(labels)), [float(x) for x in draw.integers(-40, 60, dimension)]) for i in range(n)
    ]


@pytest.mark.parametrize("block_rows", [7, 10_000])
def test_equals_plain_search(spark, block_rows):
    rows = random_rows(160, 1)
    rows += [(500 + i, 0, [30.0] * 12) for i in range(40)]  # one frequent vector and label
    rows += [
        (900, 1, None), (901, None, [1.0] * 12), (None, 1, [1.0] * 12), (902, 1, [float("nan")] * 12),
        (903, 2, [None] * 12), (904, 2, [float("inf")] * 12), (905, 2, [0.0] * 12), (906, 2, []), (907, 2, [50.0] * 3),
        rows[3], rows[3], (3, 2, [40.0] * 12),
    ]
    anchors = [r for r in rows if r[0] is not None and r[0] % 10 == 0] + [rows[3], (3, 2, [40.0] * 12), (905, 2, [0.0] * 12)]
    got = hard_negatives.hard_negatives(table(spark, rows), table(spark, anchors), block_rows=block_rows)
    assert found(got) == brute(rows, anchors)


def test_large_numbers_are_exact(spark):
    draw = np.random.default_rng(4)
    rows = [(i, i % 2, [float(x) for x in draw.integers(-(2**30), 2**30, 4)]) for i in range(40)]
    assert found(hard_negatives.hard_negatives(table(spark, rows), table(spark, rows[:6]))) == brute(rows, rows[:6])


def test_empty_tables(spark):
    rows = random_rows(5, 2)
    assert hard_negatives.hard_negatives(table(spark, []), table(spark, rows)).count() == 0
    assert hard_negatives.hard_negatives(table(spark, rows), table(spark, [])).count() == 0
    assert hard_negatives.hard_negatives(table(spark, rows[:1]), table(spark, rows[:1])).count() == 0


def test_bounds_shrink_the_bitmap():
    """What the bounds leave out is never asked for again, and the best are found."""
    draw = np.random.default_rng(3)
    vectors = draw.integers(-5, 6, (3000, 64)) * np.where(np.arange(64) < 6, 40, 1)
    block = hard_negatives.Block(np.arange(3000), np.zeros(3000, int), vectors)
    query = vectors[17]
    alive = np.ones(3000, bool)
    (best,) = hard_negatives.scan(block, query, alive, [(-(1 << 62), 1 << 62)], 5)
    scores = vectors @ query
    order = np.lexsort((np.arange(3000), -scores))[:5]
    assert best == [(-int(scores[i]), int(i)) for i in order]


def test_query_equals_plain_search(spark, folder):
    given = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    moved = lambda r: (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label
    rows = [(r.vec_id, moved(r), [float(np.floor(256 * float(x))) for x in r.embedding]) for r in given]
    got = QUERIES["op12_hard_negatives"](spark, folder)
    assert found(got) == brute(rows, [r for r in rows if r[0] % 100 == 0])

"""Exact and approximate vector search against brute force."""

import math
from collections import Counter

import numpy as np
import pytest

from quillrun.llm import permutation_index, pivot_search
from quillrun.llm.queries import QUERIES


def brute(vectors, queries, k):
    rows = set()
    for q, v in queries:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q)
        rows |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return rows


def frame(spark, rows, name="vector"):
    # Clashing names of the input are not read.
    return spark.createDataFrame(
        [(i, v, "x", 1) for i, v in rows], f"vec_id long, {name} array<double>, block string, v int"
    )


def whole_vectors(n, clusters, seed):
    draw = np.random.default_rng(seed)
    centres = draw.integers(-200, 200, (clusters, 6))
    rows = centres[draw.integers(0, clusters, n)] + draw.integers(-8, 9, (n, 6))
    return [(int(i), [float(x) for x in row]) for i, row in enumerate(rows)]


def test_exact_search_prunes_nothing_right(spark):
    rows = whole_vectors(900, 9, 3)
    rows += [(1000 + i, rows[5][1]) for i in range(300)]  # one vector many times over
    queries = rows[::40]
    found = pivot_search.exact_top_k(
        frame(spark, rows), frame(spark, queries), 5, pivots=8, block_rows=64, query_rows=8
    )
    assert {tuple(r) for r in found.collect()} == brute(rows, queries, 5)


def test_rings_bound_all_distances():
    draw = np.random.default_rng(1)
    points, queries = draw.normal(size=(400, 4)), draw.normal(size=(20, 4))
    pivots = pivot_search.choose_pivots(points, 6)
    far = pivot_search._distances(points, pivots)
    nearest = far.argmin(axis=1)
    own = far[np.arange(400), nearest]
    width = 2 * own.max() / pivot_search.BINS
    bins = np.clip((own / width).astype(int), 0, pivot_search.BINS - 1)
    counts = Counter(zip(nearest.tolist(), bins.tolist(), strict=True))
    rings = pivot_search.Rings(counts, len(pivots), width, 20)
    ring = rings.of[nearest, rings.bin(own)]
    pruned = 0
    for q in queries:
        bounds = rings.nearest_possible(pivot_search._distances(q[None], pivots)[0])
        true = np.linalg.norm(points - q, axis=1)
        assert (bounds[ring] <= true + 1e-9).all()
        pruned += (bounds > np.sort(true)[5]).sum()
    assert pruned > 0


ODD = [
    (1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [math.nan, 1.0]), (5, [math.inf, 1.0]),
    (6, [0.0, 0.0]), (7, [1.0, 2.0]), (8, [3.0]), (None, [1.0, 1.0]), (9, [-1.0, -2.0]),
]


def test_exact_search_of_odd_rows(spark):
    df = frame(spark, ODD)
    found = {tuple(r) for r in pivot_search.exact_top_k(df, df, 3).collect()}
    usable = [(i, (v + [0.0])[:2]) for i, v in ODD if i in (1, 6, 7, 8, 9)]
    assert found == brute(usable, usable, 3)
    empty = frame(spark, [])
    assert pivot_search.exact_top_k(empty, empty, 3).count() == 0
    assert pivot_search.exact_top_k(df, empty, 3).count() == 0
    big = frame(spark, [(1, [2.0**31 - 1, 2.0**30]), (2, [2.0**30 + 1, -5.0]), (3, [7.0, 2.0**30])])
    found = {tuple(r) for r in pivot_search.exact_top_k(big, big, 2).collect()}
    whole = [(r.vec_id, [int(x) for x in r.vector]) for r in big.collect()]
    assert found == brute(whole, whole, 2)


def test_permutations_of_odd_rows(spark):
    df = frame(spark, ODD, "embedding")
    found = {tuple(r) for r in permutation_index.nearest_by_permutation(df, df, 20).collect()}
    usable = [(i, (v + [0.0])[:2]) for i, v in ODD if i in (1, 7, 8, 9)]
    assert found == brute(usable, usable, 20)
    empty = frame(spark, [], "embedding")
    assert permutation_index.nearest_by_permutation(empty, empty, 20).count() == 0


@pytest.mark.parametrize("common", [0, 400])
def test_permutation_recall(spark, common):
    draw = np.random.default_rng(8)
    points = draw.normal(size=(1500, 32))
    points[:common] = points[0] + draw.normal(size=(common, 32)) * 0.01
    points /= np.linalg.norm(points, axis=1)[:, None]
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    queries = rows[::20]
    found = permutation_index.nearest_by_permutation(
        frame(spark, rows, "embedding"), frame(spark, queries, "embedding"), 20, shard_rows=400
    ).collect()
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, {})[r.vec_id] = r.score
    recall = []
    for q, _ in queries:
        scores = points @ points[q]
        scores[q] = -9
        best = np.argsort(-scores)[:20]
        recall.append(len(set(best.tolist()) & set(by_query[q])) / 20)
        assert all(abs(s - scores[i]) < 1e-9 for i, s in by_query[q].items())
    assert np.mean(recall) >= 0.9


def test_search_queries(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    ids, points = table.vec_id.to_numpy(), np.stack(table.embedding).astype(float)
    whole = [(int(i), [int(x) for x in np.floor(256 * p)]) for i, p in zip(ids, points)]
    found = {tuple(r) for r in QUERIES["op2_exact_top_k"](spark, folder).collect()}
    assert found == brute(whole, [w for w in whole if w[0] % 50 == 0], 5)
    near = QUERIES["op5_permutation_index"](spark, folder).toPandas()
    exact = brute(
        list(zip(ids.tolist(), points.tolist())),
        [(i, p) for i, p in zip(ids.tolist(), points.tolist()) if i % 20 == 0],
        20,
    )
    got = set(zip(near.query_id, near.vec_id))
    assert len(got & {(q, i) for q, _, i, _ in exact}) / len(exact) >= 0.9

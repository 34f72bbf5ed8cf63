"""The quality model on held-out documents and on odd rows."""

import math
import zlib

import numpy as np

from quillrun.llm import quality
from quillrun.llm.queries import QUERIES

SMALL = quality.Settings(buckets=1 << 12, dimensions=4, sample_rows=200)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, text string")


def test_learns_and_scores_odd_rows(spark, docs_of):
    good = [(i, f"the story of a day {i} and of the night in the town") for i in range(60)]
    junk = [(100 + i, " ".join([f"zq{i}x"] * 12)) for i in range(60)]
    docs = docs_of([*good, *junk, (500, None), (501, ""), (None, "the town"), (1, good[1][1])])
    labels = labels_of(spark, [(i, 1, "") for i, _ in good] + [(i, 0, "") for i, _ in junk] + [(500, None, ""), (None, 1, "")])
    model = quality.fit(docs, labels, settings=SMALL)
    found = quality.score(docs, model, out="good").collect()
    assert len(found) == 124 and found[0].asDict().keys() == {*docs.columns, "good"}
    by_id = {r.doc_id: r.good for r in found}
    assert min(by_id[i] for i, _ in good) > 0.5 > max(by_id[i] for i, _ in junk)
    assert 0 <= by_id[500] == by_id[501] <= 1
    again = quality.score(docs, quality.fit(docs, labels, settings=SMALL), out="good").collect()
    assert {(r.doc_id, r.good) for r in again} == {(r.doc_id, r.good) for r in found}


def test_scores_equal_the_plain_sum(spark, docs_of):
    draw = np.random.default_rng(0)
    model = quality.Model(
        draw.normal(size=(SMALL.buckets, 4)), draw.normal(size=4), 0.3, SMALL
    )
    texts = ["a a b", "one two two, three", "x", "é é é ß 😀"]
    for r in quality.score(docs_of(list(enumerate(texts))), model, out="good").collect():
        buckets, counts = quality.features(r.text, SMALL)
        mean = (counts / counts.sum()) @ model.vectors[buckets]
        assert math.isclose(r.good, 1 / (1 + math.exp(-(mean @ model.weights + 0.3))), rel_tol=1e-6)


def test_nothing_to_learn_from(spark, docs_of):
    docs = docs_of([(1, "a b"), (2, "c")])
    for rows in ([], [(1, 1, "")]):
        model = quality.fit(docs, labels_of(spark, rows), settings=SMALL)
        assert {r.good for r in quality.score(docs, model, out="good").collect()} == {0.5}
    model = quality.fit(docs_of([]), labels_of(spark, []), settings=SMALL)
    assert quality.score(docs_of([]), model, out="good").count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op10_quality"](spark, folder).toPandas()
    assert len(found) == 1000
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]).all()
    assert (found.predicted == (found.score >= 0.3)).all() and found.score.between(0, 1).all()
    known = found.merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    held = known[known.held_out]
    assert (held.predicted == held.quality).mean() >= 0.97

"""The pipeline's stages against plain code."""

import re
from collections import Counter

import corpus_pipeline
from quillrun.llm.storage import rewritten
from tests.llm.test_near_dup import brute
from tests.llm.test_secrets import base_spans

FOLDER = "/root/testdata/sf0.01"


def test_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = rewritten(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        if name == "quality":
            known = [(i in after) == bool(q) for i, q in labels.items()]
            assert sum(known) / len(known) >= 0.99
        elif name == "near_duplicates":
            expected = brute(sorted((i, r.text) for i, r in before.items()), 5)
            assert set(after) == {i for i, _, component, _ in expected if i == component}
        elif name == "secrets":
            assert after.keys() == before.keys()
            for i, r in after.items():
                spans = base_spans(before[i].text)
                assert bool(spans) == (r.text != before[i].text) and not base_spans(r.text)
                assert r.n_chars == len(r.text)
        if name != "secrets":
            assert all(after[i] == before[i] for i in after)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).toPandas()
    assert set(packed.doc_id) == set(after)
    assert packed.groupby("sequence_id").length.sum().max() <= 2048
    whole = corpus_pipeline.run(spark, FOLDER).toPandas()
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert Counter(map(tuple, whole[key].to_numpy())) == Counter(map(tuple, packed[key].to_numpy()))


def test_stages_of_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (None, "a b", "en", "s", 3), (None, None, None, None, 0),
            (2, "", "en", "s", 0), (3, "w " * 9, "en", "s", 18), (3, "w " * 9, "en", "s", 18)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        once = corpus_pipeline.single_documents(spark, docs, FOLDER)
        assert once.columns == docs.columns and once.count() == max(0, len(given) - 1)
        assert corpus_pipeline.without_secrets(spark, docs, FOLDER).count() == len(given)
        assert corpus_pipeline.packed(spark, docs, FOLDER).count() == len(given)


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "packing"]
    assert re.match("One|Pieces|Documents|All", corpus_pipeline.STAGES[0][1].__doc__)

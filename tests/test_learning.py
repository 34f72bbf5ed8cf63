import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillrun.operators import evaluation, inference, language_model, learn


def test_ngram_model_and_perplexity(spark):
    train = spark.createDataFrame([("aa bb aa bb cc",), ("aa cc",), ("",)], "text string")
    held = spark.createDataFrame([("aa bb dd",), ("zz aa",)], "text string")
    pairs = Counter([("aa", "bb"), ("bb", "aa"), ("aa", "bb"), ("bb", "cc"), ("aa", "cc")])
    contexts = Counter()
    for (context, _), n in pairs.items():
        contexts[context] += n
    model = {(r.context, r.target): r for r in language_model.fit_ngram_lm(train, "text").collect()}
    assert set(model) == set(pairs)
    for (context, target), n in pairs.items():
        row = model[context, target]
        assert row.p == pytest.approx((n + 1) / (contexts[context] + 3))
    asked = [("aa", "bb"), ("bb", "dd"), ("zz", "aa")]
    loss = -sum(math.log((pairs[a] + 1) / (contexts[a[0]] + 3)) for a in asked) / len(asked)
    row = language_model.evaluate_ngram_lm(train, held, "text").first()
    assert row.n_pairs == 3
    assert row.cross_entropy == pytest.approx(loss)
    assert row.perplexity == pytest.approx(math.exp(loss))


def test_longer_contexts(spark):
    texts = spark.createDataFrame([("aa bb cc dd",)], "text string")
    got = [tuple(r) for r in language_model.token_pairs(texts, "text", 3).collect()]
    assert got == [("aa bb", "cc"), ("bb cc", "dd")]
    with pytest.raises(ValueError):
        language_model.token_pairs(texts, "text", 1)


@pytest.fixture(scope="module")
def news(spark):
    themes = {"sport": "ball goal team", "world": "vote state war", "tech": "chip code data"}
    data = [
        (i, f"{words} extra{i % 4} {words.split()[i % 3]}", name)
        for i in range(40)
        for name, words in themes.items()
    ]
    return spark.createDataFrame(data, "id long, text string, topic string")


def test_text_classifier_learns_saves_and_loads(spark, news, tmp_path):
    model = learn.fit_text_classifier(news, "text", "topic", vocab_size=100, max_iter=10)
    score = evaluation.accuracy(learn.classify(model, news, ["topic"]), "predicted", "topic").first()
    assert score.accuracy == 1.0
    path = str(tmp_path / "model")
    learn.save_model(model, path)
    again = learn.classify(learn.load_model(path), news, ["id", "topic"])
    assert again.filter("topic = predicted").count() == news.count()


def test_text_classifier_counts_words_once_for_training_and_scoring(spark, news):
    """The predictions of the model applied to texts, though no text is split again."""
    odd = [(900, None, "sport"), (901, "", "tech"), (902, "VOTE a vote, état_1 x 7 ball", None)]
    rows = news.unionByName(spark.createDataFrame(odd, news.schema))
    train = F.col("id") % 4 != 0
    model, scored = learn.fit_and_classify(
        rows, "text", "topic", train, ["id", "topic"], vocab_size=100, max_iter=10
    )
    assert "_text" not in scored.columns and "regexp" not in scored._jdf.queryExecution().toString()
    readable = rows.filter("text IS NOT NULL")
    again = learn.classify(model, readable, ["id", "topic"])
    found = sorted(map(tuple, scored.filter("id <> 900").collect()), key=str)
    assert found == sorted(map(tuple, again.collect()), key=str)
    assert scored.count() == rows.count() and scored.filter("id = 900 AND predicted IS NOT NULL").count() == 1
    fitted = learn.fit_text_classifier(readable.filter(train), "text", "topic", vocab_size=100, max_iter=10)
    assert sorted(fitted.stages[1].vocabulary) == sorted(model.stages[1].vocabulary)
    assert "vote" in fitted.stages[1].vocabulary and "x" not in fitted.stages[1].vocabulary


def test_text_classifier_counts_as_the_vectorizer_does(spark, monkeypatch):
    """Word counts by Arrow are those of CountVectorizer over the split texts."""
    from quillrun.functions import text as tx
    from quillrun.operators import term_codes

    monkeypatch.setattr(term_codes, "SLICE_BYTES", 20)
    texts = ["Été ÉTÉ un_1 a bb", "", "bb, bb; x bb\n\tcc", "\U0001d7d8 \U0001d7d8\U0001d7d9 日本 日 İi", "the the cc"]
    data = [(i, t, "ab"[i % 2]) for i, t in enumerate(texts)]
    rows = spark.createDataFrame(data, "id long, text string, name string")
    model, counts = learn._fit_on_counts(rows, "text", "name", F.lit(True), ["id"], 1000, 2, 0.1)
    want = {w for r in rows.select(tx.words(F.col("text")).alias("w")).collect() for w in r.w}
    assert set(model.stages[1].vocabulary) == want
    split = model.stages[1].transform(model.stages[0].transform(rows))
    assert {r.id: r._counts for r in counts.collect()} == {r.id: r._counts for r in split.collect()}


def test_text_classifier_words_are_frequent_ones_and_ties_go_by_word(spark):
    data = [("zz zz zz dd cc", "p"), ("zz bb aa bb aa", "q"), ("ee ff gg hh", "q")]
    rows = spark.createDataFrame(data, "text string, name string")
    for size, words in ((1, {"zz"}), (2, {"zz", "aa"}), (4, {"zz", "aa", "bb", "cc"})):
        model = learn.fit_text_classifier(rows, "text", "name", vocab_size=size, max_iter=2)
        assert set(model.stages[1].vocabulary) == words
        assert model.stages[1].vocabulary[0] == "zz"


def test_head_on_features(spark):
    data = [(i, [float(i % 2), 1.0 - i % 2, 0.1], i % 2) for i in range(40)]
    df = spark.createDataFrame(data, "id long, f array<float>, label int")
    model = learn.fit_head(df, "f", "label")
    got = learn.predict_head(model, df, "f", ["label"])
    assert got.filter("label = prediction").count() == 40


def test_predict_loads_the_model_and_batches(spark):
    def make_model():
        import numpy as np

        def score(batch):
            assert len(batch) <= 7
            return np.asarray(batch).sum(axis=1)

        return score

    df = spark.range(50).select("id", F.array(F.col("id") * 1.0, F.lit(2.0)).alias("x"))
    got = inference.predict(df, make_model, ["x"], "s", "double", 7, [[2]]).collect()
    assert all(r.s == r.id + 2.0 for r in got)


def test_map_batches_and_metric(spark):
    def sizes(frame):
        import pandas as pd

        return pd.DataFrame({"n": [len(frame)]})

    counts = [r.n for r in inference.map_batches(spark.range(0, 100, 1, 2), sizes, "n long", 8).collect()]
    assert sum(counts) == 100 and max(counts) <= 8

    def add_batch(frame):
        return {"hits": float((frame["id"] % 4 == 0).sum()), "total": float(len(frame))}

    ratio = F.col("hits") / F.greatest("total", F.lit(1.0))
    row = inference.batched_metric(
        spark.range(100).repartition(3), add_batch, ["hits", "total"], ratio, "share", 9
    ).first()
    assert row.share == 0.25


def test_accuracy_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], "a int, b int")
    row = evaluation.accuracy(empty, "a", "b").first()
    assert (row.n_correct, row.n_total, row.accuracy) == (0, 0, 0.0)


def test_rank_reduction_takes_longest_time(spark):
    df = spark.createDataFrame(
        [(0, True, 1.0), (0, False, 1.0), (1, True, 0.5)], "rank int, ok boolean, sec double"
    )
    counts = evaluation.per_rank_counts(
        df, F.col("rank"), F.col("ok"), F.lit(128), F.col("sec")
    )
    row = evaluation.reduce_ranks(counts).first()
    assert (row.correct, row.total, row.tokens, row.wall_seconds) == (2.0, 3.0, 384.0, 2.0)
    assert row.global_samples_per_sec == 1.5 and row.global_tokens_per_sec == 192.0
    nothing = evaluation.reduce_ranks(counts.limit(0)).first()
    assert nothing.global_accuracy == 0.0


def test_best_epoch_ties_go_to_the_first(spark):
    metrics = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.9), (4, 0.1)], "epoch long, accuracy double")
    row = evaluation.best_epoch(metrics).first()
    assert (row.best_accuracy, row.best_epoch, row.last_accuracy, row.last_epoch) == (0.9, 2, 0.1, 4)

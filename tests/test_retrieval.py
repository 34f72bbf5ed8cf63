import math
import random
import re
from collections import Counter

import pytest

from quillrun.operators import retrieval
from quillrun.plans import answers

WORDS = ["the", "cat", "dog", "runs", "blue", "tree", "fast", "x", "deep", "sea"]


def make_texts(n, seed):
    draw = random.Random(seed)
    # One word is in nearly every text, as a stop word would be.
    return [
        (i, " ".join(["the"] * (i % 3 > 0) + draw.choices(WORDS, k=draw.randint(0, 9))))
        for i in range(n)
    ]


DOCS = make_texts(30, 1) + [(30, ""), (31, "cat dog"), (32, "cat dog")]
ASKED = make_texts(6, 2) + [(100, "unknown words"), (101, ""), (102, "Cat DOG")]
K = 4


def terms(text):
    words = re.findall(r"\w\w+", text.lower())
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute_tfidf(max_features):
    counts, df = Counter(), Counter()
    for _, text in DOCS:
        counts.update(terms(text))
        df.update(set(terms(text)))
    kept = sorted(counts, key=lambda t: (-counts[t], t))[:max_features]
    idf = {t: math.log((1 + len(DOCS)) / (1 + df[t])) + 1 for t in kept}

    def weights(text):
        raw = {t: n * idf[t] for t, n in Counter(terms(text)).items() if t in idf}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / norm for t, w in raw.items()}

    docs = {i: weights(text) for i, text in DOCS}
    return {
        q: {i: sum(w * d.get(t, 0) for t, w in weights(text).items()) for i, d in docs.items()}
        for q, text in ASKED
    }


def brute_overlap():
    def score(q, d):
        q, d = set(q.lower().split()), set(d.lower().split())
        return len(q & d) / math.sqrt(len(q) * len(d)) if q and d else 0.0

    return {q: {i: score(text, d) for i, d in DOCS} for q, text in ASKED}


def brute_hits(scores, k):
    return {
        (q, rank): (doc, round(score, 9))
        for q, by_doc in scores.items()
        for rank, (doc, score) in enumerate(
            sorted(by_doc.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k], start=1
        )
    }


@pytest.fixture(scope="module")
def tables(spark):
    corpus = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(ASKED, "query_id long, text string")
    return corpus, asked


@pytest.mark.parametrize("small,pruned", [(True, True), (False, True), (None, None), (False, False)])
@pytest.mark.parametrize("kind,max_features", [("tfidf", 20_000), ("tfidf", 12), ("overlap", 0)])
def test_hits_equal_brute_force(tables, small, pruned, kind, max_features):
    corpus, asked = tables
    hits = retrieval.retrieve(
        corpus, asked, K, kind, max_features=max_features or 1, small=small, pruned=pruned
    ).collect()
    expected = brute_hits(brute_tfidf(max_features) if kind == "tfidf" else brute_overlap(), K)
    assert {(h.query_id, h.rank): (h.doc_id, round(h.score, 9)) for h in hits} == expected
    assert len(hits) == K * len(ASKED)


def test_small_corpus_gives_all_documents(tables):
    corpus, asked = tables
    hits = retrieval.retrieve(corpus.filter("doc_id < 2"), asked, K, "overlap").collect()
    assert len(hits) == 2 * len(ASKED)


def test_weights_have_length_one(tables):
    corpus, _ = tables
    fitted = retrieval.fit_tfidf(corpus, "doc_id", "text", 12)
    lengths = (
        retrieval.tfidf_weights(corpus, fitted, "doc_id", "text")
        .groupBy("doc_id").agg({"weight": "count"}).count()
    )
    squares = retrieval.tfidf_weights(corpus, fitted, "doc_id", "text").selectExpr(
        "doc_id", "weight * weight AS w"
    ).groupBy("doc_id").sum("w").collect()
    assert len(squares) == lengths
    assert all(abs(r["sum(w)"] - 1) < 1e-9 for r in squares)


def test_batch_bounds(spark, monkeypatch):
    asked = spark.createDataFrame(ASKED, "query_id long, text string")
    assert retrieval.batch_is_small(asked, "text")
    monkeypatch.setattr(retrieval, "BROADCAST_CHARS", 10)
    assert not retrieval.batch_is_small(asked, "text")


def test_broadcast_plan_never_shuffles_scores(tables):
    corpus, asked = tables
    fitted = retrieval.fit_tfidf(corpus, "doc_id", "text")
    scores = retrieval.cosine_scores(
        retrieval.tfidf_weights(corpus, fitted, "doc_id", "text"),
        retrieval.tfidf_weights(asked, fitted, "query_id", "text"),
        True,
    )
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query_id" not in plan.split("BroadcastExchange")[0]
    top = retrieval.top_k(scores, asked.select("query_id"), corpus.select("doc_id"), K)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_unknown_kind(tables):
    with pytest.raises(ValueError):
        retrieval.retrieve(*tables, kind="other")


@pytest.mark.parametrize("fits", [True, False])
def test_prompts(tables, monkeypatch, fits):
    if not fits:
        monkeypatch.setattr(retrieval, "BROADCAST_QUERIES", 1)
    corpus, asked = tables
    got = {r.query_id: r.prompt for r in answers.build_prompts(corpus, asked, 2, "overlap").collect()}
    texts, hits = dict(DOCS), brute_hits(brute_overlap(), 2)
    for query, text in ASKED:
        block = "\n\n".join(f"- {texts[hits[query, rank][0]]}" for rank in (1, 2))
        assert got[query] == (
            "Answer the question concisely using the context.\n"
            f"Context:\n{block}\n\nQuestion: {text}\nAnswer:"
        )


def test_answers_come_from_the_callers_generator(tables):
    def make_echo():
        import numpy as np

        return lambda prompts: np.array([f"answer of {len(p)}" for p in prompts], dtype=object)

    corpus, asked = tables
    rows = answers.answer(corpus, asked, make_echo, 2, "overlap").collect()
    assert len(rows) == len(ASKED)
    assert all(r.answer == f"answer of {len(r.prompt)}" for r in rows)


def test_single_query(tables, spark):
    corpus, _ = tables
    one = spark.createDataFrame([(1, "cat dog")], "query_id long, text string")
    hits = retrieval.retrieve(corpus, one, 2, "overlap").orderBy("rank").collect()
    assert [h.doc_id for h in hits] == [31, 32]


def test_query_shards(tables):
    _, asked = tables
    rows = answers.shard_queries(asked, "query_id", 2, batch_size=2).orderBy("query_id").collect()
    assert [r.shard for r in rows] == [i % 2 for i in range(len(ASKED))]
    assert [r.batch_id for r in rows] == [i // 2 // 2 for i in range(len(ASKED))]


def test_corpus_stats(tables):
    corpus, _ = tables
    row = retrieval.corpus_stats(corpus, retrieval.fit_tfidf(corpus, "doc_id", "text", 12)).first()
    assert (row.kind, row.n_docs, row.n_terms) == ("tfidf", len(DOCS), 12)


@pytest.mark.parametrize("max_features", [5, 40, 300, 10_000])
def test_fit_counts_pairs_of_frequent_words_alone(spark, max_features):
    """Ties in words and pairs included: all words of the second half are found once."""
    draw = random.Random(3)
    common = [f"w{i}" for i in range(30)]
    texts = [" ".join(draw.choices(common, k=12)) for _ in range(40)]
    texts += [f"once{2 * i} once{2 * i + 1}" for i in range(60)] + [None, "", "Ünder ünder x"]
    corpus = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    n, df = Counter(), Counter()
    for text in texts:
        n.update(terms(text or ""))
        df.update(set(terms(text or "")))
    kept = sorted(n, key=lambda t: (-n[t], t.encode()))[:max_features]
    fitted = retrieval.fit_tfidf(corpus, "doc_id", "text", max_features).collect()
    assert {r["term"]: (r["n"], r["df"]) for r in fitted} == {t: (n[t], df[t]) for t in kept}
    found = retrieval.frequent_words(
        retrieval.stored_words(corpus, "doc_id", "text"), "text", max_features
    )
    if found is not None:
        assert {w for t in kept for w in t.split(" ")} <= set(found[0])
        assert all(n[w] >= found[1] for w in found[0])


def test_weights_are_built_without_rows_of_unknown_terms(spark, rows):
    """Rows that share a key share its norm; a text is one row until its norm is known."""
    texts = [(1, "cat dog cat"), (1, "cat sea"), (None, "dog"), (None, "sea sea"), (2, "x"), (3, None)]
    corpus = spark.createDataFrame(texts, "doc_id long, text string")
    fitted = spark.createDataFrame(
        [("cat", 2.0), ("dog cat", 3.0), ("sea", 1.0)], "term string, idf double"
    )
    weights = retrieval.tfidf_weights(corpus, fitted, "doc_id", "text")
    root = math.sqrt(4**2 + 3**2 + 2**2 + 1**2)
    found = [(k, t, round(w * (root if k else 1), 9)) for k, t, w in rows(weights)]
    assert sorted(found, key=str) == sorted(
        [(1, "cat", 4.0), (1, "dog cat", 3.0), (1, "cat", 2.0), (1, "sea", 1.0), (None, "sea", 1.0)],
        key=str,
    )
    plan = weights._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.index("inline") < plan.index("Window")


def test_term_codes_in_slices(monkeypatch):
    import pyarrow as pa

    from quillrun.operators import term_codes

    texts = ["aa bb aa bb", None, "", "bb", "cc aa bb zz"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["words"])
    monkeypatch.setattr(term_codes, "SLICE_BYTES", 12)
    assert [b.num_rows for b in term_codes.in_slices([batch], 0)] == [3, 1, 1]
    n, df = Counter(), Counter()
    for part in term_codes.count_codes([batch], pa.array(["aa", "bb", "cc"]), (1, 2)):
        for code, a, b in zip(*(c.to_pylist() for c in part.columns)):
            n[code] += a
            df[code] += b
    # aa, bb, cc, aa bb, bb aa, cc aa
    assert n == {0: 3, 1: 4, 2: 1, 4: 3, 6: 1, 9: 1}
    assert df == {0: 2, 1: 3, 2: 1, 4: 2, 6: 1, 9: 1}

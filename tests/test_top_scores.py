"""Best scores over postings with bounds, against all scores."""

import random
from collections import defaultdict

import pytest

from quillrun.operators import retrieval
from quillrun.operators.top_scores import PostingIndex


def all_scores(postings, queries):
    of_term = defaultdict(list)
    for doc, _, term, weight in postings:
        of_term[term].append((doc, weight))
    scores = defaultdict(lambda: defaultdict(float))
    for query, term, asked in queries:
        for doc, weight in of_term[term]:
            scores[query][doc] += asked * weight
    return scores


def built(spark, postings, queries, small):
    return PostingIndex(
        spark.createDataFrame(postings, "doc_id long, size double, term string, weight double"),
        spark.createDataFrame(queries, "query_id long, term string, weight double"),
        small,
    )


def skewed(n_docs, seed):
    """Two terms in every document, rare ones in few, weights by the size of a document."""
    draw = random.Random(seed)
    postings = []
    for doc in range(n_docs):
        terms = {"the", "of", *(f"t{int(draw.paretovariate(0.5)) % 5000}" for _ in range(draw.randint(1, 30)))}
        size = float(len(terms))
        postings += [(doc, size, t, draw.choice([0.25, 0.5, 1.0]) / size**0.5) for t in sorted(terms)]
    queries = [
        (q, t, draw.choice([0.5, 1.0]))
        for q in range(12)
        for t in sorted({"the", "of", *(f"t{draw.randint(0, 60)}" for _ in range(6))})
    ]
    return postings, [*queries, (50, "the", 1.0), (51, "nowhere", 1.0)]


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("k", [1, 4])
def test_best_are_among_the_scores(spark, small, k):
    postings, queries = skewed(300, 7)
    index = built(spark, postings, queries, small)
    got = defaultdict(dict)
    for r in index.best(k).collect():
        got[r.query_id][r.doc_id] = r.score
    expected = all_scores(postings, queries)
    for query, scores in expected.items():
        assert all(abs(scores[d] - s) < 1e-12 for d, s in got[query].items())
        ranked = sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]
        assert {d for d, _ in ranked} <= set(got[query])


def test_frequent_terms_are_not_joined(spark):
    """Far fewer pairs are looked at than share a term, and no block of the frequent ones."""
    draw = random.Random(3)
    rare = lambda: f"r{draw.randint(0, 5000)}"
    texts = [(i, " ".join(["the", "of", "and"] + [rare() for _ in range(20)])) for i in range(1500)]
    asked = [(q, "the of and " + " ".join(text.split()[3:15])) for q, text in texts[:15]]
    corpus = spark.createDataFrame(texts, "doc_id long, text string")
    queries = spark.createDataFrame(asked, "query_id long, text string")
    docs = retrieval.overlap_weights(corpus, "doc_id", "text")
    index = PostingIndex(docs, retrieval.overlap_weights(queries, "query_id", "text"), True)
    thresholds = index.thresholds(3)
    assert index.needed(thresholds).filter("term IN ('the', 'of', 'and')").isEmpty()
    looked_at = index.candidates(thresholds).count()
    assert looked_at < 0.1 * len(texts) * len(asked)
    fully = index.best(3).count()
    assert fully < 0.06 * len(texts) * len(asked)
    scored = index.first_pairs(3).count()
    assert scored < 0.1 * len(texts) * len(asked)


def test_fewer_documents_than_wanted(spark):
    postings = [(1, 2.0, "a", 0.5), (1, 2.0, "b", 0.5), (2, 1.0, "a", 1.0)]
    index = built(spark, postings, [(7, "a", 1.0), (7, "b", 1.0)], True)
    got = {r.doc_id: r.score for r in index.best(5).collect()}
    assert got == {1: 1.0, 2: 1.0}

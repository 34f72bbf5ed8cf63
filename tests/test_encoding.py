import pytest
from pyspark.sql import functions as F

from quillrun.operators import encoding

TEXTS = [(1, "bb aa bb cc"), (2, ""), (3, "aa"), (4, "zz aa bb cc dd ee ff gg"), (5, "x ! y")]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(TEXTS, "id long, text string")


@pytest.fixture
def vocab(texts):
    return encoding.fit_vocab(texts, "text", 4)


def test_vocab_keeps_most_frequent_by_term(vocab):
    got = {r.term: (r.term_id, r.n) for r in vocab.collect()}
    assert got == {"aa": (2, 3), "bb": (3, 3), "cc": (4, 2), "dd": (5, 1)}


def test_encode_fixed_length(texts, vocab):
    rows = {r.id: r for r in encoding.encode(texts, vocab, "id", "text", 5).collect()}
    assert len(rows) == len(TEXTS)
    assert rows[1].input_ids == [3, 2, 3, 4, 0] and rows[1].attention_mask == [1, 1, 1, 1, 0]
    assert rows[2].input_ids == [0] * 5 and rows[2].attention_mask == [0] * 5
    assert rows[3].input_ids == [2, 0, 0, 0, 0]
    assert rows[4].input_ids == [1, 2, 3, 4, 5] and rows[4].attention_mask == [1] * 5
    assert rows[5].input_ids == [0] * 5


def test_encode_variable_length(texts, vocab):
    rows = {r.id: r.input_ids for r in encoding.encode_variable(texts, vocab, "id", "text").collect()}
    assert rows[4] == [1, 2, 3, 4, 5, 1, 1, 1] and rows[2] == []


def test_pairs_positions_and_account(texts, vocab):
    encoded = encoding.encode(texts, vocab, "id", "text", 5)
    pairs = {(r.id, r.pos, r.token, r.target) for r in encoding.causal_pairs(encoded, "id").collect()}
    assert pairs == {
        (1, 0, 3, 2), (1, 1, 2, 3), (1, 2, 3, 4), (4, 0, 1, 2), (4, 1, 2, 3), (4, 2, 3, 4),
        (4, 3, 4, 5),
    }
    places = {r.id: r.position_ids for r in encoding.position_ids(encoded, "id").collect()}
    assert places[1] == [0, 1, 2, 3, 3] and places[2] == [0] * 5
    row = encoding.token_account(encoded).first()
    assert (row.n_rows, row.real_tokens, row.padded_tokens) == (5, 10, 25)
    assert row.with_generated == 10 + 5 * 16


def test_position_ids_of_any_mask(spark):
    masks = spark.createDataFrame([(1, [0, 0, 1, 1]), (2, [1, 0, 1, 0])], "id int, m array<int>")
    got = {r.id: r.position_ids for r in encoding.position_ids(masks, "id", mask="m").collect()}
    assert got == {1: [0, 0, 0, 1], 2: [0, 0, 1, 1]}


def test_tokens_are_cut_before_they_are_shuffled_once(texts, vocab):
    encoded = encoding.encode(texts, vocab, "id", "text", 5)
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    by_id = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(id" in line]
    assert len(by_id) == 1 and "REPARTITION_BY_COL" in lines[by_id[0]]
    assert any("slice(" in line for line in lines[by_id[0] :])


def test_windows_cover_whole_texts(texts, vocab):
    full = {r.id: r.input_ids for r in encoding.encode_variable(texts, vocab, "id", "text").collect()}
    for overlap in (0, 1):
        rows = encoding.encode_windows(texts, vocab, "id", "text", 3, overlap).collect()
        for key, ids in full.items():
            own = sorted((r.chunk, r.input_ids, r.attention_mask) for r in rows if r.id == key)
            count = max(1, -(-(len(ids) - overlap) // 3))
            assert [c for c, _, _ in own] == list(range(count))
            for c, window, mask in own:
                part = ids[3 * c : 3 * c + 3 + overlap]
                pad = 3 + overlap - len(part)
                assert window == part + [0] * pad and mask == [1] * len(part) + [0] * pad
    row = encoding.word_account(texts, "text", 3).first()
    assert (row.n_rows, row.real_tokens, row.padded_tokens, row.with_generated) == (8, 13, 24, 141)


def test_detects_encoded_tables(texts, vocab):
    assert encoding.is_encoded(encoding.encode(texts, vocab, "id", "text", 5))
    assert not encoding.is_encoded(texts)
    assert texts.select(F.lit(1).alias("input_ids")).columns == ["input_ids"]

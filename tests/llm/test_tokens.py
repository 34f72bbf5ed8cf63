"""Packing, token counts and the codec against the libraries."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillrun.llm import bpe_codec, byte_bpe, packing, token_counts
from quillrun.llm.queries import QUERIES

BYTE, RANKS, WORD = (
    P.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json")
)
PARTS = st.lists(
    st.sampled_from(
        ["a", "b c", " ", "  ", "\n", "\t ", "'s", "'RE", "é", "ß", "İ", "Σ", "ς", "½", "²", "一",
         "́", "\xa0", "\x85", "\x1c", "12", "<|endoftext|>", "<|startoftext|>", "!..", "😀", "K"]
    ),
    max_size=25,
).map("".join)


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE)


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def rank_library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def as_bytes(ids):
    return np.array(ids, dtype="<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS | st.text(max_size=20), min_size=1, max_size=5))
def test_encoders_equal_the_libraries(byte_library, word_library, rank_library, values):
    ours = byte_bpe.from_json(BYTE, P.PATTERN)
    plain = byte_bpe.from_tiktoken(RANKS, P.PATTERN)
    count = token_counts.counter(WORD).count
    expected = [as_bytes(byte_library.encode(v, add_special_tokens=False).ids) for v in values]
    assert list(ours.encode_all(values)) == expected
    for value, ids in zip(values, plain.encode_all(values), strict=True):
        assert ids == as_bytes(rank_library.encode_ordinary(value))
        assert plain.decode(ids) == value.encode()
        assert count(value) == len(word_library.encode(value, add_special_tokens=False).ids)


def test_word_caches_stay_bounded_and_right(byte_library):
    ours = byte_bpe.from_json(BYTE, P.PATTERN)
    small = byte_bpe.ByteBpe({bytes([b]): b for b in range(256)}, P.PATTERN, {}, entries=3)
    assert small.encode("a bb ccc dddd eeeee " + "f" * 100) and len(small.words) <= 3
    long = "ab" * 50_000
    assert ours.encode(long) == as_bytes(byte_library.encode(long).ids)


ROWS = [(1, "a b"), (1, "a b"), (2, ""), (3, None), (None, "x <|endoftext|> y"), (4, "word " * 9000)]


def test_packing_places_every_id_once(docs_of, byte_library):
    pieces = packing.token_pieces(docs_of(ROWS), BYTE, P.PATTERN, capacity=64)
    found = packing.pack(pieces, capacity=64).toPandas()
    ids = {
        k: byte_library.encode(t or "", add_special_tokens=False).ids + [1] for k, t in ROWS
    }
    expected = Counter(
        (k, at, bytes(as_bytes(ids[k][at : at + 64])))
        for k, _ in ROWS
        for at in range(0, len(ids[k]), 64)
    )
    got = Counter(
        (None if np.isnan(r.doc_id) else int(r.doc_id), r.start, bytes(r.ids))
        for r in found.itertuples()
    )
    assert got == expected
    ordered = found.sort_values(["sequence_id", "offset"])
    ends = ordered.groupby("sequence_id").length.cumsum()
    assert (ends - ordered.length == ordered.offset).all() and ends.max() <= 64
    joined = packing.sequences(packing.pack(pieces, capacity=64), 64, pad_id=7).toPandas()
    assert set(map(len, joined.ids)) == {256}
    assert joined.n_tokens.sum() == sum(len(ids[k]) for k, _ in ROWS)


def test_packing_of_nothing_and_of_real_texts(spark, docs_of, folder, real_texts, byte_library):
    empty = packing.token_pieces(docs_of([]), BYTE, P.PATTERN)
    assert packing.pack(empty).count() == 0
    found = QUERIES["op1_packing"](spark, folder).toPandas()
    for r in found.itertuples():
        ids = byte_library.encode(real_texts[r.doc_id], add_special_tokens=False).ids + [1]
        assert zlib.crc32(as_bytes(ids[r.start : r.start + r.length])) == r.ids_crc32
        assert len(ids) == r.doc_tokens
    used = found.groupby("sequence_id").length.sum()
    assert used.sum() == found.drop_duplicates("doc_id").doc_tokens.sum()
    assert 1 - used.sum() / (2048 * len(used)) < 0.02


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 3000), max_size=50))
def test_patterns_hold_the_histogram(histogram):
    patterns = packing.shortest_pack_first(histogram, 50)
    held = Counter()
    for count, lengths in patterns:
        assert count > 0 and sum(lengths) <= 50
        for n in lengths:
            held[n] += count
    assert held == Counter(histogram) and len(patterns) <= 3 * len(histogram) + 1
    plan = packing.segments(patterns)
    for n, total in histogram.items():
        at = np.flatnonzero(plan["length"] == n)
        ends = [*plan["first"][at][1:], total]
        assert plan["first"][at][0] == 0 and all(np.diff([*plan["first"][at], total]) > 0) and ends


def test_counts_of_odd_rows(docs_of, word_library):
    rows = [*ROWS, (5, "Σίσυφος ΟΔΟΣ"), (6, "<|startoftext|>hi<|endoftext|>")]
    found = token_counts.token_counts(docs_of(rows), WORD, limit=100).collect()
    got = Counter(map(tuple, found))
    expected = Counter()
    for k, t in rows:
        n = len(word_library.encode(t or "", add_special_tokens=False).ids)
        expected[(k, len((t or "").encode()), n, n > 100)] += 1
    assert got == expected
    assert token_counts.token_counts(docs_of([]), WORD).count() == 0


def test_whole_tokens_are_proved(word_library):
    counter = token_counts.counter(WORD)
    assert len(counter.whole) > 10_000
    for word in sorted(counter.whole)[::997]:
        assert len(word_library.encode(word, add_special_tokens=False).ids) == 1


@pytest.mark.parametrize("chunk,overlap", [(40, 12), (500, 60)])
def test_chunks_are_stitched(docs_of, rank_library, real_texts, chunk, overlap):
    rows = [*ROWS, (7, "x" * 3000), (8, "a   \n  " * 200), (9, "it's we've " * 90), (9, "it's we've " * 90)]
    rows += [(100 + k, real_texts[k]) for k in sorted(real_texts)[:25]]
    found = bpe_codec.encode(
        docs_of(rows), RANKS, P.PATTERN, chunk=chunk, overlap=overlap, decoded=True
    ).collect()
    got = Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in found)
    assert got == Counter(
        (k, as_bytes(rank_library.encode_ordinary(t or "")), (t or "").encode()) for k, t in rows
    )


def test_codec_query_and_empty_table(spark, docs_of, folder, real_texts, rank_library):
    assert bpe_codec.encode(docs_of([]), RANKS, P.PATTERN).count() == 0
    for r in QUERIES["op8_bpe_codec"](spark, folder).collect():
        ids = rank_library.encode_ordinary(real_texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids),
            hashlib.sha256(as_bytes(ids)).hexdigest(),
            hashlib.sha256(real_texts[r.doc_id].encode()).hexdigest(),
        )


def test_texts_are_split_once():
    class Counted(str):
        splits = 0

        def split(self, *args):
            Counted.splits += 1
            return str.split(self, *args)

    ours = byte_bpe.ByteBpe.__new__(byte_bpe.ByteBpe)
    ours.__dict__.update(byte_bpe.from_json(BYTE, P.PATTERN).__dict__)
    ours.words = byte_bpe.Words(ours.ordinary, 4)
    values = ["one two two three", "", "two  spaces", "four five six seven one", " ends ", "far   apart"]
    found = list(ours.encode_all([Counted(v) for v in values]))
    assert Counted.splits == 5  # the last one is encoded whole
    assert [list(memoryview(ids).cast("I")) for ids in found] == [ours.ordinary(v) for v in values]

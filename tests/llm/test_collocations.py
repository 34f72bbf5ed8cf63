"""Collocations against counting all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from quillrun.llm import collocations
from quillrun.llm.queries import QUERIES

SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("text", "lang", "phrase", "f", "n", "bucket")]
)


def table(spark, rows):
    return spark.createDataFrame([(t, c, "p", "f", "n", "b") for t, c in rows], SCHEMA)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least=30, top=2000, covered=80):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[b : b + k]) for b in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        able = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        over = Counter()
        for p, a in able.items():
            for k in range(2, len(p)):
                for b in range(len(p) - k + 1):
                    over[p[b : b + k]] = max(over[p[b : b + k]], a)
        found = []
        for p, a in able.items():
            if 100 * over[p] >= covered * a:
                continue
            score, _, left, right = min(
                (2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for n, (score, a, phrase, left, right) in enumerate(sorted(found)[:top]):
            out.append((lang, n + 1, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def found(df):
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[x] for x in names) for r in df.collect())


def texts(n, seed):
    draw = random.Random(seed)
    words = ["the", "The", "of", "cat", "Éa", "éa", "x" * 30, "it's", "-", "a b"] + [f"w{i}" for i in range(25)]
    marks = [" "] * 12 + ["\t", "  ", ". ", ",", "\n", "\r\n", ": ", " ! "]
    rows = []
    for _ in range(n):
        text = "".join(draw.choice(words) + draw.choice(marks) for _ in range(draw.randint(0, 60)))
        text += draw.choice(["", " new york city hall", " as soon as possible.", "; this line is in many of the texts"])
        rows.append((text, draw.choice(["en", "en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", "fr"), (" \t\n", "fr"), ("...", None), ("one", "xx")]


@pytest.mark.parametrize("least,top", [(30, 2000), (3, 50), (1, 10_000)])
def test_equals_counting_all_phrases(spark, least, top):
    rows = texts(300, 1)
    rows += [rows[0]] * 40  # repeated rows
    got = collocations.collocations(table(spark, rows).repartition(3), least=least, top=top, bucket_bytes=3_000)
    assert found(got) == brute(rows, least, top)


def test_small_chunks_slices_and_codes(spark, monkeypatch):
    """Chunks that end early, texts cut between words, and pairs dealt out further."""
    rows = [(" ".join(f"w{i % 7} v{i % 3} the of" for i in range(900)), "en")] + texts(60, 2)
    got = set()
    for size, codes, edges in ((64, 40, 100), (1000, 1 << 16, 10**6)):
        monkeypatch.setattr(collocations, "SLICE_BYTES", size)
        monkeypatch.setattr(collocations, "CODES", codes)
        monkeypatch.setattr(collocations, "CHUNK_EDGES", edges)
        monkeypatch.setattr(collocations.slices, "__defaults__", (size,))
        # In this process: the constants of the workers are not patched.
        import pyarrow as pa

        batch = pa.RecordBatch.from_pylist([{"lang": c or "und", "text": t or ""} for t, c in rows])
        sums = Counter()
        for name, words, chunk, counts in collocations._read([batch], 0, 1):
            for code, times in zip(collocations._parted(chunk).tolist(), counts.tolist(), strict=True):
                sums[name, tuple(words[c] if c else b"" for c in code)] += times
        assert all(isinstance(n, int) for n in sums.values())
        got.add(frozenset(sums.items()))
    assert len(got) == 1


def test_hot_pairs_give_the_same(spark, monkeypatch):
    rows = [("the of " + f"w{i % 50} x{i % 11}", "en") for i in range(600)]
    hot = {"pairs": None}
    original = collocations.hot_pairs

    def noted(*args):
        hot["pairs"] = original(*args)
        return hot["pairs"]

    monkeypatch.setattr(collocations, "hot_pairs", noted)
    got = collocations.collocations(table(spark, rows), least=5, bucket_bytes=500)
    assert found(got) == brute(rows, 5)
    assert len(hot["pairs"])


def test_slices_join_to_the_text():
    data = ("aa bb.cc " * 40 + "x" * 90 + " " + "y" * 30).encode().translate(collocations.TABLE)
    for size in (10, 33, 64, 10_000):
        parts = list(collocations.slices(data, size))
        assert b"".join(p for p, _ in parts) == data
        assert not parts[-1][1]


def test_empty_tables(spark):
    assert collocations.collocations(table(spark, [])).count() == 0
    assert collocations.collocations(table(spark, [(None, None), ("", "en")])).count() == 0


def test_arithmetic_beyond_64_bits(spark):
    assert np.iinfo(np.int64).max < 2_000_000 * 10**13
    row = spark.sql("SELECT cast(2000000 as decimal(38,0)) * 10000000000000 div (cast(3 as decimal(38,0)) + 4) AS s")
    assert row.first().s == 2_000_000 * 10**13 // 7


def test_query_equals_counting(spark, folder):
    given = spark.read.parquet(f"{folder}/documents.parquet").select("text", "lang").collect()
    assert found(QUERIES["op11_collocations"](spark, folder)) == brute([tuple(r) for r in given])

from pyspark.sql import functions as F

from quillrun.functions import arrays, text as tx
from quillrun.operators import slices


def one(spark, text, *columns):
    return spark.createDataFrame([(text,)], "text string").select(*columns).first()


def test_normalize_and_tokens_follow_python(spark):
    samples = ["", "  A\tb\n\nC ", "É Ü", "one", " - x - ", "a_b 12 c"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, text string")
    got = {
        r.i: (r.norm, r.tokens)
        for r in df.select(
            "i",
            tx.normalize(F.col("text")).alias("norm"),
            tx.space_tokens(F.col("text")).alias("tokens"),
        ).collect()
    }
    for i, sample in enumerate(samples):
        tokens = sample.lower().split()
        assert got[i] == (" ".join(tokens), tokens)


def test_words_have_two_word_characters(spark):
    row = one(spark, "A bc, d_e É éa x9 -- 7", tx.words(F.col("text")).alias("w"))
    assert row.w == ["bc", "d_e", "éa", "x9"]


def test_terms_and_counts(spark):
    text = "aa bb aa bb cc"
    row = one(
        spark,
        text,
        tx.terms(F.col("text")).alias("t"),
        arrays.run_lengths(tx.terms(F.col("text"))).alias("c"),
    )
    assert row.t == ["aa", "bb", "aa", "bb", "cc", "aa bb", "bb aa", "aa bb", "bb cc"]
    assert {(c["value"], c["n"]) for c in row.c} == {
        ("aa", 2), ("bb", 2), ("cc", 1), ("aa bb", 2), ("bb aa", 1), ("bb cc", 1),
    }


def test_terms_of_short_texts(spark):
    for text, expected in [("", []), ("x", []), ("aa", ["aa"])]:
        row = one(
            spark,
            text,
            tx.terms(F.col("text")).alias("t"),
            arrays.run_lengths(tx.terms(F.col("text"))).alias("c"),
        )
        assert row.t == expected
        assert [c["value"] for c in row.c] == expected


def test_lines_follow_text_files(spark):
    row = one(spark, "x\ry\nz\r\n\n", tx.lines(F.col("text")).alias("l"))
    assert row.l == ["x", "y", "z", ""]
    assert one(spark, "", tx.lines(F.col("text")).alias("l")).l == []
    assert one(spark, "a", tx.lines(F.col("text")).alias("l")).l == ["a"]


def test_passage_and_preview(spark):
    df = spark.createDataFrame(
        [(None, "body - "), ("T", "text"), ("-", " ")], "title string, text string"
    )
    passages = [
        r.p for r in df.select(tx.passage_text(F.col("title"), F.col("text")).alias("p")).collect()
    ]
    assert passages == ["body", "T - text", ""]
    text = "é\n" * 60
    row = one(spark, text, tx.preview(F.col("text")).alias("p"))
    assert row.p == text[:80].replace("\n", " ") + " ..."


def test_overlap_score_edges(spark):
    df = spark.createDataFrame(
        [("a b", "B c d"), ("", "x"), ("same", "SAME same")], "q string, d string"
    )
    scores = [r.s for r in df.select(tx.overlap_score(F.col("q"), F.col("d")).alias("s")).collect()]
    assert scores == [1 / 6**0.5, 0.0, 1.0]


def test_array_functions(spark):
    row = spark.range(1).select(
        arrays.arg_max(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0))).alias("top"),
        arrays.class_name(F.lit(1), ["x", "y"]).alias("name"),
        arrays.class_name(F.lit(5), ["x", "y"]).alias("outside"),
        arrays.next_token_labels(
            F.array(F.lit(7), F.lit(8), F.lit(0)), F.lit(2), -100
        ).alias("labels"),
    ).first()
    assert (row.top, row.name, row.outside, row.labels) == (1, "y", None, [8, -100, -100])


def test_slices(spark, rows):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    assert rows(slices.head_n(df, 3, "id"), "id") == [(0,), (1,), (2,)]
    assert slices.dry_run_head(df, 50, "id", cap=4).count() == 4
    assert slices.sample_n(df, 4, "id").collect() == slices.sample_n(df, 4, "id").collect()
    assert slices.repeat_rows(df, 3).count() == 30
    assert slices.keep_columns(df, ["x"], others=True).columns == ["x", "id"]
    names = spark.createDataFrame([(0, "zero")], "class_id long, class_name string")
    decoded = slices.decode_classes(df.limit(2).orderBy("id"), names, "id", "name")
    assert rows(decoded, "id", "name") == [(0, "zero"), (1, None)]
    texts = spark.createDataFrame([(1, " a \n\n\tb"), (2, "")], "i int, text string")
    assert rows(slices.query_lines(texts, "text"), "i", "line_no", "line") == [
        (1, 0, "a"), (1, 2, "b"),
    ]

"""Classifiers trained by Spark ML, saved, loaded and applied."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, IndexToString, SQLTransformer, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrun.functions import text as tx
from quillrun.operators import term_codes
from quillrun.session import shared_folder, shuffle_width
from quillrun.sources.tables import materialize


def _dealt(df: DataFrame) -> DataFrame:
    """Training rows dealt out evenly: every pass of the solver waits for all tasks."""
    return df.repartition(shuffle_width(df.sparkSession))


def fit_text_classifier(
    df: DataFrame,
    text: str,
    label: str,
    vocab_size: int = 1 << 18,
    max_iter: int = 20,
    reg: float = 0.001,
) -> PipelineModel:
    """Linear classifier over TF-IDF words for a column of class names.

    Texts are read and split into words once, and so are words counted: both are stored
    in the shared folder, and the passes of the solver read the counts. Each step sums the
    gradients of all partitions in a tree. What reaches the driver is the vocabulary and
    the weights, both bounded by ``vocab_size``, the most frequent words that are features
    (ties by word). Rows without a class are left out of the training, and the model
    needs no class column when it is applied.
    """
    return _fit_on_counts(df.filter(F.col(label).isNotNull()), text, label, F.lit(True), [], vocab_size, max_iter, reg)[0]


def fit_and_classify(
    df: DataFrame,
    text: str,
    label: str,
    train: Column,
    keep: Sequence[str],
    vocab_size: int = 1 << 18,
    max_iter: int = 20,
    reg: float = 0.001,
) -> tuple[PipelineModel, DataFrame]:
    """The classifier of the rows where ``train`` holds, and what it says of all rows.

    The same as ``fit_text_classifier`` on the former and ``classify`` on ``df``, but the
    words of a text are split and counted once for both. A missing text has no words.
    """
    model, counts = _fit_on_counts(df, text, label, train, keep, vocab_size, max_iter, reg)
    return model, classify(PipelineModel(stages=model.stages[2:]), counts, keep)


def _fit_on_counts(
    df: DataFrame,
    text: str,
    label: str,
    train: Column,
    keep: Sequence[str],
    vocab_size: int,
    max_iter: int,
    reg: float,
) -> tuple[PipelineModel, DataFrame]:
    """The model, and the stored word counts of all rows next to the columns to keep."""
    spark = df.sparkSession
    store = lambda rows, name: materialize(rows, shared_folder(spark, name))
    splitter = SQLTransformer(
        statement=f"SELECT *, regexp_extract_all(lower(`{text}`), r'{tx.WORD}', 0) AS _words "
        "FROM __THIS__"
    )
    words = store(
        _dealt(df.select(*keep, F.col(label).alias("_class"), train.alias("_train"), F.col(text).alias("_text")))
        .withColumn("_train", F.col("_train") & F.col("_class").isNotNull())
        .withColumn("_text", tx.spaced_words(F.col("_text"))),
        "words",
    )
    indexer = StringIndexer(
        inputCol="_class", outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="skip"
    ).fit(words.filter("_train"))
    n_words = store(
        words.filter("_train")
        .select("_text")
        .mapInArrow(term_codes.count_words, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter(F.length("word") > 1),
        "word-numbers",
    )
    # The vectorizer is told the words, it need not count them again: each comes the more often
    # the more frequent it is, so that frequent words are neighbours among the weights too.
    often = F.array_repeat("word", F.floor(F.log2("n")).cast("int") + 1)
    vectorizer = CountVectorizer(inputCol="_words", outputCol="_counts", vocabSize=vocab_size).fit(
        _dealt(_most_frequent(n_words, vocab_size)).select(often.alias("_words"))
    )
    known = pa.array(vectorizer.vocabulary, pa.string())
    schema = T.StructType([*words.schema.fields[:-1], T.StructField("_counts", VectorUDT())])
    columns = schema.names
    counts = store(
        words.mapInArrow(
            lambda batches: term_codes.count_vectors(batches, known, columns), schema
        ),
        "word-counts",
    )
    taught = indexer.transform(counts.filter("_train")).select("_label", "_counts")
    idf = IDF(inputCol="_counts", outputCol="_features").fit(taught)
    solver = LogisticRegression(
        featuresCol="_features",
        labelCol="_label",
        probabilityCol="probability",
        predictionCol="prediction",
        maxIter=max_iter,
        regParam=reg,
    )
    weights = solver.fit(idf.transform(taught))
    names = IndexToString(inputCol="prediction", outputCol="predicted", labels=indexer.labels)
    return PipelineModel(stages=[splitter, vectorizer, idf, weights, names]), counts


def _most_frequent(counts: DataFrame, size: int) -> DataFrame:
    """The ``size`` most frequent words of ``(word, n)``, ties by word.

    How many words there are of each number decides first which words can be among them,
    so that only these are sorted.
    """
    least, above = 1, 0
    for row in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).toLocalIterator():
        least, above = row["n"], above + row["words"]
        if above >= size:
            break
    return counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(size)


def classify(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Predicted class names next to the columns to keep."""
    return model.transform(df).select(*keep, "predicted")


def fit_head(
    df: DataFrame,
    features: str,
    label: str,
    max_iter: int = 20,
    reg: float = 0.001,
) -> PipelineModel:
    """A new linear head on given feature arrays; the features stay as they are."""
    head = LogisticRegression(
        featuresCol="_features",
        labelCol=label,
        predictionCol="prediction",
        maxIter=max_iter,
        regParam=reg,
    )
    return Pipeline(stages=[head]).fit(with_feature_vector(_dealt(df), features))


def with_feature_vector(df: DataFrame, features: str) -> DataFrame:
    return df.withColumn("_features", array_to_vector(F.col(features).cast("array<double>")))


def predict_head(
    model: PipelineModel, df: DataFrame, features: str, keep: Sequence[str]
) -> DataFrame:
    scored = model.transform(with_feature_vector(df, features))
    return scored.select(*keep, F.col("prediction").cast("int").alias("prediction"))


def save_model(model: PipelineModel, path: str) -> None:
    """Pipeline, weights and vocabulary in one folder."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)

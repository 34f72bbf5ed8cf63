"""Supervised subword embeddings: a quality score for every document.

A word is the sum of the vectors of its own bucket and of its character n-grams; a
document is the mean over all n-grams of all its words, followed by a linear softmax
layer. One n-gram more stands for a word that repeats the one before it, and ``marks`` of
another for the document as such, so that little text says little. Because everything up to the softmax is a mean, a word adds the same
numbers to every document; workers remember these for the words they have met.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrun.llm.storage import in_slices, texts

SEED = 7


@dataclass(frozen=True)
class Settings:
    """All parameters of the model.

    ``sample_rows`` bounds the labelled rows that it is fitted on, half of them of either
    class. The bound is on rows: their texts, as all texts, are read to the end.
    """

    buckets: int = 1 << 16
    dimensions: int = 16
    shortest: int = 2
    longest: int = 4
    epochs: int = 6
    rate: float = 0.5
    sample_rows: int = 4_000
    marks: int = 32
    entries: int = 300_000


def subwords(words: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and of their character n-grams, and the place of each's word.

    Words are marked at both ends; all n-grams of one length are hashed at once. Buckets
    0 and 1 are left free.
    """
    marked = [f"<{w}>" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(m) for m in marked])
    whole = np.fromiter((xxhash.xxh64_intdigest(m, SEED) for m in marked), np.uint64, len(words))
    hashes, owners = [whole], [np.arange(len(words))]
    rolling = codes
    for n in range(2, settings.longest + 1):
        rolling = rolling[:-1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        inside = owner[: len(rolling)] == owner[n - 1 :]
        if n >= settings.shortest:
            hashes.append(rolling[inside] + np.uint64(n))
            owners.append(owner[: len(rolling)][inside])
    mixed = np.concatenate(hashes) * np.uint64(0x9E3779B97F4A7C15)
    buckets = 2 + (mixed >> np.uint64(32)) % np.uint64(settings.buckets - 2)
    return buckets.astype(np.int64), np.concatenate(owners)


def repeats(words: list[str]) -> int:
    """How many words equal the one before them."""
    return sum(map(eq, words, words[1:]))


class Model:
    """Vectors of the buckets and the softmax layer (two classes: one margin)."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray, bias: float, settings: Settings):
        self.vectors, self.weights, self.bias, self.settings = vectors, weights, bias, settings

    def margins(self) -> np.ndarray:
        """What one occurrence of each bucket adds to the margin of a document."""
        return self.vectors @ self.weights


def features(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of a text and how often each occurs.

    Bucket 0 counts repetitions, bucket 1 is the mark of every document.
    """
    words = text.split()
    times = Counter(words)
    buckets, owner = subwords(list(times), settings)
    weights = np.fromiter(times.values(), np.float64, len(times))[owner]
    counts = np.bincount(buckets, weights, minlength=settings.buckets)
    counts[0] += repeats(words)
    counts[1] += settings.marks
    kept = np.flatnonzero(counts)
    return kept.astype(np.int32), counts[kept].astype(np.float32)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, settings: Settings) -> Model:
    """Stochastic gradient descent on the logistic loss, rate falling to zero.

    Classes weigh alike whatever their number. Without rows, or with rows of one class,
    the model gives one half everywhere.
    """
    draw = np.random.default_rng(SEED)
    vectors = ((draw.random((settings.buckets, settings.dimensions)) - 0.5) / settings.dimensions).astype(
        np.float64
    )
    weights = np.zeros(settings.dimensions)
    bias = 0.0
    positive = int(labels.sum())
    if not 0 < positive < len(labels):
        return Model(vectors, weights, bias, settings)
    weigh = np.where(labels == 1, len(labels) / (2 * positive), len(labels) / (2 * (len(labels) - positive)))
    weigh = np.minimum(weigh, 5.0)
    steps, total = 0, settings.epochs * len(rows)
    for _ in range(settings.epochs):
        for at in draw.permutation(len(rows)):
            buckets, counts = rows[at]
            rate = settings.rate * (1 - steps / total)
            steps += 1
            if not len(buckets):
                continue
            share = counts / counts.sum()
            mean = share @ vectors[buckets]
            error = (labels[at] - 1 / (1 + np.exp(-(mean @ weights + bias)))) * weigh[at] * rate
            before = weights.copy()
            weights += error * mean
            bias += error * 0.1
            # The step of a rare bucket is its share; scaled so that vectors move at all.
            vectors[buckets] += np.outer(error * share * len(buckets) ** 0.5, before)
    return Model(vectors, weights, bias, settings)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    settings: Settings | None = None,
) -> Model:
    """A model from the labelled documents; rows without a 0 or 1 label teach nothing.

    The sample of ``sample_rows`` at most is chosen by a hash of the key, half of it for
    either class; the features of these rows are made on the executors.
    """
    settings = settings or Settings()
    known = labels.select(F.col(key), F.col(label).cast("int").alias("label_")).filter(
        "label_ IN (0, 1)"
    )
    half = settings.sample_rows // 2
    order = (F.xxhash64(key), F.col(key))
    chosen = [
        known.filter(F.col("label_") == value).orderBy(*order).limit(half) for value in (0, 1)
    ]
    sample = chosen[0].unionByName(chosen[1])
    found = texts(docs, key, text).join(F.broadcast(sample), key)  # sample_rows at most

    def run(batches):
        for batch in in_slices(batches):
            rows = [features(v, settings) for v in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(2),
                    *(pa.array([r[k].tobytes() for r in rows], pa.binary()) for k in (0, 1)),
                ],
                ["order_", "label_", "buckets", "counts"],
            )

    taught = (
        found.select(text, F.xxhash64(key).alias("order_"), "label_")
        .mapInArrow(run, "order_ long, label_ int, buckets binary, counts binary")
        .toPandas()
        .sort_values(["order_", "label_", "buckets"])
    )
    rows = [
        (np.frombuffer(bytes(b), dtype=np.int32), np.frombuffer(bytes(c), dtype=np.float32))
        for b, c in zip(taught["buckets"], taught["counts"], strict=True)
    ]
    return train(rows, taught["label_"].to_numpy(), settings)


class _WordSums:
    """For each word met, what it adds to the margin (real) and its n-grams (imaginary)."""

    def __init__(self, margins: np.ndarray, settings: Settings):
        self.margins, self.settings = margins, settings
        self.known: dict[str, complex] = {}

    def learn(self, texts_: list[list[str]]) -> None:
        """Make all words of these texts known; forget others when there are too many."""
        found = set().union(*texts_)
        new = found - self.known.keys()
        if len(new) + len(self.known) > self.settings.entries:
            self.known.clear()
            new = found
        new = list(new)
        for begin in range(0, len(new), 20_000):
            part = new[begin : begin + 20_000]
            buckets, owner = subwords(part, self.settings)
            sums = np.bincount(owner, self.margins[buckets], minlength=len(part))
            counts = np.bincount(owner, minlength=len(part))
            self.known.update(zip(part, (sums + 1j * counts).tolist(), strict=True))


def score(
    docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", out: str = "score"
) -> DataFrame:
    """``docs`` with ``out``: the probability of label 1, from the whole text alone.

    A null or empty text is scored by its marks alone. No shuffle: the model, of a fixed
    size, goes to every task. Other columns are kept as they are, repeated rows too; an
    empty table gives no rows.
    """
    settings, bias = model.settings, model.bias
    shared = docs.sparkSession.sparkContext.broadcast(model.margins())  # fixed by buckets
    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)

    def run(batches):
        margins = shared.value
        words = _WordSums(margins, settings)
        for batch in in_slices(batches):
            split = [(value or "").split() for value in batch.column(text).to_pylist()]
            words.learn(split)
            values = []
            for parts in split:
                again = repeats(parts)
                total = sum(map(words.known.__getitem__, parts), 0j)
                number = total.imag + again + settings.marks
                summed = total.real + again * margins[0] + settings.marks * margins[1]
                margin = bias + summed / number
                values.append(1 / (1 + np.exp(-np.clip(margin, -500, 500))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.float64())], [*batch.schema.names, out]
            )

    return docs.mapInArrow(run, f"{kinds}, `{out}` double")

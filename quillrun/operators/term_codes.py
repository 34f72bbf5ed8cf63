"""Words and neighbouring pairs of words as numbers, counted in Arrow batches.

A known word is its place in a list of ``v`` words, a pair of known words is one number
beyond these places. Sorting the numbers of a batch counts them; no string is built.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bounds of what is counted at a time: bytes of words (or one text) and texts.
SLICE_BYTES = 16_000_000
ROW_BITS = 16


def in_slices(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of few bytes; ``words`` is the place of their column."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(words)), 0).to_numpy(False))
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))
            end = min(max(end, begin + 1), begin + (1 << ROW_BITS))
            yield batch.slice(begin, end - begin)
            begin = end


def count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(word, n)`` of batches of ``(words)``, texts whose words stand between spaces."""
    for batch in in_slices(batches, 0):
        found = pc.split_pattern(batch.column(0), " ").flatten()
        counts = found.filter(pc.not_equal(found, "")).value_counts()
        yield pa.RecordBatch.from_arrays(counts.flatten(), ["word", "n"])


def codes(texts: pa.Array, known: pa.Array, ngrams: tuple[int, int]) -> tuple[np.ndarray, ...]:
    """``(row, code)`` of all known words and pairs in texts of words between spaces.

    Word ``a`` is code ``a``, the pair ``a b`` is ``(a + 1) * v + b``.
    """
    words = pc.split_pattern(texts, " ")
    lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(False)
    row = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)
    place = pc.fill_null(pc.index_in(words.flatten(), value_set=known), -1).to_numpy(False)
    place = place.astype(np.int64)
    rows, found = [], []
    if ngrams[0] == 1:
        at = place >= 0
        rows.append(row[at])
        found.append(place[at])
    if ngrams[1] == 2:
        at = np.flatnonzero((place[:-1] >= 0) & (place[1:] >= 0) & (row[:-1] == row[1:]))
        rows.append(row[at])
        found.append((place[at] + 1) * len(known) + place[at + 1])
    return np.concatenate(rows), np.concatenate(found)


def runs(major: np.ndarray, minor: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """Distinct pairs ``(major, minor, n)`` in their order; ``minor`` has ``bits`` bits."""
    ordered = np.sort((major << bits) | minor)
    starts = np.flatnonzero(np.diff(ordered, prepend=-1))
    n = np.diff(starts, append=len(ordered))
    return ordered[starts] >> bits, ordered[starts] & ((1 << bits) - 1), n


def sums(group: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(start, length, sums...)`` of the runs of equal numbers in ``group``."""
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    added = [np.add.reduceat(v, starts) if len(starts) else v for v in values]
    return starts, np.diff(starts, append=len(group)), *added


def count_codes(batches: Iterable[pa.RecordBatch], known: pa.Array, ngrams: tuple[int, int]):
    """``(code, n, df)`` of batches of ``(words)``: occurrences, and rows that have some."""
    for batch in in_slices(batches, 0):
        row, code = codes(batch.column(0), known, ngrams)
        code, _, tf = runs(code, row, ROW_BITS)
        starts, df, n = sums(code, tf)
        yield pa.RecordBatch.from_arrays(
            [pa.array(code[starts]), pa.array(n), pa.array(df)], ["code", "n", "df"]
        )


def weigh_codes(
    batches: Iterable[pa.RecordBatch],
    known: pa.Array,
    fitted: np.ndarray,
    idf: np.ndarray,
    ngrams: tuple[int, int],
    names: list[str],
):
    """``(key, terms, squares)`` of batches of ``(key, words)`` with some fitted term.

    ``fitted`` are sorted codes; ``terms`` are their places and tf times ``idf``.
    """
    kind = pa.struct([("place", pa.int32()), ("w", pa.float64())])
    for batch in in_slices(batches, 1):
        row, code = codes(batch.column(1), known, ngrams)
        place = np.minimum(np.searchsorted(fitted, code), len(fitted) - 1)
        at = fitted[place] == code
        row, place, tf = runs(row[at], place[at], 32)
        w = tf * idf[place]
        starts, _, squares = sums(row, w * w)
        terms = pa.StructArray.from_arrays(
            [pa.array(place.astype(np.int32)), pa.array(w)], fields=list(kind)
        )
        offsets = np.append(starts, len(row)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(row[starts])),
                pa.ListArray.from_arrays(pa.array(offsets), terms),
                pa.array(squares),
            ],
            names,
        )


# How Spark keeps a vector; kind 0 is a sparse one.
VECTOR = pa.struct(
    [
        pa.field("type", pa.int8(), False),
        ("size", pa.int32()),
        ("indices", pa.list_(pa.field("element", pa.int32(), False))),
        ("values", pa.list_(pa.field("element", pa.float64(), False))),
    ]
)


def count_vectors(batches: Iterable[pa.RecordBatch], known: pa.Array, names: list[str]):
    """All rows; the last column, words between spaces, becomes the vector of their counts."""
    for batch in in_slices(batches, len(names) - 1):
        rows = batch.num_rows
        row, place, n = runs(*codes(batch.column(len(names) - 1), known, (1, 1)), 32)
        offsets = pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32))
        indices, values = (
            pa.ListArray.from_arrays(offsets, pa.array(v.astype(kind)), type=VECTOR.field(name).type)
            for v, kind, name in ((place, np.int32, "indices"), (n, np.float64, "values"))
        )
        size = np.full(rows, len(known), np.int32)
        vectors = pa.StructArray.from_arrays(
            [pa.array(np.zeros(rows, np.int8)), pa.array(size), indices, values], fields=list(VECTOR)
        )
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], vectors], names)

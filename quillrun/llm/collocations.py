"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are runs of words, edges the longest runs, each from its first words to its last
ones. Only edges are counted over the text. A piece is taken to go on with end marks, so
that every word begins exactly one edge; the count of any shorter run is then the flow out
of its node: the edges that begin with it, those into the end of a piece included.

Edges are counted in chunks first, then, by their first two words, in buckets, where all
flows out of these words meet. Runs that only ever go on in one way are one path with one
count, and shorter runs on it need no rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrun.llm.storage import in_slices, rewritten

#: Words of an edge.
LONGEST = 4
END = b"\n"
#: A-Z lower-cased; what ends a piece becomes the end mark, a tab a space.
TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t",
    b"abcdefghijklmnopqrstuvwxyz" + END * 10 + b" ",
)
#: Bytes read at once, few enough for their words to have codes of 16 bits.
SLICE_BYTES = 120_000
#: Edges of a chunk before they are counted.
CHUNK_EDGES = 1_500_000
CODES = 1 << 16
#: Languages whose size is looked at alone; each of the others is smaller than all these.
SIZED = 1_000


class _Codes(dict):
    """Words by number in order of appearance; the end mark is 0."""

    def __init__(self) -> None:
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def slices(data: bytes, size: int = SLICE_BYTES) -> Iterator[tuple[bytes, bool]]:
    """A translated text in parts, cut between pieces or words, and whether a piece goes on.

    A cut between words is made only where no piece ends within ``size``.
    """
    begin = 0
    while len(data) - begin > size:
        cut = data.rfind(END, begin, begin + size)
        if cut <= begin:
            cut = data.rfind(b" ", begin + 1, begin + size)
        if cut <= begin:
            places = [p for p in (data.find(END, begin + 1), data.find(b" ", begin + 1)) if p > 0]
            cut = min(places, default=len(data))
        yield data[begin:cut], data[cut : cut + 1] == b" "
        begin = cut
    yield data[begin:], False


def _words(part: bytes) -> list[bytes]:
    return list(filter(None, part.replace(END, b" \n ").split(b" ")))


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, seed=11)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


class _Chunk:
    """Edges of one language, with codes of its own, until it is full."""

    def __init__(self) -> None:
        self.codes, self.edges, self.held = _Codes(), [], 0

    def add(self, words: list[bytes], open_: bool) -> bool:
        """Takes the edges that begin in ``words``; false if their codes do not fit.

        With ``open_``, the last words begin no edge yet: the piece goes on.
        """
        known = len(self.codes)
        codes = np.fromiter(map(self.codes.__getitem__, words), np.uint64, len(words))
        if len(self.codes) > CODES and known > 1:
            for word in list(self.codes)[known:]:
                del self.codes[word]
            return False
        if not open_:
            codes = np.concatenate([codes, np.zeros(LONGEST - 1, np.uint64)])
        n = max(0, len(codes) - LONGEST + 1)
        steps = [codes[k : n + k] for k in range(LONGEST)]
        edge, on = steps[0], np.ones(n, bool)
        for step in steps[1:]:
            on = on & (step > 0)  # after an end only ends follow
            edge = (edge << np.uint64(16)) | np.where(on, step, np.uint64(0))
        edge = edge[steps[0] > 0]
        self.edges.append(edge)
        self.held += len(edge)
        return True

    def counted(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """``(words, edges, counts)``; an edge has a code of 16 bits for each word."""
        edges, counts = np.unique(np.concatenate(self.edges), return_counts=True)
        return list(self.codes), edges, counts


def _parted(edges: np.ndarray) -> np.ndarray:
    """Edges as rows of codes."""
    return np.stack(
        [(edges >> np.uint64(16 * (LONGEST - 1 - k))) & np.uint64(0xFFFF) for k in range(LONGEST)],
        axis=1,
    ).astype(np.uint16)


class Buckets:
    """How many buckets each language has, by the bytes of its texts."""

    def __init__(self, sizes: dict[str, int], bytes_: int):
        self.of = {name: max(1, -(-size // bytes_)) for name, size in sizes.items()}
        self.other = min(self.of.values(), default=1)

    def __getitem__(self, name: str) -> int:
        return self.of.get(name, self.other)


def _dealt(words: list[bytes], rows: np.ndarray, buckets: int, hot: np.ndarray) -> np.ndarray:
    """The bucket of every edge: by its first two words, for a hot pair by the third too."""
    hashes = np.array([_hash(w) for w in words], np.uint64)
    pair = _pair(hashes[rows[:, 0]], hashes[rows[:, 1]])
    if len(hot):
        pair = np.where(np.isin(pair, hot), _pair(pair, hashes[rows[:, 2]]), pair)
    return (pair % np.uint64(buckets)).astype(np.int64)


def _read(batches, lang: int, text: int) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
    """``(lang, words, edges, counts)`` of chunks of the texts of a task."""
    chunks: dict[str, _Chunk] = {}
    waiting: dict[str, list[bytes]] = {}
    bytes_: dict[str, int] = {}

    def taken(name: str, data: bytes):
        carry: list[bytes] = []
        for part, open_ in slices(data):
            words = carry + _words(part)
            chunk = chunks.setdefault(name, _Chunk())
            if not chunk.add(words, open_):
                yield name, *chunk.counted()
                chunk = chunks[name] = _Chunk()
                chunk.add(words, open_)
            carry = words[-(LONGEST - 1) :] if open_ else []
            if chunk.held >= CHUNK_EDGES:
                yield name, *chunk.counted()
                del chunks[name]

    def flushed(name: str):
        bytes_.pop(name)
        yield from taken(name, END.join(waiting.pop(name)))

    for batch in in_slices(batches):
        names, values = batch.column(lang).to_pylist(), batch.column(text).to_pylist()
        for name, value in zip(names, values, strict=True):
            data = value.encode().translate(TABLE)
            waiting.setdefault(name, []).append(data)
            bytes_[name] = bytes_.get(name, 0) + len(data) + 1
            if bytes_[name] >= SLICE_BYTES // 2:
                yield from flushed(name)
            elif len(waiting) > SIZED:
                yield from flushed(max(bytes_, key=bytes_.__getitem__))
        if sum(chunk.held for chunk in chunks.values()) > 2 * CHUNK_EDGES:
            for name in sorted(chunks, key=lambda n: -chunks[n].held)[: max(1, len(chunks) // 2)]:
                yield name, *chunks.pop(name).counted()
    for name in list(waiting):
        yield from flushed(name)
    for name in list(chunks):
        yield name, *chunks.pop(name).counted()


def edge_blobs(docs: DataFrame, lang: str, text: str, buckets: Buckets, hot: np.ndarray) -> DataFrame:
    """``(lang, bucket, words, edges, counts)``: counted edges of a chunk by bucket.

    ``words`` are those of the edges, one a line; ``edges`` hold codes of 16 bits, word by
    word; ``counts`` have 32 bits.
    """

    def run(batches):
        for name, words, edges, counts in _read(batches, 0, 1):
            if not len(edges):
                continue
            rows = _parted(edges)
            bucket = _dealt(words, rows, buckets[name], hot)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            out = [[], [], [], []]
            for own in np.split(order, cuts):
                used, codes = np.unique(rows[own], return_inverse=True)
                out[0].append(int(bucket[own[0]]))
                out[1].append(END.join(words[c] if c else b"" for c in used.tolist()))
                out[2].append(codes.reshape(-1, LONGEST).T.astype(np.uint16).tobytes())
                out[3].append(counts[own].astype(np.uint32).tobytes())
            for begin in range(0, len(out[0]), 256):
                part = [column[begin : begin + 256] for column in out]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(part[0]), pa.string()),
                        pa.array(part[0], pa.int64()),
                        *(pa.array(x, pa.binary()) for x in part[1:]),
                    ],
                    ["lang", "bucket", "words", "edges", "counts"],
                )

    return docs.select(lang, text).mapInArrow(
        run, "lang string, bucket long, words binary, edges binary, counts binary"
    )


def _merged(blobs: pd.DataFrame) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All edges of a bucket, with codes of their own, sorted, each once with its count."""
    codes = _Codes()
    rows, counts = [], []
    for words, edges, times in zip(blobs["words"], blobs["edges"], blobs["counts"], strict=True):
        of = np.array([codes[w or END] for w in words.split(END)], np.uint64)
        local = np.frombuffer(edges, np.uint16).reshape(LONGEST, -1)
        rows.append(
            np.stack([(of[local[0]] << np.uint64(32)) | of[local[1]], (of[local[2]] << np.uint64(32)) | of[local[3]]])
        )
        counts.append(np.frombuffer(times, np.uint32).astype(np.int64))
    both, n = np.concatenate(rows, axis=1), np.concatenate(counts)
    order = np.lexsort((both[1], both[0]))
    both, n = both[:, order], n[order]
    new = np.ones(len(n), bool)
    new[1:] = (both[:, 1:] != both[:, :-1]).any(axis=0)
    first = np.flatnonzero(new)
    return list(codes), both[:, first], np.add.reduceat(n, first)


def bucket_paths(blobs: pd.DataFrame, least: int, hot: np.ndarray) -> dict[str, list]:
    """Paths and flows of one bucket: columns ``phrase, shortest, longest, f, partial``.

    A row is a run of ``longest`` words with count ``f`` that its first words have too,
    down to ``shortest`` of them. Single words, and pairs that are dealt out to several
    buckets, are ``partial``: their counts are sums over buckets.
    """
    words, both, n = _merged(blobs)
    low32 = np.uint64(0xFFFFFFFF)
    columns = [both[0] >> np.uint64(32), both[0] & low32, both[1] >> np.uint64(32), both[1] & low32]
    new, level = np.zeros(len(n), bool), []
    new[:1] = True
    for column in columns:
        new = new.copy()
        new[1:] |= column[1:] != column[:-1]
        level.append(np.flatnonzero(new))
    flow = [np.add.reduceat(n, first) for first in level]
    hashes = np.array([_hash(w) for w in words], np.uint64)
    out: dict[str, list] = {c: [] for c in ("phrase", "shortest", "longest", "f", "partial")}

    def put(at: int, shortest: int, longest: int, f: int, partial: bool) -> None:
        out["phrase"].append(b" ".join(words[int(c[at])] for c in columns[:longest]).decode())
        out["shortest"].append(shortest)
        out["longest"].append(longest)
        out["f"].append(int(f))
        out["partial"].append(partial)

    for at, f in zip(level[0].tolist(), flow[0].tolist(), strict=True):
        put(at, 1, 1, f, True)
    # From the longest runs to pairs: the path that a run is the beginning of, if any.
    reach: dict[int, tuple[int, int, int]] = {}
    for k in range(LONGEST, 1, -1):
        first, f = level[k - 1], flow[k - 1]
        wanted = columns[k - 1][first] > 0
        spread = np.zeros(len(first), bool)
        if k == 2 and len(hot):
            pair = _pair(hashes[columns[0][first]], hashes[columns[1][first]])
            spread = np.isin(pair, hot)
        chosen = np.flatnonzero(wanted & ((f >= least) | spread))
        ends = np.append(first, len(n))
        longer = sorted(reach)
        below: dict[int, tuple[int, int, int]] = {}
        places = np.array(longer, np.int64)
        for j in chosen.tolist():
            at, own = int(first[j]), int(f[j])
            if spread[j]:
                put(at, 2, 2, own, True)
                continue
            begin, end = np.searchsorted(places, [at, int(ends[j + 1])])
            going = [p for p in longer[begin:end] if reach[p][2] == own]
            if going:
                shortest, longest, _ = reach.pop(going[0])
                below[going[0]] = (k, longest, own)
            else:
                below[at] = (k, k, own)
        for at, (shortest, longest, own) in reach.items():
            put(at, shortest, longest, own, False)
        reach = below
    for at, (shortest, longest, own) in reach.items():
        put(at, shortest, longest, own, False)
    return out


def hot_pairs(docs: DataFrame, lang: str, text: str, rows: int, buckets: Buckets) -> np.ndarray:
    """Hashes of the pairs of words that begin more edges than a quarter of a bucket.

    They decide which edges are dealt out further, never a count, so a sample will do: the
    beginnings of ``rows`` documents. Pairs seen under 20 times in it do not count.
    """
    beginning = F.substring(text, 1, 4_096).alias(text)
    order = F.xxhash64(F.monotonically_increasing_id()).alias("order")
    chosen = docs.select(lang, beginning, order).orderBy("order").limit(rows)
    pairs: dict[str, dict[int, int]] = {}
    table = pa.RecordBatch.from_pylist(
        [{"lang": r[0], "text": r[1]} for r in chosen.toLocalIterator()],
        schema=pa.schema([("lang", pa.string()), ("text", pa.string())]),
    )
    for name, words, edges, counts in _read([table], 0, 1):
        hashes = np.array([_hash(w) for w in words], np.uint64)
        parts = _parted(edges)
        keys, which = np.unique(_pair(hashes[parts[:, 0]], hashes[parts[:, 1]]), return_inverse=True)
        own = pairs.setdefault(name, {})
        for key, times in zip(keys.tolist(), np.bincount(which, counts).tolist(), strict=True):
            own[key] = own.get(key, 0) + times
    hot = {
        k
        for name, own in pairs.items()
        for k, n in own.items()
        if n >= 20 and 4 * n * buckets[name] > sum(own.values())
    }
    return np.array(sorted(hot), np.uint64)


def graph_paths(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = 30,
    bucket_bytes: int = 6_000_000,
    sample_rows: int = 1_000,
) -> DataFrame:
    """``(lang, phrase, shortest, longest, f, partial)`` of all runs found ``least`` times.

    See `bucket_paths`; single words are there whatever their count. Buckets are as many
    as the bytes of a language ask for.
    """
    sizes = docs.groupBy(lang).agg(F.sum(F.octet_length(text)).alias("size"))
    largest = sizes.orderBy(F.desc("size"), lang).limit(SIZED).collect()
    buckets = Buckets(dict(map(tuple, largest)), bucket_bytes)
    hot = hot_pairs(docs, lang, text, sample_rows, buckets)

    def reduced(blobs: pd.DataFrame) -> pd.DataFrame:
        found = pd.DataFrame(bucket_paths(blobs, least, hot))
        found.insert(0, "lang", blobs["lang"].iloc[0])
        return found

    return edge_blobs(docs, lang, text, buckets, hot).groupBy("lang", "bucket").applyInPandas(
        reduced, "lang string, phrase string, shortest int, longest int, f long, partial boolean"
    )


def _part(words: Column, begin, length) -> Column:
    return F.array_join(F.slice(words, begin, length), " ")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = 30,
    covered_percent: int = 80,
    top: int = 2_000,
    scale: int = 2_000_000,
    **graph: int,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language.

    Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line ends, pieces
    into words at spaces and tabs. Candidates are phrases of 2 to 4 words found at least
    ``least`` times (``a``). Cut in two parts found ``l`` and ``r`` times, a phrase scores
    ``floor(scale * a / (l + r))``; the cut with the least score counts, of equal ones the
    first. A candidate inside a longer one with ``covered_percent`` of its count or more
    is left out. ``n`` counts all words of the language. Order: score, then ``a``, both
    descending, then phrase by its bytes.

    A null text is empty, a null language is ``und``. Repeated rows count each; empty
    texts and tables give no rows. Other columns play no part.
    """
    given = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    found = rewritten(graph_paths(given, least=least, **graph), "word-paths")
    sums = (
        found.filter("partial")
        .groupBy("lang", "phrase", "longest")
        .agg(F.sum("f").alias("f"))
        .select("lang", "phrase", F.col("longest").alias("shortest"), "longest", "f")
    )
    sums = rewritten(sums, "word-sums")
    total = sums.filter("longest = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    paths = found.filter("NOT partial").drop("partial")
    paths = paths.unionByName(sums.filter(F.col("f") >= least))
    words = F.split("phrase", " ")
    # What shorter runs on a path are found by; as phrases, they are inside a longer one.
    runs = paths.select(
        "lang",
        F.explode(
            F.transform(F.sequence("shortest", "longest"), lambda k: _part(words, F.lit(1), k))
        ).alias("phrase"),
        "f",
    )
    whole = paths.filter("longest > 1").select("lang", "phrase", "longest", F.col("f").alias("a"))
    inside = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("longest") - 1),
            lambda k: F.transform(
                F.sequence(F.lit(1), F.col("longest") - k + 1), lambda b: _part(words, b, k)
            ),
        )
    )
    longer = (
        whole.filter("longest > 2")
        .select("lang", F.explode(F.array_distinct(inside)).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("over"))
    )
    left = whole.join(longer, ["lang", "phrase"], "left").filter(
        F.col("over").isNull()
        | (F.col("over").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * covered_percent)
    )
    cuts = left.select(
        "lang", "phrase", "a", "longest", F.explode(F.sequence(F.lit(1), F.col("longest") - 1)).alias("cut")
    ).select(
        "lang",
        "phrase",
        "a",
        "cut",
        _part(words, F.lit(1), F.col("cut")).alias("one"),
        _part(words, F.col("cut") + 1, F.col("longest")).alias("two"),
    )
    of = lambda part, f: runs.select("lang", F.col("phrase").alias(part), F.col("f").alias(f))
    scored = (
        cuts.join(of("one", "l"), ["lang", "one"])
        .join(of("two", "r"), ["lang", "two"])
        .withColumn("score", F.expr(f"cast({scale} as decimal(38,0)) * a div (cast(l as decimal(38,0)) + r)"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
        .select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    )
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # First the best of 64 parts of a language, so that none is ranked in one task whole.
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    few = salted.withColumn("rank", rank("lang", "salt")).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", rank("lang").cast("long")).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""Near-duplicate documents by tensored MinHash banding with exact confirmation.

Two collections of ``halves`` half-keys are made of minhashes, each half-key of ``rows``
of them. A table key is any half-key of the first collection with any one of the second,
so that ``2 * halves * rows`` minhashes serve ``halves ** 2`` tables, where tables of
their own would need ``2 * rows`` minhashes each. Keys are not written out in pairs: rows
meet on the first half, and the second halves are compared where they meet.

With 24 and 4, two sets of similarity 0.8 meet in no table with probability 6e-6.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrun.llm.components import components
from quillrun.llm.storage import in_slices, stored, texts

HALVES, ROWS = 24, 4
SEED = 20_240_501
#: Sketch bits that may differ: six standard deviations above what 0.8 leads to.
DEVIATIONS = 6.0
#: Parts that the nodes of one half-key, or of one difference, are dealt out to.
SLICES = 16
#: Linked nodes of its hub that a stray is compared with at first.
TRIED = 32
#: Nodes of one half-key that meet on it alone, without the second halves.
TOGETHER = 512


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= 500_000:
                self.clear()
            self[word] = value
        return value


@lru_cache(maxsize=8)
def _constants(words: int, halves: int, rows: int):
    draw = np.random.default_rng(SEED)
    odd = lambda n, kind: draw.integers(0, np.iinfo(kind).max, n, dtype=kind) | kind(1)
    minhashes = 2 * halves * rows
    return {
        "place": odd(words, np.uint64),
        "xor": draw.integers(0, np.iinfo(np.uint32).max, minhashes, dtype=np.uint32),
        "times": odd(minhashes, np.uint32),
        "join": odd((halves, rows), np.uint64),
        "which": draw.integers(0, np.iinfo(np.int64).max, halves, dtype=np.uint64),
    }


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def shingles(text: str, words: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text."""
    parts = text.encode().lower().split()  # A-Z only; the six white-space bytes only
    n = len(parts)
    if not n:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, parts), np.uint64, n)
    place = _constants(words, HALVES, ROWS)["place"]
    if n < words:
        return _mixed(np.array([(values * place[:n]).sum() + np.uint64(n)], np.uint64))
    total = values[: n - words + 1] * place[0]
    for k in range(1, words):
        total = total + values[k : n - words + 1 + k] * place[k]
    return np.unique(_mixed(total))


def minhashes(found: np.ndarray, words: int) -> np.ndarray:
    """One minimum for each hash function, in slices of bounded memory."""
    fixed = _constants(words, HALVES, ROWS)
    low = np.full(len(fixed["xor"]), np.iinfo(np.uint32).max, np.uint32)
    narrow = (found >> np.uint64(32)).astype(np.uint32)
    for begin in range(0, len(narrow), 2048):
        part = narrow[begin : begin + 2048, None]
        np.minimum(low, ((part ^ fixed["xor"]) * fixed["times"]).min(axis=0), out=low)
    return low


def _name(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``(key, n, node, first, second, sketch)`` of every row, in one pass.

    ``node`` names the set (null for the empty one), ``first`` holds the first half-keys,
    ``second`` the second ones, ``sketch`` one bit of every minhash.
    """
    kind = docs.schema[key].dataType.simpleString()
    half = HALVES * ROWS

    def run(batches):
        hashes = _WordHashes()
        fixed = _constants(words, HALVES, ROWS)
        for batch in in_slices(batches):
            sizes, nodes, first, second, sketch = [], [], [], [], []
            for value in batch.column(1).to_pylist():
                found = shingles(value, words, hashes)
                sizes.append(len(found))
                if not len(found):
                    for column in (nodes, first, second, sketch):
                        column.append(None)
                    continue
                low = minhashes(found, words)
                grouped = low.reshape(2 * HALVES, ROWS).astype(np.uint64)
                keys = _mixed((grouped[:HALVES] * fixed["join"]).sum(axis=1) + fixed["which"])
                others = _mixed((grouped[HALVES:] * fixed["join"]).sum(axis=1) + fixed["which"])
                nodes.append(_name(found))
                first.append(keys.view(np.int64))
                second.append((others >> np.uint64(32)).astype(np.uint32).view(np.int32))
                sketch.append(np.packbits((low & 1).astype(bool)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(first, pa.list_(pa.int64())),
                    pa.array(second, pa.list_(pa.int32())),
                    pa.array(sketch, pa.list_(pa.int64())),
                ],
                [key, "n", "node", "first", "second", "sketch"],
            )

    assert 2 * half % 64 == 0
    return docs.mapInArrow(
        run,
        f"{key} {kind}, n long, node binary, first array<long>, second array<int>, sketch array<long>",
    )


def shingle_sets(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``(node, shingles)`` of every row with words."""

    def run(batches):
        hashes = _WordHashes()
        for batch in in_slices(batches):
            sets = [shingles(v, words, hashes) for v in batch.column(1).to_pylist()]
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(map(_name, sets), pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["node", "shingles"],
            )

    return docs.select(key, text).mapInArrow(run, "node binary, shingles array<long>")


def _similar_sizes(x: str, y: str, percent: int):
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    return pairs.join(
        sets.select(F.col("node").alias("x"), F.col("shingles").alias("sx")), "x"
    ).join(sets.select(F.col("node").alias("y"), F.col("shingles").alias("sy")), "y")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(x, y)`` whose full sets are similar enough."""
    both = F.size(F.array_intersect("sx", "sy"))
    return (
        _with_sets(pairs, sets)
        .filter(both * 100 >= (F.size("sx") + F.size("sy") - both) * percent)
        .select("x", "y")
    )


def _sliced(node: str):
    """Part of a key that spreads the nodes of a frequent one over tasks."""
    return F.pmod(F.xxhash64(node), F.lit(SLICES)).cast("int").alias("slice")


def _hub_pairs(members: DataFrame) -> DataFrame:
    """``(x, y)``: each node ``y`` with the hub ``x``, the best of the hubs of its half-keys.

    The hub of a half-key is the one of its nodes that meets most others in all: of
    copies with changes, one with few changes. So do nodes choose among hubs, and nodes
    that could be linked mostly have one hub. ``members`` has a row for each node and
    half-key, with the number of nodes of the half-key.
    """
    met = (
        members.groupBy("node")
        .agg(F.sum("members").alias("met"), F.collect_list("half").alias("halves"))
        .select("node", _sliced("node"), "met", F.explode("halves").alias("half"))
    )
    hubs = met.groupBy("half").agg(
        F.max(F.struct("met", "node")).alias("best"), F.collect_set("slice").alias("slices")
    )
    hubs = hubs.select("half", "best", F.explode("slices").alias("slice"))
    votes = met.join(hubs, ["half", "slice"]).filter("node <> best.node")
    chosen = votes.groupBy("node").agg(F.max("best").alias("best"))
    return chosen.select(F.col("best.node").alias("x"), F.col("node").alias("y"))


def _measured(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(hub, node, n_hub, n, apart, linked)``: nodes by how they differ from their hub.

    ``apart`` are the shingles that only one of both has.
    """
    measured = _with_sets(pairs, sets).select(
        F.col("x").alias("hub"),
        F.col("y").alias("node"),
        F.size("sx").alias("n_hub"),
        F.size("sy").alias("n"),
        F.concat(F.array_except("sy", "sx"), F.array_except("sx", "sy")).alias("apart"),
    )
    total = F.col("n") + F.col("n_hub")
    return measured.withColumn(
        "linked", F.size("apart") * (100 + percent) <= total * (100 - percent)
    )


def _alike_enough(x: str, y: str, percent: int):
    """Whether two nodes of one hub are linked, by their differences from it."""
    same = F.size(F.array_intersect(f"apart_{x}", f"apart_{y}"))
    between = F.size(f"apart_{x}") + F.size(f"apart_{y}") - 2 * same
    return between * (100 + percent) <= (F.col(f"n_{x}") + F.col(f"n_{y}")) * (100 - percent)


def _first_links(measured: DataFrame, percent: int) -> DataFrame:
    """``(x, y)``: strays, nodes not linked to their hub, with a node that is.

    Each stray is compared with about ``TRIED`` nodes, dealt to it by their hashes. What
    is found that way is connected, and needs no further links.
    """
    sizes = (
        measured.groupBy("hub")
        .agg(
            F.ceil(F.sum(F.col("linked").cast("int")) / TRIED).alias("blocks"),
            F.collect_set(_sliced("node")).alias("slices"),
        )
        .filter("blocks > 0")
        .select("hub", "blocks", F.explode("slices").alias("slice"))
    )
    dealt = measured.withColumn("slice", _sliced("node")).join(sizes, ["hub", "slice"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit(5), "node"), "blocks"))
    side = lambda df, s: df.select(
        "hub", "block", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "apart"))
    )
    met = side(dealt.filter("NOT linked"), "x").join(side(dealt.filter("linked"), "y"), ["hub", "block"])
    return (
        met.filter(_similar_sizes("n_x", "n_y", percent) & _alike_enough("x", "y", percent))
        .groupBy(F.col("node_x").alias("x"))
        .agg(F.min("node_y").alias("y"))
    )


def _links_around_hubs(measured: DataFrame, percent: int) -> DataFrame:
    """Links ``(x, y)`` of strays not connected to their hub yet, among nodes of that hub.

    ``measured`` says with ``joined`` which nodes are connected. Two sets are apart by the shingles that exactly one of them differs from the hub in.
    With ``c = (100 - percent) / (100 + percent)``, a link allows ``c * (n_x + n_y)`` of
    them, so that both must differ from the hub in ``(w_x + w_y) / 2`` shingles alike,
    where ``w = size(apart) - c * n``. A stray has ``w > c * n_hub``, which gives the least
    number for the others; its own follows from that no node has more alike than it has
    differences. So linked nodes meet in the rarest ones of their differences, as many as
    that number leaves over. What a passage that
    many documents share adds to all of them is frequent and not among these.
    """
    c = (100 - percent) / (100 + percent)
    weight = F.size("apart") - c * F.col("n")
    slack = weight - c * F.col("n_hub")
    alike = (c * F.col("n_hub") + weight) / 2
    alike = F.when(F.col("linked"), alike).otherwise(slack / (1 + c))
    # Rounding errors only lengthen what is compared.
    least = F.greatest(F.ceil(alike - 1e-6), F.lit(1))
    sized = measured.filter(F.size("apart") > 0).select(
        "hub", "node", "n", "joined", "apart", weight.alias("w"), (F.size("apart") - least + 1).alias("first_")
    )
    parts = sized.select("hub", _sliced("node"), "node", F.explode("apart").alias("shingle"))
    often = (
        parts.groupBy("hub", "shingle")
        .agg(F.count("*").alias("often"), F.collect_set("slice").alias("slices"))
        .filter("often > 1")
        .select("hub", "shingle", "often", F.explode("slices").alias("slice"))
    )
    # Shingles of one node only come first, and meet nobody: their number is enough.
    ordered = (
        parts.join(often, ["hub", "shingle", "slice"])
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("common"))
    )
    alone = F.size("apart") - F.size("common")
    posted = (
        sized.join(ordered, "node")
        .filter(F.col("first_") > alone)
        .select(
            "hub",
            "node",
            "n",
            "joined",
            "w",
            F.size("common").alias("size"),
            F.posexplode(
                F.slice("common", F.lit(1), (F.col("first_") - alone).cast("int"))
            ).alias("at", "one"),
        )
        .withColumn("shingle", F.col("one.shingle"))
    )
    side = lambda df, s: df.select(
        "hub", "shingle", *(F.col(x).alias(f"{x}_{s}") for x in ("node", "n", "joined", "w", "size", "at"))
    )
    rest = F.least(F.col("size_x") - F.col("at_x"), F.col("size_y") - F.col("at_y"))
    pairs = (
        side(posted.filter("NOT joined"), "x")
        .join(side(posted, "y"), ["hub", "shingle"])
        .filter(
            (F.col("joined_y") | (F.col("node_x") < F.col("node_y")))
            & _similar_sizes("n_x", "n_y", percent)
            & (2 * rest + 1e-6 >= F.col("w_x") + F.col("w_y"))
        )
        .select(F.col("node_x").alias("x"), F.col("node_y").alias("y"))
        .distinct()
    )
    of = lambda s: sized.select(
        F.col("node").alias(s), F.col("apart").alias(f"apart_{s}"), F.col("n").alias(f"n_{s}")
    )
    return pairs.join(of("x"), "x").join(of("y"), "y").filter(_alike_enough("x", "y", percent)).select("x", "y")


def _labelled(members: DataFrame, measured: DataFrame) -> DataFrame:
    """``(node, label, hub)``: nodes of one label are connected by way of their hubs.

    A hub may be connected to a hub of its own, and so on; the label is four such steps
    away at most. Each step leads to a node that meets more others, so no path is closed.
    """
    towards = measured.filter("joined").select("node", F.col("hub").alias("to"))
    for _ in range(2):
        next_ = towards.select(F.col("node").alias("to"), F.col("to").alias("next"))
        towards = towards.join(next_, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
    return (
        members.select("node")
        .distinct()
        .join(measured.select("node", "hub"), "node", "left")
        .join(towards, "node", "left")
        .select("node", F.coalesce("to", "node").alias("label"), F.coalesce("hub", "node").alias("hub"))
    )


def _other_pairs(
    members: DataFrame, classes: DataFrame, known: DataFrame, percent: int
) -> DataFrame:
    """Pairs of one table, of different hubs, not yet known to be connected.

    Of a half-key, only the nodes outside of its most frequent label are compared with
    all its nodes: a group of copies that is connected already costs nothing more. Rows
    of a half-key with many nodes meet on the whole table key, that is with each of
    their second halves.
    """
    labelled = members.join(known, "node").withColumn("slice", _sliced("node"))
    counts = labelled.groupBy("half", "label").agg(
        F.count("*").alias("n"),
        F.min("hub").alias("low"),
        F.max("hub").alias("high"),
        F.collect_set("slice").alias("slices"),
    )
    mixed = (
        counts.groupBy("half")
        .agg(
            F.max(F.struct("n", "label")).alias("most"),
            F.count("*").alias("labels"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.array_distinct(F.flatten(F.collect_set("slices"))).alias("slices"),
        )
        .filter("labels > 1 AND low <> high")
        .select("half", F.col("most.label").alias("most"), F.explode("slices").alias("slice"))
    )
    many = F.col("members") > TOGETHER
    left = stored(
        labelled.join(mixed, ["half", "slice"])
        .drop("slice")
        .join(classes.select("node", "n", "second", "sketch"), "node")
    )
    left = left.withColumn(
        "table", F.explode(F.when(many, F.col("second")).otherwise(F.array(F.lit(0))))
    ).withColumn("second", F.when(~many, F.col("second")))
    columns = ("node", "label", "hub", "n", "second", "sketch")
    mine = left.filter("label <> most").select(
        "half", "table", *(F.col(c).alias(f"{c}_x") for c in columns)
    )
    all_ = left.select("half", "table", "most", *(F.col(c).alias(f"{c}_y") for c in columns))
    bits = 2 * HALVES * ROWS
    agree = (1 + percent / 100) / 2
    differ = int(bits * (1 - agree) + DEVIATIONS * (bits * agree * (1 - agree)) ** 0.5)
    distance = sum(
        F.bit_count(F.col("sketch_x")[k].bitwiseXOR(F.col("sketch_y")[k])) for k in range(bits // 64)
    )
    return (
        mine.join(all_, ["half", "table"])
        .filter(
            (F.col("label_x") != F.col("label_y"))
            & (F.col("hub_x") != F.col("hub_y"))
            & ((F.col("label_y") == F.col("most")) | (F.col("node_x") < F.col("node_y")))
            & _similar_sizes("n_x", "n_y", percent)
            & (distance <= differ)
            & (F.col("second_x").isNull() | F.arrays_overlap("second_x", "second_y"))
        )
        .select(F.least("node_x", "node_y").alias("x"), F.greatest("node_x", "node_y").alias("y"))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` of every row.

    A document's set is that of its distinct shingles of ``words`` words (of all its
    words, if fewer); sets with ``100 * intersection >= percent * union`` are linked.
    ``component_id`` is the smallest key reachable, ``kept`` says whether it is the row's
    own. Rows with equal sets are one node, so copies are never expanded. A null or
    wordless text has size 0 and stands alone. A row with a null key takes no part in
    linking: its component is null and it is kept. Repeated keys are rows of their own,
    each with the component of its own set. An empty table gives no rows.

    First every node is compared with one hub, the node it shares most with, and what is
    not linked to its hub with some nodes that are; what is not connected then is compared
    with all nodes of its hub with which it shares a rare difference from it; then, of each table, nodes of different hubs that have no hub in
    common are compared. No pair that shares a table and could be linked is left out,
    unless both are linked to one hub, and each link is confirmed on the full sets.
    """
    docs = texts(docs, key, text)
    rows = stored(signatures(docs, key, text, words))
    classes = stored(
        rows.filter(F.col("node").isNotNull() & F.col(key).isNotNull())
        .groupBy("node")
        .agg(
            F.min(key).alias("least_"),
            *(F.first(c).alias(c) for c in ("n", "first", "second", "sketch")),
        )
    )
    halves = classes.select("node", F.explode("first").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("members")).filter("members > 1")
    members = stored(halves.join(shared, "half"))
    wanted = classes.select("node", "least_").join(members.select("node").distinct(), "node")
    wanted = wanted.select(F.col("least_").alias(key)).distinct()
    sets = stored(
        shingle_sets(docs.join(wanted, key, "left_semi"), key, text, words)
        .groupBy("node")
        .agg(F.first("shingles").alias("shingles"))
    )
    measured = stored(_measured(_hub_pairs(members), sets, percent))
    first = stored(_first_links(measured, percent))
    tried = first.select(F.col("x").alias("node"), F.lit(True).alias("found"))
    measured = stored(
        measured.join(tried, "node", "left")
        .withColumn("joined", F.col("linked") | F.coalesce("found", F.lit(False)))
        .drop("found")
    )
    known = _labelled(members, measured)
    to_hubs = measured.filter("linked").select(F.col("hub").alias("x"), F.col("node").alias("y"))
    around = _links_around_hubs(measured, percent)
    beyond = _confirmed(_other_pairs(members, classes, known, percent), sets, percent)
    links = to_hubs.unionByName(first).unionByName(around).unionByName(beyond)
    labels = components(links, "x", "y")
    own = classes.select("node", "least_").join(labels, "node", "left")
    own = own.select("node", "least_", F.coalesce("label", "node").alias("label"))
    least = own.groupBy("label").agg(F.min("least_").alias("component_id"))
    found = own.join(least, "label").select("node", "component_id")
    alone = F.col("node").isNull() | F.col(key).isNull()
    sized = rows.select(key, F.col("n").alias("n_shingles"), "node")
    out = sized.filter(~alone).join(found, "node").select(key, "n_shingles", "component_id")
    out = out.unionByName(
        sized.filter(alone).select(key, "n_shingles", F.col(key).alias("component_id"))
    )
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))

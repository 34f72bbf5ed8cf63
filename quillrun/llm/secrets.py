"""Secrets in whole texts: patterns, and weak parts linked by what stands near them.

Everything here is DataFrame functions. Spans are ``kind:start:end`` in code points, end
exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrun.llm.prefix import prefix_sums
from quillrun.llm.storage import stored, texts

# The base kinds in their order, patterns and least lengths.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_LEAST = 12
#: Runs of one class of characters are matched whole, so that the least length may stand
#: in the pattern without another result.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
BASE_KINDS = ("assign", "access", "hex")

#: Weak parts: nothing alone, a credential where their complement is near.
WEAK = {
    "identifier": (
        r"(?i:\b(?:access_?key_?id|client_?id|account_?id|user_?name|user|login))"
        r"[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{4,}"
    ),
    "secret": r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])",
    "endpoint": r"\b(?:https?|ftp|jdbc:[a-z]+|postgres|mysql|redis|amqp)://[A-Za-z0-9_.:@/-]{4,}",
}
ROLE_OF_BASE = {"assign": "secret", "access": "identifier", "hex": "secret"}


def spans(df: DataFrame, text: str, pattern: str, out: str, valued: bool = False) -> DataFrame:
    """``out``: spans ``(start, end, size)`` of all leftmost matches of a pattern.

    What stands between matches and the matches themselves give their places. ``size``
    is the length of the match, or of its second group if ``valued``. Texts without a
    match are only searched once.
    """
    has = F.col(text).rlike(pattern)
    none = F.array().cast("array<string>")
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    df = df.withColumns(
        {
            "found_": F.when(has, whole).otherwise(none),
            "between_": F.when(has, F.split(text, pattern, -1)).otherwise(none),
            "value_": F.when(
                has, F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if valued else whole
            ).otherwise(none),
        }
    )
    df = df.withColumn(
        "steps_",
        F.zip_with(
            F.slice("between_", F.lit(1), F.size("found_")),
            "found_",
            lambda b, m: F.struct(F.length(b).alias("gap"), F.length(m).alias("size")),
        ),
    ).withColumn("before_", prefix_sums(F.transform("steps_", lambda s: s["gap"] + s["size"])))
    placed = F.zip_with(
        F.zip_with(
            "steps_",
            "before_",
            lambda s, b: F.struct(
                (b + s["gap"]).alias("start"), (b + s["gap"] + s["size"]).alias("end")
            ),
        ),
        "value_",
        lambda s, v: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.length(v).alias("size")
        ),
    )
    return df.withColumn(
        out, F.when(F.size("found_") > 0, placed).otherwise(F.slice(placed, 1, 0))
    ).drop("found_", "between_", "value_", "steps_", "before_")


def _named(found: Column, kind: str, order: int, role: str, weak: bool) -> Column:
    return F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(order).alias("order"),
            F.lit(kind).alias("kind"),
            s["end"].alias("end"),
            F.lit(role).alias("role"),
            F.lit(weak).alias("weak"),
        ),
    )


def _parts(docs: DataFrame, text: str) -> DataFrame:
    """``base_`` and ``weak_`` parts in place of the text."""
    df = spans(docs, text, ASSIGN, "assign_", valued=True)
    df = spans(spans(df, text, ACCESS, "access_"), text, HEX, "hex_")
    for role, pattern in WEAK.items():
        df = spans(df, text, pattern, f"weak_{role}_")
    base = [
        _named(
            F.filter("assign_", lambda s: s["size"] >= ASSIGN_LEAST) if kind == "assign" else F.col(f"{kind}_"),
            kind, order, ROLE_OF_BASE[kind], False,
        )
        for order, kind in enumerate(BASE_KINDS)
    ]
    mixed = lambda s: (  # noqa: E731  both cases and a digit: no word, no number
        F.substring(text, s["start"] + 1, s["end"] - s["start"]).rlike(
            r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])"
        )
    )
    weak = [
        _named(
            F.filter(f"weak_{role}_", mixed) if role == "secret" else F.col(f"weak_{role}_"),
            role, len(BASE_KINDS) + order, role, True,
        )
        for order, role in enumerate(WEAK)
    ]
    return df.withColumns(
        {"base_": F.array_sort(F.concat(*base)), "weak_": F.concat(*weak)}
    ).drop("assign_", "access_", "hex_", *(f"weak_{role}_" for role in WEAK))


def _linked(scanned: DataFrame, reach: int) -> DataFrame:
    """``(row_, linked_)``: weak parts whose complement is near, in no base span.

    An interval join over bins of ``reach`` code points: a part meets only what falls in
    the same bins of its own text, and semi joins keep it once, whatever it meets.
    """
    parts = scanned.groupBy("row_").agg(F.first(F.concat("base_", "weak_")).alias("parts_"))
    parts = parts.select("row_", F.inline("parts_"))
    bins = lambda low, high: F.explode(
        F.sequence(F.floor(low / reach), F.floor(high / reach))
    )
    weak = parts.filter("weak").withColumn(
        "bin_", bins(F.col("start") - reach, F.col("end") + reach)
    )
    other = parts.select(
        "row_",
        F.col("role").alias("role_o"),
        F.col("start").alias("start_o"),
        F.col("end").alias("end_o"),
        F.col("weak").alias("weak_o"),
        bins(F.col("start"), F.col("end")).alias("bin_"),
    )
    same = (weak["row_"] == other["row_"]) & (weak["bin_"] == other["bin_"])
    near = (weak["start"] <= other["end_o"] + reach) & (other["start_o"] <= weak["end"] + reach)
    complement = (weak["role"] != other["role_o"]) & (
        (weak["role"] == "secret") | (other["role_o"] == "secret")
    )
    inside = (weak["start"] < other["end_o"]) & (other["start_o"] < weak["end"])
    columns = ("row_", "start", "order", "kind", "end", "role", "weak")
    once = lambda df: df.select(*columns).distinct()
    reported = once(weak.join(other, same & near & complement, "left_semi"))
    covered = once(weak.join(other.filter("NOT weak_o"), same & inside, "left_semi"))
    return (
        reported.join(covered, ["row_", "start", "kind", "end"], "left_anti")
        .groupBy("row_")
        .agg(F.collect_list(F.struct(*columns[1:])).alias("linked_"))
    )


def _row_name(key: str, text: str) -> Column:
    """What equal rows (key and text) share, and no others."""
    name = F.coalesce(F.concat(F.lit("+"), F.col(key).cast("string")), F.lit("-"))
    return F.sha2(F.concat(name, F.lit(" "), F.col(text)), 256)


def _found(docs: DataFrame, key: str, text: str, reach: int) -> DataFrame:
    """``(key, row_, base, spans)``; ``row_`` is null for rows without any part."""
    scanned = stored(
        _parts(docs.select(key, text), text).select(
            key,
            "base_",
            "weak_",
            F.when(F.size("weak_") + F.size("base_") > 0, _row_name(key, text)).alias("row_"),
        )
    )
    weak = F.size("weak_") > 0
    some = scanned.filter(weak)
    found = some.join(_linked(some, reach), "row_", "left").select(
        key, "row_", "base_", F.coalesce(F.concat("base_", "linked_"), "base_").alias("all_")
    )
    rest = scanned.filter(~weak).select(key, "row_", "base_", F.col("base_").alias("all_"))
    short = lambda c: F.transform(
        F.array_sort(c),
        lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")
        ),
    )
    return rest.unionByName(found).select(
        key, "row_", short("base_").alias("base"), short("all_").alias("spans")
    )


def find_secrets(
    docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = 200
) -> DataFrame:
    """``(key, base, spans)`` of every row: spans ``(start, kind, end)`` by start.

    ``base`` are the matches of the fixed patterns; ``spans`` has them and the weak parts
    (identifiers, secrets, endpoints) that have a complement, one of both being a secret,
    at most ``reach`` code points away. Texts are read once; only the places found are
    shuffled. A null or empty text has no spans; equal rows (key and text) have equal
    ones and stay rows of their own, null keys too; an empty table gives no rows; further
    columns are not read.
    """
    return _found(texts(docs, key, text), key, text, reach).drop("row_")


def redact_secrets(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    reach: int = 200,
    mark: str = "[secret]",
) -> DataFrame:
    """``docs`` with a mark in place of every span that ``find_secrets`` gives.

    All columns and rows stay. Texts without a span stay as they are, null ones too.
    """
    plain = docs.withColumn("plain_", F.coalesce(F.col(text).cast("string"), F.lit("")))
    plain = plain.withColumn("row_", _row_name(key, "plain_"))
    found = (
        _found(plain.select(key, "plain_"), key, "plain_", reach)
        .filter(F.size("spans") > 0)
        .groupBy("row_")
        .agg(F.first("spans").alias("spans_"))
    )
    clean = F.when(F.col("spans_").isNull(), F.col(text)).otherwise(
        redacted(F.col("plain_"), F.col("spans_"), mark)
    )
    return plain.join(found, "row_", "left").withColumn(text, clean).select(*docs.columns)


def written(found: str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redacted(text: Column, found: Column, mark: str = "[secret]") -> Column:
    """The text with every span, or chain of spans that overlap, replaced by a mark."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, span: Column) -> Column:
        begins = span["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(begins, F.concat(state["out"], F.array(gap, F.lit(mark))))
            .otherwise(state["out"])
            .alias("out"),
        )

    return F.aggregate(
        found,
        start,
        step,
        lambda s: F.concat(
            F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))
        ),
    )

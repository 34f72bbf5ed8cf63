"""Conversations as training windows of bounded size, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrun.llm.prefix import prefix_sums

# The template. A turn is TURN, role, a line end, text, END.
TURN = "<|turn|>"
END = "<|end|>\n"
#: What could be taken for a marker, of this template or of other common ones, gets a
#: backslash after its first character; backslashes are doubled.
CONTROL = r"<(?=\||/?s>)|\[(?=/?INST\])"
#: Tokens are counted as words and marks, and a fixed number for the markers of a turn.
TOKENS = r"\w+|[^\w\s]"
TURN_TOKENS = 6


def escaped(text: Column) -> Column:
    """The text without any marker in it; ``unescaped`` gives the text back."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def chat_windows(
    conversations: DataFrame,
    budget: int = 1024,
    history: int = 256,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained: str = "assistant",
) -> DataFrame:
    """``(key, window, text, n_repeated, loss)``: one row per window, in turn order.

    The running sum of tokens before a turn says in which stretch of the budget it
    starts and ends: turns inside the same stretch are one window, a turn that crosses
    into the next is a window of its own. So every turn is new in exactly one window and
    whole there; a window stays within ``budget`` tokens unless a single turn does not.
    In front of the new turns a window repeats the system turn, if the conversation
    starts with one, and the turns that lie within the ``history`` tokens before it;
    ``n_repeated`` is their number. ``loss`` has the spans ``(start, end)`` (code points
    of the window's text) of the new turns of role ``trained``, without markers; repeated
    ones are masked.

    A null text or role is the empty one. Turns go by ``turn`` (nulls first), ties by
    role, then text; repeated rows are turns of their own; rows with a null key are one
    conversation; an empty table gives no rows; further columns are not read. One
    shuffle, by conversation; the turns of a conversation meet in a task, its texts only
    in windows.
    """
    said = conversations.select(
        F.col(key).alias(key),
        F.col(turn).alias("turn_"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role_"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_"),
    ).withColumn("cost_", F.regexp_count("text_", F.lit(TOKENS)) + TURN_TOKENS)
    order = Window.partitionBy(key).orderBy("turn_", "role_", "text_")
    said = said.withColumns(
        {
            "at_": F.row_number().over(order),
            "before_": F.coalesce(
                F.sum("cost_").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
            "first_": F.first(F.struct("role_", "text_", "cost_")).over(
                order.rowsBetween(Window.unboundedPreceding, 0)
            ),
        }
    )
    system = F.col("first_.role_") == "system"
    width = F.greatest(
        F.lit(budget - history) - F.when(system, F.col("first_.cost_")).otherwise(0),
        F.lit(max(1, budget // 8)),
    )
    low = F.floor(F.col("before_") / width)
    high = F.floor((F.col("before_") + F.col("cost_") - 1) / width)
    near = (
        Window.partitionBy(key).orderBy("before_").rangeBetween(-history, -1)
    )
    spread = said.withColumns(
        {
            "window": F.when(low == high, 2 * low).otherwise(2 * low + 1),
            "near_": F.collect_list(F.struct("at_", "role_", "text_")).over(near),
        }
    )
    shown = spread.groupBy(key, "window").agg(
        F.sort_array(F.collect_list(F.struct("at_", "role_", "text_"))).alias("new_"),
        F.min_by("near_", "at_").alias("near_"),
        F.first("first_").alias("first_"),
    )
    kept_system = F.when(
        (F.col("first_.role_") == "system") & (F.col("new_")[0]["at_"] > 1),
        F.array(F.struct(F.lit(1).alias("at_"), F.col("first_.role_"), F.col("first_.text_"))),
    ).otherwise(F.slice("new_", 1, 0))
    has_system = F.col("first_.role_") == "system"
    earlier = F.filter("near_", lambda t: (t["at_"] > 1) | ~has_system)
    written = shown.select(
        key,
        "window",
        F.concat(kept_system, earlier).alias("old_"),
        "new_",
    ).select(
        key,
        "window",
        F.size("old_").alias("n_repeated"),
        F.transform(
            F.concat("old_", "new_"),
            lambda t: F.struct(
                (t["role_"] == trained).alias("trained"),
                F.concat(F.lit(TURN), F.url_encode(t["role_"]), F.lit("\n")).alias("head"),
                escaped(t["text_"]).alias("body"),
            ),
        ).alias("turns_"),
    )
    written = written.withColumn(
        "starts_",
        prefix_sums(
            F.transform(
                "turns_", lambda t: F.length(t["head"]) + F.length(t["body"]) + len(END)
            )
        ),
    )
    loss = F.filter(
        F.zip_with(
            F.transform("turns_", lambda t, i: F.struct(t.alias("t"), i.alias("i"))),
            "starts_",
            lambda x, s: F.struct(
                (s + F.length(x["t"]["head"])).alias("start"),
                (s + F.length(x["t"]["head"]) + F.length(x["t"]["body"])).alias("end"),
                (x["t"]["trained"] & (x["i"] >= F.col("n_repeated"))).alias("learn"),
            ),
        ),
        lambda s: s["learn"],
    )
    return written.select(
        key,
        "window",
        F.array_join(
            F.transform("turns_", lambda t: F.concat(t["head"], t["body"], F.lit(END))), ""
        ).alias("text"),
        "n_repeated",
        F.transform(
            loss, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
        ).alias("loss"),
    )


def read_back(windows: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(key, turns, learned, formatted_chars)`` of every conversation, from its windows.

    ``turns`` are ``(role, text)`` in order, each once; ``learned`` is all text under the
    loss mask, in order; both are unescaped.
    """
    parts = F.split("text", r"<\|end\|>\n", -1)
    turns = F.transform(
        F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - 1 - F.col("n_repeated")),
        lambda p: F.struct(
            F.url_decode(
                F.substring_index(p, "\n", 1).substr(F.lit(len(TURN) + 1), F.length(p))
            ).alias("role"),
            unescaped(
                p.substr(F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p))
            ).alias("text"),
        ),
    )
    learned = F.array_join(
        F.transform(
            "loss",
            lambda s: unescaped(F.col("text").substr(s["start"] + 1, s["end"] - s["start"])),
        ),
        "",
    )
    return (
        windows.select(
            key,
            F.struct("window", turns.alias("turns"), learned.alias("learned")).alias("read"),
            F.length("text").cast("long").alias("n"),
        )
        .groupBy(key)
        .agg(F.sort_array(F.collect_list("read")).alias("read"), F.sum("n").alias("formatted_chars"))
        .select(
            key,
            F.flatten(F.transform("read", lambda r: r["turns"])).alias("turns"),
            F.array_join(F.transform("read", lambda r: r["learned"]), "").alias("learned"),
            "formatted_chars",
        )
    )

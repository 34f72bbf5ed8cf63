"""Text functions. All of them are JVM-side expressions on one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillrun.functions.arrays import let

# What counts as white space, a word, a line end, and the preview.
WHITE_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"
WORD = r"[\p{L}\p{N}_]{2,}"
NO_WORD = r"[^\p{L}\p{N}_]+"
LINE_END = r"\r\n|\r|\n"
PREVIEW_CHARS = 80
PREVIEW_TAIL = " ..."


def normalize(text: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(text), WHITE_SPACE, " "))


def space_tokens(text: Column) -> Column:
    """Tokens of the normalised text between spaces; an empty text has none."""
    return F.filter(F.split(normalize(text), " "), lambda token: token != "")


def words(text: Column) -> Column:
    """Lower-cased words of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def spaced_words(text: Column) -> Column:
    """One text of the ``words`` with a space between them, and words of one character too."""
    return F.regexp_replace(F.lower(text), NO_WORD, " ")


def bigrams(tokens: Column) -> Column:
    """Neighbouring tokens of an array column joined by a space."""
    n_pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, F.lit(1), n_pairs),
        F.slice(tokens, F.lit(2), n_pairs),
        lambda left, right: F.concat_ws(" ", left, right),
    )


def terms(text: Column, ngrams: tuple[int, int] = (1, 2)) -> Column:
    """Words, neighbouring pairs, or both, within one text."""
    single = words(text)
    if ngrams == (1, 1):
        return single
    if ngrams == (2, 2):
        return let(single, bigrams)
    if ngrams == (1, 2):
        return let(single, lambda tokens: F.concat(tokens, bigrams(tokens)))
    raise ValueError("ngrams must be (1, 1), (1, 2) or (2, 2)")


def lines(text: Column) -> Column:
    """Lines of a text as a text file would give them.

    CR, LF and CRLF end a line, blank lines stay, and a line end at the very end
    of the text does not open another line.
    """
    body = F.regexp_replace(text, rf"(?:{LINE_END})\z", "")
    return F.when(F.length(text) > 0, F.split(body, LINE_END)).otherwise(
        F.array().cast("array<string>")
    )


def passage_text(title: Column, text: Column) -> Column:
    """Title and text joined by `` - ``, without spaces or hyphens at the ends."""
    return F.btrim(F.concat(F.coalesce(title, F.lit("")), F.lit(" - "), text), F.lit(" -"))


def preview(text: Column) -> Column:
    """The first characters of a text on one line."""
    head = F.substring(text, 1, PREVIEW_CHARS)
    return F.concat(F.replace(head, F.lit("\n"), F.lit(" ")), F.lit(PREVIEW_TAIL))


def overlap_score(query: Column, text: Column) -> Column:
    """Shared distinct tokens over the root of the product of both set sizes."""

    def score(sets: Column) -> Column:
        left, right = sets["left"], sets["right"]
        both = F.size(F.array_intersect(left, right))
        size = F.size(left).cast("double") * F.size(right)
        return F.when(size > 0, both / F.sqrt(size)).otherwise(F.lit(0.0))

    sets = F.struct(
        F.array_distinct(space_tokens(query)).alias("left"),
        F.array_distinct(space_tokens(text)).alias("right"),
    )
    return let(sets, score)

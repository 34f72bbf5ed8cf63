"""Main text of web pages: marked parts, and differences to the pages of the nearest URLs."""

from __future__ import annotations

import re
from collections.abc import Container, Iterable
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrun.llm.storage import in_slices, rewritten, stored
from quillrun.session import shuffle_width

#: Whole elements that hold no main text, wherever they stand.
SKIPPED = frozenset(
    "script style noscript template head title nav footer aside form button select textarea "
    "option dialog menu iframe object canvas svg math audio video".split()
)
#: The same, as a token of a class, an id or a role.
MARKED = frozenset(
    "ad ads advert advertisement advertising sponsor sponsored promo promotion banner cookie "
    "cookies consent notice newsletter subscribe popup modal nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer masthead share sharing social comment comments "
    "disqus related recommended complementary contentinfo search alert".split()
)
#: What may stand beside such a word in a token that is a mark, as in site-footer or ad-slot-3.
BESIDE = frozenset(
    "area articles bar block bottom box button buttons container form global group header holder icons "
    "inner item items left links list main outer page panel post posts primary right row "
    "secondary section signup site slot stories thread top unit widget wrap wrapper".split()
)
#: Elements whose id is not made of their own words, as the id of a heading is.
ID_MARKED = frozenset("div section ul ol dl table header center iframe".split())
#: Elements that never carry such a word for themselves.
NEVER_MARKED = frozenset(["html", "body", "article", "main"])
MAIN = frozenset(["article", "main"])
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements whose text stays in the line it stands in.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements whose start ends an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search "
    "section summary table ul".split()
)
#: Elements that keep what is in them from ending a paragraph or an item around them.
SCOPE = frozenset("html table td th caption button object template article main".split())
_HEADINGS = [f"h{n}" for n in range(1, 7)]
#: A start tag ends an open element of the first set, unless one of the second is between;
#: None is any element but inline ones.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"} | SCOPE),
    "dt": ({"dt", "dd"}, {"dl"} | SCOPE),
    "dd": ({"dt", "dd"}, {"dl"} | SCOPE),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    **{k: ({"thead", "tbody", "tfoot", "caption"}, {"table"}) for k in ("thead", "tbody", "tfoot")},
    **{k: (set(_HEADINGS), None) for k in _HEADINGS},
}
#: Elements that stay in the head of a page.
HEAD = frozenset("base bgsound link meta title script style noscript template".split())
OUTSIDE, INSIDE, BOILERPLATE, WEAK = 0, 1, 2, 3


def _mark(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    """What class, id and role say: ``BOILERPLATE``, ``WEAK`` for a word among others, or 0."""
    found = 0
    for name, value in attrs:
        if name not in ("class", "id", "role") or not value:
            continue
        for token in value.lower().split():
            words = [w for w in re.split(r"[^a-z]+", token) if w]
            if MARKED.isdisjoint(words):
                continue
            if (name != "id" or tag in ID_MARKED) and all(w in MARKED or w in BESIDE for w in words):
                return BOILERPLATE
            found = WEAK
    return found
#: So many different pages on either side of a page are asked which lines they share.
SIDE = 3
#: A page that shares more of the text than this is a copy of it, and says nothing.
COPY = 0.9
#: One that shares more than this is asked only if no other shares less.
ALIKE = 0.5
#: So many pages in URL order are compared in one go.
BLOCK = 64


class _Lines(HTMLParser):
    """Lines of a page with what is known of each: in the article, boilerplate, weak, neither."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # tag, mark, inside
        self.parts: list[str] = []
        self.lines: list[tuple[str, int]] = []

    def _state(self) -> tuple[int, bool]:
        return self.open[-1][1:] if self.open else (0, False)

    def flush(self) -> None:
        line = " ".join("".join(self.parts).split())
        self.parts.clear()
        if line:
            mark, inside = self._state()
            self.lines.append((line, mark or (INSIDE if inside else OUTSIDE)))

    def _end(self, at: int) -> None:
        if any(t not in INLINE or m for t, m, _ in self.open[at:]):
            self.flush()
        del self.open[at:]

    def _end_implied(self, tags: Container[str], within: Container[str] | None) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            tag = self.open[at][0]
            if tag in tags:
                self._end(at)
                return
            if tag in within if within is not None else tag not in INLINE:
                return

    def _end_head(self) -> None:
        if self.open and self.open[-1][0] == "head":
            self._end(len(self.open) - 1)

    def handle_starttag(self, tag, attrs):
        if tag not in HEAD and tag != "head":
            self._end_head()
        if tag in ENDS_P:
            self._end_implied({"p"}, SCOPE)
        if tag in IMPLIED_END:
            self._end_implied(*IMPLIED_END[tag])
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            if tag not in INLINE:
                self.flush()
            return
        mark, inside = self._state()
        own = 0
        if tag in SKIPPED or (tag == "header" and not inside):
            own = BOILERPLATE
        elif tag not in NEVER_MARKED:
            own = _mark(tag, attrs)
        if own or tag not in INLINE:
            self.flush()
        if tag in MAIN and mark == WEAK:
            mark = 0
        mark = BOILERPLATE if BOILERPLATE in (mark, own) else mark or own
        self.open.append((tag, mark, inside or tag in MAIN))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        at = next((k for k in range(len(self.open) - 1, -1, -1) if self.open[k][0] == tag), None)
        if at is not None:
            self._end(at)

    def handle_data(self, data):
        if data.strip():
            self._end_head()
        self.parts.append(data)


def page_lines(html: str) -> list[tuple[str, int]]:
    """``(line, mark)`` of all blocks of a page, in page order."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.lines


def _lcs_profile(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each prefix of ``b``."""
    where: dict[int, int] = {}
    for at, value in enumerate(b):
        where[value] = where.get(value, 0) | (1 << at)
    full = (1 << len(b)) - 1
    row = full
    for value in a:  # one machine word holds 64 columns
        hits = row & where.get(value, 0)
        row = ((row + hits) | (row - hits)) & full
    bits = np.frombuffer((~row & full).to_bytes(len(b) // 8 + 1, "little"), np.uint8)
    steps = np.unpackbits(bits, bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of one longest common subsequence of ``a`` and ``b``.

    Halves ``a`` and finds where to halve ``b`` from the lengths of both sides, so that
    memory stays linear.
    """
    known = set(b)
    places = [k for k, v in enumerate(a) if v in known]
    known = {a[k] for k in places}
    b = [v for v in b if v in known]
    found: list[int] = []
    stack = [(places, b)]
    while stack:
        left, right = stack.pop()
        while left and right and a[left[0]] == right[0]:
            found.append(left[0])
            left, right = left[1:], right[1:]
        if not left or not right:
            continue
        if len(left) == 1:
            if a[left[0]] in right:
                found.append(left[0])
            continue
        half = len(left) // 2
        ahead = _lcs_profile([a[k] for k in left[:half]], right)
        behind = _lcs_profile([a[k] for k in reversed(left[half:])], right[::-1])[::-1]
        cut = int(np.argmax(ahead + behind))
        stack.append((left[:half], right[:cut]))
        stack.append((left[half:], right[cut:]))
    return sorted(found)


def shared_lines(
    values: list[int], marks: list[int], copied: bool, others: list[list[int]]
) -> list[bool]:
    """Which lines of a page belong to the site, by the pages around it.

    ``values`` are line values of ``_value``; ``copied`` tells of an equal page elsewhere.
    A line goes if most of the pages asked share it, a weakly marked one if any does. A page that shares nearly all the text
    is a copy and is not asked. Where half of the text or more is in ``article`` or ``main``,
    that part is the text, and copies may decide about the other lines.
    """
    sizes = np.array([v & SIZE for v in values], np.int64)
    inside = np.array([m == INSIDE for m in marks], bool)
    spoken = 2 * int(sizes[inside].sum()) >= int(sizes.sum()) and bool(inside.any())
    text = inside if spoken else np.ones(len(values), bool)
    total = max(int(sizes[text].sum()), 1)
    seen = []
    for other in others:
        shared = np.zeros(len(values), bool)
        shared[common_lines(values, other)] = True
        seen.append((int(sizes[shared & text].sum()) / total, shared))

    def most(asked: list[np.ndarray]) -> np.ndarray:
        return 2 * np.sum(asked, axis=0) > len(asked) if asked else np.zeros(len(values), bool)

    asked = [s for part, s in seen if part <= ALIKE] or [s for part, s in seen if part <= COPY]
    frame = most([s for _, s in seen]) | copied
    weak = np.array([m == WEAK for m in marks], bool)
    gone = np.where(text, most(asked), frame)
    return np.where(weak, np.any(asked, axis=0) if asked else False, gone).tolist()


#: The low bits of a line value hold its length, the others its hash.
SIZE = 0xFFFF


def _value(line: str) -> int:
    return ((xxhash.xxh64_intdigest(line) & ~SIZE) | min(len(line), SIZE)) - (1 << 63)


def _undecided(html: str) -> list[tuple[str, int]]:
    return [(x, m) for x, m in page_lines(html) if m != BOILERPLATE]


def _group(host: str, values: list[int], marks: list[int]) -> bytes:
    """One key for all pages of a host with the same lines."""
    said = np.array(values, np.int64).tobytes() + bytes(marks)
    return xxhash.xxh3_128_digest(len(said).to_bytes(8, "little") + said + host.encode())


def _parsed(pages: DataFrame, with_text: bool) -> DataFrame:
    """The further columns and ``group_``, with the lines that no mark decides.

    As ``lines``, or as their ``values`` and ``marks``.
    """
    kept = [c for c in pages.columns if c not in ("html_", "host_" if with_text else "")]
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches):
        for batch in in_slices(batches):
            found = [_undecided(h) for h in batch.column("html_").to_pylist()]
            values = [[_value(x) for x, _ in p] for p in found]
            marks = [[m for _, m in p] for p in found]
            hosts = batch.column("host_").to_pylist()
            groups = [_group(*g) for g in zip(hosts, values, marks, strict=True)]
            more = {"group_": pa.array(groups, pa.binary())}
            if with_text:
                lines = [[x for x, _ in p] for p in found]
                more["lines"] = pa.array(lines, pa.list_(pa.string()))
            else:
                more["values"] = pa.array(values, pa.list_(pa.int64()))
                more["marks"] = pa.array([bytes(m) for m in marks], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *more.values()], [*kept, *more]
            )

    last = "lines array<string>" if with_text else "values array<long>, marks binary"
    return pages.mapInArrow(run, f"{kinds}, group_ binary, {last}")


def _in_url_order(groups: DataFrame) -> DataFrame:
    """``groups`` with ``at_``, their place by host, path and group, counted from 0.

    Sorted in ranges, so that a host with most of the pages is many ranges.
    """
    order = ["host_", "path_", "group_"]
    laid = stored(
        groups.repartitionByRange(shuffle_width(groups.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumn("id_", F.monotonically_increasing_id())
    )
    # The id is the partition, and below 33 bits the place in it.
    range_ = F.shiftright("id_", 33).alias("range_")
    before = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        laid.groupBy(range_)
        .count()
        .select("range_", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start_"))
    )
    return (
        laid.withColumn("range_", range_)
        .join(F.broadcast(starts), "range_")
        .withColumn("at_", F.col("start_") + F.col("id_").bitwiseAND((1 << 33) - 1))
        .drop("range_", "start_", "id_")
    )


def site_lines(pages: DataFrame) -> DataFrame:
    """``(group_, gone)``: for each undecided line of a group, whether it is the site's.

    Groups without such a line are left out.
    """
    groups = stored(
        _parsed(pages, False)
        .filter(F.size("values") > 0)
        .groupBy("host_", "group_")
        .agg(
            F.min("path_").alias("path_"),
            (F.min("page_") != F.max("page_")).alias("copied"),
            F.first("values").alias("values"),
            F.first("marks").alias("marks"),
        )
    )
    block = lambda by: F.floor((F.col("at_") + by) / BLOCK).cast("long")
    blocks = (
        _in_url_order(groups)
        .withColumn("block", F.explode(F.array_distinct(F.array(*map(block, (-SIDE, 0, SIDE))))))
        .select("block", "at_", "host_", "group_", "copied", "values", "marks")
        .repartition(shuffle_width(pages.sparkSession), "block")
        .sortWithinPartitions("block", "at_")
    )

    def decided(block: list[dict]) -> Iterable[tuple[bytes, list[bool]]]:
        for k, page in enumerate(block):
            if page["at_"] // BLOCK != page["block"]:
                continue
            around = block[max(k - SIDE, 0) : k] + block[k + 1 : k + 1 + SIDE]
            others = [
                other["values"]
                for other in around
                if other["host_"] == page["host_"] and other["values"] != page["values"]
            ]
            gone = shared_lines(page["values"], list(page["marks"]), page["copied"], others)
            if any(gone):
                yield page["group_"], gone

    def batch_of(found) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([g for g, _ in found], pa.binary()),
                pa.array([x for _, x in found], pa.list_(pa.bool_())),
            ],
            ["group_", "gone"],
        )

    def run(batches):
        held: list[dict] = []
        for batch in in_slices(batches):
            found: list = []
            for page in batch.to_pylist():
                if held and held[0]["block"] != page["block"]:
                    found.extend(decided(held))
                    held = []
                held.append(page)
            yield batch_of(found)
        yield batch_of(list(decided(held)))

    return blocks.mapInArrow(run, "group_ binary, gone array<boolean>")


def _host_and_path(url: str) -> tuple[Column, Column]:
    # Scheme, host, and path up to the query, without a trailing slash.
    shape = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)"
    said = F.coalesce(F.col(url).cast("string"), F.lit(""))
    return (
        F.lower(F.regexp_extract(said, shape, 1)),
        F.regexp_replace(F.regexp_extract(said, shape, 2), "/+$", ""),
    )


def main_text(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """``(key, url, text)`` of every row: lines of the main text, joined by line ends.

    A page is cut into lines at block elements. Elements that say themselves that they are
    no text (menus, footers, forms, adverts, scripts) go; a class, id or role says so by a
    whole token, and where it only has such a word among others, or is the id of a heading
    or a paragraph, one sharing page has to confirm it. Pages of a host with the same
    other lines are one page; each is aligned, by longest common subsequences, with the
    three different ones of its host before it and after it in path order, and lines that
    most of these share are the frame of the site and go, inside of ``article`` and
    ``main`` too. Pages that share nearly all the text are copies and do not count, save
    for lines outside of an ``article`` or ``main`` that holds most of the text.

    A null page is an empty one, with empty text; a null URL has no neighbours but other
    such; equal rows are one page when neighbours are sought and each keep a row; null
    keys too; an empty table gives no rows; further columns are not read.
    """
    host, path = _host_and_path(url)
    said = lambda c: F.coalesce(F.concat(F.lit("+"), F.col(c).cast("string")), F.lit("-"))
    text = F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html_")
    found = site_lines(
        pages.select(
            F.xxhash64(said(key), said(url)).alias("page_"),
            host.alias("host_"),
            path.alias("path_"),
            text,
        )
    )
    lines = _parsed(
        pages.select(F.col(key).alias(key), F.col(url).alias(url), host.alias("host_"), text), True
    )
    # Written first: where the lines are few, no text is shuffled for them.
    lines = lines.join(rewritten(found, "site_lines"), "group_", "left")
    kept = F.filter("lines", lambda x, at: ~F.coalesce(F.get("gone", at), F.lit(False)))
    return lines.select(key, url, F.array_join(kept, "\n").alias("text"))

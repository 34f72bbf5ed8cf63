"""Main text: marked parts, differences between neighbours, alignment."""

from collections import Counter
from html import unescape
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from quillrun.llm import pages
from quillrun.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, lines string, row_ int, host string"


def texts_of(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "h") for r in rows], SCHEMA)
    return [(r.page_id, r.text) for r in pages.main_text(df).collect()]


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=40), st.lists(st.integers(0, 6), max_size=40))
def test_alignment_is_longest(a, b):
    places = pages.common_lines(a, b)
    assert len(places) == lcs(a, b) and places == sorted(set(places))
    rest = iter(b)
    assert all(a[p] in rest for p in places)  # a subsequence of b


def test_long_pages_align_in_bounded_time():
    a = [k % 50 for k in range(6000)]
    b = [k % 49 for k in range(6000)]
    assert len(pages.common_lines(a, b)) >= 4800


def test_marked_parts_and_references():
    html = (
        "<html><head><title>t</title><style>p{}</style></head><body class='has-sidebar'>"
        "<header>Site</header><nav><ul><li>Menu</li></ul></nav><div class='cookie-notice'>Eat</div>"
        "<article><header><h1>A &amp; B &am</h1></header><p>x&nbsp; <b>y</b>\n z<br>w</p>"
        "<script>var a='<p>no</p>';</script><aside>side</aside><form>f<button>b</button></form>"
        "<table><tr><td>1</td><td>2</td></tr></table><p>last<!-- c --></article>"
        "<section id='comments'><p>me too</p></section><div role='contentinfo'>end</div>"
        "<footer>&copy;</footer></body>"
    )
    kept = [x for x, m in pages.page_lines(html) if m == pages.INSIDE]
    assert kept == ["A & B &am", "x y z w", "1", "2", "last"]
    assert not [x for x, m in pages.page_lines(html) if m == pages.OUTSIDE]


def page(*lines):
    return "<html><body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body></html>"


def test_shared_lines_of_the_nearest_page_go(spark):
    rows = [
        (1, "http://a.org/news/1", page("Logo", "Menu", "first story", "Imprint")),
        (2, "http://a.org/news/2", page("Logo", "Menu", "second story", "Imprint")),
        (3, "http://a.org/news/3/", page("Logo", "Menu", "third story", "more", "Imprint")),
        (4, "http://b.org/news/1", page("Logo", "Menu", "alone", "Imprint")),
    ]
    assert sorted(texts_of(spark, rows)) == [
        (1, "first story"), (2, "second story"), (3, "third story\nmore"),
        (4, "Logo\nMenu\nalone\nImprint"),
    ]


def test_copies_of_an_article_keep_it(spark):
    html = "<div>frame</div><article><p>the story</p></article>"
    rows = [(1, "http://a.org/x", html), (2, "http://a.org/x?page=2", html)]
    assert sorted(texts_of(spark, rows)) == [(1, "the story"), (2, "the story")]


def test_odd_rows(spark):
    rows = [
        (1, None, None), (None, "u", "<p>a"), (2, "http://a.org/1", ""), (2, "http://a.org/1", ""),
        (3, None, "<p>only"), (4, "http://c.org/", "<p>" + "long " * 200_000), (5, "::", "</p><<p <b>x"),
    ]
    found = Counter(texts_of(spark, rows))
    assert found[(2, "")] == 2 and found[(1, "")] == 1 and found[(None, "a")] == 1
    assert found[(4, " ".join(["long"] * 200_000))] == 1 and sum(found.values()) == len(rows)
    assert texts_of(spark, []) == []


def test_neighbours_in_one_large_host(spark):
    rows = [(i, f"http://a.org/{i:05d}", page("Frame", f"own {i}")) for i in range(300)]
    assert sorted(texts_of(spark, rows)) == [(i, f"own {i}") for i in range(300)]


def test_query(spark, folder):
    table = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in QUERIES["op7_page_text"](spark, folder).collect():
        html = table[r.page_id].html
        inner = html[html.index("<article>") + 9 : html.index("</article>")]
        blocks = re.split(r"</?(?:p|h1)>", inner)
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text) and r.url == table[r.page_id].url


def test_copies_without_marks_keep_their_text(spark):
    copy = page("Logo", "Menu", "the same story", "Imprint")
    rows = [(i, f"http://a.org/news/1?from={i}", copy) for i in range(4)]
    rows += [(9, "http://a.org/news/2", page("Logo", "Menu", "another story", "Imprint"))]
    assert sorted(texts_of(spark, rows)) == [
        *((i, "the same story") for i in range(4)), (9, "another story"),
    ]
    assert {t for _, t in texts_of(spark, rows[:4])} == {"Logo\nMenu\nthe same story\nImprint"}


def test_lines_of_the_site_go_inside_main_too(spark):
    rows = [
        (i, f"http://a.org/{i}", f"<main><div>Subscribers read more</div><p>A story of its own, {i}</p>"
         f"<p>{'shared by two' if i in (3, 4) else f'single {i}'}</p></main>")
        for i in range(8)
    ]
    for i, text in texts_of(spark, rows):
        last = "shared by two" if i in (3, 4) else f"single {i}"
        assert text == f"A story of its own, {i}\n{last}"


def test_near_copies_of_an_article_keep_it(spark):
    story = "".join(f"<p>Sentence {k} of a long story that is told again.</p>" for k in range(20))
    rows = [
        (i, f"http://a.org/{i:02d}", f"<div>Frame</div><article>{story}<p>Visit {i}</p></article>")
        for i in range(10)
    ]
    assert all(text.count("told again") == 20 for _, text in texts_of(spark, rows))
    assert not any("Frame" in text for _, text in texts_of(spark, rows))


def test_implied_end_tags_end_a_mark():
    html = (
        "<head><title>t</title><body><article><p class='notice'>x<p>Real text"
        "<ul><li class='share'>a<li>b</ul><table><tr><td class='ad'>c<td>d<tr class='ad'><td>e<tr><td>f"
        "</table><dl><dt class='promo'>g<dd>h</dl><p class='ad'><b>i<div>j</div>"
        "<ul><li>k<ul><li class='social'>l</ul>m</ul><h2 class='related'>n<h3>o</h3></article>"
    )
    found = pages.page_lines(html)
    assert [x for x, m in found if m == pages.INSIDE] == ["Real text", "b", "d", "f", "h", "j", "k", "m", "o"]
    assert [x for x, m in found if m == pages.BOILERPLATE] == list("txacegiln")


def test_words_inside_other_names_are_no_marks(spark):
    html = (
        "<article><h2 id='search-methods'>Methods</h2><h2 id='share-of-exports'>Exports</h2>"
        "<h2 id='share'>Share</h2><section class='related-work'><p>Others</p></section>"
        "<p id='comment-on-results'>Results</p><div class='promo-of-the-week'>Buy it</div>"
        "<div class='related-posts'>gone</div><div id='disqus_thread'>gone</div>"
        "<p class='text share-buttons'>gone</p><p>Story {}, as long as any other line of it</p></article>"
    )
    lines = "Methods\nExports\nShare\nOthers\nResults\nBuy it\nStory {}, as long as any other line of it"
    assert texts_of(spark, [(1, "http://a.org/1", html.format(1))]) == [(1, lines.format(1))]
    advert = "<article><div class='promo-of-the-week'>Buy it</div><p>Another story</p></article>"
    rows = [(1, "http://a.org/1", html.format(1)), (2, "http://a.org/2", advert)]
    rows += [(i, f"http://a.org/{i}", f"<article><p>More {i}</p></article>") for i in (3, 4)]
    found = dict(texts_of(spark, rows))
    assert found[1] == lines.format(1).replace("Buy it\n", "") and found[2] == "Another story"

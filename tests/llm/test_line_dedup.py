"""Line dedup against plain Python."""

import hashlib
from collections import defaultdict

import pytest

from quillrun.llm import line_dedup
from quillrun.llm.queries import QUERIES

LONG = "a line of more than twenty characters"
WHITE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(rows, least_chars=20, least_docs=3):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key_of(line)) >= least_chars:
                holders[key_of(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        lost = lambda x: len(h := holders.get(key_of(x), ())) >= least_docs and doc < max(h)
        kept = [x for x in lines if doc is None or not lost(x)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


ROWS = [
    (1, f"{LONG}\nown line of document one here\n{LONG}"),
    (2, f"\t{LONG.upper()}\r\nshort"),
    (3, f"{LONG}\n\n{LONG}"),
    (3, f"{LONG}\n\n{LONG}"),  # a repeated row
    (3, "another text under the same key"),
    (4, None), (5, ""), (6, "\n"), (None, LONG), (None, None),
    (7, "Éine Zeile mit Großbuchstaben ÄÖÜ"), (8, "Éine zeile mit großbuchstaben ÄÖÜ"),
    (9, "éine Zeile mit Großbuchstaben ÄÖÜ"), (10, "Éine Zeile mit GroßBUCHSTABEN ÄÖÜ"),
    (-1, "x" * 19 + "\n" + "y" * 20), (-2, "x" * 19 + "\n" + "y" * 20), (-3, "x" * 19 + "\n  " + "y" * 20),
]


def found(docs, **bounds):
    rows = line_dedup.without_repeated_lines(docs, **bounds)
    return sorted(map(tuple, rows.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=str)


@pytest.mark.parametrize("bounds", [{}, {"least_chars": 1, "least_docs": 2}, {"least_docs": 1}])
def test_equals_plain_code(docs_of, bounds):
    assert found(docs_of(ROWS), **bounds) == brute(ROWS, **bounds)


def test_one_line_in_most_documents_and_a_long_document(docs_of):
    many = [(n, f"{LONG}\nline {n} has its own text of some length") for n in range(400)]
    many.append((1000, "\n".join([LONG, "another line of some length"] * 150)))
    many += [(n, "\n".join(["another line of some length"] * 200)) for n in (1001, 1002)]
    assert found(docs_of(many).repartition(5)) == brute(many)


def test_bitmaps_hold_only_words_with_dropped_lines(docs_of):
    rows = [(n, "\n".join([f"own line {k} of the document {n}" for k in range(300)] + [LONG])) for n in range(3)]
    keep = line_dedup.keep_bitmaps(docs_of(rows)).collect()
    assert {r.doc_id for r in keep} == {0, 1}
    assert all([(w.word, w.bits) for w in r.keep] == [(4, ~(1 << 44))] for r in keep)
    assert line_dedup.keep_bitmaps(docs_of([])).count() == 0
    assert found(docs_of([])) == []


def test_query_equals_plain_code(spark, folder, real_texts):
    rows = QUERIES["op13_line_dedup"](spark, folder).collect()
    expected = {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(list(real_texts.items()))}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in rows} == expected
    assert sum(r.n_dropped for r in rows) > 0

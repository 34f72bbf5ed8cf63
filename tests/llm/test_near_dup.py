"""Near-duplicates against all pairs of full sets."""

import random
from collections import Counter

from quillrun.llm import near_dup
from quillrun.llm.components import components
from quillrun.llm.queries import QUERIES


def shingle_set(text, words):
    parts = (text or "").encode().lower().split()
    if not parts:
        return set()
    return {tuple(parts[i : i + words]) for i in range(len(parts) - words + 1)} or {tuple(parts)}


def brute(rows, words):
    """Component of each row by links between all rows with an id and words."""
    sets = [shingle_set(t, words) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                top[find(a)] = find(b)
    least = {}
    for a, (key, _) in enumerate(rows):
        if key is not None:
            least[find(a)] = min(least.get(find(a), key), key)
    return Counter(
        (k, len(sets[a]), least.get(find(a)), k is None or least[find(a)] == k)
        for a, (k, _) in enumerate(rows)
    )


def near_copies(seed, groups, size):
    draw = random.Random(seed)
    rows, key = [], 0
    for _ in range(groups):
        base = [draw.choice("abcdefgh") + str(draw.randint(0, 400)) for _ in range(draw.randint(20, 150))]
        for _ in range(size):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = f"z{draw.randint(0, 9999)}"
            rows.append((key, " ".join(copy)))
            key += 1
    draw.shuffle(rows)
    return rows


def test_equals_all_pairs(docs_of):
    rows = near_copies(5, 12, 12)
    for words in (4, 5):
        found = near_dup.near_duplicates(docs_of(rows), words=words)
        assert Counter(map(tuple, found.collect())) == brute(rows, words)


def test_odd_rows(docs_of):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [
        (5, text), (3, text.upper()), (3, text), (None, text), (9, ""), (8, None), (7, " \t\n"),
        (6, "one two"), (2, "ONE  two"), (1, "one two three"), (4, "Ä b c d e f"),
        (10, "ä b c d e f"), (11, "big " * 3 + " ".join(map(str, range(30_000)))),
        (12, "big " * 3 + " ".join(map(str, range(30_000))) + " end"),
    ]
    found = near_dup.near_duplicates(docs_of(rows), words=4)
    assert Counter(map(tuple, found.collect())) == brute(rows, 4)
    assert near_dup.near_duplicates(docs_of([])).count() == 0


def test_query_equals_all_pairs(spark, folder, real_texts):
    found = QUERIES["op6_near_duplicates"](spark, folder)
    assert Counter(map(tuple, found.collect())) == brute(sorted(real_texts.items()), 4)


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 30)] + [(3, 3), (1, None)]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b")
    expected = {(i, 100) for i in range(100, 161)} | {(i, 7) for i in range(7, 30)}
    assert {tuple(r) for r in found.collect()} == expected


def test_many_documents_around_a_passage_and_a_template(spark, docs_of, monkeypatch):
    """Large groups below and above the threshold: equal to brute force, records in proportion."""
    draw = random.Random(11)
    word = lambda: f"w{draw.randint(0, 10**6)}"
    passage = " ".join(f"p{i}" for i in range(75))
    template = [f"t{i}" for i in range(90)]

    def edited(changes):
        words = list(template)
        for at in draw.sample(range(len(words)), changes):
            words[at] = draw.choice(["x", "y", word()])
        return " ".join(words)

    rows = [(i, passage + " " + " ".join(word() for _ in range(draw.randint(20, 110)))) for i in range(700)]
    rows += [(1_000 + i, edited(draw.randint(0, 9))) for i in range(600)]
    rows += [(3_000 + i, " ".join(template[: draw.randint(60, 90)])) for i in range(150)]
    counted = []
    original = near_dup._links_around_hubs

    def noted(measured, percent):
        links = original(measured, percent)
        counted.append(links.count())
        return links

    monkeypatch.setattr(near_dup, "_links_around_hubs", noted)
    found = near_dup.near_duplicates(docs_of(rows), words=4, percent=80).collect()
    sets = {}
    for key, text in rows:
        words = text.split()
        sets[key] = {tuple(words[k : k + 4]) for k in range(len(words) - 3)}
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(sets)
    for n, x in enumerate(keys):
        for y in keys[:n]:
            both = len(sets[x] & sets[y])
            if 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                a, b = sorted((root(x), root(y)))
                parent[b] = a
    assert {r.doc_id: r.component_id for r in found} == {k: root(k) for k in keys}
    assert counted[0] < 20 * len(rows)

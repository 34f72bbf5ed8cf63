"""Base spans against Python's matcher, and linking of weak parts."""

import hashlib
import re
from collections import Counter

from quillrun.llm import secrets
from quillrun.llm.queries import QUERIES

BASE = [
    (
        "assign",
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        lambda m: len(m[2]) >= 12,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
]


def base_spans(text):
    found = [
        (m.start(), order, kind, m.end())
        for order, (kind, pattern, good) in enumerate(BASE)
        for m in pattern.finditer(text or "")
        if good(m)
    ]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


WEAK = "Ab3" + "dEf7Gh1J" * 4 + "Zz9xQ"
TEXTS = [
    "token=secret=abcdefghijklmnop token=secret:abcdefghijklmnop",
    "password:  'abc' then PassWord\" = \"0123456789abcdef0123",
    "é 😀 AKIA" + "A" * 13 + " AKIA" + "B" * 14 + " AKIAAKIA" + "C" * 12,
    "deadbeef" * 3 + "x" + "0" * 15 + "g" + "1" * 16,
    "", None, "api_key=" + "z" * 5000, "apikey: " + " " * 50 + "q" * 12 + "\ntoken\n= " + "a" * 12,
    " ".join(f"secret={'a' * (k % 30)}" for k in range(900)),
]


def test_base_spans_equal_pythons(docs_of):
    rows = [*enumerate(TEXTS), (0, TEXTS[0]), (None, TEXTS[1])]
    found = secrets.find_secrets(docs_of(rows)).select("doc_id", secrets.written("base").alias("s"))
    got = Counter(map(tuple, found.collect()))
    assert got == Counter((k, ",".join(base_spans(t))) for k, t in rows)
    assert secrets.find_secrets(docs_of([])).count() == 0


def linked(docs_of, *texts):
    rows = secrets.find_secrets(docs_of(list(enumerate(texts)))).collect()
    return {r.doc_id: [f"{s['kind']}:{s['start']}:{s['end']}" for s in r.spans] for r in rows}


def test_weak_parts_need_a_complement(docs_of):
    near = f"login: someone and {WEAK} at https://vault.example.org/x"
    far = f"login: someone {'w ' * 400} {WEAK}"
    access = f"AKIA{'Q' * 16} {WEAK}"
    found = linked(docs_of, near, far, WEAK, "login: someone at https://a.example.org", access)
    at = near.index(WEAK)
    url = near.index("https")
    assert found[0] == [
        "identifier:0:14", f"secret:{at}:{at + 40}", f"endpoint:{url}:{len(near)}"
    ]
    assert found[1] == found[2] == found[3] == []
    assert found[4] == ["access:0:20", "secret:21:61"]


def test_base_spans_stay_and_are_not_repeated(docs_of):
    text = f"user=admin password={WEAK}"
    found = linked(docs_of, text)[0]
    assert base_spans(text) == ["assign:11:60"] and found == ["identifier:0:10", "assign:11:60"]


def test_redaction(docs_of):
    rows = [(1, f"a token={'x' * 14} b {'0123456789abcdef' * 2} c"), (2, None), (3, "plain"),
            (4, f"AKIA{'Q' * 16} {WEAK}!"), (4, "other"), (5, "secret=" + "0123456789abcdef" * 2)]
    found = secrets.redact_secrets(docs_of(rows))
    assert found.columns == docs_of([]).columns
    assert Counter((r.doc_id, r.text) for r in found.collect()) == Counter(
        [(1, "a [secret] b [secret] c"), (2, None), (3, "plain"), (4, "[secret] [secret]!"),
         (4, "other"), (5, "[secret]")]
    )


def test_no_python_on_the_path(spark, folder):
    plan = QUERIES["op4_secret_scan"](spark, folder)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def test_query(spark, folder, real_texts):
    for r in QUERIES["op4_secret_scan"](spark, folder).collect():
        spans = base_spans(real_texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        kinds = Counter(s.split(":")[0] for s in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds[k] for k in ("assign", "access", "hex"))
        assert set(spans) <= set(r.spans.split(",")) | {""}

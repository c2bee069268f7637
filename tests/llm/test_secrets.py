import hashlib
import random
import re
from collections import Counter

from corpora import documents, no_docs, odd_docs, odd_rows

from wicklake.llm import secrets
from wicklake.llm.common import table
from wicklake.llm.queries import LLM_QUERIES

ASSIGN = re.compile("""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
                    """|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(secrets.KINDS[k], a, b) for a, k, b in sorted(spans)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def test_whole_table_equals_brute_force(spark, small):
    got = {r.doc_id: r for r in LLM_QUERIES["op5_secrets"](spark, small).collect()}
    found = Counter()
    for d, text, _, _ in documents(small):
        want, r = brute(text), got[d]
        assert r.base_sha256 == digest(want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for k, *_ in want) for kind in secrets.KINDS)
        spans = [tuple(s.split(":")) for s in r.spans.split(",") if s]
        assert [s for s in spans if s[0] in secrets.KINDS] == [(k, str(a), str(b)) for k, a, b in want]
        assert [int(s[1]) for s in spans] == sorted(int(s[1]) for s in spans)
        found.update(s[0] for s in spans)
    assert found["assign"] and found["hex"]


def test_base_spans_on_random_texts():
    rng = random.Random(2)
    parts = ["password", "PassWd", "token", "api_key", "APIKEY", "ſecret", "secret", '"', "'", " ", ":", "=", "AKIA", "A1B2C3D4E5F6G7H8", "deadbeef0123",
             "0123456789abcdef", "é", "\n", "x", "abc.def", "-", "AKIAAKIA", "token=token=abcdef", "€"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert [(k, a, b) for a, b, k, *_ in secrets.base_spans(text)] == brute(text), repr(text)


def test_inference_learns_a_format():
    rng = random.Random(6)
    words = Counter("AKIA" + "".join(rng.choices("A9", k=16)) for _ in range(800))
    automaton = secrets.infer(words)
    assert len(automaton.moves) < 60
    new = ["AKIA" + "".join(rng.choices("A9", k=16)) for _ in range(50)]
    other = ["".join(rng.choices("zf9", k=20)) for _ in range(50)]
    assert min(map(automaton.likelihood, new)) > max(map(automaton.likelihood, other))
    for row, end in zip(automaton.moves, automaton.ends):
        assert abs(sum(p for _, p in row.values()) + end - 1) < 1e-9


def test_unnamed_credentials_are_added(spark, small):
    formats = secrets.learn(table(spark, small, "documents"))
    rng = random.Random(1)
    prose = "Onre the of heerly stand in the house and thereoforeandnoword 4293469861724982 of it. "
    key = "".join(rng.choices("0123456789abcdef", k=20))
    assert [k for *_, k in secrets.format_spans(prose, formats, secrets.MARGIN, [])] == []
    text = "é" + prose + key + " end"
    (span,) = secrets.format_spans(text, formats, secrets.MARGIN, [])
    assert text[span[0]:span[1]] == key and span[2].startswith("like_")
    assert secrets.format_spans(text, formats, secrets.MARGIN, [(span[0], span[0] + 1)]) == []


def test_odd_rows(spark, small):
    formats = secrets.learn(table(spark, small, "documents"))
    got = secrets.scan(odd_docs(spark), formats).collect()
    assert len(got) == len(odd_rows())
    assert all(r.base == [] and r.spans == [] for r in got)
    empty = secrets.learn(no_docs(spark))
    assert empty.automata == {}
    rows = [(1, "x" * 500_000 + " token: 'abcdef' " + "0a" * 300_000), (1, "token: abcdef"), (1, "token: abcdef")]
    (long, *same) = sorted(secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"), empty).collect(), key=lambda r: -len(r.base))
    assert [(s.kind, s.start, s.end) for s in long.base] == brute(rows[0][1])
    assert same[0] == same[1]
    assert secrets.scan(no_docs(spark), empty).collect() == []

import hashlib
import random
import zlib

from corpora import documents, no_docs, odd_docs, odd_rows

from wicklake.llm import runs
from wicklake.llm.queries import op11_periodic_runs


def brute_runs(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        same = [a == b for a, b in zip(words, words[q:])] + [False]
        start = 0
        for i, equal in enumerate(same):
            if not equal:
                if i - start + q >= max(6, 4 * q):
                    found.append((start, i - start + q, q))
                start = i + 1
    return sorted((s, n, q) for s, n, q in found if not any(words[s:s + n - p] == words[s + p:s + n] for p in range(1, q)))


def planted(doc_id, words):
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def collapsed(words, found):
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in dropped)


def expected(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    found = brute_runs(words)
    s, n, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    return (doc_id, len(found), s, n, q, n and 1000 * n // q,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, found)).hexdigest())


def by_document(docs):
    found = [[] for _ in docs]
    for doc, *run in zip(*(x.tolist() for x in runs.find_runs(docs))):
        found[doc].append(tuple(run))
    return found


def test_small_alphabets_equal_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        docs = []
        for _ in range(rng.randint(1, 4)):
            letters, n = rng.choice([1, 2, 3, 5]), rng.randint(0, 60)
            words = [b"%d" % rng.randrange(letters) for _ in range(n)]
            if n and rng.random() < 0.6:
                base = [b"%d" % rng.randrange(letters + 1) for _ in range(rng.randint(1, 12))]
                words[rng.randrange(n):] = [base[i % len(base)] for i in range(rng.randint(0, 90))]
            docs.append(words)
        assert by_document(docs) == [brute_runs(words) for words in docs]


def test_long_periods_and_long_runs():
    rng = random.Random(2)
    root = [b"w%d" % rng.randrange(10**6) for _ in range(1500)]
    docs = [root * 5 + root[:77], [b"a"] * 20000, [b"x", b"y"] * 9000 + [b"z"], root]
    assert by_document(docs) == [[(0, 7577, 1500)], [(0, 20000, 1)], [(0, 18000, 2)], []]


def test_progressions_of_blocks_that_have_a_smaller_period_inside():
    words = [b"a"] * 7 + [b"b"]
    assert by_document([words * 5]) == [brute_runs(words * 5)]
    assert (0, 40, 8) in brute_runs(words * 5)


def test_whole_table_equals_brute_force(spark, small):
    got = sorted(tuple(r) for r in op11_periodic_runs(spark, small).collect())
    want = sorted(expected(d, t) for d, t, _, _ in documents(small))
    assert got == want
    assert sum(r[1] > 0 for r in want) > 50


def test_odd_rows(spark):
    got = runs.periodic_runs(odd_docs(spark)).collect()
    rows = {(r[0], (r[1] or "")): brute_runs((r[1] or "").encode().split()) for r in odd_rows() if r[0] != 5}
    for (doc_id, text), found in rows.items():
        words = text.encode().split()
        assert [r for r in got if r.doc_id == doc_id and r.n_words == len(words) and [tuple(x) for x in r.runs] == found
                and r.collapsed.encode() == collapsed(words, found)]
    long = next(r for r in got if r.doc_id == 5)
    assert [tuple(x) for x in long.runs] == [(0, 160000, 8)] and long.collapsed == "Der lange Satz steht hier und endet nie."
    assert len(got) == 12


def test_planted_tails(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(i % 23))) for i in range(300)] + [(None, "a b"), (10, None)]
    got = runs.with_periodic_tails(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    words = {(r.doc_id, tuple((r.text or "").split())) for r in got}
    assert words == {(d, tuple(planted(d, (t or "").split()))) for d, t in rows}


def test_no_rows(spark):
    assert runs.periodic_runs(no_docs(spark)).collect() == []
    assert runs.with_periodic_tails(no_docs(spark)).collect() == []

import random

import xxhash
from corpora import documents, no_docs, odd_docs

from wicklake.llm import simhash
from wicklake.llm.common import table
from wicklake.llm.components import connected_components


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    words = low.split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_whole_table_equals_brute_force(spark, small):
    prints = {d: brute_print(t) for d, t, _, _ in documents(small)}
    ids = sorted(prints)
    want = brute_components(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if bin(prints[a] ^ prints[b]).count("1") <= 2])
    got = simhash.groups(table(spark, small, "documents")).collect()
    assert {r.doc_id: r.fingerprint % 2**64 for r in got} == prints
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(set(want.values())) < len(ids)


def test_links_for_each_radius(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = {b for x in base for b in (x, *(x ^ sum(1 << k for k in rng.sample(range(64), rng.randint(1, 4))) for _ in range(6)))}
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    for radius in (0, 1, 2, 3):
        near = [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) % 2**64).count("1") <= radius]
        found = simhash.links(frame, radius).collect()
        assert set(map(tuple, found)) <= set(near)
        assert brute_components(signed, found) == brute_components(signed, near)


def test_long_text_in_steps(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(3000))
    whole = simhash.fingerprint(text)
    assert whole == brute_print(text)
    monkeypatch.setattr(simhash, "_SHINGLES_AT_ONCE", 7)
    assert simhash.fingerprint(text) == whole


def test_odd_rows(spark):
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.groups(odd_docs(spark)).collect()]
    assert len(got) == 12
    zero = {d for d, f, _ in got if f == 0}
    assert {2, 3, 4} <= zero
    assert {c for d, f, c in got if f == 0} == {2}
    assert {c for d, _, c in got if d in (1, 6)} == {1}
    assert [c for d, _, c in got if d is None] == [None]
    kept = simhash.keep_one(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted({c for _, _, c in got}, key=str)
    assert simhash.keep_one(odd_docs(spark).filter("doc_id = 6")).count() == 1


def test_groups_without_an_id_of_their_own_keep_a_row_each(spark):
    rng = random.Random(11)
    a, b, c, d, e, f = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(6))
    # Unrelated texts without an id, and under one id; copies of those and of a text that has an id.
    rows = [(None, a), (None, a.upper()), (None, b), (7, c), (7, d), (None, d), (9, e), (None, e.upper()), (8, f), (8, f)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id or 0), r.text.lower()) for r in kept) == sorted([(0, a), (0, b), (7, c), (7, d), (9, e), (8, f)])
    assert (9, e) in set(map(tuple, kept))


def test_no_rows(spark):
    assert simhash.groups(no_docs(spark)).collect() == []
    assert simhash.keep_one(no_docs(spark)).collect() == []


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(200, 300)] + [(500, 500), (None, 4)]
    edges += [(rng.randint(1000, 1400), rng.randint(1000, 1400)) for _ in range(250)]
    rng.shuffle(edges)
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = brute_components({x for e in real for x in e}, real)
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []

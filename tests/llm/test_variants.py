import random
import re
from collections import Counter
from itertools import combinations
from zlib import crc32

import numpy as np
from corpora import no_docs, odd_docs

from wicklake.llm import variants
from wicklake.llm.common import staged

LETTERS = "abcdefghàÿ×À"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_counts(rows, slips=None):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{doc_id}:{run}".encode())
            if slips and doc_id is not None and h % slips == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute_groups(counts):
    links = {w: [] for w in counts}
    for a, b in combinations(counts, 2):
        if near(a, b):
            links[a].append(b)
            links[b].append(a)
    forms = {}
    for word, others in links.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        forms[word] = best if best and counts[best] >= 10 * counts[word] else None
    out = set()
    for word in counts:
        root = word
        while forms[root]:
            root = forms[root]
        out.add((word, forms[word], root, counts[word], len(links[word]), forms[word] and counts[forms[word]]))
    return out


def chained_rows():
    rng = random.Random(4)
    base = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(6, 9))) for _ in range(60)]
    words = []
    for word in base:
        n = 1300
        while n:
            words += [word] * n
            n //= 11
            i = rng.randrange(len(word))
            word = rng.choice([word[:i] + word[i + 1:], word[:i] + rng.choice(LETTERS) + word[i:], word[:i] + rng.choice(LETTERS) + word[i + 1:]])
    rng.shuffle(words)
    return [(i, ", ".join(words[i::400]).title() if i % 7 == 0 else " ".join(words[i::400])) for i in range(400)]


def test_groups_equal_brute_force(spark):
    rows = chained_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for slips in (None, 31, 3):
        got = variants.group_variants(docs, slips).collect()
        want = brute_groups(brute_counts(rows, slips))
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert max(len({w for w, _, r, *_ in want if r == root}) for root in {r for _, _, r, *_ in want}) > 4


def test_filters_in_passes_give_the_same_pairs(spark, monkeypatch):
    rng = random.Random(9)
    words = {"".join(rng.choice("abcd") for _ in range(rng.randint(7, 9))) for _ in range(3000)}
    vocabulary = staged(spark.createDataFrame([(w, 2) for w in words], "word string, n long"), "vocabulary")
    want = {frozenset(p) for p in combinations(words, 2) if near(*p)}
    assert len(list(variants._passes({7: 100, 8: 100}, 64))) == 2
    monkeypatch.setattr(variants, "CHUNK_BLOCKS", 64)
    assert len(list(variants._passes(Counter(map(len, words)), 1500))) > 3
    for most in (1500, variants.FILTER_BYTES):
        got = variants.near_words(vocabulary, most).collect()
        assert len(got) == len(want) and {frozenset((r.word, r.near)) for r in got} == want


def test_filters_hold_back_most_edits():
    rng = np.random.default_rng(3)
    for size, share in ((9, 0.01), (40, 0.001)):
        blocks, bits_per_key = variants.filter_size(size, 20000)
        hashes = variants._mixed(rng.integers(0, 2**63, 20000).astype(np.uint64))
        shard = variants.Shard(blocks, bits_per_key, 0, np.zeros(blocks, np.uint64))
        np.bitwise_or.at(shard.bits, variants._blocks(hashes, blocks), variants._masks(hashes, bits_per_key))
        others = rng.integers(0, 2**63, 200000).astype(np.uint64)
        assert len(variants._passing(shard, others)) < share * len(others)


def test_very_long_words(spark):
    a = "ab" * 20000
    rows = [(1, f"{a} {a} {a[:-1]} {a[:-1]} {a}c"), (2, f"{a}c " + f"{a[:500]}x{a[501:]} " * 2)]
    got = {(len(r.word), r.n, r.n_near, r.form) for r in variants.group_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(40000, 2, 3, None), (39999, 2, 1, None), (40001, 2, 1, None), (40000, 2, 1, None)}


def test_odd_rows(spark):
    got = {r.word: r.n for r in variants.group_variants(odd_docs(spark)).collect()}
    assert got == {}
    rows = [(None, "Ärgerlich ärgerlich ärgerlich Ärgerlich"), (None, None), (3, ""), (4, "ärgerlic"), (4, "ärgerlic")]
    got = variants.group_variants(spark.createDataFrame(rows, "doc_id long, text string"), slips=1).collect()
    assert {tuple(r) for r in got} == brute_groups(brute_counts(rows, 1)) and len(got) == 3


def test_no_rows(spark):
    assert variants.group_variants(no_docs(spark)).collect() == []

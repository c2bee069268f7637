import hashlib
import random

import numpy as np
import pytest
from corpora import documents, no_docs, odd_docs, odd_rows
from pyspark.sql import functions as F

from wicklake.llm import suffix
from wicklake.llm.common import LAST_ID, table


def brute(rows):
    """By doc_id: bytes, bytes removed, runs removed and the hash of what stays."""
    least = {}
    for d, t in rows:
        x = (t or "").encode()
        for p in range(len(x) - suffix.MATCH + 1):
            k = x[p:p + suffix.MATCH]
            least[k] = min(least.get(k, LAST_ID), LAST_ID if d is None else d)
    out = []
    for d, t in rows:
        x = (t or "").encode()
        gone = np.zeros(len(x), bool)
        for p in range(len(x) - suffix.MATCH + 1):
            if least[x[p:p + suffix.MATCH]] < (LAST_ID if d is None else d):
                gone[p:p + suffix.MATCH] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((d, len(x), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(x, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    rows = df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_whole_table_equals_brute_force(spark, small):
    got = result(suffix.remove_repeats(table(spark, small, "documents")))
    assert got == brute([(d, t) for d, t, _, _ in documents(small)])
    assert sum(r[2] for r in got) > 100_000


def mosaics(seed, letters):
    """Texts made of a few passages, cut anywhere, among noise."""
    rng = random.Random(seed)
    passages = ["".join(rng.choices(letters, k=rng.randint(30, 160))) for _ in range(12)]
    rows = []
    for d in range(120):
        parts = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p))))
            parts += [p[a:b] if rng.random() < 0.6 else p, "".join(rng.choices(letters, k=rng.randint(0, 20)))]
        rows.append((rng.choice([d * 7, d * 7, 3, None]), "".join(parts)))
    return rows


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abcdefgh "), (3, "a"), (4, "\x00\x01é")])
def test_mosaics(spark, monkeypatch, seed, letters):
    monkeypatch.setattr(suffix, "UNIT", 200)
    rows = mosaics(seed, letters)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(suffix.remove_repeats(frame)) == brute(rows)


def test_texts_longer_than_a_buffer(monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choices("abcd", k=5000)).encode()
    whole = suffix.runs([b"", text, b"", text[1000:1300], b"short"])
    monkeypatch.setattr(suffix, "_BUFFER", 333)
    parts = suffix.runs([b"", text, b"", text[1000:1300], b"short"])
    for found in (whole, parts):
        strings = np.concatenate([np.arange(f, f + n) for f, n in zip(found.first, found.n)])
        assert sorted(strings) == [*range(4951), *range(5000, 5251)]
        assert set(found.doc[found.first < 4951]) == {1} and set(found.doc[found.first >= 5000]) == {3}
    first = dict(zip(whole.anchor.tolist(), whole.n.tolist()))
    assert set(first) == set(parts.anchor.tolist())


def test_index_family_merges_geometrically():
    rng, family, every = np.random.default_rng(2), suffix.IndexFamily(), set()
    for _ in range(64):
        new = np.unique(rng.integers(0, 100_000, 100)).astype(f"S{suffix.MATCH}")
        new = np.sort(new)
        known = family.known(new)
        assert known.tolist() == [x in every for x in new.tolist()]
        family.add(new[~known])
        every |= set(new.tolist())
        sizes = [len(level) for level in family.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
    assert len(family.levels) <= 8


def test_odd_rows(spark):
    assert result(suffix.remove_repeats(odd_docs(spark))) == brute([(r[0], r[1]) for r in odd_rows()])


def test_no_rows(spark):
    assert suffix.remove_repeats(no_docs(spark)).collect() == []

import math
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from corpora import documents, no_docs, odd_docs

from wicklake.llm import maxent
from wicklake.llm.common import staged
from wicklake.llm.queries import op13_language_model


def brute(rows):
    """Id, held out, tokens, known tokens, training tokens, base score."""
    texts = [(d, d is None or crc32(str(d).encode()) % 7 == 2, [*(t or "").encode().lower().split(), None]) for d, t in rows]
    counts = Counter(w for _, held, words in texts if not held for w in words)
    n, v = sum(counts.values()), len(counts)
    return [(d, held, len(words), sum(counts[w] > 0 for w in words), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
            for d, held, words in texts]


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-9)


def test_whole_table_equals_brute_force_and_beats_counts(spark, small):
    got = op13_language_model(spark, small).collect()
    same(got, brute([(d, t) for d, t, _, _ in documents(small)]))
    held = [r for r in got if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    assert all(r.score < 0 for r in got)
    assert sum(r.score for r in held) / tokens > sum(r.base_score for r in held) / tokens + 0.05


def test_few_broadcast_counts_give_the_same_sums(spark, small, monkeypatch):
    rows = [(d, t) for d, t, _, _ in documents(small)][:300]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = maxent.score(docs).collect()
    monkeypatch.setattr(maxent, "KNOWN", 3 * maxent.HEAD)
    few = maxent.score(docs).collect()
    same(few, brute(rows))
    by_id = {r.doc_id: r.score for r in whole}
    assert [r.score for r in few] == pytest.approx([by_id[r.doc_id] for r in few], abs=0.1)


def trained(spark, rows):
    docs = maxent.in_training(spark.createDataFrame(rows, "doc_id long, text string"))
    words = maxent.vocabulary(staged(maxent.token_counts(docs.where("NOT held_out")), "counts"))
    encoded = staged(maxent.encoded(docs, words), "encoded")
    return words, encoded, maxent.train(encoded.where("NOT held_out"), words)


def test_scores_equal_a_plain_softmax(spark, small):
    rows = [(d, t) for d, t, _, _ in documents(small)][:200]
    words, encoded, weights = trained(spark, rows)
    place = {w: i for i, w in enumerate(words.tokens)}
    texts = dict(rows)

    def ending(word):
        return int(maxent.endings(pa.array([word]))[0])

    def row(kind, rows, first, *parts):
        return first + int(maxent._hashed(kind, rows, *(np.array([p]) for p in parts))[0])

    def log_softmax(active, target):
        z = [sum(float(weights[r][c]) for r in active) for c in range(maxent.WIDTH)]
        return z[target] - math.log(sum(map(math.exp, z)))

    for r in encoded.limit(12).collect():
        total, before, second = 0.0, maxent.START, maxent.START
        for token in [*maxent.words_of(pa.array([texts[r.doc_id]]))[0].to_pylist()[:80], maxent.END]:
            i = place.get(token, maxent.HEAD)
            symbol = i if i < maxent.HEAD else maxent.HEAD + ending(token)
            of_class = [row(0, 1 << 11, 0, before), row(1, 1 << 11, 1 << 11, second), maxent._CLASS_BIAS]
            own = symbol // 64 if i < maxent.HEAD else maxent.HEAD_CLASSES + ending(token)
            total += log_softmax(of_class, own)
            if i < maxent.HEAD:
                of_word = [row(2, 1 << 13, 1 << 12, before, own), row(3, 1 << 13, 3 << 12, second, own), maxent._WORD_BIAS + own]
                total += log_softmax(of_word, symbol % 64)
            before, second = symbol, before
        symbols = np.frombuffer(r.symbols, "<u2")
        short = np.append(symbols[:-1][:80], symbols[-1:]).astype("<u2").tobytes()
        got = maxent.log_probabilities(weights, maxent.with_contexts([short])).sum()
        assert got == pytest.approx(total, rel=1e-4)


def test_all_continuations_add_up_to_one(spark, small):
    words, _, weights = trained(spark, [(d, t) for d, t, _, _ in documents(small)][:200])
    everything = np.arange(maxent.START)
    for before, second in ((maxent.START, maxent.START), (3, maxent.HEAD + 5), (maxent.HEAD + 1, 0)):
        t = maxent.Tokens(everything, np.full(len(everything), before), np.full(len(everything), second), np.zeros(1, np.int64))
        assert np.exp(maxent.log_probabilities(weights, t)).sum() == pytest.approx(1, abs=1e-4)
    # Of each ending: the words with their counts and one added, and one place for all that is not known.
    assert (words.tail_sizes() == words.ending_total + words.ending_distinct + 1).all()


def test_words_and_endings():
    texts = ["", None, " a\x0bB\u00a0c\x1cd ", "\u2003x\ty\r\nÉÀz\x85", "abcd xbcd d  bcd"]
    words, sizes = maxent.words_of(pa.array(texts, pa.string()))
    want = [(t or "").encode().lower().split() for t in texts]
    assert sizes.tolist() == list(map(len, want)) and [w.encode() for w in words.to_pylist()] == [w for ws in want for w in ws]
    by_word = dict(zip(words.to_pylist(), maxent.endings(words).tolist()))
    assert by_word["abcd"] == by_word["xbcd"] == by_word["bcd"] and all(0 <= e < maxent.ENDINGS for e in by_word.values())
    assert maxent.endings(words.slice(3)).tolist() == maxent.endings(words).tolist()[3:]


def test_broadcast_counts_are_the_largest(spark, monkeypatch):
    counts = staged(spark.createDataFrame([(f"w{i}", 1, 1 + (4000 - i) // 40) for i in range(4000)] + [("\n", 0, 3)], "token string, ending int, n long"), "counts")
    for known in (10, 500, 3000, 5000):
        monkeypatch.setattr(maxent, "KNOWN", known)
        words = maxent.vocabulary(counts)
        assert len(words.tokens) <= known + 1 and maxent.END in words.tokens
        if known >= 500:
            assert len(words.tokens) > 0.7 * min(known, 4000)
        if words.counts.min() < 3:
            assert words.counts.min() <= 3
        held = dict(zip(words.tokens, words.counts.tolist()))
        # All of a higher level than the last one are there.
        least = min(n for w, n in held.items() if w != maxent.END) if len(held) > 1 else 10**9
        assert all(f"w{i}" in held for i in range(4000) if 1 + (4000 - i) // 40 > 1.1 * least + 1)


def test_group_sums():
    rng = np.random.default_rng(1)
    group = np.concatenate((rng.integers(0, 40, 900), np.full(500, 77), rng.integers(1000, 1200, 300)))
    rng.shuffle(group)
    values = rng.normal(size=(len(group), 5)).astype(np.float32)
    rows, sizes, sums = maxent._group_sums(values, group)
    assert rows.tolist() == np.unique(group).tolist() and sizes.tolist() == np.unique(group, return_counts=True)[1].tolist()
    for g, s in zip(rows, sums):
        assert s == pytest.approx(values[group == g].sum(axis=0), abs=1e-4)


def test_updates_are_averaged_by_what_was_seen(spark, monkeypatch):
    monkeypatch.setattr(maxent, "FAN_IN", 2)
    rng = np.random.default_rng(2)
    seen = rng.integers(0, 5, (7, 3)).astype(np.float32)
    change = rng.normal(size=(7, 3, maxent.WIDTH)).astype(np.float16)
    rows = [(0, i, seen[i].tobytes(), change[i].tobytes()) for i in range(7)]
    frame = spark.createDataFrame([(c, t, bytearray(s), bytearray(x)) for c, t, s, x in rows], "chunk long, task long, seen binary, change binary")
    (got,) = maxent._combined(frame, 7).collect()
    want = (seen[:, :, None] * change).sum(axis=0) / np.maximum(seen.sum(axis=0), 1)[:, None]
    assert np.frombuffer(got.change, np.float16).reshape(3, -1) == pytest.approx(want, abs=0.01)
    assert np.frombuffer(got.seen, np.float32).tolist() == seen.sum(axis=0).tolist()


def test_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd_docs(spark).collect()]
    got = maxent.score(odd_docs(spark)).collect()
    same(got, brute(rows))
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    long = "x" * 1000
    rows = [(1, f"{long} {long} a"), (2, f"{long} b"), (3, None), (None, long), (5, f"{long} {'y' * 500}")]
    same(maxent.score(spark.createDataFrame(rows, "doc_id long, text string")).collect(), brute(rows))


def test_no_rows_and_nothing_to_learn_from(spark):
    assert maxent.score(no_docs(spark)).collect() == []
    rows = [(None, "a b"), (None, "")]
    got = maxent.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    same(got, brute(rows))
    assert all(math.isfinite(r.score) for r in got)

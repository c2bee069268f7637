import random

import numpy as np
import pytest
from corpora import documents, no_docs, odd_docs

from wicklake.llm import decontaminate
from wicklake.llm.common import table
from wicklake.llm.queries import LLM_QUERIES


def distance_in(passage, text):
    """Fewest edits between a whole passage and any stretch of a text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(passage, 1):
        above, row = row, [i]
        for j, x in enumerate(text, 1):
            row.append(min(above[j - 1] + (c != x), above[j] + 1, row[-1] + 1))
    return min(row)


def test_whole_table_finds_every_exact_passage(spark, small):
    import duckdb

    bench = duckdb.sql(f"SELECT item_id, text FROM read_parquet('{small}/benchmark.parquet')").fetchall()
    got = {(r.doc_id, r.item_id): r for r in LLM_QUERIES["op2_decontaminate"](spark, small).collect()}
    exact = {(d, i) for d, t, _, _ in documents(small) for i, b in bench if b.lower() in (t or "").lower()}
    assert exact and exact <= set(got)
    texts, items = {d: t for d, t, _, _ in documents(small)}, dict(bench)
    for (d, i), r in got.items():
        stretch = texts[d][r.start:r.end]
        assert distance_in(decontaminate.folded(items[i]), decontaminate.folded(stretch)) == r.edits <= len(items[i]) // 10
    kept = {r.doc_id for r in decontaminate.clean(table(spark, small, "documents"), table(spark, small, "benchmark")).select("doc_id").collect()}
    assert kept == set(texts) - {d for d, _ in got}


def edited(rng, passage, edits):
    for _ in range(edits):
        at = rng.randrange(len(passage))
        passage = rng.choice([passage[:at] + passage[at + 1:], passage[:at] + rng.choice("abcd ") + passage[at:],
                              passage[:at] + rng.choice("abcd ") + passage[at + 1:]])
    return passage


def test_every_passage_within_its_budget_is_found():
    rng = random.Random(4)
    letters = "abcdefghijklmnop  "
    bench = ["".join(rng.choices(letters, k=rng.randint(20, 260))).strip() for _ in range(30)]
    texts, planted = [], {}
    for t in range(150):
        noise = ["".join(rng.choices(letters, k=rng.randint(0, 300))) for _ in range(2)]
        i = rng.randrange(len(bench))
        texts.append(noise[0] + edited(rng, bench[i], rng.randint(0, len(bench[i]) // 6)) + noise[1])
        planted[t] = i
    passages = decontaminate.Passages.of(bench)
    got = {(t, i): edits for t, i, _, _, edits in decontaminate.find(passages, texts)}
    for t, text in enumerate(texts):
        for i in {planted[t], (planted[t] + 1) % len(bench)}:
            least = distance_in(bench[i], text)
            assert got.get((t, i)) == (least if least <= passages.budgets[i] else None)


def test_alignment_equals_full_table():
    rng = random.Random(8)
    for _ in range(200):
        passage = "".join(rng.choices("abc", k=rng.randint(1, 12)))
        text = "".join(rng.choices("abc", k=rng.randint(0, 15)))
        first, width = -len(passage), len(passage) + len(text) + 1
        cost, start, end = decontaminate.align(np.array([ord(c) for c in passage]), np.array([ord(c) for c in text], np.int64), first, width)
        assert cost == distance_in(passage, text)
        assert 0 <= start <= end <= len(text) and distance_in(passage, text[start:end]) == cost


@pytest.mark.parametrize("gram", [1, 2, 3, 5, 8, 12, 13])
def test_hash_of_q_grams_depends_on_them_alone(gram):
    text = decontaminate._characters("abcabcabcdefabcabcabcdefxyz" * 2)
    hashes = decontaminate._gram_hashes(text, gram)
    assert len(hashes) == len(text) - gram + 1
    words = [text[i:i + gram].tobytes() for i in range(len(hashes))]
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))


def test_blocks_give_the_same_rows(spark, small):
    docs, bench = table(spark, small, "documents"), table(spark, small, "benchmark")
    one = decontaminate.contaminated(docs, bench).collect()
    assert sorted(one) == sorted(decontaminate.contaminated(docs, bench, block_chars=2500).collect())


def test_odd_rows(spark):
    rows = [(1, "one two three four five six seven eight nine ten"), (11, "One two THREE four\nfive six seven eight nine ten"), (2, None),
            (3, ""), (4, "one"), (5, "  \n"), (None, "no id at all")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.edits) for r in decontaminate.contaminated(odd_docs(spark), bench).collect()}
    assert got == {(1, 1, 0), (1, 11, 0), (6, 1, 0), (6, 11, 0), (9, 4, 0), (None, None, 0)}
    kept = decontaminate.clean(odd_docs(spark), bench)
    assert kept.columns == odd_docs(spark).columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 7, 8, 10]


def test_no_rows(spark, small):
    docs, bench = table(spark, small, "documents"), table(spark, small, "benchmark")
    assert decontaminate.contaminated(no_docs(spark), bench).collect() == []
    assert decontaminate.contaminated(docs, bench.limit(0)).collect() == []
    assert decontaminate.clean(docs, bench.limit(0)).count() == docs.count()


def every_pair(passages, texts):
    """Fewest edits of each passage in each text, where they are within its budget and the lemma holds."""
    return {(t, i): n for t, text in enumerate(texts) for i, p in enumerate(passages.texts)
            if (n := distance_in(p, text)) <= passages.budgets[i]}


@pytest.mark.parametrize("hits", [1, 200, decontaminate._HITS])
def test_rulers_and_windows_equal_full_alignment(monkeypatch, hits):
    monkeypatch.setattr(decontaminate, "_HITS", hits)
    rng = random.Random(8)
    for _ in range(12):
        texts = ["=" * 40, "question " + "-" * 30 + " answer", "".join(rng.choice("abcd ") for _ in range(50)).strip() or "abcdabcd"]
        passages = decontaminate.Passages.of(texts)
        docs = []
        for _ in range(4):
            parts = [rng.choice(["=" * rng.randint(0, 120), "-" * rng.randint(0, 80), "".join(edited(rng, rng.choice(texts), rng.randint(0, 4))),
                                 "".join(rng.choice("abcd ") for _ in range(60))]) for _ in range(rng.randint(0, 3))]
            docs.append(" ".join(parts))
        got = decontaminate.find(passages, docs)
        assert {(t, i): n for t, i, _, _, n in got} == every_pair(passages, docs)
        for t, i, start, end, n in got:
            assert distance_in(passages.texts[i], docs[t][start:end]) == n


def test_long_rulers_need_little_memory():
    import tracemalloc

    for passage, text in (("-" * 300, "-" * 200_000), ("Question: what? " + "=" * 200 + " answer", "x " + "=" * 60_000)):
        passages = decontaminate.Passages.of([passage])
        tracemalloc.start()
        found = decontaminate.find(passages, [text])
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 400 << 20
        assert [f[4] for f in found] == [distance_in(passage, text[:1500])][:1 if distance_in(passage, text[:1500]) <= passages.budgets[0] else 0]

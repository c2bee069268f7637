import random
import zlib

import duckdb
from corpora import no_docs, odd_docs, odd_rows

from wicklake.llm import toxicity
from wicklake.llm.common import table
from wicklake.llm.queries import LLM_QUERIES


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        above, row = row, [i]
        for j, d in enumerate(b, 1):
            row.append(min(above[j - 1] + (c != d), above[j] + 1, row[-1] + 1))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(3)
    words = {"".join(rng.choices("abc", k=rng.randint(3, 8))) for _ in range(25)}
    lexicon = toxicity.Lexicon(words)
    tried = words | {"".join(rng.choices("abcd", k=rng.randint(0, 9))) for _ in range(4000)}
    for word in tried:
        near = any(len(w) >= 5 and edits(w, word) <= 1 and (word[:1] == w[0] or word in words) for w in words)
        got = lexicon.match(word)
        assert (got == 3) == (word in words)
        if got == 1:
            assert any(len(w) >= 5 and edits(w, word) <= 1 for w in words)
        if near and word not in words:
            assert got == 1, word


def test_stems():
    lexicon = toxicity.Lexicon(["idiot"], ["lowei", "vequ"])
    assert [lexicon.match(w) for w in ("loweischaft", "lowei", "vequeur", "veq", "idiot", "idiott", "idoit", "lowi", "loweeischaft", "house")] \
        == [2, 2, 2, 0, 3, 1, 0, 1, 1, 0]


def test_quotation():
    matched = {"idiot": 3, '"idiot"': 3, "idiot.": 3}
    assert [q for *_, q in toxicity.hits('he is an idiot today'.split(), matched)] == [False]
    assert [q for *_, q in toxicity.hits('she said he is an idiot'.split(), matched)] == [True]
    assert [q for *_, q in toxicity.hits('the note has "idiot" in it'.split(), matched)] == [True]
    assert [q for *_, q in toxicity.hits('a "nice day" idiot. yes'.split(), matched)] == [False]


def test_held_out_accuracy(spark, small):
    got = {r.doc_id: r for r in LLM_QUERIES["op6_toxicity"](spark, small).collect()}
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM read_parquet('{small}/labels.parquet')").fetchall())
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    test = [d for d in labels if d in got and got[d].held_out]
    right = sum(got[d].predicted == labels[d] for d in test)
    assert len(test) > 40 and right >= 0.95 * len(test)
    toxic = [got[d].score for d in test if labels[d]]
    clean = [got[d].score for d in test if not labels[d]]
    # The small table has two dozen toxic documents to learn from; some terms of the held-out ones occur nowhere else.
    assert sum((a > b) + (a == b) / 2 for a in toxic for b in clean) >= 0.8 * len(toxic) * len(clean)


def test_odd_rows_and_nothing_learned(spark):
    empty = toxicity.learn(no_docs(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert empty.words == [] and empty.stems == []
    got = toxicity.score(odd_docs(spark), empty).collect()
    assert len(got) == len(odd_rows()) and {r.score for r in got} == {0.5}
    labels = spark.createDataFrame([(1, 0, None), (None, 1, 1), (5, 0, 1), (5, 0, 0), (77, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(odd_docs(spark), labels)
    assert len(toxicity.score(odd_docs(spark), model).collect()) == len(odd_rows())
    assert toxicity.score(no_docs(spark), model).collect() == []


def test_word_in_a_long_text(spark):
    model = toxicity.Model(["worthless"], [], toxicity.np.array([2.0, 2.0, 2.0, 0.0, 0.0, -1.0]))
    rows = [(1, "the of " * 200_000 + "wortless"), (2, "the of"), (2, "the of"), (3, None)]
    got = sorted((r.doc_id, r.predicted, r.n_hits) for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect())
    assert got == [(1, 1, 1), (2, 0, 0), (2, 0, 0), (3, 0, 0)]

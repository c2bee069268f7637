import zlib

import numpy as np
from corpora import documents, no_docs, odd_docs, odd_rows

from wicklake.llm import language
from wicklake.llm.common import table
from wicklake.llm.queries import LLM_QUERIES


def test_held_out_accuracy(spark, small):
    got = {r.doc_id: r for r in LLM_QUERIES["op10_language"](spark, small).collect()}
    truth = {d: lang for d, _, lang, _ in documents(small)}
    assert set(got) == set(truth)
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    test = [d for d in truth if got[d].held_out and truth[d]]
    assert len(test) > 100
    assert sum(got[d].lang_pred == truth[d] for d in test) >= 0.98 * len(test)


def test_filters_contain_their_grams_and_count_wrong_answers():
    rng = np.random.default_rng(1)
    for n_langs in (3, 40, 70):
        grams = {f"l{i}": rng.integers(0, 2**32, 200 + i) for i in range(n_langs)}
        model = language.LanguageFilter.build(grams, slots_log2=14)
        buffer = grams["l1"].astype("<u4").tobytes()
        n, hits = model.counts(buffer, np.arange(0, len(buffer) + 1, 4))
        assert (n == 1).all() and hits[:, 1].all()
        other = hits[:, 2].mean()
        assert other < 0.02 and abs(other - model.wrong[2]) < 0.02


def test_counts_do_not_cross_texts():
    model = language.LanguageFilter.build({"x": np.array([int.from_bytes(b"bcde", "little")])})
    n, hits = model.counts(b"abcdexbcd" + b"e", np.array([0, 6, 9, 10]))
    assert n.tolist() == [3, 0, 0] and hits[:, 0].tolist() == [1, 0, 0]


def test_odd_rows(spark, small):
    model = language.learn(table(spark, small, "documents"))
    got = language.identify(odd_docs(spark), model).collect()
    assert len(got) == len(odd_rows())
    by_id = {r.doc_id: r for r in got}
    assert [by_id[d].lang_pred for d in (2, 3, 4, 7)] == ["und"] * 4
    assert by_id[5].lang_pred == "de"
    assert by_id[None].lang_pred in model.langs
    assert all(by_id[d].score == 0 for d in (2, 3, 4, 7))


def test_nothing_learned(spark):
    model = language.learn(no_docs(spark))
    assert {r.lang_pred for r in language.identify(odd_docs(spark), model).collect()} == {"und"}
    assert language.identify(no_docs(spark), model).collect() == []


def test_letters():
    assert language.has_letter("12 é") and language.has_letter("½ a")
    assert not any(map(language.has_letter, (None, "", "½²_ 12 !")))

import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
from corpora import documents, no_docs, odd_docs
from test_simhash import brute_components, brute_print
from tokenizers import Tokenizer

from wicklake.llm import language, mixing
from wicklake.llm.common import staged, table
from wicklake.llm.queries import tokenizer_path


def test_stages_and_whole_run_against_brute_force(spark, small):
    docs = table(spark, small, "documents")
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = staged(stage(spark, docs, small), "stage")
        kept.append(docs)
        if i < 4:
            assert docs.columns == table(spark, small, "documents").columns
    ids = [Counter(r.doc_id for r in k.select("doc_id").collect()) for k in kept]
    texts = {d: t for d, t, _, _ in documents(small)}

    # Language ID: only texts without letters or of unknown language go.
    model = language.learn(table(spark, small, "documents"))
    names, _, cover = model.decide(list(texts.values()))
    first = [d for d, lang, c in zip(texts, names, cover) if lang != "und" and c >= corpus_pipeline.LEAST_COVERAGE]
    assert ids[0] == Counter(first) and len(first) >= 0.97 * len(texts)

    prints = {d: brute_print(texts[d]) for d in first}
    linked = [(a, b) for i, a in enumerate(first) for b in first[i + 1:] if bin(prints[a] ^ prints[b]).count("1") <= 2]
    second = sorted(set(brute_components(first, linked).values()))
    assert ids[1] == Counter(second) and len(second) < len(first)

    items = [t.lower() for (t,) in duckdb.sql(f"SELECT text FROM read_parquet('{small}/benchmark.parquet')").fetchall()]
    third = [d for d in second if not any(i in texts[d].lower() for i in items)]
    assert ids[2] == Counter(third) and len(third) < len(second)

    taken = {r.doc_id: r.taken // r.size for r in mixing.mixture(kept[2]).collect() if r.size}
    assert ids[3] == Counter({d: n for d, n in taken.items() if n})

    tokenizer, start, want = Tokenizer.from_file(tokenizer_path()), 0, []
    for d in sorted(ids[3].elements()):
        own = [*tokenizer.encode(texts[d] or "", add_special_tokens=False).ids, 0]
        want.append((d, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    assert sorted(tuple(r) for r in kept[4].collect()) == want
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, small).collect()) == want


def test_odd_rows_and_no_rows(spark, small):
    for docs in (odd_docs(spark), no_docs(spark)):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = staged(stage(spark, docs, small), "stage")
            assert i == 4 or out.columns == odd_docs(spark).columns
            docs = out
        docs.collect()
    kept = corpus_pipeline.STAGES[0][1](spark, odd_docs(spark), small).collect()
    assert not {r.doc_id for r in kept} & {2, 3, 4, 7}

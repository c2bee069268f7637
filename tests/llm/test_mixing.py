from collections import Counter, defaultdict

from corpora import no_docs, odd_docs, odd_rows
from wicklake.llm import mixing
from wicklake.llm.common import table


def brute_targets(words):
    """Shares by weight, stopped at three times the size, what is left shared again."""
    order = sorted(words, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = sum(words.values()), set()
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(3 * words[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * words[s]}
        if not over:
            return {s: 3.0 * words[s] if s in full else share[s] for s in order}
        full |= over


def test_targets_and_copies(spark, small):
    rows = mixing.mixture(table(spark, small, "documents")).join(
        table(spark, small, "documents").select("doc_id", "source"), "doc_id").collect()
    words, taken, largest = Counter(), Counter(), defaultdict(int)
    for r in rows:
        words[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken in {k * r.size for k in range(4)}
    want = brute_targets(words)
    for r in rows:
        assert r.source_size == words[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
    for s in words:
        assert abs(taken[s] - want[s]) <= 3 * largest[s]


def test_reruns_agree(spark, small):
    docs = table(spark, small, "documents")
    assert sorted(mixing.mixture(docs).collect()) == sorted(mixing.mixture(docs.repartition(5)).collect())


def test_mix_repeats_rows(spark, small):
    docs = table(spark, small, "documents")
    plan = {r.doc_id: r.taken // r.size for r in mixing.mixture(docs).collect() if r.size}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter(r.doc_id for r in mixed.collect())
    assert {d: n for d, n in plan.items() if n} == {d: n for d, n in got.items() if d in plan}


def test_odd_rows(spark):
    rows = mixing.mixture(odd_docs(spark)).collect()
    assert len(rows) == len(odd_rows())
    sizes = {r.doc_id: r.size for r in rows}
    assert (sizes[2], sizes[3], sizes[4], sizes[1], sizes[None]) == (0, 0, 0, 10, 4)
    assert all(r.taken <= 3 * r.size for r in rows)
    assert mixing.mix(odd_docs(spark)).columns == odd_docs(spark).columns
    assert mixing.mix(odd_docs(spark)).count() >= 0


def test_empty_and_wordless(spark):
    assert mixing.mixture(no_docs(spark)).collect() == []
    assert mixing.mix(no_docs(spark)).collect() == []
    wordless = odd_docs(spark).filter("doc_id IN (2, 3, 4)")
    assert {(r.size, r.target, r.taken) for r in mixing.mixture(wordless).collect()} == {(0, 0.0, 0)}


def test_no_python_on_the_main_path(spark, small):
    plan = mixing.mix(table(spark, small, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    carried = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("source_key" in line and "stratum" in line for line in carried) <= 2

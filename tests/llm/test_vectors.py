import duckdb
import numpy as np
import pytest
from test_simhash import brute_components

from wicklake.llm import vectors
from wicklake.llm.common import table


def brute(rows, similarity=0.95):
    """Links and components of (vec_id, vector) rows by comparing everything."""
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, unit = [i for i, _ in good], np.array([v / np.linalg.norm(v) for _, v in good])
    close = unit @ unit.T >= similarity
    np.fill_diagonal(close, False)
    links = {i: 0 for i, _ in rows} | dict(zip(ids, close.sum(1).tolist()))
    roots = brute_components([i for i, _ in rows], [(ids[a], ids[b]) for a, b in zip(*np.nonzero(close))])
    return links, roots


def embeddings(path):
    return duckdb.sql(f"SELECT vec_id, embedding FROM read_parquet('{path}') ORDER BY vec_id").fetchall()


def test_whole_table_against_brute_force(spark, small):
    rows = embeddings(f"{small}/embeddings.parquet")
    links, roots = brute(rows)
    got = {r.vec_id: r for r in vectors.groups(table(spark, small, "embeddings")).collect()}
    assert set(got) == set(links)
    assert all(got[i].n_links <= links[i] for i in links)
    assert sum(got[i].n_links for i in links) >= 0.9 * sum(links.values())
    assert all(got[i].component_id >= roots[i] and got[i].kept == (got[i].component_id == i) for i in links)


def planted(seed, n, dims=32):
    """Vectors at every similarity around the threshold, copies, and one large cluster."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dims))
    rows = list(base)
    for v in base[: n // 2]:
        other = rng.standard_normal(dims)
        other -= v * (other @ v) / (v @ v)
        cosine = rng.uniform(0.9, 1.0)
        rows.append(cosine * v / np.linalg.norm(v) + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other))
    rows += [base[0]] * 40 + list(base[1] + 0.05 * rng.standard_normal((120, dims)))
    return [(int(i), [float(x) for x in v]) for i, v in zip(rng.permutation(len(rows)), rows)]


@pytest.mark.parametrize("block_rows", [2048, 60])
def test_recall_at_every_similarity(spark, block_rows):
    rows = planted(1, 1200)
    links, roots = brute(rows)
    got = {r.vec_id: r for r in vectors.groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>"),
                                               cell_rows=200, block_rows=block_rows).collect()}
    assert all(got[i].n_links <= links[i] for i in links)
    assert sum(got[i].n_links for i in links) >= 0.95 * sum(links.values())
    assert sum(got[i].component_id == roots[i] for i in links) >= 0.95 * len(links)


def test_collision_count_is_calibrated():
    rng, cosine = np.random.default_rng(3), 0.95
    base = rng.standard_normal((1500, 48))
    other = rng.standard_normal((1500, 48))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other -= base * (other * base).sum(1, keepdims=True)
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    both = np.concatenate([base, (cosine + 1e-9) * base + np.sqrt(1 - (cosine + 1e-9)**2) * other])
    both /= np.linalg.norm(both, axis=1, keepdims=True)
    left, right = vectors.colliding_pairs(both, len(both))
    assert len(set(zip(left.tolist(), right.tolist())) & {(i, i + 1500) for i in range(1500)}) >= 0.97 * 1500


def test_odd_rows(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [None, 1.0]), (8, [float("inf"), 1.0]),
            (9, [0.0, 1.0]), (9, [0.0, 1.0]), (10, [1.0, 0.0, 0.0]), (None, [0.0, 1.0]), (None, None), (11, [1e300, 1e299]), (12, [1e-300, 0.0]), (13, [-0.0, 3.0])]
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows],
                                  "vec_id long, embedding array<double>, key int, node int, rows int, component_id int, v int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.groups(frame).collect()), key=str)
    single = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 10)]
    assert got == sorted([(1, 3, 1, True), (2, 3, 1, False), (11, 3, 1, False), (12, 3, 1, False), *single, (None, 0, None, True),
                          (9, 3, 9, True), (9, 3, 9, True), (13, 3, 9, False), (None, 3, 9, False)], key=str)


def test_no_rows(spark):
    assert vectors.groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []

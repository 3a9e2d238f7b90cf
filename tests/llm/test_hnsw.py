import numpy as np
import pytest
from pyspark.sql import functions as F

from kinora.llm.hnsw import Graph, nearest

SCHEMA = "vec_id long, embedding array<float>, score int"


def run(spark, rows, k=5, step=4, **options):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in rows], SCHEMA)
    out = {}
    for r in nearest(df, F.col("vec_id") % step == 0, k, **options).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def plain(rows, k=5, step=4):
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 8}
    out = {}
    for i, q in good.items():
        if i % step == 0:
            best = sorted((-float(np.dot(x, q)), j) for j, x in good.items() if j != i)[:k]
            out[i] = [(n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [x[:2] for x in got[q]] == [x[:2] for x in want[q]]
        assert np.allclose([x[2] for x in got[q]], [x[2] for x in want[q]], rtol=1e-12)


def test_odd_rows_are_exact(spark):
    """Few vectors: the search reaches all, so the result must be the brute force's."""
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.1, 5)).tolist()) for i in range(90)]
    common = rng.normal(size=8).tolist()
    rows += [(200 + i, common) for i in range(40)] + [(3, rows[3][1])]
    rows += [(400, None), (404, []), (408, [0.0] * 8), (412, [1.0, None] + [0.0] * 6), (416, [float("nan")] + [1.0] * 7),
             (420, [float("inf")] + [1.0] * 7), (424, [1.0, 2.0]), (None, common)]
    same(run(spark, rows), plain(rows))


def test_fewer_candidates_than_k_and_empty(spark):
    rows = [(i, [float(i + 1)] + [1.0] * 7) for i in range(3)]
    same(run(spark, rows, k=5, step=1), plain(rows, 5, 1))
    assert run(spark, []) == {} and run(spark, [(4, None)]) == {}


def test_recall(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 8))
    rows = [(i, (centres[i % 30] + 0.5 * rng.normal(size=8)).tolist()) for i in range(3000)]
    got, want = run(spark, rows, 20, 50), plain(rows, 20, 50)
    hits = sum(len({x[1] for x in got[q]} & {x[1] for x in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) > 0.95


def test_graph_is_deterministic():
    x = np.random.default_rng(3).normal(size=(400, 6)).astype(np.float32)
    assert all((a == b).all() for a, b in zip(Graph(x).near, Graph(x).near, strict=True))


@pytest.mark.parametrize(("scale", "longer"), [(1.0, 1e4), (1.0, 3e8), (1e-25, 300.0), (1e20, 1.0), (1e145, 1.0), (1e-140, 1e4)])
def test_recall_on_uneven_and_extreme_norms(spark, scale, longer):
    """One vector much longer than the others, at scales whose squares leave double precision."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1200, 8))
    x *= scale / np.linalg.norm(x, axis=1)[:, None]
    x[17] *= longer
    x[18:40] *= 0.01
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, score int")
    got = {}
    for r in nearest(df, F.col("vec_id") % 50 == 0, 10).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    unit = x / scale
    hits = 0
    for q in range(0, 1200, 50):
        score = unit @ unit[q]
        score[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-score)[:10].tolist()))
    assert len(got) == 24 and hits >= 0.9 * 240


def test_search_ends_on_distances_that_are_no_numbers():
    x = np.random.default_rng(6).normal(size=(60, 4)).astype(np.float32)
    x[7] = np.nan
    assert len(Graph(x).search(x[0], 5, 20))

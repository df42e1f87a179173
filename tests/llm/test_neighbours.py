import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.llm import neighbours as nb

SCHEMA = "vec_id long, embedding array<float>, label int, u int, id string, q int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", 2) for i, v in rows], SCHEMA)


def plain(rows, every, k=10):
    ok = [(i, np.float32(v).astype(float)) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    out = []
    for a, (i, x) in enumerate(ok):
        if i % every:
            continue
        near = sorted((float(np.sqrt(((x - y) ** 2).sum())), j) for b, (j, y) in enumerate(ok) if b != a and len(x) == len(y))
        out += [(i, r + 1, j, d) for r, (d, j) in enumerate(near[:k])]
    return sorted(out)


def found(spark, rows, every, **more):
    return sorted(tuple(r) for r in nb.nearest(table(spark, rows), F.col("vec_id") % every == 0, **more).collect())


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12, atol=0)


def test_odd_rows_and_ties_against_all_pairs(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=12).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(30)] + [(0, rows[0][1]), (7, rows[3][1])]  # copies, and keys used twice
    rows += [(200, None), (201, []), (210, [0.0] * 12), (220, [None] * 12), (230, [float("nan")] * 12), (240, [float("inf")] * 12), (None, rows[5][1]), (250, [1.0, 2.0]), (255, [2.0, 1.0])]
    same(found(spark, rows, 5), plain(rows, 5))


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 3.0]), (2, [-1.0, 1.0])]
    same(found(spark, rows, 1), plain(rows, 1))
    assert found(spark, rows[:1], 1) == [] and found(spark, [], 1) == []
    assert found(spark, rows, 7) == plain(rows, 7)
    assert nb.nearest(table(spark, []), F.col("vec_id") == 0).columns == ["query_id", "rank", "vec_id", "score"]


def test_many_rows_in_blocks_and_of_any_length(spark):
    r = np.random.default_rng(2)
    centres = r.normal(size=(40, 24))
    x = centres[r.integers(0, 40, 1500)] + 0.25 * r.normal(size=(1500, 24))
    x *= r.uniform(0.5, 2.0, (1500, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(np.float32(x))]
    got, want = found(spark, rows, 20, how=nb.Tables(block=64)), plain(rows, 20)
    hit = {g[::2] for g in got} & {w[::2] for w in want}
    assert len(got) == len(want) and len(hit) >= 0.97 * len(want)


@pytest.mark.parametrize("joined", [1, 2])
def test_recall_where_tables_are_asked(spark, joined):
    """Close neighbours are met in few buckets; none of these queries reads all rows."""
    r = np.random.default_rng(3)
    base = r.normal(size=(60, 32))
    x = np.repeat(base, 20, 0) + 0.1 * r.normal(size=(1200, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(np.float32(x))]
    how = nb.Tables(joined=joined)
    deep = how.depth(1200, 32)
    assert nb.needed(how, 32, deep)[np.searchsorted(-nb.GRID, -0.9)] <= how.widest(32, deep) // 4
    got, want = found(spark, rows, 10, how=how), plain(rows, 10)
    assert len({g[::2] for g in got} & {w[::2] for w in want}) >= 0.95 * len(want)


def test_chance_of_meeting_a_neighbour():
    how, r = nb.Tables(), np.random.default_rng(4)
    a = r.normal(size=(800, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = r.normal(size=(800, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    for c in (0.9, 0.7, 0.5):
        most = int(nb.needed(how, 64, 1)[np.searchsorted(-nb.GRID, -c)])
        own = nb.own_buckets(c * a + (1 - c * c) ** 0.5 * b, how, 1)
        met = np.zeros(800, bool)
        for t in range(how.tables):
            met |= (nb.probes(a, how, 1, most, t) == own[:, t : t + 1]).any(1)
        assert met.mean() > 0.96


def test_least_cosine_bounds_every_vector_within_reach():
    r = np.random.default_rng(5)
    q, y = r.normal(size=(5000, 3)), r.normal(size=(5000, 3)) * r.uniform(0.2, 3, (5000, 1))
    n, m = np.linalg.norm(q, axis=1), np.linalg.norm(y, axis=1)
    away = np.linalg.norm(q - y, axis=1)
    cosine = (q * y).sum(1) / n / m
    assert (nb.least_cosine(n, m * 0.7, m * 1.4, away) <= cosine + 1e-9).all()
    assert np.allclose(nb.least_cosine(n, m, m, away), cosine)

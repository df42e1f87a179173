import numpy as np
import pytest
from plain_links import roots

from spanforge.llm import vectors


def plain(rows, least=0.93):
    """Links and components by all pairs."""
    ok = {}
    for k, (i, v, label) in enumerate(rows):
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.float32(v).astype(float)
            ok[k] = (label, x / np.linalg.norm(x))
    pairs = [(a, b) for a in ok for b in ok if a < b and ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1]) and ok[a][1] @ ok[b][1] >= least]
    return pairs


def clustered(r, clusters, each, d=32, spread=0.03):
    out = []
    for _ in range(clusters):
        c = r.normal(size=d)
        out += [(c / np.linalg.norm(c) + spread * r.normal(size=d)).astype(np.float32).tolist() for _ in range(each)]
    return out


@pytest.mark.parametrize("block", [8, 2048])
def test_links_against_all_pairs(spark, block):
    r = np.random.default_rng(4)
    vecs = clustered(r, 12, 6) + clustered(r, 1, 40) + r.normal(size=(60, 32)).astype(np.float32).tolist()
    rows = [(100 + i, v, i % 2) for i, v in enumerate(vecs)]
    rows += [(5, vecs[0], 0), (6, vecs[0], 0), (6, vecs[0], 1), (7, None, 0), (8, [0.0] * 32, 0), (9, vecs[0], None), (10, [None, *vecs[0][1:]], 0), (11, [float("nan"), *vecs[0][1:]], 0), (12, [float("inf"), *vecs[0][1:]], 0), (13, [], 0), (14, vecs[0][:16], 0), (15, vecs[0][:16], 0)]
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "vec_id long, embedding array<float>, label int, u int, n int")
    got = vectors.near_vectors(df, block=block).collect()
    pairs = plain(rows)
    root = roots(range(len(rows)), pairs)
    least = {}
    for k, x in enumerate(rows):
        least[root[k]] = min(least.get(root[k], x[0]), x[0])
    links = [0] * len(rows)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    want = sorted((x[0], links[k], least[root[k]], x[0] == least[root[k]]) for k, x in enumerate(rows))
    assert sorted(tuple(x) for x in got) == want


def test_empty_and_null_keys(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vectors.near_vectors(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [0.5], 1), (5, [0.25], 1)], schema)
    got = sorted(((x.vec_id or 0), x.n_links, x.component_id) for x in vectors.near_vectors(df).collect())
    assert got == [(0, 1, 3), (3, 1, 3), (4, 1, 4), (5, 1, 4)]


def test_recall_at_the_threshold():
    r = np.random.default_rng(2)
    a = vectors.unit(r.normal(size=(1500, 64)))
    b = r.normal(size=(1500, 64))
    b = vectors.unit(b - (a * b).sum(1, keepdims=True) * a)
    how = vectors.Hashing()
    x, y = (vectors.bucket_codes(v, how) for v in (a, 0.93 * a + (1 - 0.93**2) ** 0.5 * b))
    assert ((x[:, :, :1] == y) | (y[:, :, :1] == x)).any((1, 2)).mean() > 0.99


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(vectors.hadamard(vectors.hadamard(x)), x)
    assert np.allclose((vectors.hadamard(x) ** 2).sum(1), (x**2).sum(1))


@pytest.mark.parametrize("kind, labels", [("double", [1.2, 1.9, 1.2, float("nan"), float("nan")]), ("string", ["a", "b", "a", "", ""])])
def test_labels_of_any_type(spark, kind, labels):
    df = spark.createDataFrame([(i, [1.0, 2.0], x) for i, x in enumerate(labels)], f"vec_id long, embedding array<float>, label {kind}")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_vectors(df).collect())
    assert got == [(0, 1, 0), (1, 0, 1), (2, 1, 0), (3, 1, 3), (4, 1, 3)]

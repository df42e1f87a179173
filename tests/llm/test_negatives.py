import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.llm import negatives as ng

SCHEMA = "vec_id long, embedding array<double>, label string, q int, u int, tile int"
SMALL = ng.Tree(leaf=4, fan=3, tile=16, sample=200)


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, 3) for i, v, label in rows], SCHEMA)


def plain(rows, every):
    ok = [(i, [int(np.floor(256 * c)) for c in v], label) for i, v, label in rows if i is not None and v and label is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for a, (i, x, label) in enumerate(ok):
        if i % every:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y, strict=True)), j, other == label) for b, (j, y, other) in enumerate(ok) if b != a and len(x) == len(y)]
        for minus, j, _ in sorted(s for s in scored if s[2])[:5]:
            fit = sorted(s for s in scored if not s[2] and -50 * minus <= -100 * s[0] <= -95 * minus)[:3]
            out += [(i, j, r + 1, n, -minus, -m) for r, (m, n, _) in enumerate(fit)]
    return sorted(out)


def found(spark, rows, every, how=SMALL):
    return sorted(tuple(r) for r in ng.hard_negatives(table(spark, rows), F.col("vec_id") % every == 0, how=how).collect())


@pytest.mark.parametrize("how", [SMALL, ng.Tree()])
def test_against_all_pairs(spark, how):
    r = np.random.default_rng(1)
    centres = r.normal(size=(12, 8))
    rows = [(i, (centres[i % 12] + 0.7 * r.normal(size=8)).tolist(), f"l{i % 3}") for i in range(300)]
    got = found(spark, rows, 10, how)
    assert got == plain(rows, 10) and len(got) > 100


def test_ties_copies_and_odd_rows(spark):
    r = np.random.default_rng(2)
    few = r.integers(-2, 3, size=(6, 4)) / 2
    rows = [(i, few[i % 6].tolist(), "ab"[i % 2]) for i in range(160)]
    rows += [(0, few[0].tolist(), "a"), (5, few[1].tolist(), "b")]  # keys used twice
    rows += [(500, None, "a"), (510, [], "a"), (520, few[0].tolist(), None), (None, few[0].tolist(), "b"), (530, [None, 1.0, 1.0, 1.0], "a"), (540, [float("nan")] * 4, "a"), (550, [float("inf")] * 4, "b"), (560, [0.0] * 4, "a"), (570, [1.0, 2.0], "a"), (571, [1.0, 2.0], "a"), (572, [1.0, 1.0], "b")]
    got = found(spark, rows, 10)
    assert sorted(set(got)) == sorted(set(plain(rows, 10))) and len(got) == len(plain(rows, 10))


def test_large_components_stay_exact(spark):
    r = np.random.default_rng(3)
    rows = [(i, (r.normal(size=4) * 4e5).tolist(), "ab"[i % 2]) for i in range(80)]
    assert found(spark, rows, 4) == plain(rows, 4)
    # beyond a long: takes no part and stops nothing
    assert found(spark, [*rows, (80, [1e300] * 4, "a")], 4) == plain(rows, 4)


def test_small_tables(spark):
    assert found(spark, [], 1) == []
    rows = [(0, [1.0, 1.0], "a"), (1, [1.0, 0.5], "a"), (2, [0.5, 0.5], "b"), (3, [-1.0, 0.0], "b")]
    for n in range(1, 5):
        assert found(spark, rows[:n], 1) == plain(rows[:n], 1)


def test_packed_boxes_hold_their_rows_and_bound_products():
    r = np.random.default_rng(4)
    x = np.floor(r.normal(size=(700, 5)) * 50)
    root, order = ng.pack(x, SMALL)
    assert sorted(order) == list(range(700))
    x = x[order]
    seen = []

    def walk(node):
        for low, high, child in zip(node.low, node.high, node.children, strict=True):
            if isinstance(child, ng.Node):
                assert len(child.children) <= SMALL.fan and (child.low >= low).all() and (child.high <= high).all()
                walk(child)
            else:
                rows = x[slice(*child)]
                seen.extend(range(*child))
                assert len(rows) <= SMALL.leaf and (rows >= low).all() and (rows <= high).all()
                a = np.floor(r.normal(size=(3, 5)) * 50)
                least, most = ng.intervals(a, low[None], high[None])
                assert (a @ rows.T >= least - 1e-6).all() and (a @ rows.T <= most + 1e-6).all()

    walk(root)
    assert sorted(seen) == list(range(700))


def test_search_leaves_most_boxes_alone():
    """With rows in clusters, boxes below the k-th score or outside the window are not opened."""
    r = np.random.default_rng(5)
    x = np.floor((np.repeat(np.eye(6) * 300, 200, 0)) + 10 * r.normal(size=(1200, 6)))
    how = ng.Tree(leaf=20, fan=6)
    root, order = ng.pack(x, how)
    x, opened = x[order], []
    exact = ng._exact
    ng._exact = lambda a, rows: opened.append(len(rows)) or exact(a, rows)
    try:
        w = ng._Windows(np.array([ng.LOWEST]), np.array([ng.HIGHEST]), np.array([ng.LOWEST]), 5)
        ng.search(root, x, order, order, np.zeros(1200, int), np.eye(6)[0] * 300, -1, 0, True, w)
    finally:
        ng._exact = exact
    score = (x @ (np.eye(6)[0] * 300)).astype(int)
    assert [-m for m, _, _ in w.best[0]] == sorted(score)[::-1][:5] and sum(opened) < 300

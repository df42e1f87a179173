import numpy as np
import pytest

from spanforge.llm import quality, queries

SF = "/root/testdata/sf0.01"


def two_kinds(n, share, seed):
    r = np.random.default_rng(seed)
    good = r.random(n) < share
    x = np.zeros((n, quality.WIDTH))
    x[:, :8] = r.normal(np.where(good, 1.5, -1.5)[:, None], 1, (n, 8))
    return x, good


def test_risk_gradient():
    r = np.random.default_rng(0)
    for prior, shift in ((0.3, 0.0), (0.9, 4.0)):  # the second has a negative part below zero
        p, u = r.normal(size=5) + shift, r.normal(size=7) - shift
        base = quality.softplus(u).mean() - prior * quality.softplus(p).mean()
        loss, dp, du = quality.risk_gradient(p, u, prior)
        assert loss >= prior * quality.softplus(-p).mean()

        def part(p, u):
            neg = quality.softplus(u).mean() - prior * quality.softplus(p).mean()
            return -neg if base < 0 else prior * quality.softplus(-p).mean() + neg

        for v, d in ((p, dp), (u, du)):
            for i in range(len(v)):
                v[i] += 1e-6
                up = part(p, u)
                v[i] -= 2e-6
                assert np.isclose((up - part(p, u)) / 2e-6, d[i], atol=1e-6)
                v[i] += 1e-6


@pytest.mark.parametrize("share", [0.3, 0.8])
def test_prior_and_scores(share):
    fit = quality.Fit(steps=100)
    u, good = two_kinds(4000, share, 1)
    p = two_kinds(4000, 1.0, 2)[0][:2000]
    prior = quality.estimate_prior(p, u, fit)
    assert abs(prior - share) < 0.08
    s = quality.train_network(p, u, prior, fit).scores(u)
    assert ((s >= 0.5) == good).mean() > 0.97


def test_features():
    a, empty = quality.features(b"the words, the words. And 5% more!"), quality.features(b"")
    assert a.shape == empty.shape == (quality.WIDTH,) and np.isfinite(empty).all() and not empty.any()
    assert quality.features(b"a a a a b b b b " * 200000)[256 + 3] > 0.7


def test_edges(spark):
    rows = [(1, None, 3), (1, "", 3), (None, "some words here.", 3), (4, "x" * 300000, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    keys = spark.createDataFrame([(1,), (1,), (None,), (99,)], "doc_id long")
    net = quality.train(df, keys, fit=quality.Fit(steps=5))
    got = quality.score(df, net).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert quality.train(df, keys.limit(0)) is None and quality.train(df.limit(0), keys) is None
    assert [r.score for r in quality.score(df, None).collect()] == [0.5] * 4 and quality.score(df.limit(0), net).count() == 0


def test_held_out_labels(spark):
    got = queries.op8_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert len(got) > 50 and (got.predicted == got.quality).mean() > 0.95

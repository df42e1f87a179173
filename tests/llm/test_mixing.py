import hashlib
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spanforge.llm import mixing

FIELDS = "doc_id long, text string, source string, tokens string, pass int"


def table(spark, sizes, seed=0):
    """Documents of 1 to 9 words; ``sizes`` documents per source."""
    r, rows = random.Random(seed), []
    for s, n in sizes.items():
        rows += [(len(rows) + i, "w " * r.randint(1, 9), s, "x", 7) for i in range(n)]
    return rows, spark.createDataFrame(rows, FIELDS)


def alpha_of(totals, mix):
    total = sum(totals)
    shares = sorted(t / total for t in totals if t)

    def entropy(a):
        w = [s**a for s in shares]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)

    grid = [i / 20000 for i in range(20001)]
    flat = max(a for a in grid if entropy(a) >= mix.entropy * math.log(len(shares)) - 1e-9)
    even = min(a for a in grid if (shares[-1] / shares[0]) ** (1 - a) <= mix.repeats + 1e-9)
    return max(flat, even)


@pytest.mark.parametrize("mix", [mixing.Mix(entropy=0.95), mixing.Mix(entropy=1.0, repeats=2.0), mixing.Mix(entropy=0.5)])
def test_weights(spark, mix):
    rows, df = table(spark, {"hot": 400, "b": 90, "c": 10})
    got = {r.source: r for r in mixing.weights(df.select("source", mixing.tokens(df.text).alias("tokens")), mix).collect()}
    totals = defaultdict(int)
    for _, t, s, *_ in rows:
        totals[s] += len(t.split())
    alpha = alpha_of(totals.values(), mix)
    assert abs(got["hot"].alpha - alpha) < 2e-4 and math.isclose(sum(r.weight for r in got.values()), 1)
    a = got["hot"].alpha
    z = sum(t**a for t in totals.values())
    for s, t in totals.items():
        assert got[s].total == t and math.isclose(got[s].weight, t**a / z) and got[s].full * t + got[s].rest == got[s].budget
    repeats = [r.budget / r.total for r in got.values()]
    assert min(repeats) == 1 and max(repeats) <= mix.repeats * 1.001


def by_hand(rows, plan, mix):
    """Draws of each (document, pass) as one sorted list per source and pass."""
    out = set()
    for s, p in plan.items():
        own = [(i, len((t or "").split())) for i, t, x, *_ in rows if (x or "") == s]
        for turn in range(p.full + (p.rest > 0)):
            before = 0
            for h, i, n in sorted((hashlib.md5(f"{i}:{turn}:{mix.seed}".encode()).hexdigest(), i, n) for i, n in own):
                if not p.total:
                    out.add((i, turn, int(h[:8], 16) % p.blocks))
                elif turn < p.full or before + n <= p.rest:
                    out.add((i, turn, min(math.floor((turn * p.total + before) / max(p.budget, 1) * p.blocks), p.blocks - 1)))
                before += n
    return out


@pytest.mark.parametrize("mix", [mixing.Mix(entropy=0.97, block=300), mixing.Mix(entropy=0.9, block=50, budget=900)])
def test_draws(spark, mix):
    rows, df = table(spark, {"hot": 300, "b": 60, "c": 9, None: 20})
    rows += [(9000, None, "b", "x", 7), (9001, "", "silent", "x", 7)]
    df = spark.createDataFrame(rows, FIELDS)
    plan = {r.source: r for r in mixing.weights(df.select(F.coalesce("source", F.lit("")).alias("source"), mixing.tokens(df.text).alias("tokens")), mix).collect()}
    got = mixing.mixture(df, mix=mix).collect()
    assert {(r.doc_id, r["pass"], r.block) for r in got} == by_hand(rows, plan, mix) and len(got) == len({(r.doc_id, r["pass"]) for r in got})
    drawn = defaultdict(int)
    per_block = defaultdict(list)
    for r in got:
        drawn[r.source] += r.tokens
        per_block[r.block].append(r)
    for s, p in plan.items():
        assert p.budget - 9 < drawn[s] <= p.budget or s == "silent"
    for b in per_block.values():
        assert sorted(r.position for r in b) == list(range(len(b)))
    if mix.budget is None:
        assert {r.doc_id for r in got} == {r[0] for r in rows}


def test_edges(spark):
    none = spark.createDataFrame([], FIELDS)
    assert mixing.mixture(none).count() == 0 and mixing.mixed(none).count() == 0
    rows = [(None, "a b", "s", "x", 1), (1, "a", "s", "x", 1), (1, "a", "s", "x", 1), (2, None, None, "x", 1), (3, "w " * 50000, "t", "x", 1)]
    df = spark.createDataFrame(rows, FIELDS)
    got = mixing.mixture(df, mix=mixing.Mix(entropy=0.0)).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 1, 1, 2, 3] and all(r["pass"] == 0 for r in got)
    again = mixing.mixed(df.withColumn("_", F.lit(5)).withColumn("row", F.lit("r")).withColumn("doc", F.lit(1.5)), mix=mixing.Mix(entropy=0.0))
    assert again.columns == [*df.columns, "_", "row", "doc"] and sorted(r.doc_id or 0 for r in again.collect()) == [0, 1, 1, 2, 3]
    one = mixing.mixed(spark.createDataFrame([r for r in rows if r[0] != 1], FIELDS), mix=mixing.Mix(entropy=0.99))
    assert one.columns == df.columns and {r.doc_id for r in one.collect()} == {None, 2, 3}


def test_copies_are_drawn_as_often_as_rows_of_their_own(spark, tmp_path):
    """A third of all rows under one key: as many draws of each source as the mixture makes, and blocks in order."""
    rows = [(7, "a b c", "hot", "x", 1)] * 60 + [(100 + i, "w " * (1 + i % 5), "hot", "x", 1) for i in range(90)] + [(500 + i, "v v", "small", "x", 1) for i in range(20)]
    spark.createDataFrame(rows, FIELDS).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    mix = mixing.Mix(entropy=1.0, block=100)
    draws = mixing.mixture(df, mix=mix)
    want = {tuple(r) for r in draws.groupBy("doc_id", "source").count().collect()}
    out = mixing.mixed(df, mix=mix)
    assert {tuple(r) for r in out.groupBy("doc_id", "source").count().collect()} == want
    assert out.count() == draws.count()
    out.write.parquet(str(tmp_path / "m"))
    order = [r.doc_id for r in draws.orderBy("block", "position").collect()]
    files = sorted((tmp_path / "m").glob("*.parquet"))
    assert [r.doc_id for f in files for r in spark.read.parquet(str(f)).coalesce(1).collect()] == order


def test_rows_without_tokens_are_spread(spark):
    df = spark.createDataFrame([(i, None, "silent", "x", 1) for i in range(400)] + [(1000 + i, "a b", "loud", "x", 1) for i in range(400)], FIELDS)
    per = {r.block: r["count"] for r in mixing.mixture(df, mix=mixing.Mix(block=100)).filter("source = 'silent'").groupBy("block").count().collect()}
    assert len(per) == 8 and max(per.values()) < 100 and sum(per.values()) == 400

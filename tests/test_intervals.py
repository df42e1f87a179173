import random

from pyspark.sql import functions as F

from spanforge.operators import intervals as iv
from spanforge.operators.ordered import halo_window, ordinal, prefix_scan

KEYS = ["g", "s"]


def frame(spark, rows, names):
    return spark.createDataFrame(rows, ", ".join(f"{n} {'string' if n in ('g', 's', 'kind') else 'bigint'}" for n in names))


def spans(rng, n, hot=False):
    out = []
    for i in range(n):
        s = rng.randrange(0, 400)
        key = "A" if hot and i % 3 else rng.choice("AB")
        out.append(("g", key, i, s, s + rng.choice([0, 1, 5, 40, 300])))
    return out


def overlaps(a, b):
    return a[1] == b[1] and a[3] < b[4] and a[4] > b[3]


def test_overlap_join_equals_nested_loop(spark):
    rng = random.Random(1)
    left, right = spans(rng, 120, hot=True), spans(rng, 80)
    want = sorted((a[2], b[2]) for a in left for b in right if overlaps(a, b))
    l = frame(spark, left, ["g", "s", "i", "start", "end"])
    r = frame(spark, right, ["g", "s", "j", "r_start", "r_end"])
    for width in (7, 64, 1000):
        for salt in (1, 3):
            got = iv.overlap_join(l, r, KEYS, width, salt=salt).select("i", "j").collect()
            assert sorted((x.i, x.j) for x in got) == want


def test_half_open_overlap_fixture(spark):
    rows = [("g", "S1", 0, 20, 30), ("g", "S1", 1, 10, 20), ("g", "S1", 2, 20, 20), ("g", "S1", 3, 20, 25), ("g", "S1", 4, 30, 40), ("g", "S1", 5, 15, 35), ("g", "S2", 6, 10, 40)]
    l = frame(spark, rows, ["g", "s", "i", "start", "end"])
    r = frame(spark, [("g", "S1", 9, 20, 30)], ["g", "s", "j", "r_start", "r_end"])
    assert sorted(x.i for x in iv.overlap_join(l, r, KEYS, 8).collect()) == [0, 3, 5]


def test_point_containment_and_near_joins(spark):
    rng = random.Random(2)
    left, right = spans(rng, 90), spans(rng, 60)
    l = frame(spark, left, ["g", "s", "i", "start", "end"]).withColumn("mid", F.floor((F.col("start") + F.col("end")) / 2))
    r = frame(spark, right, ["g", "s", "j", "r_start", "r_end"])
    mid = lambda a: (a[3] + a[4]) // 2
    pairs = [(a, b) for a in left for b in right if a[1] == b[1]]
    for closed in (True, False):
        want = sorted((a[2], b[2]) for a, b in pairs if b[3] <= mid(a) and (mid(a) <= b[4] if closed else mid(a) < b[4]))
        assert sorted((x.i, x.j) for x in iv.point_join(l, r, KEYS, 50, closed=closed).collect()) == want
    want = sorted((a[2], b[2]) for a, b in pairs if a[3] >= b[3] and a[4] <= b[4])
    assert sorted((x.i, x.j) for x in iv.containment_join(l, r, KEYS, 50).collect()) == want
    want = sorted((a[2], b[2], min(abs(a[3] - b[3]), abs(a[4] - b[4]))) for a, b in pairs if min(abs(a[3] - b[3]), abs(a[4] - b[4])) <= 20)
    assert sorted((x.i, x.j, x.distance) for x in iv.near_join(l, r, KEYS, 20, salt=2).collect()) == want


def fold_merge(rows, gap, strict=False):
    out = []
    for r in sorted(rows):
        if out and (r[0] < out[-1][1] + gap if strict else r[0] <= out[-1][1] + gap):
            out[-1][1] = max(out[-1][1], r[1])
        else:
            out.append(list(r))
    return [tuple(x) for x in out]


def test_merge_is_a_disjoint_idempotent_cover(spark):
    rng = random.Random(3)
    rows = [("g", "A", i, s, s + rng.choice([1, 4, 60])) for i, s in enumerate(rng.choices(range(3000), k=200))]
    d = frame(spark, rows, ["g", "s", "i", "start", "end"])
    for gap, strict in ((0, False), (0, True), (9, False)):
        merged = iv.merge_intervals(d, KEYS, 16, gap, strict)
        got = sorted((x.start, x.end) for x in merged.collect())
        assert got == fold_merge([(r[3], r[4]) for r in rows], gap, strict)
    again = iv.merge_intervals(merged.select(*KEYS, "start", "end"), KEYS, 16, 9)
    assert sorted((x.start, x.end) for x in again.collect()) == got


def test_gap_clusters_look_at_the_previous_row_only(spark):
    # the long first record does not reach the third one through its own end
    rows = [("g", "A", 0, 0, 100), ("g", "A", 1, 10, 20), ("g", "A", 2, 50, 60)]
    d = iv.gap_cluster(frame(spark, rows, ["g", "s", "i", "start", "end"]), KEYS, 32, 10, ["i"])
    assert {x.i: x.island for x in d.collect()} == {0: 1, 1: 1, 2: 2}


def test_typed_islands_equal_the_fold(spark):
    rng = random.Random(4)
    rows = [("g", "A", i, s, s + rng.choice([5, 30, 90]), rng.choice("ab")) for i, s in enumerate(sorted(rng.choices(range(900), k=80)))]
    runs, cur = [], None
    for r in sorted(rows, key=lambda r: (r[3], r[4], r[2])):
        if cur and r[3] < cur[1] and r[5] == cur[2]:
            cur[1] = max(cur[1], r[4])
        else:
            cur = [r[3], r[4], r[5]]
            runs.append(cur)
    d = frame(spark, rows, ["g", "s", "i", "start", "end", "kind"])
    m = iv.typed_islands(d, KEYS, 64, ["end", "i"], "kind", F.lit(True)).groupBy("island", "kind").agg(F.min("start").alias("a"), F.max("end").alias("b"))
    assert sorted((x.a, x.b, x.kind) for x in m.collect()) == sorted(map(tuple, runs))


def test_scans_match_plain_windows_on_a_hot_key(spark):
    rng = random.Random(5)
    rows = [("g", "A", i, rng.randrange(500), rng.randrange(50)) for i in range(300)]
    d = frame(spark, rows, ["g", "s", "i", "start", "end"])
    out = prefix_scan(d, KEYS, "start", ["start", "i"], {"t": ("sum", F.col("end")), "m": ("max", F.col("end")), "p": ("lag", F.col("i")), "n": ("count", F.lit(1))}, 13)
    got = {x.i: (x.t, x.m, x.p, x.n) for x in out.collect()}
    seen = []
    for r in sorted(rows, key=lambda r: (r[3], r[2])):
        v = [x[4] for x in seen]
        assert got[r[2]] == (sum(v), max(v) if v else None, seen[-1][2] if seen else None, len(v))
        seen.append(r)
    idx = ordinal(d, KEYS, "start", ["start", "i"], 13, "k")
    around = halo_window(idx, KEYS, "k", {"a": lambda w: F.sum("end").over(w.rowsBetween(-3, 3))}, 3, 8)
    order = [r[4] for r in sorted(rows, key=lambda r: (r[3], r[2]))]
    assert sorted((x.k, x.a) for x in around.collect()) == [(i, sum(order[max(0, i - 3) : i + 4])) for i in range(300)]


def test_windows_tiles_and_midpoints(spark):
    d = frame(spark, [("g", "A", 0, 0, 20)], ["g", "s", "i", "start", "end"])
    w = [(x.w_start, x.w_end) for x in iv.sliding_windows(d, 10, 10).orderBy("w_start").collect()]
    assert w == [(0, 10), (10, 20)]
    marks = frame(spark, [("g", "A", 1, 10)], ["g", "s", "m", "mid"])
    wins = iv.sliding_windows(d, 10, 10).select(*KEYS, F.col("w_start").alias("r_start"), F.col("w_end").alias("r_end"))
    assert [x.r_start for x in iv.point_join(marks, wins, KEYS, 8).collect()] == [10]
    t = iv.tile(spark.createDataFrame([("c", "ACGTACGTAC", 10), ("e", "", 0)], "id string, seq string, seq_len bigint"), 4, 2)
    assert [(x.core_start, x.core_end, x.tile_seq) for x in t.filter("id = 'c'").orderBy("tile_idx").collect()] == [(0, 4, "ACGTAC"), (4, 8, "GTACGTAC"), (8, 10, "GTAC")]
    assert t.filter("id = 'e'").count() == 1
    own = spark.range(1).select(iv.owns_midpoint(F.lit(8), F.lit(12), F.lit(10), F.lit(20)), iv.owns_midpoint(F.lit(8), F.lit(12), F.lit(0), F.lit(10))).first()
    assert tuple(own) == (True, False)


def test_no_join_broadcasts_a_side_copied_per_bin(spark):
    """The estimate of a small table that is copied per bin stays small, so the plan has to name the join."""
    a = spark.range(10).selectExpr("id % 2 AS k", "id AS start", "id + 1000000 AS end")
    b = a.selectExpr("k", "start AS r_start", "end AS r_end")
    for d in (iv.overlap_join(a, b, ["k"], 16), iv.point_join(a.withColumn("mid", F.col("start")), b, ["k"], 16), iv.containment_join(a, b, ["k"], 16)):
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan

import random

import pytest
from pyspark.sql import functions as F

from spanforge.operators import evidence as ev
from spanforge.operators import graph as gr
from spanforge.operators import quality as ql
from spanforge.operators import similarity as sm


def test_components_do_not_depend_on_edge_order(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201)]
    nodes = spark.createDataFrame([(i,) for i in [*range(61), *range(100, 130), 200, 201, 300]], "id bigint")
    want = {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200, 300: 300}
    for _ in range(2):
        rng.shuffle(chain)
        e = spark.createDataFrame([(a, b) if rng.random() < 0.5 else (b, a) for a, b in chain], "a bigint, b bigint")
        assert {r.id: r.root for r in gr.components(nodes, e).collect()} == want


def test_clusters_and_propagation(spark):
    e = spark.createDataFrame([("E1", "E2", 99.1), ("E3", "E4", 98.5), ("E4", "E5", 94.0)], "a string, b string, ani double")
    rows = [
        ("g", "E1", "PPV", True, 2), ("g", "E2", "UNKNOWN", False, 0), ("g", "E3", "NCLDV", True, 1), ("g", "E4", "MIRUS", True, 1),
        ("g", "E5", "UNKNOWN", False, 0), ("g", "E6", "VIRAL_UNKNOWN", False, 0),
    ]
    n = spark.createDataFrame(rows, "genome_id string, id string, taxonomy_class string, from_capsid boolean, hallmark_count int")
    first = {r.id: (r.cluster_id, r.cluster_size) for r in gr.cluster(n, e).collect()}
    assert first == {"E1": (0, 2), "E2": (0, 2), "E3": (1, 2), "E4": (1, 2), "E5": (-1, 1), "E6": (-1, 1)}
    out = {r.id: (r.taxonomy_class, r.propagated_from, r.cluster_id) for r in gr.cluster_and_propagate(n, e).collect()}
    # two donors that disagree pass nothing on; E5 has no evidence and no relative at 95
    assert out == {"E1": ("PPV", None, 0), "E2": ("PPV", "E1", 0), "E3": ("NCLDV", None, 1), "E4": ("MIRUS", None, 1), "E6": ("VIRAL_UNKNOWN", None, -1)}


def kmers(seq, k):
    flip = str.maketrans("ACGT", "TGCA")
    mers = [seq[i : i + k] for i in range(len(seq) - k + 1)]
    return {min(m, m.translate(flip)[::-1]) for m in mers if set(m) <= set("ACGT")}


def plain_pairs(recs, k, min_ani=80.0, min_af=0.5):
    """All pairs of one genome by all k-mers; copies hang on the smallest of them."""
    sets = {(g, i): kmers(s.upper(), k) for g, i, s in recs}
    first = {}
    for (g, i), m in sorted(sets.items()):
        first.setdefault((g, frozenset(m)), i)
    out = {}
    for (g, x), m in sets.items():
        if m and first[g, frozenset(m)] != x:
            out[g, first[g, frozenset(m)], x] = (100.0, 100.0, 100.0)
        for (h, y), n in sets.items():
            if g == h and x < y and m and n and first[g, frozenset(m)] == x and first[g, frozenset(n)] == y:
                c = len(m & n)
                ani = 100 * (c / min(len(m), len(n))) ** (1 / k)
                if ani >= min_ani and max(c / len(m), c / len(n)) >= min_af:
                    out[g, x, y] = (ani, 100 * c / len(m), 100 * c / len(n))
    return out


def same_pairs(spark, recs, k, **more):
    d = spark.createDataFrame(recs, "g bigint, id bigint, seq string")
    got = {(r.genome_id, r.a, r.b): (r.ani, r.af_a, r.af_b) for r in sm.similar_pairs(d, "id", "g", k, **more).collect()}
    want = plain_pairs(recs, k)
    assert set(got) == set(want)
    assert all(abs(u - v) < 1e-9 for p in got for u, v in zip(got[p], want[p], strict=True))
    return got


def edited(rng, s, n):
    s = list(s)
    for _ in range(n):
        s[rng.randrange(len(s))] = rng.choice("ACGT")
    return "".join(s)


def test_similar_pairs_lose_none(spark):
    rng = random.Random(9)
    common = "".join(rng.choices("ACGT", k=60))
    recs = []
    for i in range(6):
        base = "".join(rng.choices("ACGT", k=400))
        recs += [(i % 2, i * 10 + j, common + edited(rng, base, 2 * j)) for j in range(4)]
    recs += [(0, 90, recs[0][2]), (0, 91, recs[0][2].lower()), (1, 92, recs[0][2]), (0, 93, ""), (0, 94, "ACGTN" * 30), (1, 95, "NNNNNNNNNNNNNNNN"), (0, 96, None)]
    same_pairs(spark, [r for r in recs if r[2] is not None], 12)
    d = spark.createDataFrame(recs, "g bigint, id bigint, seq string")
    assert sm.similar_pairs(d, "id", "g", 12).filter("a = 96 or b = 96").isEmpty()
    assert sm.similar_pairs(d.limit(0), "id", "g", 12).isEmpty()


def test_short_copies_keep_their_edges(spark):
    rng = random.Random(3)
    recs = []
    for i in range(40):
        s = "".join(rng.choices("ACGT", k=60))
        recs += [(0, 2 * i, s), (0, 2 * i + 1, s)]
    got = same_pairs(spark, recs, 16)
    assert len(got) == 40


def test_records_around_the_limit_of_all_kmers(spark):
    """Pairs with a short record are exact, however long the other is; a long one of few k-mers counts as short."""
    rng = random.Random(5)
    long = "".join(rng.choices("ACGT", k=2600))
    unit = "".join(rng.choices("ACGT", k=90))
    recs = [(0, 1, long[500:900]), (0, 2, long), (0, 3, edited(rng, long[1000:1300], 3)), (0, 4, unit * 25), (0, 5, unit * 3), (0, 6, unit * 24 + long[:60])]
    recs += [(0, 7, long.translate(str.maketrans("ACGT", "TGCA"))[::-1])]
    same_pairs(spark, recs, 16, exact=500)


def test_long_records_by_a_share_of_all_hashes(spark):
    rng = random.Random(4)
    inner, a, b = ("".join(rng.choices("ACGT", k=n)) for n in (3000, 20000, 20000))
    d = spark.createDataFrame([(1, inner), (2, a + inner + b), (3, a[:5000])], "id bigint, seq string")
    got = {(r.a, r.b): (r.af_a, r.af_b) for r in sm.similar_pairs(d, "id", exact=1000, scale=16).collect()}
    assert set(got) == {(1, 2), (2, 3)} and got[1, 2][0] > 99 and got[1, 2][1] < 15


def test_copies_stay_together_without_their_first(spark):
    edges = "a string, b string, ani double, af_a double, af_b double, copy boolean"
    e = spark.createDataFrame([("c1", "c2", 100.0, 100.0, 100.0, True), ("c1", "c3", 100.0, 100.0, 100.0, True), ("c1", "x", 97.0, 90.0, 90.0, False), ("y", "z", 96.0, 90.0, 90.0, False)], edges)
    rows = [("g", "c1", "UNKNOWN", False, 0), ("g", "c2", "VIRAL_UNKNOWN", False, 0), ("g", "c3", "VIRAL_UNKNOWN", False, 0), ("g", "x", "VIRAL_UNKNOWN", False, 0), ("g", "y", "UNKNOWN", False, 0), ("g", "z", "VIRAL_UNKNOWN", False, 0)]
    n = spark.createDataFrame(rows, "genome_id string, id string, taxonomy_class string, from_capsid boolean, hallmark_count int")
    got = {r.id: (r.cluster_id, r.cluster_size, r.max_ani) for r in gr.cluster_and_propagate(n, e).collect()}
    assert got == {"c2": (0, 3, 100.0), "c3": (0, 3, 100.0), "x": (0, 3, 97.0), "z": (-1, 1, 0.0)}


def test_components_of_a_hub(spark):
    e = spark.createDataFrame([(5000, i) for i in range(3000)], "a bigint, b bigint")
    nodes = spark.createDataFrame([(5000,), (7,), (9999,)], "id bigint")
    assert {r.id: r.root for r in gr.components(nodes, e).collect()} == {5000: 0, 7: 0, 9999: 9999}


def test_nearest_blocks_agree_with_one_block(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(60)] + [(60, [0.0] * 8)]
    q = spark.createDataFrame(rows, "q_id bigint, vec array<double>")
    b = q.withColumnRenamed("q_id", "d_id")
    one = {(r.q_id, r.d_id) for r in sm.nearest(q, b, 0.2).collect()}
    many = {(r.q_id, r.d_id) for r in sm.nearest(q, b, 0.2, block_rows=7).collect()}
    assert one == many and len(one) > 40 and all(60 not in p for p in one)


def test_conflicting_vectors_fail(spark):
    d = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0])], "q_id bigint, vec array<float>")
    with pytest.raises(Exception, match="conflicting vectors"):
        sm.unique_vectors(d).collect()


def test_coherence(spark):
    w = spark.createDataFrame([("c", 0, "hallmark_mcp"), ("c", 0, "high_kfd"), ("c", 1, "high_novelty")], "cand string, idx bigint, type string")
    n = spark.createDataFrame([("c", 2)], "cand string, n bigint")
    edges = {(r.u, r.v): r.weight for r in ev.co_occurrence(w).collect()}
    assert edges == {("hallmark_mcp", "high_kfd"): 1.0, ("hallmark_mcp", "high_novelty"): 0.5, ("high_kfd", "high_novelty"): 0.5}
    r = ev.coherence(w, n).first()
    assert abs(r.coherence - (0.15 + 0.25 + 0.0375 * 0.5 + 0.0375 * 0.25 + 0.05)) < 1e-12 and r.level == "low"


GOOD = dict(eve_id="e", total_proteins="3", ncldv_top10_proteins="1", mirus_top10_proteins="0", ppv_top10_proteins="0", cress_top10_proteins="0", taxonomy_best_hits="EUK:2;NCLDV:1")


@pytest.mark.parametrize(
    "change, checks",
    [
        ({}, []),
        ({"total_proteins": "x"}, ["ncldv_top_count_out_of_range", "parse_error", "taxonomy_total_mismatch"]),
        ({"taxonomy_best_hits": "EUK"}, ["taxonomy_best_hits_format"]),
        ({"taxonomy_best_hits": "EUK:9"}, ["taxonomy_total_mismatch"]),
        ({"og_count": "2", "og_names": "OG1:1"}, ["og_count_names_mismatch"]),
        ({"og_count": "0", "og_names": "OG1:1"}, ["og_names_nonzero"]),
        ({"og_count": "1", "og_names": "."}, ["og_count_names_mismatch", "og_names_missing"]),
        ({"gvogm_unvalidated_count": "2", "gvogm_unvalidated_names": "a"}, ["gvogm_unvalidated_count_names_mismatch"]),
        ({"host_signature_gene_count": "1", "host_signature_fraction": "0"}, ["host_signature_fraction_zero"]),
        ({"host_signature_gene_count": "4", "host_signature_fraction": "1.5"}, ["host_signature_count_out_of_range", "host_signature_fraction_out_of_range"]),
        ({"seed_marker_names": "GVOGm7:1", "seed_marker_patterns": "p"}, ["gvogm_marker_evidence_zero_count"]),
        ({"seed_marker_names": "m"}, ["seed_marker_patterns_missing"]),
    ],
)
def test_contract_rules(spark, change, checks):
    row = {**GOOD, **change}
    d = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
    assert sorted(r.check for r in ql.detailed_issues(d).collect()) == checks


def test_missing_columns_and_enforcement(spark, tmp_path):
    d = spark.createDataFrame([("e", "1")], "eve_id string, total_proteins string")
    issues = ql.detailed_issues(d)
    assert [r.check for r in issues.collect()] == ["detailed_tsv_schema"]
    with pytest.raises(ql.ContractError):
        ql.enforce(issues, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1
    assert ql.enforce(issues.withColumn("severity", F.lit("warning")), str(tmp_path / "b")) == 1
    with pytest.raises(ql.ContractError):
        ql.enforce(issues.withColumn("severity", F.lit("typo")), str(tmp_path / "c"))


def test_numbers_by_string_keys_with_most_rows_in_one(spark):
    from spanforge.operators.ordered import number_rows

    rng = random.Random(6)
    rows = [("hot" if i % 10 else f"g{i % 7}", f"id{rng.randrange(10**6):06d}", i) for i in range(3000)]
    d = spark.createDataFrame(rows, "genome string, name string, n int")
    got = number_rows(d, ["genome"], [F.col("name").desc(), "n"], "no").collect()
    by = {}
    for r in got:
        by.setdefault(r.genome, {})[r.no] = (r.name, r.n)
    for genome, placed in by.items():
        want = sorted([(x[1], x[2]) for x in rows if x[0] == genome], key=lambda v: v[1])
        assert [placed[i] for i in range(len(placed))] == sorted(want, key=lambda v: v[0], reverse=True)
    assert number_rows(d.limit(0), ["genome"], ["name"], "no").count() == 0


def test_medians_of_tied_values(spark):
    import statistics

    from spanforge.operators.summary import medians

    rows = [("a", 5.0)] * 900 + [("a", float(i % 50)) for i in range(100)] + [("b", 1.0), ("b", 4.0), ("c", 2.5), ("d", None), ("d", 7.0)]
    got = {r.k: r.median for r in medians(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", 0.5).collect()}
    assert got == {k: statistics.median(v for x, v in rows if x == k and v is not None) for k in "abcd"}


def test_listed_words_by_automaton_and_by_join(spark, monkeypatch):
    words = spark.createDataFrame([("ring", 3), ("in", 1), ("string", 5), ("bolt", 0), ("naïve", 2), ("in", 4)], "word string, pos int")
    d = spark.createDataFrame([(1, "a string"), (2, "bolts in rings"), (3, "none"), (4, None), (5, "naïve ring"), (6, "")], "id int, t string")
    want = {(1, "in", 1), (2, "bolt", 0), (5, "in", 1)}
    assert {tuple(r) for r in sm.contains_first(d, "t", words, "word", "pos").select("id", "word", "pos").collect()} == want
    monkeypatch.setattr(sm, "FEW_WORDS", 2)
    assert {tuple(r) for r in sm.contains_first(d, "t", words, "word", "pos").select("id", "word", "pos").collect()} == want


def test_a_stage_writes_less_than_a_checkpoint(spark):
    """Region genes and k-mers are staged as compressed columns, with the same rows and types."""
    import glob
    import os

    from spanforge.session import shared_dir, stage

    rows = spark.range(50000).selectExpr("id AS region_id", "'interior' AS role", "id % 7 AS pos", "id % 2 = 0 AS viral")
    before = set(glob.glob(shared_dir(spark).removeprefix("file:") + "/stage-*"))
    back = stage(rows)
    (path,) = set(glob.glob(shared_dir(spark).removeprefix("file:") + "/stage-*")) - before
    size = sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path))
    assert size < 50000 * 16 and back.dtypes == rows.dtypes and back.exceptAll(rows).isEmpty() and back.count() == 50000


def test_long_records_are_compared_on_all_kmers(spark):
    rng = random.Random(6)
    long = "".join(rng.choices("ACGT", k=6000))
    recs = [(0, 1, long), (0, 2, edited(rng, long, 20)), (0, 3, edited(rng, long[:4000], 9)), (1, 4, edited(rng, long, 30)), (0, 5, long[1000:1400])]
    assert len(same_pairs(spark, recs, 16, exact=500)) == 6


def test_probes_of_a_record_are_met_by_every_partner():
    """Any half of the k-mers, the most common ones too, has as many of the probes as are asked for."""
    import numpy as np

    rng, draws = np.random.default_rng(2), sm._draws()
    for n in (1, 2, 3, 9, 40, 150, 700, 5000):
        codes = np.sort(rng.choice(10**9, n, replace=False))
        common = codes[rng.random(n) < 0.4]
        counts = rng.integers(2, 5000, len(common)).astype(float)
        probes, need = sm.probes_of(codes, common, counts, 0.5, draws)
        assert len(np.unique(probes)) == len(probes) and np.isin(probes, codes).all() and len(probes) <= max(n // 2 + 1, 400)
        worst = np.r_[common[np.argsort(-counts)], np.setdiff1d(codes, common)][: -(-n // 2)]
        assert np.isin(probes, worst).sum() >= need
        for _ in range(50):
            assert np.isin(probes, rng.choice(codes, -(-n // 2), replace=False)).sum() >= need


def test_shuffle_files_go_with_the_stage_that_made_them(spark):
    from pathlib import Path

    from spanforge.session import cut, stage

    def files():
        folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {p for d in folder for p in Path(d).rglob("shuffle_*.data")}

    before = files()
    d = spark.range(20000).withColumn("k", F.col("id") % 977)
    kept = [keep(d.repartition(7, "k").groupBy("k").count()) for keep in (stage, cut)]
    assert files() <= before and [x.count() for x in kept] == [977, 977]

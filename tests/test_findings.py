import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry


def same_as_sql(spark, folder, name, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    got = entry.queries()[name](spark, str(folder)).select(*cols)
    return sorted(map(tuple, got.collect()), key=repr), sorted(cur.fetchall(), key=repr)


def test_domain_summary_with_words_of_other_categories(spark, tmp_path):
    rows = [
        (1, "a", "the Coat and d5"), (2, "a", "coat near a POLB word"), (3, "a", "rnap"), (4, "b", "mcp, portal"),
        (5, "c", None), (6, "c", "packaging a32"), (7, None, "helicase ou"), (8, "d", "terminase atpase primase capsid"),
    ]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got, want = same_as_sql(spark, tmp_path, "domain_summary", "documents")
    assert got == want


def test_genome_batch_sends_no_join_side_through_the_driver(spark, monkeypatch):
    from spanforge.plans import genomes as gn
    from spanforge.plans.stages import Store
    from test_genomes import THREE, inputs

    plans, put, name = [], Store.put, "spark.sql.autoBroadcastJoinThreshold"

    def noted(self, stage, rows, genomes):
        plans.append((stage, rows._jdf.queryExecution().executedPlan().toString()))
        put(self, stage, rows, genomes)

    monkeypatch.setattr(Store, "put", noted)
    before = spark.conf.get(name)
    assert gn.run(spark, inputs(spark, THREE)).count() == 3
    assert [s for s, _ in plans] == [s for s, _ in gn.STAGES]
    assert [s for s, p in plans if "BroadcastHashJoin" in p] == []
    assert spark.conf.get(name) == before


def test_fingerprints_rank_the_hits_once_and_expand_after_the_move(spark):
    from spanforge.plans import fingerprint_queries as fq

    plan = fq.gene_fingerprints(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1
    assert plan.index("Generate explode") < plan.index("RepartitionByExpression")


def test_jaccard_keeps_keys_without_a_shared_token(spark):
    from spanforge.operators import fingerprints as fp

    f = spark.createDataFrame([(1, 1, "a", 3.0), (1, 1, "b", 1.0), (1, 2, "c", 2.0), (2, 3, "a", 1.0), (1, 4, "a", 0.0)], "genome_id long, gene_id long, token string, weight double")
    base = spark.createDataFrame([(1, "a", 1.0), (1, "d", 1.0)], "genome_id long, token string, weight double")
    got = {r.gene_id: r.score for r in fp.jaccard(f, base, ["genome_id", "gene_id"], ["genome_id"], False).collect()}
    assert got == {1: 0.5 / 1.5, 2: 0.0, 3: 0.0, 4: 0.0}


def test_softmask_runs_compare_texts_where_they_are_read(spark, tmp_path):
    rows = [(1, "abC dé\U0001f600fg"), (2, None), (3, ""), (4, "ß straße"), (5, "x" * 2000), (6, "ABC"), (7, ("a" * 511 + "B") * 3)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got, want = same_as_sql(spark, tmp_path, "softmask_runs", "documents")
    assert got == want
    plan = entry.queries()["softmask_runs"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_six_frames_equal_the_codon_table_and_leave_the_expression_engine(spark):
    import random

    from spanforge.functions import seq as sq

    rng = random.Random(5)
    texts = ["".join(rng.choices("ACGTNRacgt\u00e9", [9, 9, 9, 9, 1, 1, 3, 3, 3, 3, 1], k=n)) for n in (0, 1, 2, 3, 4, 5, 400, 1301)] + [None]
    table, pair = sq.codon_table(), str.maketrans("ACGT", "TGCA")

    def plain(text):
        up, out = text.upper(), []
        for strand, s in (("f", up), ("r", up.translate(pair)[::-1])):
            for frame in range(3):
                residues = "".join(table.get(s[i : i + 3], "X") for i in range(frame, len(s) - 2, 3))
                out += [(f"{strand}{frame}_{j}", p) for j, p in enumerate(residues.split("*")) if len(p) >= 4]
        return out

    d = spark.createDataFrame(list(enumerate(texts)), "id int, seq string").select("id", sq.six_frame_proteins(F.col("seq"), 4).alias("p"))
    got = {r.id: r.p and [tuple(x) for x in r.p] for r in d.collect()}
    assert {i: p or [] for i, p in got.items()} == {i: plain(t) if t else [] for i, t in enumerate(texts)}
    assert sum(map(len, filter(None, got.values()))) > 50
    assert "ArrowEvalPython" in d._jdf.queryExecution().executedPlan().toString()


def test_composition_audit_keeps_a_record_in_one_row(spark, tmp_path):
    import random

    rng = random.Random(7)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz .", k=n)) for n in (0, 3, 90, 130, 400, 3000)] + [None, "z" * 300, "zzzab" * 60]
    rows = [(i, t, lang, 0) for i, (t, lang) in enumerate(zip(texts * 3, ["en", "fr", None] * 9))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got, want = same_as_sql(spark, tmp_path, "composition_audit", "documents")
    assert len(want) == 18 and [r[0] for r in got] == [r[0] for r in want]
    assert max(abs(a - b) for g, w in zip(got, want) for a, b in zip(g[1:], w[1:])) < 2e-6
    plan = entry.queries()["composition_audit"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    # no rows per record and k-mer are grouped
    assert "Aggregate [lang#" in plan and "doc_id" not in "".join(x for x in plan.splitlines() if "Aggregate" in x)


def test_gene_support_gives_the_features_of_the_lists_of_hits(spark):
    import random

    from spanforge.operators import hits as ho
    from spanforge.operators import learn
    from spanforge.plans import region_queries as rq

    rng = random.Random(9)
    names = ["EUK__", "BAC__", "NCLDV__", "MIRUS__", "PPV__", "VP__", "GVMAG__", "CRESS__"]
    rows = []
    for gene in range(60):
        for rank in range(rng.randint(0, 10)):
            p = rng.choice(names)
            rows.append((gene, rank, f"{p}x|{rank}", p, float(rng.randint(0, 400)), float(rng.choice([10, 24.9, 25, 60])), rng.choice([0.0, 1e-9, 1.0, 5.0])))
    ranked = spark.createDataFrame(rows, "gene_id long, rank int, target string, prefix string, bits double, pident double, evalue double")
    genes = spark.range(62).select(F.col("id").alias("gene_id"), F.when(F.col("id") % 3 == 0, F.lit(0.4)).alias("host_score"))
    cols = ["gene_id", *[c for c in learn.FEATURES if not c.startswith("neighbor_")]]
    old = learn.gene_features(ho.with_no_hits(genes, ho.gene_hits(ranked))).select(*cols)
    new = learn.support_features(ho.with_no_hits(genes, ho.gene_support(ranked))).select(*cols)
    rounded = lambda d: sorted(tuple(round(float(v), 9) for v in r) for r in d.collect())
    assert rounded(new) == rounded(old)
    for name in ("heuristic_probability", "gene_labels"):
        plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_list" not in plan
    assert "top10" not in rq.scored_genes(spark, "/root/testdata/sf0.001").columns


def test_set_distances_shuffle_no_pairs_and_equal_plain_answers_in_blocks(spark):
    import random

    from spanforge.operators import similarity as sm

    rng = random.Random(11)
    sets = {k: frozenset(rng.sample("abcdefgh", rng.randint(1, 4))) for k in range(60)}
    d = spark.createDataFrame([(k, i) for k, s in sets.items() for i in s], "k long, i string")
    reps = {}
    for k, s in sorted(sets.items()):
        reps.setdefault(s, []).append(k)
    own = sorted((v[0], len(v), s) for s, v in reps.items())
    want = [(a, b, na, nb, 1 - len(s & t) / len(s | t)) for a, na, s in own for b, nb, t in own if a < b and s & t]
    for rows in (1_000, 7):
        out = sm.set_distances(d, "k", "i", rows)
        assert sorted(tuple(r) for r in out.collect()) == sorted(want)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan


def test_vector_blocks_in_slices_keep_the_first_of_equals_and_move_vectors_less(spark):
    from spanforge.operators import similarity as sm

    rows = [(i, [float(i % 5 == j) + 0.01 * (i % 3) for j in range(5)]) for i in range(50)] + [(50, [0.0] * 5)]
    q, b = spark.createDataFrame(rows, "q_id long, vec array<float>"), spark.createDataFrame(rows, "d_id long, vec array<float>")
    whole = sorted(tuple(r) for r in sm.nearest(q, b, 0.3).select("q_id", "d_id").collect())
    cut = sorted(tuple(r) for r in sm.nearest(q, b, 0.3, slice_rows=4).select("q_id", "d_id").collect())
    plain = sorted(tuple(r) for r in sm.nearest(q, b, 0.3, 9, 4).select("q_id", "d_id").collect())
    # 15 different directions, three or four copies each: the first copy that is not the vector itself
    assert whole == cut == plain == [(i, i % 15 if i >= 15 else i + 15) for i in range(50)]


def test_region_queries_without_status_rank_no_hits(spark):
    for name in ("marker_summary", "subtype_and_group"):
        plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan


def test_marker_summary_of_folded_rows_and_names(spark):
    from spanforge.operators import votes as vt

    rows = [(1, m) for m in ["GVOGm0003", "gvogm0003", "VP_MCP_1", "x"]] + [(2, "PLV_MCP_2"), (2, "zz"), (2, "zz"), (3, "x")]
    d = spark.createDataFrame(rows, "region_id long, model string")
    known = spark.createDataFrame([("zz", ["capsid"], "UNKNOWN")], "model string, categories array<string>, family string")
    folded = d.groupBy("region_id", F.lower("model").alias("model")).agg(F.count(F.lit(1)).alias("n"))
    plain = sorted(map(tuple, vt.marker_summary(d, known, ["region_id"]).collect()))
    assert plain == sorted(map(tuple, vt.marker_summary(folded, known, ["region_id"], folded).collect()))
    assert [r[:3] for r in plain] == [(1, 4, 3), (2, 3, 2), (3, 1, 1)]


def test_region_assembly_folds_markers_before_they_move(spark, monkeypatch):
    import random

    from spanforge.operators import regions as rg
    from spanforge.plans import region_queries as rq
    from test_regions import KEYS as K
    from test_regions import assemble

    # several markers per gene and start, so that rows are folded; the answer is that of single markers
    rng, n = random.Random(23), 150000
    gs = sorted((s, s + rng.randrange(200, 9000)) for s in rng.choices(range(0, n, 1500), k=60))
    ms = [(f"{i:02d}:{j}", *gs[i], rng.random() < 0.4) for i in rng.sample(range(60), 25) for j in range(rng.randrange(1, 5))]
    marks = [("g", "A", m[0], m[0].split(":")[0], m[1], m[2], 1.0, m[3], False) for m in ms]
    m = spark.createDataFrame(marks, "g string, s string, marker_id string, gene_id string, start bigint, end bigint, score double, seedable boolean, compact boolean")
    g = spark.createDataFrame([("g", "A", *x) for x in gs], "g string, s string, start bigint, end bigint")
    lengths = spark.createDataFrame([("g", "A", n)], "g string, s string, seq_len bigint")
    for least in (2, 3):
        rows = rg.assemble_regions(m, g, lengths, K, 8192, min_markers=least).collect()
        want = assemble(ms, gs, n, min_n=least)
        assert sorted((r.start, r.end) for r in rows) == want
        assert sorted(r.n_markers for r in rows) == sorted(sum(1 for x in ms if x[1] < e and x[2] > s) for s, e in want)

    seen = []
    monkeypatch.setattr(rq, "stage", lambda d: seen.append(d) or d)
    rq.production_markers(spark, "/root/testdata/sf0.001")
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and plan.count("Window [") == 1


def test_production_markers_are_the_validated_ones(spark, tmp_path):
    import random

    from spanforge.plans import region_queries as rq
    from spanforge.plans.hit_queries import validated
    from spanforge.plans.tables import load

    kept = {(r.gene_id, r.status): r.n for r in validated(spark, "/root/testdata/sf0.001").groupBy("gene_id", "status").agg(F.count(F.lit(1)).alias("n")).collect() if r.status.startswith("validated")}
    got = {}
    for r in rq.production_markers(spark, "/root/testdata/sf0.001").collect():
        got[r.gene_id] = got.get(r.gene_id, 0) + r.n_here
    assert got == {g: n for (g, _), n in kept.items()} and len(got) > 100

    # genes without hits: a profile hit that has the scaffold for itself is no marker
    orders, lines = load(spark, "/root/testdata/sf0.001", "orders"), load(spark, "/root/testdata/sf0.001", "lineitem")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    rng = random.Random(3)
    bare = {r.l_orderkey for r in lines.select("l_orderkey").distinct().collect() if rng.random() < 0.5}
    from spanforge.plans import hit_queries as hq
    from spanforge.plans import tables

    some = tables.hits(spark, str(tmp_path)).filter(~F.col("gene_id").isin(sorted(bare)))
    one = tables.genes(spark, str(tmp_path)).withColumn("scaffold", F.col("scaffold") * 10 + F.col("gene_id") % 7)
    before = hq.hits, hq.genes, rq.hits
    try:
        hq.hits = rq.hits = lambda *_: some
        hq.genes = lambda *_: one
        want = {r.gene_id: r.n for r in validated(spark, str(tmp_path)).filter("status in ('validated', 'validated_novel')").groupBy("gene_id").agg(F.count(F.lit(1)).alias("n")).collect()}
        got = {r.gene_id: r.n for r in rq.production_markers(spark, str(tmp_path)).groupBy("gene_id").agg(F.sum("n_here").alias("n")).collect()}
    finally:
        hq.hits, hq.genes, rq.hits = before
    assert got == want and bare & set(got)


def test_near_pairs_of_long_and_short_records_by_one_join_on_starts(spark):
    import random

    from spanforge.operators import intervals as iv
    from spanforge.operators.neighbors import neighbour_scores

    rng, window = random.Random(31), 40
    spans = [(s := rng.randrange(600), s + rng.choice([0, 3, 10, 11, 60, 300])) for _ in range(150)]
    rows = [("g", i, *x, float(i % 7)) for i, x in enumerate(spans)]
    d = spark.createDataFrame(rows, "g string, i int, start bigint, end bigint, score double")
    r = d.select("g", F.col("i").alias("j"), F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    near = lambda a, b: min(abs(a[0] - b[0]), abs(a[1] - b[1]))
    want = sorted((i, j, near(a, b)) for i, a in enumerate(spans) for j, b in enumerate(spans) if near(a, b) <= window)
    joined = iv.near_join(d.drop("score"), r, ["g"], window)
    assert sorted((x.i, x.j, x.distance) for x in joined.collect()) == want
    # short records alone: a row on the left is copied to one bin, and one on the right to three at most
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("explode(sequence(") == 3 and "explode(array(" not in plan
    # an id without a row among the others, and ids with one; the row at hand and the looked up one agree
    others = d.filter("i % 3 > 0")
    mine = d.withColumn("own", F.when(F.col("i") % 3 > 0, F.col("score")))
    got = [{x.i: round(x.neighbour_score, 9) for x in neighbour_scores(mine, ["g"], "i", window, others=others, own=own, lone=True).collect()} for own in ("own", None)]
    plain = {i: round(sum(j % 7 for j, b in enumerate(spans) if j % 3 and j != i and near(a, b) <= window) / (window / 1000), 9) for i, a in enumerate(spans)}
    assert got == [plain, plain]


def test_anchor_seeds_are_scanned_from_a_stage_table(spark):
    plan = entry.queries()["anchor_seeds"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    # neither the line items nor the neighbours are read again for the summaries of the scans
    assert "l_orderkey" not in plan and "_near_sum" not in plan


def test_greedy_choice_asks_for_blocks_no_longer_than_a_record(spark):
    import random

    from spanforge.operators import selection as sel

    rng = random.Random(12)
    rows = [("s", s := 10**9 + rng.randrange(400), s + rng.choice([0, 1, 5, 30]), (float(rng.randrange(4)), i)) for i in range(120)]
    d = spark.createDataFrame(rows, "k string, start bigint, end bigint, rank struct<c:double,i:int>")
    assert sel.bits_for(d) == 5
    taken = []
    for _, s, e, r in sorted(rows, key=lambda x: x[3]):
        if s < e and not any(s < b and e > a for a, b, _ in taken):
            taken.append((s, e, r))
    got = sel.greedy_disjoint(d, ["k"], "rank", 64)
    assert got.columns == d.columns and sorted((x.start, x.end, tuple(x.rank)) for x in got.collect()) == sorted(taken)


def test_folded_ballots_equal_those_of_single_hits(spark):
    import random

    from spanforge.functions import hits as hx
    from spanforge.functions import text
    from spanforge.operators import hits as ho
    from spanforge.operators import votes as vt

    rng, prefixes = random.Random(15), ["EUK__", "NCLDV__", "GVMAG__", "PPV__", "MIRUS__", "BAC__"]
    hits = spark.createDataFrame([(g, j, p := rng.choice(prefixes), p + "x", float(rng.randrange(9)), rng.choice([10.0, 24.0, 26.0, 70.0]), 1e-9) for g in range(60) if g % 7 for j in range(rng.choice([1, 2, 12]))], "gene_id int, ordinal int, prefix string, target string, bits double, pident double, evalue double")
    genes = spark.createDataFrame([("g", g // 2 if g % 5 else None, g) for g in range(60)], "genome_id string, scaffold int, gene_id int")
    models = ["VP_MCP_1", "COG0532", "gamadvirusMCP", None]
    marks = spark.createDataFrame([(rng.randrange(64), rng.choice(models), rng.choice([10.0, 30.0, None]), 1, rng.choice([100, 299]), i) for i in range(70)], "gene_id int, model string, score double, q_start int, q_end int, ordinal int")
    second = spark.createDataFrame([(g, rng.choice(["PPV", "NCLDV"])) for g in range(0, 60, 3)], "gene_id int, vote string")
    ranked, keys = ho.rank_hits(hits), ["genome_id", "scaffold"]
    single = vt.mark_leads(ho.validate_markers(marks.join(genes, "gene_id"), ho.gene_hits(ranked), keys), []).select(
        "gene_id", "status", "lead", text.is_capsid(F.col("model")).alias("capsid"), hx.single_vote(hx.qualified_classes(F.col("top10"))).alias("vote")
    )
    cls = F.when(hx.qualifies(F.col("prefix"), F.col("pident")), hx.class_of_prefix(F.col("prefix"), F.lit(None).cast("string")))
    support = ho.marker_support(ranked, more=[hx.single_vote(F.collect_set(cls)).alias("vote")])
    want = sorted(map(repr, vt.gene_ballots(single, second).collect()))
    assert sorted(map(repr, vt.folded_ballots(marks, support, genes, second, keys).collect())) == want


def test_window_trim_moves_seeds_and_not_windows(spark, monkeypatch):
    import random

    from spanforge.operators import refine as rf

    rng = random.Random(8)
    seeds = [(i % 2, f"r{i}", s := rng.randrange(300), s + rng.choice([1, 7, 40, 160])) for i in range(40)]
    genes = [(i % 2, s := rng.randrange(450), s + rng.choice([0, 0, 1, 9, 30]), rng.choice([0.1, 0.3, 0.9]), rng.random() < 0.4) for i in range(160)]
    marks = [(i % 2, rng.randrange(450)) for i in range(12)]
    want = {}
    for g, r, a, b in seeds:
        rows = []
        for w in range(a, b, 5):
            e = min(w + 20, b)
            own = [(h, v) for k, s, t, h, v in genes if k == g and s < e and t > w]
            if own:
                hf, vf = sum(h >= 0.3 for h, _ in own) / len(own), sum(v for _, v in own) / len(own)
                rows.append((w, e, hf, vf, any(k == g and w <= m < e for k, m in marks)))
        good = [x for x in rows if x[2] <= 0.5 and x[3] >= 0.05]
        kind, pick = "no_windows" if not rows else "no_good_windows", []
        if good:
            mid = (a + b) // 2
            marked, middle = [x for x in good if x[4]], [x for x in good if x[0] <= mid < x[1]]
            kind, pick = ("marker_windows", marked) if marked else ("midpoint_windows", middle) if middle else ("best_window", [min(good, key=lambda x: (x[2], -x[3], x[0]))])
        want[r] = (max(a, min(x[0] for x in pick) - 10), min(b, max(x[1] for x in pick) + 10), kind) if pick else (a, b, kind)
    s = spark.createDataFrame(seeds, "g int, region_id string, start bigint, end bigint")
    d = spark.createDataFrame(genes, "g int, start bigint, end bigint, host_score double, viral boolean")
    m = spark.createDataFrame(marks, "g int, mid bigint")
    for lane in (4096, 3):
        monkeypatch.setattr(rf, "LANE", lane)
        out = rf.host_window_trim(s, d, m, ["g"], 64, size=20, step=5, buffer=10, max_host=0.5)
        assert {x.region_id: (x.start, x.end, x.reason) for x in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Join" in x and "w_start" in x]


def test_refinements_read_stage_rows_of_genes(spark):
    from spanforge.plans import region_queries as rq

    sf = "/root/testdata/sf0.001"
    for d in (rq.labelled_region_genes(spark, sf), rq.supported_genes(spark, sf), rq.host_edge_trim(spark, sf)):
        plan = d._jdf.queryExecution().optimizedPlan().toString()
        # neither hits nor tokens nor an earlier walk are worked out again where genes meet regions
        assert not [x for x in ("l_orderkey", "tokens", "_ahead") if x in plan]

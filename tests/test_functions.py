import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.functions import hits as hx
from spanforge.functions import seq as sq
from spanforge.functions import text
from spanforge.operators import composition as cp
from spanforge.operators import fingerprints as fp
from spanforge.operators import hits as ho
from spanforge.operators import votes as vt
from spanforge.sources import fasta, reports


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_capsid_names(spark):
    good = ["mcp", "OG1352", "GVOGm0003", "vp_mcp_1", "PLV_MCP_10", "mirus_mcp", "gamadvirusMCP", "mcp_poli", "VS000086"]
    bad = ["ncmcp_pseudoprotein", "Baculovirus mcp-like", "plv_mcp-x", "og13521", "", "vp_mc", "mcp2", "penton"]
    d = spark.createDataFrame([(n,) for n in good + bad], "n string")
    got = {r.n for r in d.filter(text.is_capsid(F.col("n"))).collect()}
    assert got == set(good)


def test_host_and_packaging_markers(spark):
    d = [text.is_host_marker(F.lit(x)) for x in ("COG0532", "12at2759", "cog1")] + [text.is_atpase(F.lit(x)) for x in ("PLV_PC_054", "VP_ATPase_2", "vp_mcp_1")]
    assert one(spark, *d) == (True, True, False, True, True, False)


def test_class_folding(spark):
    d = [text.published_class(F.lit(x)) for x in (" vp ", "PLV", "MIXED", "phage", "other", None)]
    assert one(spark, *d) == ("PPV", "PPV", "VIRAL_UNKNOWN", "PHAGE", "UNKNOWN", "UNKNOWN")
    g = lambda *a: text.gate_class(*[F.lit(x) for x in a])
    assert one(spark, g("HIGH", "MIXED", "", "NCLDV"), g("LOW", "NCLDV", "", ""), g("LOW", "", "MIRUS", ""), g("HIGH", "PHAGE", "", "MIXED")) == ("NCLDV", "UNKNOWN", "MIRUS", "MIXED")


def test_tokens_and_namespaces(spark):
    t = text.tokens_or_prefix(F.lit("EUK| Discosea|uncultured|ab|clade_X"), F.lit("EUK__EP1"))
    fall = text.tokens_or_prefix(F.lit("sp."), F.lit("EUK__EP1"))
    assert one(spark, t, fall) == (["euk", "discosea"], ["euk"])
    assert one(spark, text.organism(F.lit("EUK__A_b|p")), text.organism(F.lit("none")), text.known_prefix(F.lit("X__a")), text.folded_prefix(F.lit("MITO__a"))) == ("A_b", "unknown", "UNKNOWN", "EUK")
    assert one(spark, text.lineage_levels(F.lit("a0|b1|c2"))) == (["a0", "b1", "c2"],)


def test_longest_prefix_prefers_the_own_namespace(spark):
    labels = spark.createDataFrame([("EUK__EP1", "EUK|x"), ("EUK__EP1_a", "EUK|y"), ("PHAGE__z", "PHAGE|z"), ("PHAGE__VARDNA__q", "PHAGE|q")], "org_id string, lineage string")
    t = spark.createDataFrame([("EUK__EP1_a_b|p",), ("EUK__EP1_c|p",), ("PHAGE__VARDNA__z_1|p",), ("PHAGE__VARDNA__q_1|p",), ("NO__x_y|p",)], "target string")
    got = {r.target: r.org_id for r in ho.resolve_organisms(t, labels).collect()}
    assert list(got.values()).count("EUK__EP1_a") == 1 and got["EUK__EP1_c|p"] == "EUK__EP1"
    assert got["PHAGE__VARDNA__z_1|p"] == "PHAGE__z" and got["PHAGE__VARDNA__q_1|p"] == "PHAGE__VARDNA__q" and got["NO__x_y|p"] == "NO__x_y"


def test_namespace_migration_is_idempotent(spark):
    rows = [("VP__a", "VP|fam|VP__a"), ("PLV__a", "PLV|fam|PLV__a"), ("VP__b", "VP|VP_unclassified|VP__b"), ("EUK__a", "EUK|VPx")]
    first = ho.migrate_labels(spark.createDataFrame(rows, "org_id string, lineage string"))
    got = {r.org_id: (r.new_id, r.new_lineage) for r in first.collect()}
    assert got == {
        "VP__a": ("PPV__a__vpdup", "PPV|fam|PPV__a__vpdup"), "PLV__a": ("PPV__a", "PPV|fam|PPV__a"),
        "VP__b": ("PPV__b", "PPV|VP_unclassified|PPV__b"), "EUK__a": ("EUK__a", "EUK|VPx"),
    }
    again = ho.migrate_labels(first.select(F.col("new_id").alias("org_id"), F.col("new_lineage").alias("lineage")))
    assert all(r.org_id == r.new_id for r in again.collect())
    assert one(spark, text.migrate_header(F.lit("VP__a|p|q"), F.lit(True))) == ("PPV__a__vpdup|p|q",)


def test_headers(spark):
    ok = one(spark, fasta.gene_header(F.lit("c_1_7 # 143 # 456 # -1 # ID=1_7;x=y")), fasta.gene_header(F.lit("plain")), fasta.orf_header(F.lit("pORF_1|bin-7|NC_0.1:3-90_strand:-_frame:2")))
    assert tuple(ok[0]) == ("c_1", 142, 456, "-") and ok[1] is None and tuple(ok[2]) == ("pORF_1", "bin-7|NC_0.1", 3, 90, "-", 2)
    assert tuple(one(spark, fasta.frame_header(F.lit("c_x_frame=-2_offset=30")))[0]) == ("c_x", -2, 30)
    for bad in ("c # 0 # 4 # 1 # ID=1", "c # 5 # 4 # 1 # ID=1", "c # 1 # 4 # x # ID=1", "c # a # 4 # 1"):
        with pytest.raises(Exception, match="malformed gene header"):
            one(spark, fasta.gene_header(F.lit(bad)))


def test_residue_coordinates_and_translation(spark):
    f = lambda fr: sq.aa_to_nt(F.lit(2), F.lit(4), F.lit(100), F.lit(fr), F.lit(0))
    assert [tuple(x) for x in one(spark, f(1), f(3), f(4), f(-1))] == [(3, 12, "+"), (5, 14, "+"), (88, 97, "-"), (88, 97, "-")]
    assert one(spark, sq.translate_frame(F.lit("ATGGCNTAANNN"), 0), sq.translate_frame(F.lit("AT"), 0)) == ("MA*X", "")
    assert one(spark, sq.gc_content(F.lit("GGNN")), sq.gc_percent(F.lit("GGNN")), sq.gc_content(F.lit("NN")), sq.gc_percent(F.lit(""))) == (1.0, 50.0, 0.5, 0.0)


def test_kmers_and_distance_match_numpy(spark):
    rng = random.Random(3)
    bg = "".join(rng.choices("ACGTN", [5, 3, 3, 5, 1], k=3000))
    reg = "".join(rng.choices("ACGTRN", [2, 5, 5, 2, 1, 1], k=1500))

    def counts(s):
        out = {}
        for i in range(len(s) - 3):
            if "N" not in s[i : i + 4]:
                out[s[i : i + 4]] = out.get(s[i : i + 4], 0) + 1
        return out

    d = spark.createDataFrame([("g", "r", reg)], "genome string, id string, seq string")
    b = spark.createDataFrame([("g", bg)], "genome string, seq string")
    got = {r.kmer: r.cnt for r in cp.kmer_counts(d, ["genome", "id"]).collect()}
    assert got == counts(reg)
    import itertools

    bins = ["".join(x) for x in itertools.product("ACGT", repeat=4)]
    vec = lambda c: np.array([c.get(k, 0) / sum(c.values()) for k in bins]) + 1e-10
    p, q = vec(counts(reg)), vec(counts(bg))
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    want = np.sqrt((np.sum(p * np.log(p / m)) + np.sum(q * np.log(q / m))) / 2)
    audit = cp.composition_audit(d, ["genome", "id"], cp.kmer_counts(d, ["genome", "id"]), cp.kmer_counts(b, ["genome"]), cp.gc_background(b, "genome"), "genome")
    assert abs(audit.first().kfd - want) < 1e-9


def test_masks_and_lowercase_runs(spark):
    seq = "acgtACGTacgt" * 200
    d = spark.createDataFrame([("x", seq)], "id string, seq string")
    m = spark.createDataFrame([("x", 2, 5), ("x", 4, 9), ("x", 1000, 1400)], "id string, start bigint, end bigint")
    out = cp.join_tiles(cp.mask_records(d, m, "id", 64), "id", "masked").first()
    want = list(seq)
    for a, b in ((2, 9), (1000, 1400)):
        want[a:b] = "N" * (b - a)
    assert out.seq == "".join(want) and out.n_new == 407
    orig = spark.createDataFrame([("x", seq.upper()[:1200] + seq[1200:])], "id string, original string")
    runs = sorted((r.start, r.end) for r in reports.lowercase_runs(d, orig, "id").collect())
    flags = [a.islower() and a != b for a, b in zip(seq, seq.upper()[:1200] + seq[1200:])] + [False]
    want, start = [], None
    for i, f in enumerate(flags):
        if f and start is None:
            start = i
        elif not f and start is not None:
            want.append((start, i))
            start = None
    assert runs == want


def hits_of(spark, rows):
    d = spark.createDataFrame(rows, "gene_id string, target string, bits double, pident double, evalue double, ordinal bigint")
    return d.withColumn("prefix", text.known_prefix(F.col("target")))


def test_rank_ties_follow_file_order_and_validation(spark):
    rows = [("a", "EUK__x|1", 50.0, 90.0, 1e-9, 2), ("a", "NCLDV__y|1", 50.0, 24.96, 1e-9, 1), ("b", "NCLDV__y|1", 9.0, 25.0, 1e-9, 3), ("c", "GVMAG__y|1", 9.0, 80.0, 1e-9, 4)]
    ranked = ho.rank_hits(hits_of(spark, rows))
    assert {(r.gene_id, r.rank): r.target for r in ranked.collect()}[("a", 0)] == "NCLDV__y|1"
    m = spark.createDataFrame(
        [("g", "s", g, "vp_mcp_1", 40.0, 1e-9, 1, 200) for g in "abc"] + [("g", "s", "d", "vp_mcp_1", 40.0, 1e-9, 1, 149), ("g", "s", "e", "vp_mcp_1", 40.0, 1e-9, 1, 150), ("g", "lone", "f", "m", 90.0, 1e-9, 1, 300)],
        "genome_id string, scaffold string, gene_id string, model string, score double, evalue double, q_start int, q_end int",
    )
    got = {r.gene_id: r.status for r in ho.validate_markers(m, ho.gene_hits(ranked), ["genome_id", "scaffold"]).collect()}
    assert got == {"a": "unvalidated", "b": "validated", "c": "supported", "d": "unvalidated", "e": "validated_novel", "f": "unvalidated"}


def test_model_arbitration_outcomes(spark):
    marks = [(p, m, s, i) for p in "12345" for m, s, i in (("a", 100.0, 1), ("b", 90.0, 2))] + [("6", "a", 10.0, 3)]
    m = spark.createDataFrame(marks, "gene_id string, model string, score double, ordinal bigint")
    dom = spark.createDataFrame([("1", "A"), ("2", "B"), ("4", "S"), ("5", "wrong")], "gene_id string, domain string")
    ann = spark.createDataFrame([("a", ["A", "S"]), ("b", ["B", "S"])], "model string, required array<string>")
    out = ho.arbitrate_models(m, dom, ann)
    assert {r.gene_id: (r.outcome, r.final_model) for r in out.collect()} == {
        "1": ("confirmed", "a"), "2": ("reassigned", "b"), "3": ("unresolved_no_domain", "a"), "4": ("unresolved_shared_domain", "a"), "5": ("contradicted", None),
    }
    kept = sorted((r.gene_id, r.model) for r in ho.apply_arbitration(m, out).collect())
    assert kept == [("1", "a"), ("2", "b"), ("3", "a"), ("4", "a"), ("6", "a")]


def test_weighted_jaccard(spark):
    f = spark.createDataFrame([("x", "g", "euk", 5.0), ("x", "g", "fungi", 5.0), ("x", "h", "bact", 2.0)], "genome_id string, gene_id string, token string, weight double")
    b = spark.createDataFrame([("x", "fungi", 3.0), ("x", "plants", 1.0)], "genome_id string, token string, weight double")
    got = {r.gene_id: r.score for r in fp.jaccard(f, b, ["genome_id", "gene_id"], ["genome_id"], True).collect()}
    assert abs(got["g"] - 0.75 / 1.25) < 1e-12 and got["h"] == 0.0


def test_votes(spark):
    m = spark.createDataFrame(
        [(1, "a", "NCLDV", False, "validated", True), (2, "a", "PPV", True, "validated", True), (2, "b", "NCLDV", False, "validated", True), (3, "a", None, False, "validated_novel", True)],
        "region_id int, gene_id string, vote string, capsid boolean, status string, lead boolean",
    )
    g = spark.createDataFrame([(1, "a", "PPV"), (1, "b", "NCLDV"), (1, "c", "PPV"), (2, "b", "NCLDV"), (4, "z", "MIRUS"), (4, "y", "PPV"), (5, "q", None)], "region_id int, gene_id string, vote string")
    got = {r.region_id: r.taxonomy_class for r in vt.consensus_class(m, g, ["region_id"]).collect()}
    # 1: 3 for NCLDV against 2 is 60 percent; 4: a tie decides nothing
    assert got == {1: "NCLDV", 2: "PPV", 3: "VIRAL_UNKNOWN", 4: "VIRAL_UNKNOWN"}


def test_qualified_hits_need_identity(spark):
    arr = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(p).alias("prefix"), F.lit(x).alias("pident")) for i, (p, x) in enumerate([("EUK__", 90.0), ("VP__", 24.9), ("GVMAG__", 25.0)])])
    assert one(spark, hx.has_qualified_hit(arr), hx.qualified_classes(arr), hx.best_hit_bucket(arr, F.lit("EUK__x"), F.lit("EUK"))) == (True, ["NCLDV"], "GVMAG")


def test_four_decimals_of_the_exact_value(spark):
    """Doubles just below and just above the middle of two four-decimal numbers, the middle itself, missing ones."""
    values = [0.70875, 0.77125, 0.65775, 0.5, 0.03125, 0.00005, 0.99995, 1.0, None]
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", text.four_decimals(F.col("v")).alias("t"))
    assert [r.t for r in d.orderBy("i").collect()] == [None if v is None else f"{v:.4f}" for v in values]

"""Candidate confidence, tiers, acceptance gate and verdict rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

# Inputs of ``score`` and the value a missing one takes.
DEFAULTS = {
    "kfd": 0.0, "gc_deviation": 0.0, "cub_deviation": 0.0, "hallmark_count": 0, "hallmark_diversity": 0,
    "has_mcp": False, "complement_score": 0.0, "has_categories": False, "gene_count": 0, "viral_top10": 0,
    "ncldv_mirus_top10": 0, "viral_interior": 0, "dominant_fraction": 0.0, "structural_score": 0.0,
    "boundary_confidence": 0.0, "high_conf_euk": 0, "high_pident_euk": 0, "host_gene_count": 0, "host_fraction": 0.0,
    "interpro_score": 0.0, "ncldv_markers": 0, "vp_plv_markers": 0, "mirus_markers": 0, "family_consistency": 0.0,
    "completeness": 0.0, "ncldv_core": 0, "clustering_bonus": 0.0, "dist_viral": 0.0, "dist_genes": 0,
    "dist_baseline": 0, "dist_overlap": 0.0, "has_priority": False, "n_families": 0, "fold_bonus": 0.0,
}


def with_inputs(df: DataFrame) -> DataFrame:
    for name, value in DEFAULTS.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
        else:
            df = df.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    if "tm_score" not in df.columns:
        df = df.withColumn("tm_score", F.lit(None).cast("double"))
    return df


def capped(c: Column, top: float = 1.0) -> Column:
    return F.least(c, F.lit(top))


def marker_score() -> Column:
    mcp = F.col("has_mcp").cast("double")
    diversity = F.when(F.col("hallmark_count") > 0, capped(F.col("hallmark_diversity") / 5.0)).otherwise(F.lit(0.0))
    return F.when(
        F.col("has_categories"), 0.45 * mcp + 0.35 * F.col("complement_score") + 0.20 * diversity
    ).otherwise(0.50 * mcp + 0.30 * diversity + 0.20 * capped(F.col("hallmark_count") / 8.0))


def family_consistency(region: Column, taxonomy: Column, taxonomy_fraction: Column, marker: Column, complement: Column, domain_families: Column) -> Column:
    """Bonus when two or three evidence sources name one family."""
    known = ["NCLDV", "MIRUS", "PPV"]
    doms = F.array_distinct(F.filter(F.transform(domain_families, text.canonical_family), lambda f: f.isin(known)))
    r, t, m = text.canonical_family(region), text.canonical_family(taxonomy), text.canonical_family(marker)

    def votes(f: str) -> Column:
        return (
            (r == f).cast("int")
            + ((t == f) & (taxonomy_fraction >= 0.25)).cast("int")
            + ((m == f) & (complement > 0)).cast("int")
            + ((F.size(doms) == 1) & (F.coalesce(F.try_element_at(doms, F.lit(1)), F.lit("")) == f)).cast("int")
        )

    top = F.greatest(*[votes(f) for f in known])
    return F.when(top >= 3, 0.08).when(top == 2, 0.04).otherwise(F.lit(0.0))


def score(df: DataFrame, use_boundary: bool = False, composition: bool = True, host_threshold: float = 0.3, stage: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """Add the component scores and ``final_confidence``.

    ``composition=False`` is the counterfactual without the composition evidence.
    Everything is one projection chain; nothing is shuffled. Where the rows come out of a large
    plan, ``stage`` (such as ``cut``) parts the chain after the components, the sums and the raw score,
    so that no generated method gets too large to compile.
    """
    d = with_inputs(df)
    n = F.col("gene_count")
    per = F.nullif(n, F.lit(0))  # a divisor that is null rather than zero
    viral = F.when(F.col("viral_top10") > 0, F.col("viral_top10")).otherwise(F.col("ncldv_mirus_top10"))
    d = (
        d.withColumn("marker_score", marker_score())
        .withColumn(
            "composition_score",
            0.4 * capped(F.col("kfd") / 0.3) + 0.3 * capped(F.col("gc_deviation") / 0.15) + 0.3 * capped(F.col("cub_deviation") / 0.5),
        )
        .withColumn("viral_fraction", F.when(n > 0, capped(viral / per)).otherwise(F.lit(0.0)))
        .withColumn("gene_score", F.when(n > 0, capped(0.7 * F.col("viral_fraction") + 0.3 * F.col("dominant_fraction"))).otherwise(F.lit(0.0)))
        .withColumn(
            "structure",
            F.when(F.col("tm_score") > 0, F.greatest(F.lit(0.0), capped((F.col("tm_score") - 0.3) / 0.4))).otherwise(F.col("structural_score")),
        )
    )
    most = F.greatest("ncldv_markers", "vp_plv_markers", "mirus_markers")
    strong = (F.col("vp_plv_markers") >= 4) | (F.col("ncldv_markers") >= 3) | (F.col("mirus_markers") >= 3)
    d = stage(d.withColumn("seed_score", F.when(strong, 1.0).when(most >= 2, 0.5).otherwise(F.lit(0.0))))
    comp, mark, gene, seed = (F.col(c) for c in ("composition_score", "marker_score", "gene_score", "seed_score"))
    crf, inter, mcp = F.col("boundary_confidence"), F.col("interpro_score"), F.col("has_mcp")

    # penalties
    euk = F.when((n > 0) & (F.col("high_conf_euk") > 0), capped(F.col("high_conf_euk") / per * 0.20, 0.12)).otherwise(F.lit(0.0))
    broad = F.col("high_pident_euk") / per
    euk = F.when((n > 0) & (broad > 0.80) & (F.col("viral_fraction") < 0.10), F.greatest(euk, capped(broad * 0.12, 0.12))).otherwise(euk)
    excess = F.col("host_fraction") - host_threshold
    host = F.when((F.col("host_gene_count") > 0) & (F.col("host_fraction") >= host_threshold), capped(excess * 0.60, 0.18)).otherwise(F.lit(0.0))
    dist = F.col("dist_viral")
    ease = F.when(dist >= 0.4, capped(dist, 0.8)).otherwise(F.lit(0.0))
    size = F.when(mcp, 0.0).when(n <= 1, 0.15).when(n <= 2, 0.08).when(n <= 3, 0.04).otherwise(F.lit(0.0))
    penalty = euk * (1 - ease) + host * (1 - ease * 0.5) + size

    # weights
    w_crf = F.lit(0.0)
    if use_boundary:
        w_crf = F.when(n <= 2, 0.06).when(n <= 4, 0.12).otherwise(F.lit(0.18))
    w_comp = F.when(comp > 0, 0.18).otherwise(F.lit(0.0)) if composition else F.lit(0.0)
    total = w_crf + w_comp + 0.64  # 0.24 + 0.24 + 0.08 + 0.08 added one by one lands a bit beside it
    base = (w_crf * crf + w_comp * comp + 0.24 * mark + 0.24 * gene + 0.08 * inter + 0.08 * seed) / total

    # bonuses
    def bonus(cond: Column, value) -> Column:
        return F.when(cond, value).otherwise(F.lit(0.0))

    ratio, core = F.col("completeness"), F.col("ncldv_core")
    vf_bonus = F.col("viral_top10") / per
    divergence = 1 - F.greatest(F.lit(0.0), capped(F.col("dist_overlap")))
    families, priority = F.col("n_families"), F.col("has_priority")
    extra = (
        bonus((mark >= 0.6) & (gene >= 0.6), 0.04)
        + bonus((seed >= 1.0) & (inter >= 0.5), 0.03)
        + capped(F.col("family_consistency"), 0.05)
        + bonus(mcp, 0.05)
        + F.when(ratio >= 0.9, 0.60).when(ratio >= 0.7, 0.40).when(ratio >= 0.5, 0.20).otherwise(F.lit(0.0))
        + F.when(core >= 4, 0.20).when(core >= 3, 0.10).otherwise(F.lit(0.0))
        + F.greatest(F.lit(0.0), F.col("clustering_bonus"))
        + bonus(dist >= 0.6, capped((dist - 0.4) * 0.5, 0.15))
        + bonus(
            (F.col("dist_genes") > 0) & (F.col("dist_baseline") > 0) & (divergence >= 0.5),
            capped(0.05 + (divergence - 0.5) * 0.30, 0.20),
        )
        + bonus((n > 0) & (vf_bonus >= 0.15) & (F.col("host_fraction") < 0.10), capped(vf_bonus * 0.4, 0.12))
        + F.when(priority & (families >= 2), 0.08).when(priority & (families >= 1), 0.06).otherwise(F.lit(0.0))
        + F.greatest(F.lit(0.0), F.col("fold_bonus"))
    )
    if composition:
        extra = extra + bonus((crf >= 0.9) & (comp >= 0.6), 0.03)
    floor = F.when(priority & (families >= 2), 0.80).when(priority & (families >= 1), 0.70).when(priority, 0.55).otherwise(F.lit(0.0))
    cap = F.when((seed >= 1.0) & (gene >= 0.6) & (mark >= 0.6), 0.99).otherwise(F.lit(0.95))
    if composition:
        top = (comp >= 0.6) & (seed >= 1.0) & (gene >= 0.7) & (mark >= 0.7)
        if use_boundary:
            top = top & (crf >= 0.9)
        cap = F.when(top, 1.0).otherwise(cap)

    d = stage(d.withColumn("penalty", penalty).withColumn("weighted_base", base).withColumn("bonus_total", extra).withColumn("_floor", floor).withColumn("_cap", cap))
    raw = F.greatest(F.least(F.col("weighted_base") + F.col("bonus_total") + 0.15 * F.col("structure") - F.col("penalty"), F.col("_cap")), F.col("_floor"))
    evidence = F.when(F.col("viral_interior") > 0, F.col("viral_interior")).otherwise(F.col("viral_top10"))
    d = stage(d.withColumn("_raw", raw).drop("_floor", "_cap"))
    low = F.when((evidence == 0) & ~mcp, capped(F.col("_raw"), 0.05)).otherwise(F.col("_raw"))
    d = d.withColumn("_raw", low)
    low = F.when((n > 0) & ~mcp & (F.col("viral_fraction") < 0.05), capped(F.col("_raw"), 0.19)).otherwise(F.col("_raw"))
    return d.withColumn("final_confidence", F.greatest(F.lit(0.0), capped(low))).drop("_raw")


def tier_of(confidence: Column, high: float = 0.7, low: float = 0.2) -> Column:
    return F.when(confidence >= high, "HIGH").when(confidence >= low, "MEDIUM").otherwise("LOW")


def apply_policy(df: DataFrame, high: float = 0.7, low: float = 0.2) -> DataFrame:
    """Tier, promotion of priority markers, demotion of weakly seeded candidates."""
    conf = F.col("final_confidence")
    d = df.withColumn("confidence_tier", tier_of(conf, high, low))
    promoted = F.col("has_priority") & (F.col("confidence_tier") == "LOW")
    d = (
        d.withColumn("promoted", promoted)
        .withColumn("final_confidence", F.when(F.col("promoted"), F.greatest(conf, F.lit(low))).otherwise(conf))
        .withColumn("confidence_tier", F.when(F.col("promoted"), "MEDIUM").otherwise(F.col("confidence_tier")))
    )
    solid = (
        (F.col("hallmark_count") >= 3)
        | ((F.col("hallmark_count") >= 1) & F.col("has_mcp"))
        | (F.col("gene_count") - F.col("host_gene_count") >= 5)
    )
    other_seed = (F.size("sources") > 0) & ~F.array_contains("sources", "hhg")
    demoted = F.col("confidence_tier").isin("HIGH", "MEDIUM") & other_seed & ~solid
    return (
        d.withColumn("demoted", demoted)
        .withColumn("final_confidence", F.when(F.col("demoted"), F.least(conf, F.lit(low - 0.001))).otherwise(conf))
        .withColumn("confidence_tier", F.when(F.col("demoted"), "LOW").otherwise(F.col("confidence_tier")))
    )


def gate(tier: Column, cls: Column, length: Column, markers: Column, non_atpase: Column, mcp: Column, cress_support: Column) -> Column:
    """Acceptance decision as ``(kept, reason, promoted_low)``; ``cls`` is the gate class."""
    t = F.upper(F.coalesce(tier, F.lit("")))
    upper, lower = t.isin("HIGH", "MEDIUM"), t == "LOW"
    small = (length > 2000) & (mcp | ((markers >= 2) & (non_atpase >= 1)))
    cress = cress_support & (length > 0) & (markers >= 1)
    large = F.when(upper, (length > 5000) | mcp).otherwise((length > 5000) & (markers >= 2))
    kept = (
        F.when(cls.isin("MIXED", "PPV"), small).when(cls == "CRESS", cress).when(cls.isin("NCLDV", "MIRUS"), large).otherwise(F.lit(False))
    )
    kept = F.when(upper | lower, kept).otherwise(F.lit(False))
    name = (
        F.when(cls == "MIXED", "mixed").when(cls == "PPV", "small_dna").when(cls.isin("NCLDV", "MIRUS"), "ncldv_mirus").otherwise("cress_identity")
    )
    suffix = F.when(upper, F.when(kept, "_high_medium_pass").otherwise("_high_medium_gate")).otherwise(
        F.when(kept, "_low_promoted").otherwise("_low_gate")
    )
    reason = (
        F.when(~(upper | lower), "unsupported_tier")
        .when(~cls.isin("MIXED", "PPV", "CRESS", "NCLDV", "MIRUS"), F.when(upper, "unsupported_class").otherwise("low_unsupported_family"))
        .when((cls == "CRESS") & ~kept, "cress_identity_required")
        .otherwise(F.concat(name, suffix))
    )
    return F.struct(kept.alias("kept"), reason.alias("reason"), (kept & lower).alias("promoted_low"))


def contig_edge(start: Column, end: Column, contig_len: Column, buffer: int = 5000) -> tuple[Column, Column]:
    """Whether a candidate touches the left or right end of its contig."""
    known = contig_len > 0
    return known & (start < buffer), known & (contig_len - end < buffer)


# ------------------------------------------------------------- structure, fold


# fixed values: name fragments of viral structure targets
VIRAL_WORDS = ["virus", "viral", "phage", "ncldv", "mimivirus", "pandoravirus", "megavirus"]


def is_viral_target(target: Column, prefixes: list[str]) -> Column:
    return text.any_prefix(target, prefixes) | F.lower(target).rlike("|".join(VIRAL_WORDS))


def structure_score(tm: Column, evalue: Column) -> Column:
    """Evidence of the best viral structure hit."""
    e = F.when(evalue > 0, capped(-F.log10(evalue) / 20) * 0.3).otherwise(F.lit(0.3))
    return F.when(tm.isNotNull(), capped(tm) * 0.4 + e).otherwise(F.lit(0.0))


# fixed values: length ranges of double jelly-roll proteins and the score cut-off
DJR_MIN, DJR_BEST_LOW, DJR_BEST_HIGH = 400, 450, 550
SJR_MAX, SJR_BEST_LOW, SJR_BEST_HIGH = 350, 250, 320
EMBEDDING_CUTOFF = 0.3


def djr_length_confidence(n: Column) -> Column:
    return (
        F.when((n >= DJR_BEST_LOW) & (n <= DJR_BEST_HIGH), 1.0)
        .when(n > DJR_BEST_HIGH, F.greatest(F.lit(0.5), 1.0 - (n - DJR_BEST_HIGH) / 300))
        .when(n >= DJR_MIN, F.greatest(F.lit(0.6), 1.0 - (DJR_BEST_LOW - n) / 100))
        .otherwise(F.lit(0.0))
    )


def sjr_length_confidence(n: Column) -> Column:
    return (
        F.when((n >= SJR_BEST_LOW) & (n <= SJR_BEST_HIGH), 1.0)
        .when(n < SJR_BEST_LOW, F.greatest(F.lit(0.5), 1.0 - (SJR_BEST_LOW - n) / 100))
        .when(n <= SJR_MAX, F.greatest(F.lit(0.7), 1.0 - (n - SJR_BEST_HIGH) / 60))
        .otherwise(F.lit(0.0))
    )


def fold_call(n_jelly: Column, n_domains: Column, djr: Column, sjr: Column, hit_djr: Column, hit_sjr: Column, length: Column, model: Column) -> Column:
    """Fold of a capsid candidate from layered signals; the first signal decides."""
    plv = F.contains(F.lower(model), F.lit("plv_mcp"))

    def call(kind: str, confidence, evidence) -> Column:
        lit = lambda v: v if isinstance(v, Column) else F.lit(v)
        return F.struct(F.lit(kind).alias("fold"), lit(confidence).cast("double").alias("confidence"), lit(evidence).alias("evidence"))

    by_length = djr_length_confidence(length) * 0.6 + F.when(plv, 0.1).otherwise(F.lit(0.0))
    return (
        F.when(n_jelly >= 2, call("DJR", 0.95, "domains:2+"))
        .when(n_jelly == 1, call("DJR", 0.85, "domains:1"))
        .when(n_domains >= 2, call("DJR", 0.85, "profile_domains"))
        .when(djr > EMBEDDING_CUTOFF, call("DJR", F.least(F.lit(0.80), djr), "embedding"))
        .when(sjr > EMBEDDING_CUTOFF, call("SJR", F.least(F.lit(0.80), sjr), "embedding"))
        .when(hit_djr, call("DJR", 0.75, "structure"))
        .when(hit_sjr, call("SJR", 0.75, "structure"))
        .when(length > DJR_MIN, call("DJR", F.least(F.lit(1.0), by_length), "length"))
        .when(plv, call("DJR", 0.5, "plv_mcp_marker"))
        .otherwise(call("UNKNOWN", 0.0, "insufficient_evidence"))
    )


def fold_summary(records: DataFrame, keys: list[str], protein: str = "gene_id") -> DataFrame:
    """Counts, mean confidence and bonus per region from the best record per protein."""
    best = records.groupBy(*keys, protein).agg(
        F.max_by(F.struct("fold", "confidence"), F.struct("confidence", "fold")).alias("b")
    ).select(*keys, "b.*")
    is_djr = F.col("fold") == "DJR"
    d = best.groupBy(*keys).agg(
        F.count_if(is_djr).alias("djr"), F.count_if(F.col("fold") == "SJR").alias("sjr"), F.count(F.lit(1)).alias("total"),
        F.avg("confidence").alias("mean_confidence"), F.coalesce(F.avg(F.when(is_djr, F.col("confidence"))), F.lit(0.0)).alias("_dc"),
    )
    return d.withColumn("fold_bonus", capped(0.05 * F.col("djr") * F.col("_dc") * F.col("djr") / F.col("total"), 0.15)).drop("_dc")


# ------------------------------------------------------------- verdict


def neighbour_confidence(domain: Column, percent: Column, markers: Column, mcp: Column) -> Column:
    """Score of a nearest-neighbour classification."""
    more = capped(markers * 0.02, 0.2)
    viral = capped(percent / 100.0 + more + F.when(mcp > 0, 0.1).otherwise(F.lit(0.0)))
    unsure = 0.5 + F.when(markers > 0, more).otherwise(F.lit(0.0))
    return F.when(domain.isin("NCLDV", "MIRUS"), viral).when(domain.isin("BAC", "ARC", "EUK"), 0.1).otherwise(unsure)


def protein_confidence(with_hits: Column, viral: Column, cellular: Column) -> Column:
    """Score of a protein-level domain vote."""
    return (
        F.when(with_hits == 0, 0.5)
        .when(cellular > viral, F.greatest(F.lit(0.0), 0.5 - cellular / F.nullif(with_hits, F.lit(0)) * 0.5))
        .otherwise(viral / F.nullif(with_hits, F.lit(0)))
    )


def contamination(with_hits: Column, percent: Column) -> Column:
    return (
        F.when(with_hits == 0, 0.0).when(percent >= 90, 0.1).when(percent >= 70, 0.3).when(percent >= 50, 0.5).otherwise(F.lit(0.8))
    )


def verdict(nn_viral: Column, nn_score: Column, protein_viral: Column, protein_score: Column) -> Column:
    """``(score, verdict)`` from two optional classifiers (null means no answer)."""
    has_nn, has_p = nn_score.isNotNull(), protein_score.isNotNull()
    both = F.when(has_nn & has_p, 0.6 * nn_score + 0.4 * protein_score).otherwise(F.coalesce(nn_score, protein_score, F.lit(0.5)))
    a, b = nn_viral, protein_viral
    yes_a, no_a = a.eqNullSafe(True), a.eqNullSafe(False)
    yes_b, no_b = b.eqNullSafe(True), b.eqNullSafe(False)
    out = (
        F.when(yes_a & yes_b, F.when(both >= 0.8, "confirmed_viral").otherwise("likely_viral"))
        .when(yes_a & b.isNull(), F.when(nn_score >= 0.6, "likely_viral").otherwise("ambiguous"))
        .when(a.isNull() & yes_b, F.when(protein_score >= 0.6, "likely_viral").otherwise("ambiguous"))
        .when(no_a & no_b, F.when(both <= 0.2, "confirmed_non_viral").otherwise("likely_non_viral"))
        .when(no_a | no_b, F.when(both < 0.4, "likely_non_viral").otherwise("ambiguous"))
        .otherwise("ambiguous")
    )
    return F.struct(both.alias("score"), out.alias("verdict"))


def capsid_override(mcp: Column, markers: Column, categories: Column, keywords: Column) -> Column:
    """Capsid evidence that outweighs a rejecting verdict."""
    word = F.exists(keywords, lambda k: F.lower(k).rlike("capsid|mcp"))
    return (mcp & (markers >= 1)) | F.array_contains(categories, "capsid") | word

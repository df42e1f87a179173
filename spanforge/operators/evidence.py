"""Evidence co-occurrence per candidate and its coherence score."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# fixed values: evidence types that belong together, and virus-specific ones
EXPECTED = [
    ("hallmark_mcp", "high_kfd"), ("hallmark_polb", "high_kfd"), ("hallmark_mcp", "high_novelty"), ("hallmark_a32", "high_novelty"),
    ("crf_core_viral", "hallmark_mcp"), ("crf_core_viral", "high_kfd"), ("viral_structure", "hallmark_mcp"), ("viral_structure", "high_novelty"),
]
VIRUS_SPECIFIC = ["hallmark_mcp", "hallmark_a32", "hallmark_d5", "hallmark_vltf3"]


def co_occurrence(windows: DataFrame, reach: int = 1) -> DataFrame:
    """Weights of unordered type pairs in the same and in neighbouring windows.

    ``windows``: cand, idx, type.  A window holds at most one row per evidence type,
    so the pairs per window are bounded by the small vocabulary.
    """
    base = windows.select("cand", "idx", "type").distinct()
    other = base.select("cand", F.col("type").alias("t2"), F.explode(F.sequence(F.lit(0), F.lit(reach))).alias("d"), "idx")
    other = other.select("cand", (F.col("idx") - F.col("d")).alias("idx"), "t2", "d")
    pairs = base.join(other, ["cand", "idx"]).filter((F.col("type") != F.col("t2")) & ((F.col("d") > 0) | (F.col("type") < F.col("t2"))))
    return pairs.groupBy("cand", F.least("type", "t2").alias("u"), F.greatest("type", "t2").alias("v")).agg(
        F.sum(F.lit(1.0) / (F.col("d") + 1)).alias("weight")
    )


def coherence(windows: DataFrame, n_windows: DataFrame, reach: int = 1) -> DataFrame:
    """Score and level per candidate; ``n_windows`` is (cand, n)."""
    types = windows.groupBy("cand").agg(
        F.countDistinct("type").alias("n_types"),
        F.countDistinct(F.when(F.col("type").isin(VIRUS_SPECIFIC), F.col("type"))).alias("n_specific"),
        F.countDistinct(F.when(F.col("type").startswith("hallmark_"), F.col("type"))).alias("hallmark_diversity"),
    )
    edges = co_occurrence(windows, reach).join(n_windows, "cand")
    key = F.concat_ws("|", "u", "v")
    wanted = ["|".join(sorted(p)) for p in EXPECTED]
    agg = edges.groupBy("cand").agg(
        F.count(F.lit(1)).alias("n_edges"),
        F.sum(F.when(key.isin(wanted), 0.0375 * F.least(F.lit(1.0), F.col("weight") / F.col("n"))).otherwise(F.lit(0.0))).alias("bonus"),
    )
    d = types.join(agg, "cand", "left").fillna({"n_edges": 0, "bonus": 0.0})
    n = F.col("n_types")
    possible = F.nullif(n * (n - 1) / 2, F.lit(0.0))
    score = (
        F.least(F.lit(0.25), n / 20) + F.coalesce(0.25 * F.col("n_edges") / possible, F.lit(0.0)) + F.col("bonus") + 0.2 * F.col("n_specific") / 4
    )
    return d.withColumn("coherence", score).withColumn(
        "level", F.when(F.col("coherence") >= 0.7, "high").when(F.col("coherence") >= 0.5, "medium").when(F.col("coherence") >= 0.3, "low").otherwise("reject")
    )


def strongest(edges: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` heaviest pairs per candidate, ties by names."""
    w = Window.partitionBy("cand").orderBy(F.col("weight").desc(), "u", "v")
    return edges.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= k)


def evidence_profile(windows: DataFrame, n_windows: DataFrame) -> DataFrame:
    """Counts and coverage per evidence type, and windows with two or more types."""
    counts = windows.select("cand", "idx", "type").distinct().groupBy("cand", "type").agg(F.count(F.lit(1)).alias("n_seen"))
    return counts.join(n_windows, "cand").withColumn("coverage", F.col("n_seen") / F.col("n")).drop("n")

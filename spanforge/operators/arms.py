"""Counterfactual policy arms: one rule off, effects counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the arms and the rule each switches off
ARMS = {
    "A0": "none", "A1": "seed surface", "A2": "marker validation", "A3": "region extension", "A4": "host-aware coordinates",
    "A5": "composition evidence", "A6": "acceptance gate",
}


def _row(arm: str, opportunities: Column, changed: Column) -> Column:
    return F.struct(F.lit(arm).alias("arm"), opportunities.alias("opportunities"), changed.alias("changed"))


def arm_effects(cands: DataFrame) -> DataFrame:
    """Counts of A0, A5 and A6 from one pass over scored candidates.

    ``cands``: composition_score, reference, selected (score without composition), kept.
    """
    live = F.col("composition_score") > 0
    moved = live & (F.abs(F.col("reference") - F.col("selected")) > 1e-12)
    zero = F.lit(0).cast("bigint")
    one = cands.agg(
        F.count_if(live).alias("o5"), F.count_if(moved).alias("c5"), F.count(F.lit(1)).alias("o6"), F.count_if(~F.col("kept")).alias("c6")
    )
    return one.select(F.inline(F.array(_row("A0", zero, zero), _row("A5", F.col("o5"), F.col("c5")), _row("A6", F.col("o6"), F.col("c6")))))


def coordinate_effects(normal: DataFrame, ablated: DataFrame, arm: str, keys: list[str]) -> DataFrame:
    """Records whose coordinates differ between the normal rule and an arm (A1, A3, A4)."""
    b = ablated.select(*keys, F.col("start").alias("_s"), F.col("end").alias("_e"))
    d = normal.join(b, keys, "full")
    differs = ~(F.col("start").eqNullSafe(F.col("_s")) & F.col("end").eqNullSafe(F.col("_e")))
    return d.agg(F.count(F.lit(1)).alias("opportunities"), F.count_if(differs).alias("changed")).withColumn("arm", F.lit(arm))


def role_effects(roles: DataFrame) -> DataFrame:
    """Markers the validation arm (A2) keeps although the normal rule rejects them."""
    return roles.groupBy("arm").agg(F.count(F.lit(1)).alias("opportunities"), F.count_if(F.col("role") == "tier1_bypassed").alias("changed"))

"""Neighbours by distance and by ordinal."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .intervals import near_join, overlap_join, short_span
from .ordered import prefix_scan


def neighbour_scores(
    df: DataFrame, keys: Sequence[str], id_col: str, window: int, salt: int = 1, others: DataFrame | None = None, own: str | None = None, lone: bool = False
) -> DataFrame:
    """Sum of other records' scores within ``window``, per ``window / 1000`` units.

    The others are ``df`` itself or ``others``, which holds one scored row per id; the row
    of a record's own id never counts.  ``own`` names a column of ``df`` with the score of that row, null for
    none, where it is at hand.  Records without neighbours are left out, or kept with zero if ``lone``.
    Rows with equal bounds are folded before the join, so a pile of copies at one place meets its neighbours once.
    """
    every = df if others is None else others
    # stage tables, since the join reads each side by starts and by ends
    other = every.groupBy(*keys, F.col("start").alias("r_start"), F.col("end").alias("r_end")).agg(F.sum("score").alias("_r_sum"), F.count(F.lit(1)).alias("_r_n"))
    other = stage(other)
    places = other.select(*keys, F.col("r_start").alias("start"), F.col("r_end").alias("end")) if others is None else stage(df.select(*keys, "start", "end").distinct())
    long_left = not places.filter(~short_span(F.col("start"), F.col("end"), window)).isEmpty()
    long_right = not other.filter(~short_span(F.col("r_start"), F.col("r_end"), window)).isEmpty()
    near = (
        near_join(places, other, keys, window, salt=salt, long_left=long_left, long_right=long_right)
        .groupBy(*keys, "start", "end")
        .agg(F.sum("_r_sum").alias("_near_sum"), F.sum("_r_n").alias("_near_n"))
    )
    if others is None:
        d, mine = df.withColumn("_own", F.col("score")), F.lit(1)
    else:
        known = df.withColumn("_own", F.col(own)) if own else df.join(others.select(*keys, id_col, F.col("score").alias("_own")), [*keys, id_col], "left")
        d, mine = known, F.col("_own").isNotNull().cast("bigint")
    total = (F.col("_near_sum") - F.coalesce("_own", F.lit(0.0))) / (window / 1000)
    d = d.join(near, [*keys, "start", "end"], "left" if lone else "inner").withColumn("neighbours", F.coalesce("_near_n", F.lit(0)) - mine)
    some = F.col("neighbours") > 0
    d = d.withColumn("neighbour_score", F.when(some, total).otherwise(0.0))
    return (d if lone else d.filter(some)).drop("_near_n", "_near_sum", "_own")


def decayed_sum(value: str, reach: int) -> Callable:
    """Window expression: neighbours on both sides weighted by 1/distance."""

    def build(w) -> Column:
        total = F.lit(0.0)
        for d in range(1, reach + 1):
            both = F.coalesce(F.lag(value, d).over(w), F.lit(0.0)) + F.coalesce(F.lead(value, d).over(w), F.lit(0.0))
            total = total + both / F.lit(float(d))
        return total

    return build


def region_genes(
    regions: DataFrame, indexed: DataFrame, keys: Sequence[str], region_id: str, flank: int, width: int
) -> DataFrame:
    """Genes of each region and up to ``flank`` genes on either side.

    ``regions`` has ``r_start, r_end``; ``indexed`` carries ``gene_idx``.  Roles are
    interior, upstream, downstream; ``distance`` counts genes from the region.
    The ordinal range is joined like an interval, so a long region is not listed
    gene by gene before the join.
    """
    touched = (
        overlap_join(indexed.select(*keys, "start", "end", "gene_idx"), regions, keys, width)
        .groupBy(*keys, region_id)
        .agg(F.min("gene_idx").alias("first_idx"), F.max("gene_idx").alias("last_idx"))
    )
    lane = F.floor(F.col("gene_idx") / 256)
    spans = touched.withColumn(
        "_lane",
        F.explode(F.sequence(F.floor((F.col("first_idx") - flank) / 256), F.floor((F.col("last_idx") + flank) / 256))),
    )
    idx = F.col("gene_idx")
    return (
        indexed.withColumn("_lane", lane)
        .join(spans.hint("merge"), [*keys, "_lane"], "inner")
        .filter((idx >= F.col("first_idx") - flank) & (idx <= F.col("last_idx") + flank))
        .withColumn(
            "role",
            F.when(idx < F.col("first_idx"), "upstream").when(idx > F.col("last_idx"), "downstream").otherwise("interior"),
        )
        .withColumn(
            "distance",
            F.greatest(F.col("first_idx") - idx, idx - F.col("last_idx"), F.lit(0)).cast("bigint"),
        )
        .drop("_lane")
    )


def stretch_blocks(df: DataFrame, keys: Sequence[str], idx: str, size: int, chunk: int = 65536) -> DataFrame:
    """Blocks of ``size`` inside runs of consecutive ordinals.

    A run is named by ``ordinal - rank``, which is constant while ordinals rise by
    one; the block number counts from the start of the run.
    """
    d = prefix_scan(df, keys, idx, [idx], {"_rank": ("count", F.lit(1))}, chunk)
    d = d.withColumn("stretch", F.col(idx) - F.col("_rank")).drop("_rank")
    first = d.groupBy(*keys, "stretch").agg(F.min(idx).alias("_first"))
    return (
        d.join(first, [*keys, "stretch"], "inner")
        .withColumn("block", F.floor((F.col(idx) - F.col("_first")) / size))
        .drop("_first")
    )

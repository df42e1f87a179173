"""Run, genome and report summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from .ordered import prefix_scan


def medians(df: DataFrame, keys: Sequence[str], value: str, width: float) -> DataFrame:
    """Exact median per key.

    Equal values are folded to one row with a count, map-side first, so a value that most rows
    share is one row. The different values are scanned in chunks of ``width`` by running count;
    those that cover the middle one or two places make the median. Null values don't count.
    """
    keys = list(keys)
    folded = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    d = prefix_scan(folded, keys, value, [value], {"_before": ("sum", F.col("_c"))}, width)
    n = folded.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    before = F.coalesce("_before", F.lit(0))

    def covers(place: Column) -> Column:
        return ((place >= before) & (place < before + F.col("_c"))).cast("int")

    times = covers(F.floor((F.col("_n") - 1) / 2)) + covers(F.floor(F.col("_n") / 2))
    d = d.join(n, keys).withColumn("_times", times).filter("_times > 0")
    return d.groupBy(*keys).agg((F.sum(F.col(value) * F.col("_times")) / F.sum("_times")).alias("median"))


def run_summary(df: DataFrame) -> DataFrame:
    """Whole-genome and per-scaffold counts, lengths and confidences."""
    grains = []
    for keys in (["genome_id"], ["genome_id", "scaffold"]):
        counts = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("predictions"),
            F.count_if(F.col("confidence_tier") == "HIGH").alias("high"),
            F.count_if(F.col("confidence_tier") == "MEDIUM").alias("medium"),
            F.count_if(F.col("confidence_tier") == "LOW").alias("low"),
            F.sum(F.col("end") - F.col("start")).alias("total_length"),
            F.avg("final_confidence").alias("mean_confidence"),
        )
        d = counts.join(medians(df, keys, "final_confidence", 0.01), keys).withColumnRenamed("median", "median_confidence")
        grains.append(d.withColumn("is_total", F.lit(int(len(keys) == 1))))
    return grains[0].unionByName(grains[1], allowMissingColumns=True)


def batch_summary(df: DataFrame) -> DataFrame:
    """One row per genome with exclusive class counts of the accepted candidates."""
    kept = F.col("kept")
    counts = [F.count_if(kept & (F.col("published_class") == c)).alias(c.lower()) for c in vocab.PUBLISHED_CLASSES]
    return df.groupBy("genome_id").agg(
        F.count(F.lit(1)).alias("predictions"),
        F.count_if(kept).alias("accepted"),
        *[F.count_if(kept & (F.col("confidence_tier") == t)).alias(f"{t.lower()}_tier") for t in ("HIGH", "MEDIUM", "LOW")],
        *counts,
        F.coalesce(F.sum(F.when(kept, F.col("end") - F.col("start"))), F.lit(0)).alias("total_bp"),
    )


def length_statistics(df: DataFrame, keys: Sequence[str], length: str = "length", width: int = 64) -> DataFrame:
    d = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(length).alias("min_len"), F.max(length).alias("max_len"), F.avg(length).alias("mean_len")
    )
    return d.join(medians(df, keys, length, width), list(keys)).withColumnRenamed("median", "median_len")


def crosstab(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    return df.groupBy(row).pivot(col, list(values)).count().fillna(0)


def top_counts(df: DataFrame, item: str, k: int) -> DataFrame:
    return df.groupBy(item).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), item).limit(k)


def copy_numbers(df: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """Long copy-number matrix: count of each item per key."""
    return df.groupBy(*keys, item).agg(F.count(F.lit(1)).alias("copies"))


def share_of(df: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """Fraction of each item within its key."""
    c = df.groupBy(*keys, item).agg(F.count(F.lit(1)).alias("n"))
    total = c.groupBy(*keys).agg(F.sum("n").alias("_t"))
    return c.join(total, list(keys)).withColumn("fraction", F.col("n") / F.col("_t")).drop("_t")


def domain_summary(hits: DataFrame, keys: Sequence[str], viral_words: Sequence[str], organelle_words: Sequence[str], only: Sequence[str] | None = None) -> DataFrame:
    """Annotation hits per region: totals, keyword hits, categories and score.

    With ``only``, a hit that names any other category gives none at all.
    """
    from ..functions.text import keyword_tags

    words = {k: v for k, v in vocab.CATEGORY_KEYWORDS.items()}
    t = F.lower("text")

    def any_of(ws: Sequence[str]):
        out = F.lit(False)
        for w in ws:
            out = out | F.contains(t, F.lit(w))
        return out

    base = hits.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_hits"), F.count_if(any_of(viral_words)).alias("viral_hits"), F.count_if(any_of(organelle_words)).alias("organelle_hits")
    )
    tagged = hits.select(*keys, keyword_tags(F.col("text"), words).alias("_tags"))
    if only is not None:
        tagged = tagged.filter(F.size(F.array_except("_tags", F.array(*map(F.lit, only)))) == 0)
    cats = tagged.select(*keys, F.explode("_tags").alias("c")).distinct().groupBy(*keys).agg(F.array_sort(F.collect_set("c")).alias("categories"))
    d = base.join(cats, list(keys), "left").withColumn("categories", F.coalesce("categories", F.array().cast("array<string>")))
    return d.withColumn("category_score", F.least(F.size("categories") / 4.0, F.lit(1.0)))


def domain_vote(hits: DataFrame, keys: Sequence[str], query: str = "query") -> DataFrame:
    """Domain of each protein's best hit, counted per region; majority share and flags."""
    best = hits.groupBy(*keys, query).agg(F.max_by("domain", F.struct("bits", -F.col("ordinal"))).alias("domain"))
    c = best.groupBy(*keys, "domain").agg(F.count(F.lit(1)).alias("n"))
    d = c.groupBy(*keys).agg(
        F.sum("n").alias("with_hits"), F.min_by("domain", F.struct(-F.col("n"), F.col("domain"))).alias("best_domain"), F.max("n").alias("_b"),
        F.coalesce(F.sum(F.when(F.col("domain").isin("NCLDV", "PHAGE"), F.col("n"))), F.lit(0)).alias("viral"),
        F.coalesce(F.sum(F.when(F.col("domain").isin("BAC", "ARC", "EUK"), F.col("n"))), F.lit(0)).alias("cellular"),
    )
    d = d.withColumn("best_percent", 100.0 * F.col("_b") / F.col("with_hits")).drop("_b")
    return d.withColumn("is_viral", F.col("best_domain").isin("NCLDV", "PHAGE") & (F.col("best_percent") >= 50))

"""Weighted token fingerprints, host models and weighted Jaccard scores.

Fingerprints stay in long form, one row per (gene, token).  Both sides of a
comparison sum to one after normalising, so the union is two minus the overlap
and only matching tokens have to meet in the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hits as hx
from ..functions import text, vocab


def hit_tokens(resolved: DataFrame, min_len: int = 3, mode: str = "rank") -> DataFrame:
    """Explode hits into lineage tokens with their weights; a ``tokens`` column made per organism saves parsing every lineage again."""
    weighted = resolved.withColumn("weight", hx.hit_weight(F.col("rank"), F.col("bits"), mode)).filter("weight > 0")
    own = F.col("tokens") if "tokens" in resolved.columns else text.tokens_or_prefix(F.col("lineage"), F.col("org_id"), min_len)
    return weighted.withColumn("token", F.explode(own)).drop("tokens")


def fingerprint(tokens: DataFrame, keys: Sequence[str]) -> DataFrame:
    return tokens.groupBy(*keys, "token").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("cnt"))


def top_tokens(fp: DataFrame, keys: Sequence[str], k: int = 20) -> DataFrame:
    """The ``k`` heaviest tokens per key as ``token:weight`` text; ties by token."""
    w = Window.partitionBy(*keys).orderBy(F.col("weight").desc(), F.col("token"))
    top = fp.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
    item = F.struct(F.col("_rn"), F.format_string("%s:%.2f", F.col("token"), F.col("weight")).alias("t"))
    return top.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["t"]), ",").alias("tokens")
    )


def host_model_hits(markers: DataFrame, ranked: DataFrame, summary: DataFrame | None = None, host_prefix: str = "EUK__") -> DataFrame:
    """Host hits of host markers whose gene shows no viral namespace, ranked anew.

    Rows repeat per marker, since every marker of a gene adds to the model. Without a
    ``summary`` the namespaces of a gene are read from ``ranked``, without its list of hits.
    """
    if summary is None:
        seen = ranked.groupBy("gene_id").agg(F.bool_or(F.col("prefix") == host_prefix).alias("_h"), F.bool_or(F.col("prefix").isin(vocab.HOST_MODEL_EXCLUDED)).alias("_x"))
        clean = seen.filter(F.col("_h") & ~F.col("_x")).select("gene_id")
    else:
        clean = summary.filter(
            F.exists("top10", lambda h: h["prefix"] == host_prefix)
            & ~F.exists("top10", lambda h: h["prefix"].isin(vocab.HOST_MODEL_EXCLUDED))
        ).select("gene_id")
    host_markers = markers.filter(text.is_host_marker(F.col("model"))).join(clean, "gene_id", "left_semi")
    w = Window.partitionBy("gene_id").orderBy("rank")
    host_hits = ranked.filter(F.col("prefix") == host_prefix).withColumn("rank", F.row_number().over(w) - 1)
    return host_markers.select("genome_id", "gene_id").join(host_hits, "gene_id")


def host_model(tokens: DataFrame, genome: str = "genome_id", top_weights: int | None = 10) -> DataFrame:
    """Token weights, counts and the largest single weights per genome; without the latter for None.

    The largest weights are picked by a limited rank, so a token carried by most
    rows is never gathered whole.
    """
    informative = tokens.filter(~F.col("token").isin(vocab.DOMAIN_TOKENS))
    sums = fingerprint(informative, [genome])
    if top_weights is None:
        return sums
    w = Window.partitionBy(genome, "token").orderBy(F.col("weight").desc())
    top = (
        informative.select(genome, "token", "weight")
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= top_weights)
        .groupBy(genome, "token")
        .agg(F.sort_array(F.collect_list("weight"), asc=False).alias("top_weights"))
    )
    return sums.join(top, [genome, "token"])


def normalised(fp: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    total = fp.groupBy(*keys).agg(F.sum("weight").alias("_total")).filter("_total > 0")
    return fp.join(total, list(keys)).select(*keys, "token", (F.col("weight") / F.col("_total")).alias(out))


def jaccard(
    fp: DataFrame, base: DataFrame, keys: Sequence[str], base_keys: Sequence[str], drop_domains: bool, out: str = "score"
) -> DataFrame:
    """Weighted Jaccard of each fingerprint with the base of its ``base_keys``.

    A key has one row per token, so its total is a window over few rows and ``fp`` is read once.
    """
    if drop_domains:
        fp = fp.filter(~F.col("token").isin(vocab.DOMAIN_TOKENS))
        base = base.filter(~F.col("token").isin(vocab.DOMAIN_TOKENS))
    total = F.sum("weight").over(Window.partitionBy(*keys))
    left = fp.select(*keys, "token", "weight", total.alias("_total"))
    share = F.when(F.col("_total") > 0, F.col("weight") / F.col("_total"))
    right = normalised(base, base_keys, "_h")
    # a token outside the base has no overlap; a plain least() would pass over its null
    overlap = F.coalesce(F.sum(F.when(F.col("_h").isNotNull() & share.isNotNull(), F.least(share, F.col("_h")))), F.lit(0.0))
    shared = left.join(right, [*base_keys, "token"], "left").groupBy(*keys).agg(overlap.alias("_overlap"))
    return shared.select(*keys, (F.col("_overlap") / (2 - F.col("_overlap"))).alias(out))


def baseline(fp: DataFrame, host_genes: DataFrame, genome: str = "genome_id", min_genes: int = 3, min_weight: float = 0.10) -> DataFrame:
    """Tokens frequent and heavy enough among the control genes of a genome."""
    host = fp.join(host_genes.select(genome, "gene_id"), [genome, "gene_id"], "left_semi")
    n = host.groupBy(genome).agg(F.countDistinct("gene_id").alias("_n")).filter(F.col("_n") >= min_genes)
    tok = host.groupBy(genome, "token").agg(F.count(F.lit(1)).alias("_c"), F.avg("weight").alias("_w"))
    return (
        tok.filter(F.col("_c") >= min_genes)
        .join(n, genome)
        .withColumn("weight", F.col("_c") / F.col("_n") * F.col("_w"))
        .filter(F.col("weight") >= min_weight)
        .select(genome, "token", "weight")
    )


def consensus_lineage(resolved: DataFrame, keys: Sequence[str], min_len: int = 3, mode: str = "rank") -> DataFrame:
    """Heaviest token per lineage level, joined until the first empty level."""
    w = resolved.withColumn("weight", hx.hit_weight(F.col("rank"), F.col("bits"), mode)).filter(
        (F.col("weight") > 0) & F.col("lineage").isNotNull()
    )
    levels = w.select(*keys, "weight", F.posexplode(text.lineage_levels(F.col("lineage"))).alias("level", "token"))
    sums = levels.filter(F.length("token") >= min_len).groupBy(*keys, "level", "token").agg(F.sum("weight").alias("w"))
    best = sums.groupBy(*keys, "level").agg(F.min_by("token", F.struct(-F.col("w"), F.col("token"))).alias("token"))
    # a level counts only while all levels above it are present
    rows = F.array_sort(F.collect_list(F.struct("level", "token")))
    prefix = F.filter(rows, lambda x, i: x["level"] == i)
    return best.groupBy(*keys).agg(F.array_join(F.transform(prefix, lambda x: x["token"]), "|").alias("consensus"))


def control_stats(genes: DataFrame, genome: str = "genome_id", host_prefix: str = "EUK__") -> DataFrame:
    """No-hit and host rates, mean host identity and the modal host organism."""
    is_host = F.coalesce(F.col("top1_prefix") == host_prefix, F.lit(False))
    org = genes.filter(is_host).groupBy(genome, text.organism(F.col("top1_target")).alias("organism")).agg(F.count(F.lit(1)).alias("n"))
    modal = org.groupBy(genome).agg(F.min_by("organism", F.struct(-F.col("n"), F.col("organism"))).alias("dominant_organism"))
    stats = genes.groupBy(genome).agg(
        F.count(F.lit(1)).alias("n_genes"),
        F.count_if(~F.col("has_hit")).alias("n_no_hits"),
        F.avg((~F.col("has_hit")).cast("double")).alias("no_hit_frequency"),
        F.avg(is_host.cast("double")).alias("host_frequency"),
        F.coalesce(F.avg(F.when(is_host, F.col("top1_pident"))), F.lit(0.0)).alias("mean_pident"),
    )
    return stats.join(modal, genome, "left").fillna("unknown", ["dominant_organism"])


def host_density(scored: DataFrame, keys: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Host-like count, mean score and -ln(evalue)-weighted mean per group.

    ``scored`` has ``score`` (null without a fingerprint), ``has_host`` and
    ``top1_evalue``.
    """
    e = F.coalesce(F.col("top1_evalue"), F.lit(1.0))
    weight = F.when(F.col("score").isNotNull(), F.greatest(F.lit(0.0), -F.log(F.when(e <= 0, F.lit(1e-300)).otherwise(e))))
    total = F.sum(weight)
    return scored.groupBy(*keys).agg(
        F.count_if((F.col("score") >= threshold) & F.col("has_host")).alias("host_like"),
        F.avg(F.coalesce("score", F.lit(0.0))).alias("mean_score"),
        F.when(total > 0, F.sum(F.col("score") * weight) / total).otherwise(F.lit(0.0)).alias("weighted_mean"),
    )

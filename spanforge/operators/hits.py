"""Ranked hits: top-k, per-gene summaries, validation, arbitration, lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hits as hx
from ..functions import text, vocab


def rank_hits(hits: DataFrame, key: str = "gene_id", k: int | None = 10) -> DataFrame:
    """Zero-based rank by bit score, file order breaking ties; keeps the first ``k``.

    The rank filter turns into a group limit before the shuffle, so a gene with
    very many hits sends at most ``k`` of them per task.
    """
    w = Window.partitionBy(key).orderBy(F.col("bits").desc(), F.col("ordinal"))
    ranked = hits.withColumn("_rn", F.row_number().over(w))
    if k is not None:
        ranked = ranked.filter(F.col("_rn") <= k)
    return ranked.withColumn("rank", F.col("_rn") - 1).drop("_rn")


def gene_hits(ranked: DataFrame, key: str = "gene_id") -> DataFrame:
    """One row per gene: the top-10 array plus flags over it (at most ten rows each)."""
    p = F.col("prefix")

    def has(*names: str) -> Column:
        return F.coalesce(F.bool_or(p.isin(*names)), F.lit(False))

    best = F.struct(F.col("rank"))
    fields = ["rank", "target", "prefix", "bits", "pident", "evalue"]
    return ranked.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("top10"),
        F.count(F.lit(1)).alias("n_hits"),
        F.min_by("target", best).alias("top1_target"),
        F.min_by("pident", best).alias("top1_pident"),
        F.min_by("bits", best).alias("top1_bits"),
        F.min_by("evalue", best).alias("top1_evalue"),
        has("NCLDV__").alias("has_ncldv"),
        has("MIRUS__").alias("has_mirus"),
        has("PLV__", "PPV__").alias("has_plv"),
        has("VP__").alias("has_vp"),
        has("GVMAG__").alias("has_gvmag"),
        has(*vocab.VIRAL_PREFIXES).alias("has_viral"),
        F.coalesce(F.bool_or(hx.qualifies(p, F.col("pident"))), F.lit(False)).alias("has_qualified"),
        F.coalesce(F.max(F.when(p.isin(vocab.VALIDATED_PREFIXES), F.col("pident"))), F.lit(0.0)).alias("max_validated_pident"),
    )


def gene_support(ranked: DataFrame, key: str = "gene_id", host_prefix: str = "EUK__") -> DataFrame:
    """One row per gene of sums, flags and best-hit values of its ranked hits, without its list of hits.

    Every value has a fixed width, so the aggregate is a hash aggregate with a map side.
    """
    p = F.col("prefix")
    host, viral, first = p == host_prefix, hx.qualifies(p, F.col("pident")), F.col("rank") == 0
    weight = hx.hit_weight(F.col("rank"), F.col("bits"))

    def has(*names: str) -> Column:
        return F.coalesce(F.bool_or(p.isin(*names)), F.lit(False))

    return ranked.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.count_if(host).alias("n_host"),
        F.count_if(viral).alias("n_viral"),
        F.sum(F.when(host, weight).otherwise(0.0)).alias("host_rank_score"),
        F.sum(F.when(viral, weight).otherwise(0.0)).alias("viral_rank_score"),
        F.sum("bits").alias("sum_bits"),
        F.max(F.when(first, F.col("pident"))).alias("top1_pident"),
        F.max(F.when(first, F.col("evalue"))).alias("top1_evalue"),
        F.coalesce(F.bool_or(first & host), F.lit(False)).alias("top1_is_host"),
        has("NCLDV__").alias("has_ncldv"),
        has("MIRUS__").alias("has_mirus"),
        has("PLV__", "PPV__").alias("has_plv"),
        has("VP__").alias("has_vp"),
        has(*vocab.VIRAL_PREFIXES).alias("has_viral"),
        (F.count_if(viral) > 0).alias("has_qualified"),
    )


def marker_support(ranked: DataFrame, key: str = "gene_id", more: Sequence[Column] = ()) -> DataFrame:
    """One row per gene of what the status of its profile hits asks for, without its list of hits; ``more`` aggregates may follow."""
    p = F.col("prefix")
    return ranked.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.coalesce(F.max(F.when(p.isin(vocab.VALIDATED_PREFIXES), F.col("pident"))), F.lit(0.0)).alias("max_validated_pident"),
        F.coalesce(F.bool_or(p == "GVMAG__"), F.lit(False)).alias("has_gvmag"),
        F.coalesce(F.bool_or(hx.supports_cress(p, F.col("pident"))), F.lit(False)).alias("has_cress"),
        *more,
    )


def with_no_hits(genes: DataFrame, summary: DataFrame, key: str = "gene_id") -> DataFrame:
    """Every gene, the ones without hits marked and defaulted."""
    flags = [c for c, t in summary.dtypes if t == "boolean"]
    d = genes.join(summary, key, "left").withColumn("has_hit", F.col("n_hits").isNotNull())
    return d.fillna({**{f: False for f in flags}, "n_hits": 0})


def best_profile_hits(markers: DataFrame, key: str = "gene_id", min_score: float = 50.0, max_evalue: float = 1e-5) -> DataFrame:
    """Anchors: best hit per gene (first of equals), kept when strong enough."""
    return best_and_first_hits(markers, key, min_score, max_evalue).filter("strong").drop("strong", "first_score")


def best_and_first_hits(markers: DataFrame, key: str = "gene_id", min_score: float = 50.0, max_evalue: float = 1e-5) -> DataFrame:
    """Best hit of every gene, whether it is ``strong`` enough for an anchor, and the score of the first one by position."""
    best = F.max_by(F.struct("model", "score", "evalue", "q_start", "q_end"), F.struct(F.col("score"), -F.col("ordinal")))
    strong = (F.col("score") >= min_score) & (F.col("evalue") <= max_evalue)
    return markers.groupBy(key).agg(best.alias("b"), F.min_by("score", "ordinal").alias("first_score")).select(key, "b.*", "first_score").withColumn("strong", strong)


def prefer_capsid(markers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One marker per gene: capsid first, then score, then input order."""
    rest = [c for c in markers.columns if c not in keys]
    order = F.struct(text.is_capsid(F.col("model")), F.col("score"), -F.col("ordinal"))
    return markers.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("b")).select(*keys, "b.*")


def validate_markers(markers: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Status of every profile hit from its gene's top-10 hits.

    ``markers`` carries the scaffold keys; a gene without hits needs another
    profile hit on its scaffold to count as novel.
    """
    per_scaffold = markers.groupBy(*keys).agg(F.count(F.lit(1)).alias("_near"))
    d = with_no_hits(markers, summary).join(per_scaffold, list(keys), "left")
    return with_status(d, F.col("_near") > 1).drop("_near")


def coverage(q_start: Column, q_end: Column) -> Column:
    return F.least(F.lit(1.0), (q_end - q_start + 1) / 300.0)


def with_status(markers: DataFrame, nearby: Column) -> DataFrame:
    """Add ``coverage`` and ``status`` to profile hits with their gene's summary; ``nearby`` tells whether another one is on the scaffold."""
    return markers.withColumn("coverage", coverage(F.col("q_start"), F.col("q_end"))).withColumn(
        "status",
        hx.validation_status(F.col("n_hits"), F.col("max_validated_pident"), F.col("has_gvmag"), F.col("score"), F.col("coverage"), nearby),
    )


def arbitrate_models(markers: DataFrame, domains: DataFrame, annotations: DataFrame, key: str = "gene_id") -> DataFrame:
    """Outcome per protein hit by two or more models.

    ``domains`` is (key, domain), ``annotations`` (model, required ARRAY).  The last
    hit of a (protein, model) pair counts.
    """
    last = markers.groupBy(key, "model").agg(F.max_by("score", "ordinal").alias("score"))
    n_models = last.groupBy(key).agg(F.count(F.lit(1)).alias("_m")).filter("_m >= 2").select(key)
    last = last.join(n_models, key, "left_semi")
    seen = domains.select(key, "domain").distinct().join(n_models, key, "left_semi")
    needed = annotations.select("model", F.explode("required").alias("domain"))
    met = (
        last.join(needed, "model")
        .join(seen, [key, "domain"], "left_semi")
        .groupBy(key)
        .agg(F.countDistinct("model").alias("n_ok"), F.min("model").alias("only_ok"))
    )
    observed = seen.groupBy(key).agg(F.count(F.lit(1)).alias("n_observed"))
    original = last.groupBy(key).agg(
        F.min_by("model", F.struct(-F.col("score"), F.col("model"))).alias("original_model"),
        F.count(F.lit(1)).alias("n_models"),
    )
    d = original.join(observed, key, "left").join(met, key, "left").fillna(0, ["n_observed", "n_ok"])
    outcome = (
        F.when(F.col("n_observed") == 0, "unresolved_no_domain")
        .when((F.col("n_ok") == 1) & (F.col("only_ok") == F.col("original_model")), "confirmed")
        .when(F.col("n_ok") == 1, "reassigned")
        .when(F.col("n_ok") > 1, "unresolved_shared_domain")
        .otherwise("contradicted")
    )
    return (
        d.withColumn("outcome", outcome)
        .withColumn(
            "final_model",
            F.when(F.col("outcome") == "contradicted", None)
            .when(F.col("n_ok") == 1, F.col("only_ok"))
            .otherwise(F.col("original_model")),
        )
        .select(key, "n_models", "original_model", "final_model", "outcome")
    )


def apply_arbitration(markers: DataFrame, outcomes: DataFrame, key: str = "gene_id") -> DataFrame:
    """Drop the hits an arbitration decided against; keep the last hit of the winner."""
    last = markers.groupBy(key, "model").agg(F.max("ordinal").alias("_o"))
    d = markers.join(last, [key, "model"]).withColumn("_last", F.col("ordinal") == F.col("_o")).drop("_o")
    d = d.join(outcomes.select(key, "final_model", "outcome"), key, "left")
    chosen = F.col("_last") & (F.col("model") == F.col("final_model"))
    return d.filter(F.col("outcome").isNull() | F.coalesce(chosen, F.lit(False))).drop("_last", "final_model", "outcome")


def query_coverage(hits: DataFrame, key: str = "gene_id") -> DataFrame:
    """Largest coverage among hits in a validated namespace with enough identity."""
    good = F.col("prefix").isin(vocab.VALIDATED_PREFIXES) & (F.col("pident") >= vocab.MIN_VIRAL_PIDENT)
    return hits.groupBy(key).agg(F.max(F.when(good, F.col("qcov"))).alias("max_qcov"))


def resolve_organisms(
    targets: DataFrame, labels: DataFrame, column: str = "target", every: DataFrame | None = None, tokens: bool = False
) -> DataFrame:
    """Add ``org_id`` and ``lineage`` by longest-prefix match, and the ``tokens`` of the lineage on request.

    Only distinct organism names are expanded into candidate prefixes, so the work
    follows the number of organisms, not of hits. ``every`` is a plainer table with all
    values of ``column``, read for the names where ``targets`` is costly to make twice.
    """
    org = F.split_part(F.col(column), F.lit("|"), F.lit(1))
    d = targets.withColumn("_org", org)
    names = (targets if every is None else every).select(org.alias("_org")).distinct()
    legacy = F.lit("PHAGE__VARDNA__")
    bases = F.when(
        F.col("_org").startswith("PHAGE__VARDNA__"),
        F.array(F.col("_org"), F.concat(F.lit("PHAGE__"), F.substring(F.col("_org"), F.length(legacy) + 1, F.length("_org")))),
    ).otherwise(F.array("_org"))
    b = names.select("_org", F.posexplode(bases).alias("_base_no", "_base"))
    head = F.split_part(F.col("_base"), F.lit("__"), F.lit(1))
    suffix = F.regexp_extract(F.col("_base"), r"(?s)^.*?__(.*)$", 1)
    parts = F.split(suffix, "_")
    shorter = F.when(
        F.contains(F.col("_base"), F.lit("__")) & (F.size(parts) > 1),
        F.transform(
            F.sequence(F.size(parts) - 1, F.lit(1)),
            lambda n: F.struct(n.alias("n"), F.concat(head, F.lit("__"), F.array_join(F.slice(parts, 1, n), "_")).alias("id")),
        ),
    ).otherwise(F.array().cast("array<struct<n:int,id:string>>"))
    whole = F.array(F.struct(F.lit(2147483647).alias("n"), F.col("_base").alias("id")))
    cand = b.select("_org", "_base_no", F.explode(F.concat(whole, shorter)).alias("c")).select("_org", "_base_no", "c.n", "c.id")
    found = (
        cand.join(labels.select(F.col("org_id").alias("id"), "lineage"), "id")
        .groupBy("_org")
        .agg(F.min_by(F.struct("id", "lineage"), F.struct(F.col("_base_no"), -F.col("n"))).alias("f"))
    )
    if tokens:
        found = found.withColumn("_tokens", text.tokens_or_prefix(F.col("f.lineage"), F.col("f.id")))
    d = d.join(found, "_org", "left").withColumn("org_id", F.coalesce(F.col("f.id"), F.col("_org"))).withColumn("lineage", F.col("f.lineage"))
    if tokens:
        d = d.withColumn("tokens", F.coalesce("_tokens", text.tokens_or_prefix(F.col("lineage"), F.col("org_id")))).drop("_tokens")
    return d.drop("f", "_org")


def migrate_labels(labels: DataFrame) -> DataFrame:
    """Fold the old ``VP__``/``PLV__`` namespaces of ids and lineages into ``PPV__``."""
    acc = F.regexp_replace(F.col("org_id"), r"^(VP|PLV)__", "")
    vp = labels.filter(F.col("org_id").startswith("VP__")).select(acc.alias("acc"))
    plv = labels.filter(F.col("org_id").startswith("PLV__")).select(acc.alias("acc"))
    both = vp.intersect(plv).withColumn("_dup", F.lit(True))
    tokens = labels.select("org_id", F.posexplode(F.split("lineage", r"\|")).alias("pos", "tok"))
    tokens = tokens.withColumn("acc", F.regexp_replace("tok", r"^(VP|PLV)__", "")).join(both, "acc", "left")
    new_tok = F.when(F.col("tok").isin("VP", "PLV"), "PPV").otherwise(text.migrate_id(F.col("tok"), F.coalesce("_dup", F.lit(False))))
    lineages = tokens.groupBy("org_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("pos"), new_tok.alias("t")))), lambda x: x["t"]), "|").alias("new_lineage")
    )
    ids = labels.select("org_id", acc.alias("acc")).join(both, "acc", "left")
    return ids.join(lineages, "org_id").select(
        "org_id", text.migrate_id(F.col("org_id"), F.coalesce("_dup", F.lit(False))).alias("new_id"), "new_lineage"
    )

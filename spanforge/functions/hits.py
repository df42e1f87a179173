"""Expressions over ranked-hit arrays.

A gene carries ``top10 ARRAY<STRUCT<rank, target, prefix, bits, pident, evalue>>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab
from .text import is_capsid


def hit_weight(rank: Column, bits: Column, mode: str = "rank") -> Column:
    """``max(0, 10 - rank)`` for zero-based ranks, or the bit score."""
    if mode.lower() == "rank":
        return F.greatest(F.lit(0.0), F.lit(10.0) - rank)
    return F.coalesce(bits, F.lit(0.0)).cast("double")


def qualifies(prefix: Column, pident: Column) -> Column:
    return prefix.isin(vocab.VIRAL_PREFIXES) & (pident >= vocab.MIN_VIRAL_PIDENT)


def has_qualified_hit(top10: Column) -> Column:
    return F.exists(top10, lambda h: qualifies(h["prefix"], h["pident"]))


def qualified_classes(top10: Column) -> Column:
    """Distinct published classes of the qualified hits; phages stay phages."""
    good = F.filter(top10, lambda h: qualifies(h["prefix"], h["pident"]))
    return F.array_distinct(F.transform(good, lambda h: class_of_prefix(h["prefix"], F.lit(None).cast("string"))))


def class_of_prefix(prefix: Column, lineage: Column) -> Column:
    """Published class of a qualified namespace; a phage follows its lineage."""
    is_ppv = F.contains(F.lower(F.coalesce(lineage, F.lit(""))), F.lit("preplasmiviricota"))
    return (
        F.when(prefix.isin("VP__", "PLV__", "PPV__"), "PPV")
        .when(prefix == "GVMAG__", "NCLDV")
        .when((prefix == "PHAGE__") & is_ppv, "PPV")
        .otherwise(F.regexp_replace(prefix, "_+$", ""))
    )


def single_vote(classes: Column) -> Column:
    """One class is that class, several are undecided, none is no vote."""
    return F.when(F.size(classes) == 1, classes[0]).when(F.size(classes) > 1, "VIRAL_UNKNOWN")


def best_hit_bucket(top10: Column, top1_target: Column, top1_family: Column) -> Column:
    """The thirteen-way best-hit partition of a gene."""
    good = F.filter(top10, lambda h: qualifies(h["prefix"], h["pident"]))
    first = F.try_element_at(good, F.lit(1))["prefix"]
    viral = F.when(first.isin("VP__", "PLV__", "PPV__"), "PPV").otherwise(F.regexp_replace(first, "_+$", ""))
    raw = F.upper(F.split_part(top1_target, F.lit("__"), F.lit(1)))
    return (
        F.when(top1_target.isNull() | top1_target.isin("", ".", "NA", "None"), "NO_HITS")
        .when(first.isNotNull(), viral)
        .when(F.contains(top1_target, F.lit("__")) & raw.isin(vocab.ORGANELLE_PREFIXES), raw)
        .when(top1_family.isin("EUK", "BAC", "ARC"), top1_family)
        .otherwise("UNK")
    )


def validation_status(n_hits: Column, max_pident: Column, has_gvmag: Column, score: Column, coverage: Column, nearby: Column) -> Column:
    novel = (score >= 30.0) & (coverage >= 0.5) & nearby
    return (
        F.when(n_hits == 0, F.when(novel, "validated_novel").otherwise("unvalidated"))
        .when(max_pident >= vocab.MIN_VIRAL_PIDENT, "validated")
        .when(has_gvmag, "supported")
        .otherwise("unvalidated")
    )


def marker_role(arm: Column, status: Column, score: Column, evalue: Column, floor: float = 50.0) -> Column:
    """Downstream role; only arm A2 keeps strong markers that failed validation."""
    strong = (
        ~F.isnan(score) & ~F.isnan(evalue) & (F.abs(score) < float("inf"))
        & (score >= floor) & (evalue >= 0) & (evalue <= 1e-5)
    )
    return (
        F.when(status.isin("validated", "validated_novel"), "production_validated")
        .when((arm == "A2") & status.isin("supported", "unvalidated") & F.coalesce(strong, F.lit(False)), "tier1_bypassed")
        .otherwise("rejected")
    )


def is_seedable(bypassed: Column, status: Column, model: Column) -> Column:
    return bypassed | (status == "validated") | ((status == "validated_novel") & is_capsid(model))


def supports_cress(prefix: Column, pident: Column) -> Column:
    return (prefix == "CRESS__") & (pident >= vocab.MIN_VIRAL_PIDENT)


def is_cress_marker(model: Column, status: Column, top10: Column | None = None, supported: Column | None = None) -> Column:
    """``supported`` tells whether one of the gene's ranked hits is of that kind, where their list isn't at hand."""
    if supported is None:
        supported = F.exists(top10, lambda h: supports_cress(h["prefix"], h["pident"]))
    return model.isin(vocab.CRESS_MODELS) & (status == "validated") & supported


def is_cress_specific(top1_target: Column) -> Column:
    return top1_target.startswith("CRESS__") | top1_target.startswith("PHAGE__MONDNA__")


def parse_top10(targets: Column, bits: Column, pidents: Column, evalues: Column, best_target: Column, best_bits: Column) -> Column:
    """Hit structs from parallel comma lists; missing numbers get neutral values."""

    def items(c: Column) -> Column:
        return F.filter(F.split(F.coalesce(c, F.lit("")), ","), lambda t: t != "")

    def number(list_: Column, i: Column, missing: float) -> Column:
        text = F.try_element_at(list_, i + 1)
        return F.when(text.isNull(), F.lit(missing)).otherwise(F.coalesce(text.try_cast("double"), F.lit(0.0)))

    t, b, p, e = items(targets), items(bits), items(pidents), items(evalues)

    def hit(rank, target, bit, pident, evalue):
        return F.struct(rank.alias("rank"), target.alias("target"), bit.alias("bits"), pident.alias("pident"), evalue.alias("evalue"))

    listed = F.transform(t, lambda x, i: hit(i, x, number(b, i, 0.0), number(p, i, 0.0), number(e, i, 1.0)))
    lone = F.array(hit(F.lit(0), best_target, F.coalesce(best_bits, F.lit(0.0)), F.lit(0.0), F.lit(1.0)))
    has_lone = best_target.isNotNull() & (best_target != "")
    return F.when(F.size(t) > 0, listed).when(has_lone, lone).otherwise(F.filter(listed, lambda x: F.lit(False)))

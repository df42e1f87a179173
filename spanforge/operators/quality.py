"""Contract checks on published tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMPTY = ["", ".", "NA", "None", "null", "NULL"]  # fixed value: texts that mean no value
REQUIRED = ["total_proteins", "ncldv_top10_proteins", "mirus_top10_proteins", "ppv_top10_proteins", "cress_top10_proteins"]


class ContractError(RuntimeError):
    """A published table broke its contract; the report was written first."""


def _empty(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")).isin(EMPTY)


def _bad_number(c: Column, kind: str) -> Column:
    return ~_empty(c) & F.trim(c).try_cast(kind).isNull()


def _number(c: Column, kind: str) -> Column:
    return F.coalesce(F.when(~_empty(c), F.trim(c).try_cast(kind)), F.lit(0))


def _tokens(c: Column, sep: str) -> Column:
    parts = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), sep), lambda t: F.trim(t)), lambda t: t != "")
    return F.when(_empty(c), F.array().cast("array<string>")).otherwise(parts)


def _total(tokens: Column) -> Column:
    return F.aggregate(tokens, F.lit(0).cast("bigint"), lambda a, t: a + F.coalesce(F.trim(F.substring_index(t, ":", -1)).try_cast("bigint"), F.lit(0)))


def _malformed(tokens: Column) -> Column:
    return F.exists(tokens, lambda t: ~t.rlike(r"^\s*[^:\s].*:\s*-?\d+\s*$"))


def detailed_issues(table: DataFrame, gene_totals: DataFrame | None = None) -> DataFrame:
    """Issue rows ``(eve_id, check, severity)`` of the detailed table, read as text.

    All checks of a row are one projection.  ``gene_totals`` is (eve_id, genes,
    ncldv, mirus) of the interior genes and adds the cross-table checks.
    """
    have = set(table.columns)
    text = lambda c: F.col(c).cast("string") if c in have else F.lit(None).cast("string")
    ints = [*REQUIRED, "og_count", "gvogm_count", "og_unvalidated_count", "gvogm_unvalidated_count", "host_signature_gene_count"]
    n = {c: _number(text(c), "bigint") for c in ints}
    share = _number(text("host_signature_fraction"), "double")
    total, host = n["total_proteins"], n["host_signature_gene_count"]
    rules: list[tuple[str, Column]] = [("parse_error:" + c, _bad_number(text(c), "bigint")) for c in ints]
    rules.append(("parse_error:host_signature_fraction", _bad_number(text("host_signature_fraction"), "double")))
    best = _tokens(text("taxonomy_best_hits"), ";")
    rules += [
        ("taxonomy_best_hits_format", _malformed(best)),
        ("taxonomy_total_mismatch", (F.size(best) > 0) & ~_malformed(best) & (_total(best) != total)),
    ]
    rules += [(f"{f}_top_count_out_of_range", n[f"{f}_top10_proteins"] > total) for f in ("ncldv", "mirus", "ppv", "cress")]
    rules += [
        ("host_signature_count_out_of_range", host > total),
        ("host_signature_fraction_zero", (host > 0) & (share <= 0)),
        ("host_signature_fraction_nonzero", (host == 0) & (share > 0)),
        ("host_signature_fraction_out_of_range", share > 1),
    ]
    for g in ("og", "gvogm"):
        names, names_u = text(f"{g}_names"), text(f"{g}_unvalidated_names")
        toks, toks_u = _tokens(names, ","), _tokens(names_u, ",")
        c, cu = n[f"{g}_count"], n[f"{g}_unvalidated_count"]
        rules += [
            (f"{g}_names_format", _malformed(toks)),
            (f"{g}_names_missing", (c > 0) & _empty(names)),
            (f"{g}_names_nonzero", (c == 0) & ~_empty(names)),
            (f"{g}_count_names_mismatch", c > F.when(_malformed(toks), 0).otherwise(_total(toks))),
            (f"{g}_unvalidated_names_missing", (cu > 0) & _empty(names_u)),
            (f"{g}_unvalidated_names_nonzero", (cu == 0) & ~_empty(names_u)),
            (f"{g}_unvalidated_count_names_mismatch", cu != F.size(toks_u)),
        ]
    marks = F.concat_ws("|", *[text(c) for c in ("seed_marker_names", "other_marker_names", "seed_marker_patterns", "other_marker_patterns")])
    for g, pattern in (("og", r"(?i)\bOG\d+\b"), ("gvogm", r"(?i)\bGVOGM\d+\b")):
        rules.append((f"{g}_marker_evidence_zero_count", marks.rlike(pattern) & (n[f"{g}_count"] + n[f"{g}_unvalidated_count"] == 0)))
    seed_n, seed_p = text("seed_marker_names"), text("seed_marker_patterns")
    rules += [
        ("seed_marker_names_missing", ~_empty(seed_p) & _empty(seed_n)),
        ("seed_marker_patterns_missing", ~_empty(seed_n) & _empty(seed_p)),
    ]
    d = table
    if gene_totals is not None:
        d = d.join(gene_totals.select("eve_id", F.col("genes").alias("_g"), F.col("ncldv").alias("_n"), F.col("mirus").alias("_m")), "eve_id", "left")
        known = F.col("_g").isNotNull()
        rules += [
            ("gene_taxonomy_total_mismatch", known & (total != F.col("_g"))),
            ("gene_taxonomy_ncldv_mismatch", known & (n["ncldv_top10_proteins"] != F.col("_n"))),
            ("gene_taxonomy_mirus_mismatch", known & (n["mirus_top10_proteins"] != F.col("_m"))),
        ]
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules]))
    issues = d.select(text("eve_id").alias("eve_id") if "eve_id" in have else F.lit(".").alias("eve_id"), F.explode(found).alias("check"))
    issues = issues.withColumn("check", F.split_part("check", F.lit(":"), F.lit(1))).withColumn("severity", F.lit("error"))
    missing = [c for c in ["eve_id", *REQUIRED] if c not in have]
    if missing:
        row = table.limit(1).select(F.lit(".").alias("eve_id"), F.lit("detailed_tsv_schema").alias("check"), F.lit("error").alias("severity"))
        issues = issues.unionByName(row)
    return issues


def gene_totals(genes: DataFrame) -> DataFrame:
    """Interior gene counts per candidate: eve_id, is_flanking, origins ARRAY."""
    return genes.filter(~F.col("is_flanking")).groupBy("eve_id").agg(
        F.count(F.lit(1)).alias("genes"), F.count_if(F.array_contains("origins", "NCLDV")).alias("ncldv"),
        F.count_if(F.array_contains("origins", "MIRUS")).alias("mirus"),
    )


def enforce(issues: DataFrame, path: str) -> int:
    """Write the report, then fail unless every issue is a warning."""
    issues.write.mode("overwrite").parquet(path)
    written = issues.sparkSession.read.parquet(path)
    fatal = written.filter(F.lower(F.trim("severity")) != "warning")
    n = fatal.count()
    if n:
        names = [f"{r['eve_id']}:{r['check']}" for r in fatal.limit(5).collect()]
        raise ContractError(f"{n} contract violations ({', '.join(names)}); report in {path}")
    return written.count()


def class_partition_violations(summary: DataFrame, classes: Sequence[str], accepted: str = "accepted") -> DataFrame:
    """Genomes whose exclusive class counts do not add up to the accepted ones."""
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in classes), F.lit(0))
    return summary.withColumn("class_total", total).filter(F.col("class_total") != F.col(accepted))


def coordinate_violations(rows: DataFrame, lengths: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows outside the half-open contract or their contig."""
    d = rows.join(lengths, list(keys), "left")
    s, e, n = F.col("start"), F.col("end"), F.col("seq_len")
    why = F.when(n.isNull(), "unknown_contig").when(s < 0, "negative_start").when(e <= s, "empty").when(e > n, "past_end")
    return d.withColumn("violation", why).filter(F.col("violation").isNotNull())


def snapshot_difference(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows on one side only, with their multiplicity kept."""
    cols = expected.columns
    a, b = actual.select(*cols), expected.select(*cols)
    return a.exceptAll(b).withColumn("side", F.lit("unexpected")).unionByName(b.exceptAll(a).withColumn("side", F.lit("missing")))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def shape_difference(a: DataFrame, b: DataFrame, key: str, values: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Ids present once or with different values (length, order) in two record sets."""
    cols = list(values)
    l = a.select(key, F.struct(*cols).alias("_a"))
    r = b.select(key, F.struct(*cols).alias("_b"))
    return l.join(r, key, "full").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(
        key, F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "missing").otherwise("changed").alias("difference")
    )

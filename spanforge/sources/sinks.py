"""Exports: text forms of the published tables, and Parquet stage tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import four_decimals, gff_escape

# fixed values: the detailed table's columns, in order
DETAILED_COLUMNS = """eve_id scaffold start end length confidence_tier final_confidence effective_eve_class likely_family ppv_subtype likely_group
candidate_start candidate_end candidate_length candidate_reduction_bp candidate_reduction_reason seed_sources canonical_selection_outcome
hallmark_total hallmark_unique mcp_gene_ids tier1_bypassed_marker_count tier1_bypassed_marker_ids tier1_bypassed_marker_models
gvogm_count gvogm_names og_count og_names gvogm_unvalidated_count gvogm_unvalidated_names og_unvalidated_count og_unvalidated_names
marker_complement_score family_consistency_score seed_marker_names other_marker_names seed_marker_patterns other_marker_patterns
total_proteins ncldv_top10_proteins mirus_top10_proteins ppv_top10_proteins cress_top10_proteins taxonomy_best_hits
kfd gc_deviation region_gc_percent genome_gc_percent gc_delta host_signature_gene_count host_signature_fraction host_signature_weighted_mean
interproscan_total_hits interproscan_viral_hits interproscan_keyword_hits interproscan_category_score interproscan_score
vp_completeness ppv_completeness ncldv_completeness mirus_completeness
ani_cluster_id ani_cluster_size ani_max_percent taxonomy_class_before_ani taxonomy_class_propagated_from""".split()


def fixed_score(confidence: Column) -> Column:
    """0..1000 from the four-decimal confidence that is published."""
    shown = four_decimals(confidence.cast("double")).cast("double")
    return F.least(F.lit(1000), F.floor(shown * 1000)).cast("int")


def cell(c: Column, kind: str) -> Column:
    """Text of one cell; missing values show as a dot."""
    if kind in ("double", "float"):
        text = four_decimals(c.cast("double"))
    elif kind == "boolean":
        text = c.cast("int").cast("string")
    elif kind.startswith("array"):
        text = F.array_join(c, ",")
    else:
        text = c.cast("string")
    return F.when(c.isNull(), ".").otherwise(F.coalesce(F.nullif(text, F.lit("")), F.lit(".")))


def as_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*[(cell(F.col(c), kinds[c]) if c in kinds else F.lit(".")).alias(c) for c in columns])


def predictions_order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("final_confidence").desc(), F.col("eve_id").desc())


def write_tsv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    out = as_cells(df, columns or df.columns)
    out.write.mode("overwrite").options(sep="\t", header=True, quote="", emptyValue="").csv(path)


def bed_lines(df: DataFrame) -> DataFrame:
    parts = [F.col("scaffold"), F.col("start"), F.col("end"), F.col("eve_id"), fixed_score(F.col("final_confidence")), F.lit(".")]
    return df.select(F.concat_ws("\t", *[p.cast("string") for p in parts]).alias("value"))


def gff_lines(df: DataFrame, source: str = "spanforge") -> DataFrame:
    """Feature lines; attributes whose column is absent, null or false are left out."""
    have = set(df.columns)

    def attr(name: str, c: Column, show: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{name}="), c)
        return text if show is None else F.when(show, text)

    e = lambda c: gff_escape(F.col(c).cast("string"))
    attrs = [attr("ID", e("eve_id")), attr("Name", e("eve_id")), attr("confidence", four_decimals(F.col("final_confidence").cast("double")))]
    for c in ("status", "hallmark_diversity", "effective_eve_class"):
        if c in have:
            attrs.append(attr(c, e(c)))
    if "ppv_subtype" in have:
        attrs.append(attr("ppv_subtype", e("ppv_subtype"), (F.col("effective_eve_class") == "PPV") & F.col("ppv_subtype").isin("VP", "PLV")))
    for c in ("region_classification", "taxonomy"):
        if c in have:
            attrs.append(attr(c, e(c), F.coalesce(F.col(c), F.lit("")) != ""))
    for c in ("has_virus_specific", "has_structural_support"):
        if c in have:
            attrs.append(attr(c, F.lit("true"), F.col(c)))
    for c in [x for x in df.columns if x.startswith("gene_taxonomy_")]:
        attrs.append(attr(c, e(c), F.col("gene_taxonomy_total") > 0))
    cols = [
        e("scaffold"), F.lit(source), F.lit("EVE"), (F.col("start") + 1).cast("string"), F.col("end").cast("string"),
        fixed_score(F.col("final_confidence")).cast("string"), F.lit("."), F.lit("."), F.concat_ws(";", *attrs),
    ]
    return df.select(F.concat_ws("\t", *cols).alias("value"))


def fasta_lines(df: DataFrame, name: str, description: Column, seq: str) -> DataFrame:
    text = F.concat(F.lit(">"), F.col(name), F.lit(" "), description, F.lit("\n"), F.col(seq))
    return df.filter(F.length(seq) > 0).select(text.alias("value"))


def write_text(lines: DataFrame, path: str, header: str | None = None) -> None:
    """Text parts; the header line is a part of its own, the first one of the folder."""
    if header is not None:
        first = lines.sparkSession.createDataFrame([(header,)], "value string").coalesce(1)
        lines = first.unionByName(lines.select("value"))  # a union keeps the order of its parts
    lines.write.mode("overwrite").text(path)


def write_clustered(df: DataFrame, path: str, key: str) -> None:
    """One table in ranges of ``key``, so that all rows of one key lie together and few files are made."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def write_region_sequences(regions: DataFrame, path: str) -> None:
    """FASTA text of all candidates as one table clustered by candidate."""
    text = F.concat(F.lit(">"), F.col("eve_id"), F.lit("\n"), F.col("region_seq"))
    write_clustered(regions.select("eve_id", text.alias("value")), path, "eve_id")


def write_gene_taxonomy(genes: DataFrame, path: str) -> None:
    """Gene rows of all candidates as one table clustered by candidate."""
    write_clustered(genes, path, "candidate_id")


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Write a stage table and continue from the written copy."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def json_lines(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def host_model_json(model: DataFrame, genome: str = "genome_id") -> DataFrame:
    """One JSON text per genome: token weights and counts."""
    entry = lambda v: F.map_from_entries(F.array_sort(F.collect_list(F.struct("token", v))))
    d = model.groupBy(genome).agg(entry("weight").alias("token_weights"), entry("cnt").alias("token_counts"), F.max("weight").alias("max_weight"))
    return d.select(genome, F.to_json(F.struct("token_weights", "token_counts", "max_weight")).alias("value"))


def parse_host_model(texts: DataFrame, genome: str = "genome_id") -> DataFrame:
    schema = "token_weights map<string,double>, token_counts map<string,bigint>, max_weight double"
    d = texts.select(genome, F.from_json("value", schema).alias("m"))
    return d.select(genome, F.explode("m.token_weights").alias("token", "weight"), F.col("m.token_counts").alias("_c")).withColumn(
        "cnt", F.try_element_at("_c", F.col("token"))
    ).drop("_c")

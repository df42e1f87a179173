"""Tabular and report-like text sources.

Every reader has a ``parse_*`` half that works on a DataFrame of text, so the same
code serves files and columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


HIT_FIELDS = ["target", "evalue", "bits", "pident", "qcov"]


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with ``ordinal``, their order in the files.

    Tasks read file blocks in no particular order, so the order is the file, the
    block offset, then the position met while reading the block.
    """
    d = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("_f"), F.col("_metadata.file_block_start").alias("_b"))
    return d.withColumn("ordinal", F.struct("_f", "_b", F.monotonically_increasing_id().alias("_i"))).drop("_f", "_b")


def fields(lines: DataFrame, names: list[str], types: list[str], sep: str = "\t", at: list[int] | None = None, minimum: int | None = None) -> DataFrame:
    """Typed columns of separated text; short rows and unreadable numbers are dropped."""
    rest = [c for c in lines.columns if c != "value"]
    d = lines.withColumn("_p", F.split("value", sep))
    d = d.filter(F.size("_p") >= (minimum or len(names)))
    at = at or list(range(len(names)))
    # a short row may be looked at before it is dropped
    part = lambda i: F.get("_p", F.lit(i))
    cols = [(part(i) if t == "string" else part(i).try_cast(t)).alias(n) for i, n, t in zip(at, names, types)]
    return d.select(*cols, *rest).dropna(subset=[n for n, t in zip(names, types) if t != "string"] or None)


def parse_hits(lines: DataFrame) -> DataFrame:
    """Six-column ranked hits."""
    d = fields(lines, ["gene_id", *HIT_FIELDS], ["string", "string", "double", "double", "double", "double"])
    from ..functions.text import known_prefix

    return d.withColumn("prefix", known_prefix(F.col("target")))


def parse_wide_hits(lines: DataFrame) -> DataFrame:
    """Twelve-column hits."""
    names = ["gene_id", "target", "pident", "length", "mismatch", "gapopen", "qstart", "qend", "sstart", "send", "evalue", "bits"]
    return fields(lines, names, ["string", "string", "double"] + ["int"] * 7 + ["double", "double"])


def parse_frameshift(lines: DataFrame) -> DataFrame:
    """Frameshift hits: 18 blank-separated columns, rows without events dropped."""
    names = [
        "hit_id", "target_name", "target_accession", "query_name", "query_accession", "hmm_len", "hmm_from", "hmm_to", "seq_len",
        "ali_from", "ali_to", "evalue", "score", "bias", "pid", "shifts", "stops",
    ]
    types = ["string"] * 5 + ["int"] * 6 + ["double"] * 4 + ["int"] * 2
    live = lines.filter((F.trim("value") != "") & ~F.startswith("value", F.lit("#")))
    d = live.withColumn("_p", F.split(F.ltrim("value"), r"\s+", 18))
    checked = F.when(F.size("_p") >= 17, F.col("_p")).otherwise(F.raise_error(F.concat(F.lit("bad frameshift row: "), F.col("value"))).cast("array<string>"))
    d = d.withColumn("_p", checked)
    # strict casts: an unreadable number is an error, not a lost row
    cols = [F.col("_p")[i].cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))]
    d = d.select(*cols, F.coalesce(F.try_element_at("_p", F.lit(18)), F.lit("")).alias("description"))
    return (
        d.filter((F.col("shifts") > 0) | (F.col("stops") > 0))
        .withColumn("start", (F.least("ali_from", "ali_to") - 1).cast("bigint"))
        .withColumn("end", F.greatest("ali_from", "ali_to").cast("bigint"))
        .withColumn("strand", F.when(F.col("ali_from") <= F.col("ali_to"), "+").otherwise("-"))
        .withColumn("model_coverage", (F.col("hmm_to") - F.col("hmm_from") + 1) / F.col("hmm_len"))
    )


def read_tandem_repeats(spark: SparkSession, path: str) -> DataFrame:
    return parse_tandem_repeats(spark.read.option("lineSep", "Sequence:").text(path))


def parse_tandem_repeats(records: DataFrame) -> DataFrame:
    """Repeats of a report cut at its ``Sequence:`` marks; text before the first is preamble."""
    lines = F.split("value", r"\r?\n")
    d = records.filter(F.trim("value").rlike(r"(?s)^\S+.*\n")).select(F.regexp_extract("value", r"^\s*(\S+)", 1).alias("seq_id"), F.explode(F.slice(lines, 2, F.size(lines))).alias("l"))
    p = F.split(F.trim("l"), r"\s+")
    return d.filter(F.trim("l").rlike(r"^[+-]?\d") ).select(
        "seq_id", (p[0].cast("bigint") - 1).alias("start"), p[1].cast("bigint").alias("end"),
        F.coalesce(F.concat(F.lit("period="), F.try_element_at(p, F.lit(3))), F.lit("")).alias("annotation"),
    )


def parse_labels(lines: DataFrame) -> DataFrame:
    return fields(lines.select("value"), ["org_id", "lineage"], ["string", "string"])


def parse_domains(lines: DataFrame) -> DataFrame:
    """Domain annotations: thirteen or more columns, ``#`` comments."""
    live = lines.select("value").filter(~F.startswith("value", F.lit("#")))
    return fields(
        live, ["protein_id", "signature", "signature_desc", "accession", "accession_desc"], ["string"] * 5, at=[0, 4, 5, 11, 12], minimum=13
    )


def parse_structure_hits(lines: DataFrame) -> DataFrame:
    names = ["query", "target", "evalue", "bits", "qcov", "tcov", "lddt", "tm"]
    return fields(lines.select("value"), names, ["string", "string"] + ["double"] * 6)


def read_named_table(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """A table with a header, which must carry the required columns."""
    d = spark.read.option("header", True).option("sep", "\t").csv(path)
    missing = sorted(set(required) - set(d.columns))
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    return d


def parse_late_headers(lines: DataFrame, names: list[str], sep: str = "\t") -> DataFrame:
    """``source`` and the named columns as text, for files whose header comes after other lines, in any column order.

    ``lines``: value, source (the file), ordinal. A file's header is its first line with all
    ``names``; comments and what stands before it are no rows. A file without one gives an error when read;
    a missing cell is null. Headers are one row per file and joined to its rows.
    """
    parts = lines.filter(~F.startswith("value", F.lit("#")) & (F.trim("value") != "")).withColumn("_p", F.split("value", sep))
    lacks = F.size(F.array_except(F.array(*map(F.lit, names)), F.transform("_p", F.trim)))
    found = parts.filter(lacks == 0).groupBy("source").agg(F.min("ordinal").alias("_at"), F.min_by(F.transform("_p", F.trim), "ordinal").alias("_header"))
    d = parts.join(found, "source", "left")
    none = F.raise_error(F.concat(F.lit("no header with the wanted columns in "), F.col("source")))
    d = d.filter(F.when(F.col("_at").isNull(), none.cast("boolean")).otherwise(F.col("ordinal") > F.col("_at")))
    cell = lambda n: F.nullif(F.trim(F.try_element_at("_p", F.array_position("_header", n).cast("int"))), F.lit("")).alias(n)
    return d.select("source", *[cell(n) for n in names])


def read_late_headers(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Files of a folder or pattern, each with its own header line and column order."""
    lines = text_lines(spark, path)
    return parse_late_headers(lines.withColumn("source", F.col("ordinal._f")), names)


def parse_signatures(table: DataFrame) -> DataFrame:
    """(model, required domains, scope) with empty list items removed."""
    sig = F.filter(F.split(F.coalesce("pfam_signature", F.lit("")), ";"), lambda x: x != "")
    scope = F.trim("source_scope")
    return table.filter(F.trim("model_name") != "").select(
        F.trim("model_name").alias("model"), F.when(scope == "CRESS-Rep", F.array(F.lit("Gemini_AL1"))).otherwise(sig).alias("required"), scope.alias("scope")
    )


def parse_model_annotations(table: DataFrame) -> DataFrame:
    """Categories and family per model from its free text."""
    from ..functions.text import keyword_tags, model_family

    text = F.concat_ws(" ", "model_name", "description", "majority_annotation")
    return table.select(
        F.lower(F.trim("model_name")).alias("model"), keyword_tags(text).alias("categories"),
        model_family(F.col("model_name"), F.col("source"), F.col("description")).alias("family"),
    )


def parse_classifier_domains(c: Column) -> Column:
    """``dom:count(pct%)`` lists as structs, first one primary."""
    items = F.regexp_extract_all(c, F.lit(r"(\w+:\d+\([\d.]+%\))"), F.lit(1))
    pattern = r"(\w+):(\d+)\(([\d.]+)%\)"
    return F.transform(
        items,
        lambda x: F.struct(
            F.regexp_extract(x, pattern, 1).alias("domain"), F.regexp_extract(x, pattern, 2).cast("int").alias("n"),
            F.regexp_extract(x, pattern, 3).cast("double").alias("percent"),
        ),
    )


def read_name_list(spark: SparkSession, path: str) -> DataFrame:
    """Marker names, one per line; ``#`` starts a comment."""
    d = spark.read.text(path).select(F.trim(F.regexp_replace("value", r"#.*$", "")).alias("model"))
    return d.filter(F.col("model") != "").distinct()


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """Published similarity edges; an unreadable row fails the read."""
    schema = "a string, b string, ani double, af_a double, af_b double"
    return spark.read.schema(schema).options(sep="\t", header=True, mode="FAILFAST").csv(path)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("id", "vec", "protein_name", "organism", "lineage", "keywords")


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """A stage table (markers, seeds, folds, embedding hits) written by this library."""
    return spark.read.parquet(path)


def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """Encoded stem to id; a stem with two ids is an error."""
    d = spark.read.option("header", True).option("sep", "\t").csv(path).select("stem", "id").distinct()
    clash = d.groupBy("stem").agg(F.countDistinct("id").alias("n")).filter("n > 1").select("stem").limit(3).collect()
    if clash:
        raise ValueError(f"id map names several ids for {[r['stem'] for r in clash]}")
    return d


def lowercase_runs(masked: DataFrame, original: DataFrame, key: str) -> DataFrame:
    """Runs that are lower case in ``seq`` but not in ``original``; both have one row per key."""
    return case_runs(masked.join(original, key).select(key, "seq", "original"), key)


def case_runs(records: DataFrame, key: str) -> DataFrame:
    """Runs of a to z in ``seq`` where ``original`` has another character at that place, with both in one row.

    Each task compares the records it reads by code point, so no text moves and a run is whole at once.
    """
    schema = T.StructType([records.schema[key], T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])

    def points(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le"), np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for batch in batches:
            starts, ends, counts = [none], [none], []
            for seq, original in zip(batch.column(1), batch.column(2), strict=True):
                a, b = points(seq.as_py() or ""), points(original.as_py() or "")
                n = min(len(a), len(b))
                flag = np.zeros(n + 2, np.int8)
                flag[1:-1] = (a[:n] >= 97) & (a[:n] <= 122) & (a[:n] != b[:n])
                step = np.diff(flag)
                starts.append(np.flatnonzero(step == 1))
                ends.append(np.flatnonzero(step == -1))
                counts.append(len(starts[-1]))
            rows = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array(np.concatenate(starts)), pa.array(np.concatenate(ends))], names=schema.names)

    return records.select(key, "seq", "original").mapInArrow(run, schema)

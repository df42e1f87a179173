"""Sequence files: one record per row, many files per read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIXES = ("fna", "fasta", "fa")


def expand_inputs(spark: SparkSession, path: str) -> list[str]:
    """Paths to read for one file, a folder or a list file with ``#`` comments."""
    if path.rsplit(".", 1)[-1].lower() in (*SUFFIXES, "faa", "gz"):
        return [path]
    if path.endswith((".txt", ".list", ".tsv")):
        lines = spark.read.text(path).select(F.trim("value").alias("p"))
        return [r["p"] for r in lines.filter((F.col("p") != "") & ~F.col("p").startswith("#")).collect()]
    return [f"{path.rstrip('/')}/*.{s}" for s in SUFFIXES if _matches(spark, f"{path.rstrip('/')}/*.{s}")]


def _matches(spark: SparkSession, pattern: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_fasta(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """genome_id, seq_id, description, seq, seq_len from FASTA files."""
    raw = spark.read.option("lineSep", "\n>").text(paths)
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.(fna|fasta|fa|faa)(\.gz)?$", "")
    return parse_fasta(raw.select("value", name.alias("genome_id")))


def parse_fasta(records: DataFrame) -> DataFrame:
    """Split raw records (text between ``>`` marks) into header and sequence."""
    text = F.regexp_replace("value", r"^>", "")
    head = F.trim(F.regexp_extract(text, r"^([^\r\n]*)", 1))
    body = F.regexp_replace(F.regexp_replace(text, r"^[^\r\n]*", ""), r"\s", "")
    rest = [c for c in records.columns if c != "value"]
    d = records.filter(F.trim(text) != "").select(*rest, head.alias("description"), body.alias("seq"))
    return d.withColumn("seq_id", F.regexp_extract("description", r"^(\S*)", 1)).withColumn("seq_len", F.length("seq").cast("bigint"))


def gene_header(header: Column) -> Column:
    """``id # start # end # strand # ID=..`` as a half-open struct.

    Null for headers of another kind; a malformed one of this kind is an error.
    """
    p = F.split(header, " # ")
    start, end = F.try_element_at(p, F.lit(2)).try_cast("bigint"), F.try_element_at(p, F.lit(3)).try_cast("bigint")
    mark = F.trim(F.try_element_at(p, F.lit(4)))
    strand = F.when(mark.isin("1", "+"), "+").when(mark.isin("-1", "-"), "-")
    token = F.regexp_extract(p[0], r"^\s*(\S+)", 1)
    index = F.regexp_extract(header, r"ID=(?:[^;]*_)?([^;_]*)", 1)
    suffix = F.concat(F.lit("_"), index)
    scaffold = F.when((index != "") & F.endswith(token, suffix), F.left(token, F.length(token) - F.length(suffix))).otherwise(token)
    good = start.isNotNull() & end.isNotNull() & strand.isNotNull() & (start >= 1) & (end >= start) & (token != "")
    bad = F.raise_error(F.concat(F.lit("malformed gene header: "), header)).cast("string")
    return F.when(
        F.size(p) > 1,
        F.struct(
            F.when(good, scaffold).otherwise(bad).alias("scaffold"), (start - 1).alias("start"), end.alias("end"), strand.alias("strand")
        ),
    )


def orf_header(header: Column) -> Column:
    """``id|scaffold:start-end_strand:+_frame:1``, matched from the right."""
    pattern = r"^([^|]*)\|(.*):(-?\d+)-(-?\d+)_strand:([^_]*)_frame:(-?\d+)$"
    g = lambda i: F.regexp_extract(header, pattern, i)
    return F.when(
        header.rlike(pattern),
        F.struct(
            g(1).alias("gene_id"), g(2).alias("scaffold"), g(3).try_cast("bigint").alias("start"), g(4).try_cast("bigint").alias("end"),
            g(5).alias("strand"), g(6).try_cast("int").alias("frame"),
        ),
    )


def frame_header(header: Column) -> Column:
    """``contig_frame=N_offset=M`` (or ``_frame_N``) of a six-frame translation."""
    off = F.coalesce(F.nullif(F.regexp_extract(header, r"_offset=([^=]*)$", 1), F.lit("")).try_cast("int"), F.lit(0))
    base = F.regexp_replace(header, r"_offset=[^=]*$", "")
    pattern = r"^(.*)_frame[=_](-?\d+)$"
    hit = base.rlike(pattern)
    return F.struct(
        F.when(hit, F.regexp_extract(base, pattern, 1)).otherwise(base).alias("contig"),
        F.when(hit, F.regexp_extract(base, pattern, 2).try_cast("int")).alias("frame"),
        off.alias("offset"),
    )

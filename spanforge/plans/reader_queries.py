"""Readers on text lines made of the given tables, so that what is read back can be compared with the columns."""

from pyspark.sql import functions as F

from ..functions import text
from ..sources import reports as rp
from .registry import query
from .tables import LABELS, labels, load


def tabbed(*parts):
    return F.concat_ws("\t", *[p if not isinstance(p, str) else F.col(p).cast("string") for p in parts])


@query("label_lines", f"WITH {LABELS} SELECT org_id, lineage FROM labelled")
def label_lines(spark, sf):
    return rp.parse_labels(labels(spark, sf).select(tabbed("org_id", "lineage").alias("value")))


@query("structure_hit_lines", """SELECT 'g' || l_orderkey AS query, 'p' || l_partkey AS target, l_tax AS evalue, l_extendedprice AS bits, l_discount AS qcov, l_discount AS tcov, l_tax AS lddt, l_quantity AS tm FROM lineitem""")
def structure_hit_lines(spark, sf):
    own = [F.concat(F.lit("g"), "l_orderkey"), F.concat(F.lit("p"), "l_partkey")]
    return rp.parse_structure_hits(load(spark, sf, "lineitem").select(tabbed(*own, "l_tax", "l_extendedprice", "l_discount", "l_discount", "l_tax", "l_quantity").alias("value")))


@query(
    "domain_lines",
    """SELECT 'g' || l_orderkey AS protein_id, 'PF' || l_partkey AS signature, l_linestatus AS signature_desc, 'IPR' || l_suppkey AS accession, l_returnflag AS accession_desc
    FROM lineitem WHERE l_linenumber <> 3""",
)
def domain_lines(spark, sf):
    """Every third line of an order is a comment, the second one too short."""
    d = load(spark, sf, "lineitem")
    head = [F.concat(F.when(F.col("l_linenumber") == 3, "#").otherwise(""), F.lit("g"), "l_orderkey"), F.lit("md5"), "l_linenumber", F.lit("Pfam")]
    tail = [F.concat(F.lit("PF"), "l_partkey"), "l_linestatus", *[F.lit("-")] * 5, F.concat(F.lit("IPR"), "l_suppkey"), "l_returnflag"]
    short = d.select(F.lit("g1\tmd5\t7").alias("value"))
    return rp.parse_domains(d.select(tabbed(*head, *tail).alias("value")).unionByName(short))


@query(
    "domain_spans",
    """SELECT l_orderkey, l_linenumber, 'g' || l_orderkey AS gene, CASE WHEN l_linenumber <> 1 THEN l_partkey END AS aa_start, CASE WHEN l_linenumber <> 1 THEN l_partkey + l_suppkey END AS aa_end FROM lineitem""",
)
def domain_spans(spark, sf):
    name = F.concat(F.lit("g"), "l_orderkey", F.when(F.col("l_linenumber") == 1, "").otherwise(F.concat(F.lit("|aa"), "l_partkey", F.lit("-"), F.col("l_partkey") + F.col("l_suppkey"))))
    start, end = text.domain_span(F.col("name"))
    d = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", name.alias("name"))
    return d.select("l_orderkey", "l_linenumber", text.base_gene_id(F.col("name")).alias("gene"), start.alias("aa_start"), end.alias("aa_end"))


@query(
    "required_domains",
    """SELECT p_brand AS model, p_partkey, CASE WHEN p_size % 5 = 0 THEN 'Gemini_AL1' ELSE p_type || ',' || p_name END AS required FROM part WHERE p_size % 7 <> 0""",
)
def required_domains(spark, sf):
    scope = F.when(F.col("p_size") % 5 == 0, " CRESS-Rep ").otherwise("all")
    name = F.when(F.col("p_size") % 7 == 0, " ").otherwise(F.concat(F.lit(" "), "p_brand"))
    t = load(spark, sf, "part").select(name.alias("model_name"), F.concat_ws(";", "p_type", F.lit(""), "p_name").alias("pfam_signature"), F.concat(scope).alias("source_scope"), "p_partkey")
    # the reader keeps three columns; the part number rides in the name
    t = t.withColumn("model_name", F.when(F.trim("model_name") != "", F.concat("model_name", F.lit("|"), "p_partkey")).otherwise(F.col("model_name")))
    part = F.split_part("model", F.lit("|"), F.lit(2)).cast("bigint")
    return rp.parse_signatures(t).select(F.split_part("model", F.lit("|"), F.lit(1)).alias("model"), part.alias("p_partkey"), F.array_join("required", ",").alias("required"))


@query(
    "late_headers",
    """SELECT l_returnflag || l_linestatus AS source, CAST(l_orderkey AS VARCHAR) AS id, l_returnflag AS domain, nullif(CASE WHEN l_linenumber = 2 THEN '' ELSE CAST(l_partkey AS VARCHAR) END, '') AS markers FROM lineitem""",
)
def late_headers(spark, sf):
    """A file per flag and status, some with other columns first, each with comments and a title before its header."""
    d = load(spark, sf, "lineitem")
    turned = F.col("source").isin("AF", "NO", "RF")
    cells = d.select(F.concat("l_returnflag", "l_linestatus").alias("source"), F.col("l_orderkey").cast("string").alias("id"), F.col("l_returnflag").alias("domain"), F.when(F.col("l_linenumber") == 2, "").otherwise(F.col("l_partkey").cast("string")).alias("markers"))
    rows = cells.select("source", F.when(turned, tabbed("markers", F.lit("x"), "id", "domain")).otherwise(tabbed("id", "domain", "markers")).alias("value"), F.lit(9).alias("ordinal"))
    heads = cells.select("source").distinct().select("source", F.explode(F.array(
        F.struct(F.lit("# made by a tool").alias("value"), F.lit(0).alias("ordinal")), F.struct(F.lit("Results").alias("value"), F.lit(1).alias("ordinal")),
        F.struct(F.when(turned, "markers\tother\tid\tdomain").otherwise("id\tdomain\tmarkers").alias("value"), F.lit(2).alias("ordinal")),
    )).alias("h")).select("source", "h.*")
    return rp.parse_late_headers(rows.unionByName(heads), ["id", "domain", "markers"])

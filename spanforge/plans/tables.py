"""The given tables seen as genes, hits, markers and labels.

``track``    events as intervals on one scaffold per user
``genes``    orders as genes on one scaffold per customer
``hits``     line items as ranked matches of a gene against named targets
``markers``  line items as profile hits on genes
``labels``   supplier / nation / region paths as lineage labels

Every view has an SQL twin, used as a common table expression by the checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab

KEYS = ["genome_id", "scaffold"]
GENOMES = 4


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-free timestamp."""
    day = F.unix_date(F.to_date(ts)).cast("bigint") * 86400
    return day + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts)).cast("bigint")


def track(spark: SparkSession, sf: str) -> DataFrame:
    start = seconds(F.col("ts"))
    return load(spark, sf, "events").select(
        (F.col("user_id") % GENOMES).alias("genome_id"),
        F.col("user_id").alias("scaffold"),
        F.col("event_id").alias("gene_id"),
        start.alias("start"),
        (start + F.floor(F.col("value") * 60).cast("bigint")).alias("end"),
        F.col("event_type").alias("kind"),
        F.col("value").alias("score"),
    )


TRACK = f"""track AS (SELECT user_id % {GENOMES} AS genome_id, user_id AS scaffold, event_id AS gene_id,
  epoch_us(ts) // 1000000 AS "start",
  epoch_us(ts) // 1000000 + CAST(floor(value * 60) AS BIGINT) AS "end",
  event_type AS kind, value AS score FROM events)"""


def genes(spark: SparkSession, sf: str) -> DataFrame:
    day = F.datediff(F.to_date("o_orderdate"), F.to_date(F.lit("1992-01-01"))).cast("bigint")
    return load(spark, sf, "orders").select(
        (F.col("o_custkey") % GENOMES).alias("genome_id"),
        F.col("o_custkey").alias("scaffold"),
        F.col("o_orderkey").alias("gene_id"),
        (day * 100).alias("start"),
        (day * 100 + 1 + F.floor(F.col("o_totalprice") / 100).cast("bigint")).alias("end"),
        F.when(F.col("o_orderkey") % 2 == 0, "+").otherwise("-").alias("strand"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )


GENES = f"""genes AS (SELECT o_custkey % {GENOMES} AS genome_id, o_custkey AS scaffold, o_orderkey AS gene_id,
  CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 100 AS "start",
  CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 100 + 1
    + CAST(floor(o_totalprice / 100) AS BIGINT) AS "end",
  CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
  o_orderpriority AS priority, o_orderstatus AS status FROM orders)"""

# Namespaces given to suppliers, in turn.
NAMESPACES = ["EUK", "BAC", "NCLDV", "EUK", "MIRUS", "PPV", "EUK", "CRESS", "GVMAG", "PHAGE", "ARC", "EUK", "MITO"]


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def _pick_sql(values: list[str], index: str) -> str:
    return "list_extract([" + ", ".join(f"'{v}'" for v in values) + f"], CAST({index} % {len(values)} + 1 AS BIGINT))"


def hits(spark: SparkSession, sf: str) -> DataFrame:
    """Ranked-match rows; ``ordinal`` stands for file order.  Orders without lines are genes without hits."""
    ns = _pick(NAMESPACES, F.col("l_suppkey"))
    return load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("gene_id"),
        F.concat(ns, F.lit("__EP"), F.col("l_suppkey"), F.lit("_strain_"), F.col("l_partkey") % 7,
                 F.lit("|p"), F.col("l_partkey")).alias("target"),
        F.concat(ns, F.lit("__")).alias("prefix"),
        (F.col("l_extendedprice") / 100).alias("bits"),
        (F.col("l_quantity") * 2).alias("pident"),
        F.pow(F.lit(10.0), -(F.col("l_quantity") + F.lit(1))).alias("evalue"),
        (F.col("l_tax") * 1000).alias("qcov"),
        (F.col("l_linenumber").cast("bigint") * 1000000000 + F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("ordinal"),
    )


HITS = f"""hits AS (SELECT l_orderkey AS gene_id,
  {_pick_sql(NAMESPACES, 'l_suppkey')} || '__EP' || l_suppkey || '_strain_' || (l_partkey % 7) || '|p' || l_partkey AS target,
  {_pick_sql(NAMESPACES, 'l_suppkey')} || '__' AS prefix,
  l_extendedprice / 100 AS bits, l_quantity * 2 AS pident,
  pow(10.0, -(l_quantity + 1)) AS evalue, l_tax * 1000 AS qcov,
  CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 100000 + l_suppkey AS ordinal FROM lineitem)"""

RANKED = """ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gene_id
  ORDER BY bits DESC, ordinal) - 1 AS rank FROM hits) WHERE rank < 10)"""

# Profile names given to parts, in turn.
MODELS = [
    "GVOGm0003", "VP_MCP_1", "COG0532", "PLV_MCP_2", "plv_pc_054", "mirus_MCP", "VS000795", "12at2759",
    "VP_Penton_1", "VP_ATPase_2", "OG1352", "GVOGm0760", "gamadvirusMCP", "mirus_Portal", "COG0085", "PLV_PRO_3",
]


def markers(spark: SparkSession, sf: str) -> DataFrame:
    """Profile hits, one per line item."""
    return (
        load(spark, sf, "lineitem")
        .select(
            F.col("l_orderkey").alias("gene_id"),
            _pick(MODELS, F.col("l_partkey")).alias("model"),
            (F.col("l_extendedprice") / 500).alias("score"),
            F.pow(F.lit(10.0), -(F.col("l_quantity") / 2)).alias("evalue"),
            F.lit(1).cast("bigint").alias("q_start"),
            (F.col("l_quantity") * 8).cast("bigint").alias("q_end"),
            (F.col("l_linenumber").cast("bigint") * 1000000000 + F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("ordinal"),
        )
    )


MARKERS = f"""markers AS (SELECT l_orderkey AS gene_id, {_pick_sql(MODELS, 'l_partkey')} AS model,
  l_extendedprice / 500 AS score, pow(10.0, -(l_quantity / 2)) AS evalue,
  CAST(1 AS BIGINT) AS q_start, CAST(l_quantity * 8 AS BIGINT) AS q_end,
  CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 100000 + l_suppkey AS ordinal
  FROM lineitem)"""


def labels(spark: SparkSession, sf: str) -> DataFrame:
    s, n, r = (load(spark, sf, t) for t in ("supplier", "nation", "region"))
    ns = _pick(NAMESPACES, F.col("s_suppkey"))
    return (
        s.join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.concat(ns, F.lit("__EP"), F.col("s_suppkey")).alias("org_id"),
            F.concat_ws(
                "|", ns, F.col("r_name"), F.col("n_name"),
                F.when(F.col("s_suppkey") % 5 == 0, "uncultured").when(F.col("s_suppkey") % 5 == 1, "clade_X")
                .otherwise(F.concat(F.lit("genus"), F.col("s_suppkey") % 17)),
            ).alias("lineage"),
        )
    )


LABELS = f"""labelled AS (SELECT {_pick_sql(NAMESPACES, 's_suppkey')} || '__EP' || s_suppkey AS org_id,
  {_pick_sql(NAMESPACES, 's_suppkey')} || '|' || r_name || '|' || n_name || '|' ||
  CASE WHEN s_suppkey % 5 = 0 THEN 'uncultured' WHEN s_suppkey % 5 = 1 THEN 'clade_X'
       ELSE 'genus' || (s_suppkey % 17) END AS lineage
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

VIRAL_LIST = ", ".join(f"'{p}'" for p in vocab.VIRAL_PREFIXES)

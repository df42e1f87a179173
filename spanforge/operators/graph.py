"""Connected components, cluster numbering and label propagation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, vocab
from ..session import cut
from .ordered import number_rows


def roots(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every linked node that isn't a root itself; root is the smallest node it reaches.

    Each round ties all smaller neighbours of a node to the smallest one (its parent) and lifts
    each parent to its own parent. Only the minimum per node is aggregated, map-side first; the
    joins are plain ones between written tables, so adaptive execution can split a hub's rows.
    Rounds grow with the logarithm of the longest chain. Null ends and self links are ignored;
    an empty table gives an empty one.
    """
    x, y = F.col(a), F.col(b)
    e = cut(links.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct())
    while True:
        parent = cut(e.groupBy("u").agg(F.min("v").alias("p")))
        rest = e.join(parent, "u").filter("v <> p").select(F.col("v").alias("u"), F.col("p").alias("v"), F.lit(1).alias("moved"))
        above = parent.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        lifted = parent.join(above, "p", "left").select("u", F.coalesce("pp", "p").alias("v"), F.col("pp").isNotNull().cast("int").alias("moved"))
        e = cut(rest.unionByName(lifted).groupBy("u", "v").agg(F.max("moved").alias("moved")))
        if not e.agg(F.max("moved")).first()[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def components(nodes: DataFrame, edges: DataFrame, node: str = "id", a: str = "a", b: str = "b") -> DataFrame:
    """``nodes`` with ``root``, the smallest node id of each node's component."""
    found = roots(edges, a, b).withColumnRenamed("node", node)
    return nodes.join(found, node, "left").withColumn("root", F.coalesce("root", node))


def number_clusters(members: DataFrame, edges: DataFrame, genome: str = "genome_id") -> DataFrame:
    """Cluster id by falling size, then smallest member; singletons get -1.

    ``members``: genome, id, root.  ``edges``: a, b, ani above the joining threshold.
    """
    sizes = members.groupBy(genome, "root").agg(F.count(F.lit(1)).alias("cluster_size"), F.min("id").alias("_first"))
    numbered = _in_order(sizes.filter("cluster_size > 1"), genome)
    ends = edges.select(F.col("a").alias("id"), "ani").unionByName(edges.select(F.col("b").alias("id"), "ani"))
    top = ends.groupBy("id").agg(F.max("ani").alias("max_ani"))
    d = members.join(numbered.select(genome, "root", "cluster_id", "cluster_size"), [genome, "root"], "left").join(top, "id", "left")
    single = F.col("cluster_id").isNull()
    return (
        d.withColumn("max_ani", F.when(single, 0.0).otherwise(F.coalesce("max_ani", F.lit(0.0))))
        .fillna({"cluster_id": -1, "cluster_size": 1})
        .drop("root")
    )


def _in_order(sizes: DataFrame, genome: str) -> DataFrame:
    """Zero-based ``cluster_id`` by falling size, then smallest member, for ids of any type."""
    return number_rows(sizes, [genome], [F.col("cluster_size").desc(), "_first"], "cluster_id")


def propagate_class(members: DataFrame, genome: str = "genome_id") -> DataFrame:
    """Give members the one lineage class their capsid-decided relatives agree on."""
    donors = (
        members.filter((F.col("cluster_id") >= 0) & F.col("from_capsid"))
        .groupBy(genome, "cluster_id")
        .agg(F.min("taxonomy_class").alias("_lo"), F.max("taxonomy_class").alias("_hi"), F.min("id").alias("_src"))
        .filter((F.col("_lo") == F.col("_hi")) & F.col("_lo").isin(vocab.LINEAGE_CLASSES))
    )
    d = members.join(donors, [genome, "cluster_id"], "left")
    moves = F.col("_lo").isNotNull() & ~F.col("from_capsid") & (F.col("taxonomy_class") != F.col("_lo"))
    moves = F.coalesce(moves, F.lit(False))
    return (
        d.withColumn("class_before", F.when(moves, F.col("taxonomy_class")))
        .withColumn("propagated_from", F.when(moves, F.col("_src")))
        .withColumn("taxonomy_class", F.when(moves, F.col("_lo")).otherwise(F.col("taxonomy_class")))
        .drop("_lo", "_hi", "_src")
    )


def drop_unsupported(members: DataFrame, genome: str = "genome_id") -> DataFrame:
    """Remove unknown members whose cluster holds no marker-bearing one."""
    backed = members.filter((F.col("cluster_id") >= 0) & (F.col("hallmark_count") > 0)).select(genome, "cluster_id").distinct()
    bad = members.filter(F.col("taxonomy_class") == "UNKNOWN").join(backed, [genome, "cluster_id"], "left_anti").select("id")
    return members.join(bad, "id", "left_anti")


def cluster(nodes: DataFrame, edges: DataFrame, genome: str = "genome_id", min_ani: float = 95.0) -> DataFrame:
    """Components of the edges at or above ``min_ani``, numbered per genome."""
    strong = edges.filter(F.col("ani") >= min_ani)
    return number_clusters(components(nodes, strong), strong, genome)


def surviving(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges among the records of ``ids``.

    Where edges have ``copy``, all edges of a group of copies hang on one of them; if that one
    is gone, the smallest survivor of the group takes its place, as all of a group are alike.
    """
    if "copy" not in edges.columns:
        return edges.join(ids.withColumnRenamed("id", "a"), "a", "left_semi").join(ids.withColumnRenamed("id", "b"), "b", "left_semi")
    star = edges.filter("copy").select(F.col("a").alias("rep"), F.col("b").alias("id"))
    group = cut(star.unionByName(star.select("rep", F.col("rep").alias("id")).distinct()).join(ids, "id", "left_semi"))
    heads = cut(group.groupBy("rep").agg(F.min("id").alias("head")))

    def moved(d: DataFrame, end: str) -> DataFrame:
        h = heads.select(F.col("rep").alias(end), F.col("head").alias("_h"))
        return d.join(h, end, "left").withColumn(end, F.coalesce("_h", end)).drop("_h")

    others = surviving(moved(moved(edges.filter(~F.col("copy")), "a"), "b").drop("copy"), ids)
    whole = [F.lit(100.0).alias(c) for c in edges.columns if c not in ("a", "b", "copy")]
    copies = group.join(heads, "rep").filter("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b"), *whole)
    return others.withColumn("copy", F.lit(False)).unionByName(copies.withColumn("copy", F.lit(True)))


def cluster_and_propagate(nodes: DataFrame, edges: DataFrame, genome: str = "genome_id", min_ani: float = 95.0) -> DataFrame:
    """Cluster, propagate, drop unsupported members and number the survivors again."""
    nodes, edges = cut(nodes), cut(edges.drop(genome))
    first = cut(propagate_class(cluster(nodes, edges, genome, min_ani), genome))
    kept = cut(drop_unsupported(first, genome).drop("cluster_id", "cluster_size", "max_ani"))
    return cluster(kept, surviving(edges, kept.select("id")), genome, min_ani)


def edge_table(edges: DataFrame) -> DataFrame:
    """Edges as published: sorted, four decimals."""
    cols = [text.four_decimals(F.col(c).cast("double")).alias(c) for c in ("ani", "af_a", "af_b")]
    return edges.select("a", "b", *cols).orderBy("a", "b", "ani", "af_a", "af_b")

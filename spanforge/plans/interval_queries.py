"""Interval algebra on the event track and the order genes."""

from pyspark.sql import functions as F

from ..operators import intervals as iv
from ..operators.ordered import halo_window, ordinal
from .registry import query
from .tables import GENES, KEYS, TRACK, genes, load, track

W = 65536  # chunk and bin width on the event track, in seconds
G = 16384  # bin width on the order genes


def purchases(spark, sf):
    return (
        track(spark, sf)
        .filter(F.col("kind") == "purchase")
        .select(*KEYS, F.col("gene_id").alias("region_id"), F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    )


REGIONS = """regions AS (SELECT genome_id, scaffold, gene_id AS region_id, "start" AS r_start, "end" AS r_end
  FROM track WHERE kind = 'purchase')"""


@query(
    "interval_overlap_join",
    f"""WITH {TRACK}, {REGIONS}
    SELECT r.region_id, g.gene_id, greatest(g."start", r.r_start) AS shared_start,
           least(g."end", r.r_end) AS shared_end
    FROM track g JOIN regions r ON g.genome_id = r.genome_id AND g.scaffold = r.scaffold
     AND g."start" < r.r_end AND g."end" > r.r_start WHERE g.kind <> 'purchase'""",
)
def interval_overlap_join(spark, sf):
    rows = track(spark, sf).filter(F.col("kind") != "purchase")
    return iv.overlap_join(rows, purchases(spark, sf), KEYS, W).select(
        "region_id",
        "gene_id",
        F.greatest("start", "r_start").alias("shared_start"),
        F.least("end", "r_end").alias("shared_end"),
    )


@query(
    "point_in_closed_interval",
    f"""WITH {TRACK}, {REGIONS}
    SELECT r.region_id, count(*) AS n, min(g.gene_id) AS first_gene FROM track g JOIN regions r
     ON g.genome_id = r.genome_id AND g.scaffold = r.scaffold
     AND (g."start" + g."end") // 2 BETWEEN r.r_start AND r.r_end GROUP BY r.region_id""",
)
def point_in_closed_interval(spark, sf):
    points = track(spark, sf).withColumn("mid", F.floor((F.col("start") + F.col("end")) / 2))
    joined = iv.point_join(points, purchases(spark, sf), KEYS, W, closed=True)
    return joined.groupBy("region_id").agg(F.count(F.lit(1)).alias("n"), F.min("gene_id").alias("first_gene"))


@query(
    "interval_containment_join",
    f"""WITH {TRACK}, {REGIONS}
    SELECT r.region_id, count(*) AS n_inside, sum(g.gene_id)::BIGINT AS id_sum FROM track g JOIN regions r
     ON g.genome_id = r.genome_id AND g.scaffold = r.scaffold
     AND g."start" >= r.r_start AND g."end" <= r.r_end GROUP BY r.region_id""",
)
def interval_containment_join(spark, sf):
    joined = iv.containment_join(track(spark, sf), purchases(spark, sf), KEYS, W)
    return joined.groupBy("region_id").agg(F.count(F.lit(1)).alias("n_inside"), F.sum("gene_id").alias("id_sum"))


@query(
    "sliding_window_markers",
    f"""WITH {TRACK}, wide AS (SELECT o_orderkey AS region_id, o_custkey AS scaffold,
      epoch_us(TIMESTAMP '2024-01-01') // 1000000 + (o_orderkey % 20) * 86400 AS r_start,
      epoch_us(TIMESTAMP '2024-01-01') // 1000000 + (o_orderkey % 20) * 86400 + 250000 AS r_end FROM orders
      WHERE o_custkey IN (SELECT user_id FROM events)),
    w AS (SELECT *, unnest(range(r_start, r_end, 50000)) AS w_start FROM wide),
    ww AS (SELECT *, least(w_start + 100000, r_end) AS w_end FROM w)
    SELECT region_id, w_start, w_end, count(*) AS n, count(DISTINCT kind) AS kinds
    FROM ww JOIN track g ON g.scaffold = ww.scaffold AND (g."start" + g."end") // 2 >= w_start
      AND (g."start" + g."end") // 2 < w_end GROUP BY ALL""",
)
def sliding_window_markers(spark, sf):
    rows = track(spark, sf)
    origin = 1704067200
    wide = (
        load(spark, sf, "orders")
        .join(rows.select(F.col("scaffold").alias("o_custkey")).distinct(), "o_custkey", "left_semi")
        .select(
            F.col("o_orderkey").alias("region_id"),
            F.col("o_custkey").alias("scaffold"),
            (F.lit(origin) + (F.col("o_orderkey") % 20) * 86400).cast("bigint").alias("start"),
        )
        .withColumn("end", F.col("start") + 250000)
    )
    windows = iv.sliding_windows(wide, 100000, 50000).select("region_id", "scaffold", "w_start", "w_end")
    points = rows.select("scaffold", "kind", F.floor((F.col("start") + F.col("end")) / 2).alias("mid"))
    joined = iv.point_join(points, windows, ["scaffold"], W, span=("w_start", "w_end"))
    return joined.groupBy("region_id", "w_start", "w_end").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("kind").alias("kinds")
    )


@query(
    "neighbour_score",
    f"""WITH {TRACK}
    SELECT a.gene_id, round(sum(b.score) / 50, 6) AS neighbour_score, count(*) AS neighbours
    FROM track a JOIN track b ON a.genome_id = b.genome_id AND a.scaffold = b.scaffold AND a.gene_id <> b.gene_id
     AND least(abs(a."start" - b."start"), abs(a."end" - b."end")) <= 50000 GROUP BY a.gene_id""",
)
def neighbour_score(spark, sf):
    from ..operators.neighbors import neighbour_scores

    return neighbour_scores(track(spark, sf), KEYS, "gene_id", 50000).select(
        "gene_id", F.round("neighbour_score", 6).alias("neighbour_score"), "neighbours"
    )


@query(
    "gene_ordinal",
    f"""WITH {TRACK} SELECT gene_id, scaffold,
      row_number() OVER (PARTITION BY genome_id, scaffold ORDER BY "start", "end", gene_id) - 1 AS gene_idx FROM track""",
)
def gene_ordinal(spark, sf):
    return ordinal(track(spark, sf), KEYS, "start", ["start", "end", "gene_id"], W).select("gene_id", "scaffold", "gene_idx")


@query(
    "gap_clusters",
    f"""WITH {TRACK}, p AS (SELECT *, lag("end") OVER w AS pe FROM track
       WINDOW w AS (PARTITION BY genome_id, scaffold ORDER BY "start", gene_id)),
    b AS (SELECT *, CASE WHEN pe IS NULL OR "start" - pe > 10000 THEN 1 ELSE 0 END AS brk FROM p),
    c AS (SELECT *, sum(brk) OVER (PARTITION BY genome_id, scaffold ORDER BY "start", gene_id) AS island FROM b)
    SELECT scaffold, island::BIGINT AS island, min("start") AS "start", max("end") AS "end", count(*) AS n
    FROM c GROUP BY genome_id, scaffold, island""",
)
def gap_clusters(spark, sf):
    marked = iv.gap_cluster(track(spark, sf), KEYS, W, 10000, ["gene_id"])
    return (
        marked.groupBy(*KEYS, "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n"))
        .drop("genome_id")
    )


@query(
    "merged_intervals",
    f"""WITH {TRACK}, p AS (SELECT *, max("end") OVER (PARTITION BY genome_id, scaffold ORDER BY "start", gene_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM track),
    b AS (SELECT *, CASE WHEN reach IS NULL OR "start" > reach + 1000 THEN 1 ELSE 0 END AS brk FROM p),
    c AS (SELECT *, sum(brk) OVER (PARTITION BY genome_id, scaffold ORDER BY "start", gene_id) AS island FROM b)
    SELECT genome_id, scaffold, min("start") AS "start", max("end") AS "end", count(*) AS n_merged
    FROM c GROUP BY genome_id, scaffold, island""",
)
def merged_intervals(spark, sf):
    return iv.merge_intervals(track(spark, sf), KEYS, W, max_gap=1000)


@query(
    "typed_merge",
    f"""WITH {TRACK}, k AS (SELECT *, CASE WHEN kind IN ('view', 'click') THEN 'a' ELSE 'b' END AS grp FROM track),
    r AS (SELECT *, CASE WHEN lag(grp) OVER w IS DISTINCT FROM grp THEN 1 ELSE 0 END AS rb FROM k
       WINDOW w AS (PARTITION BY genome_id, scaffold ORDER BY "start", "end", gene_id)),
    r2 AS (SELECT *, sum(rb) OVER (PARTITION BY genome_id, scaffold ORDER BY "start", "end", gene_id) AS run FROM r),
    p AS (SELECT *, max("end") OVER (PARTITION BY genome_id, scaffold, run ORDER BY "start", "end", gene_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r2),
    b AS (SELECT *, CASE WHEN reach IS NULL OR "start" >= reach OR kind = 'error' THEN 1 ELSE 0 END AS brk FROM p),
    c AS (SELECT *, sum(brk) OVER (PARTITION BY genome_id, scaffold, run ORDER BY "start", "end", gene_id) AS island FROM b)
    SELECT scaffold, grp, min("start") AS "start", max("end") AS "end", count(*) AS n
    FROM c GROUP BY genome_id, scaffold, run, grp, island""",
)
def typed_merge(spark, sf):
    rows = track(spark, sf).withColumn("grp", F.when(F.col("kind").isin("view", "click"), "a").otherwise("b"))
    marked = iv.typed_islands(rows, KEYS, W, ["end", "gene_id"], "grp", F.col("kind") != "error", keep_run=True)
    return (
        marked.groupBy(*KEYS, "run", "grp", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n"))
        .drop("genome_id", "run", "island")
    )


@query(
    "best_per_overlap_cluster",
    f"""WITH {GENES}, p AS (SELECT *, max("end") OVER (PARTITION BY scaffold, strand ORDER BY "start", gene_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM genes),
    b AS (SELECT *, CASE WHEN reach IS NULL OR "start" >= reach THEN 1 ELSE 0 END AS brk FROM p),
    c AS (SELECT *, sum(brk) OVER (PARTITION BY scaffold, strand ORDER BY "start", gene_id) AS island FROM b),
    d AS (SELECT *, row_number() OVER (PARTITION BY scaffold, strand, island ORDER BY "end" - "start" DESC, gene_id) AS rn,
       count(*) OVER (PARTITION BY scaffold, strand, island) AS members FROM c)
    SELECT scaffold, strand, gene_id, members FROM d WHERE rn = 1""",
)
def best_per_overlap_cluster(spark, sf):
    from ..operators.islands import best_per_cluster

    rows = genes(spark, sf).withColumn("score", F.col("end") - F.col("start"))
    return best_per_cluster(rows, ["genome_id", "scaffold", "strand"], G, "gene_id", "score").select(
        "scaffold", "strand", "gene_id", "members"
    )


@query(
    "domain_count",
    f"""WITH {GENES}, p AS (SELECT *, max("end") OVER (PARTITION BY scaffold ORDER BY "start", gene_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM genes)
    SELECT scaffold, count(*) FILTER (reach IS NULL OR ("end" > "start" AND
       greatest(0, reach - "start") < 0.5 * ("end" - "start"))) AS n_domains FROM p GROUP BY scaffold""",
)
def domain_count(spark, sf):
    return iv.non_overlapping_count(genes(spark, sf), KEYS, G, ["gene_id"]).drop("genome_id")


@query(
    "neighbour_means",
    f"""WITH {TRACK} SELECT gene_id, round(avg(score) OVER w, 6) AS score_mean, count(*) OVER w AS n FROM track
    WINDOW w AS (PARTITION BY genome_id, scaffold ORDER BY "start", "end", gene_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""",
)
def neighbour_means(spark, sf):
    d = ordinal(track(spark, sf), KEYS, "start", ["start", "end", "gene_id"], W)
    return halo_window(
        d,
        KEYS,
        "gene_idx",
        {
            "score_mean": lambda w: F.round(F.avg("score").over(w.rowsBetween(-2, 2)), 6),
            "n": lambda w: F.count(F.lit(1)).over(w.rowsBetween(-2, 2)),
        },
        halo=2,
    ).select("gene_id", "score_mean", "n")


@query(
    "decayed_neighbour_score",
    f"""WITH {TRACK}, h AS (SELECT *, CASE WHEN kind <> 'error' THEN score END AS s FROM track)
    SELECT gene_id, round(coalesce(lag(s, 1) OVER w, 0) + coalesce(lead(s, 1) OVER w, 0)
      + (coalesce(lag(s, 2) OVER w, 0) + coalesce(lead(s, 2) OVER w, 0)) / 2, 6) AS support
    FROM h WINDOW w AS (PARTITION BY genome_id, scaffold ORDER BY "start", "end", gene_id)""",
)
def decayed_neighbour_score(spark, sf):
    from ..operators.neighbors import decayed_sum

    rows = track(spark, sf).withColumn("s", F.when(F.col("kind") != "error", F.col("score")))
    d = ordinal(rows, KEYS, "start", ["start", "end", "gene_id"], W)
    return halo_window(d, KEYS, "gene_idx", {"support": decayed_sum("s", 2)}, halo=2).select(
        "gene_id", F.round("support", 6).alias("support")
    )


@query(
    "rank_distance_neighbours",
    f"""WITH {TRACK}, g AS (SELECT *, row_number() OVER (PARTITION BY genome_id, scaffold ORDER BY "start", "end", gene_id) - 1 AS i
       FROM track),
    r AS (SELECT r.gene_id AS region_id, r.genome_id, r.scaffold, min(g.i) AS lo, max(g.i) AS hi FROM track r JOIN g
       ON g.genome_id = r.genome_id AND g.scaffold = r.scaffold AND g."start" < r."end" AND g."end" > r."start"
       WHERE r.kind = 'purchase' GROUP BY ALL)
    SELECT region_id, gene_id, CASE WHEN i < lo THEN 'upstream' WHEN i > hi THEN 'downstream' ELSE 'interior' END AS role,
      CASE WHEN i < lo THEN lo - i WHEN i > hi THEN i - hi ELSE 0 END AS distance
    FROM r JOIN g ON g.genome_id = r.genome_id AND g.scaffold = r.scaffold AND g.i BETWEEN lo - 3 AND hi + 3""",
)
def rank_distance_neighbours(spark, sf):
    from ..operators.neighbors import region_genes

    indexed = ordinal(track(spark, sf), KEYS, "start", ["start", "end", "gene_id"], W)
    return region_genes(purchases(spark, sf), indexed, KEYS, "region_id", 3, W).select(
        "region_id", "gene_id", "role", "distance"
    )


@query(
    "consecutive_blocks",
    f"""WITH {TRACK}, g AS (SELECT *, row_number() OVER (PARTITION BY genome_id, scaffold ORDER BY "start", "end", gene_id) - 1 AS i
       FROM track),
    e AS (SELECT *, i - (row_number() OVER (PARTITION BY genome_id, scaffold ORDER BY i) - 1) AS stretch FROM g WHERE kind <> 'purchase'),
    f AS (SELECT *, (row_number() OVER (PARTITION BY genome_id, scaffold, stretch ORDER BY i) - 1) // 3 AS block FROM e)
    SELECT scaffold, stretch, block, min(gene_id) AS first_gene, count(*) AS n FROM f
    GROUP BY genome_id, scaffold, stretch, block HAVING count(*) = 3""",
)
def consecutive_blocks(spark, sf):
    from ..operators.neighbors import stretch_blocks

    indexed = ordinal(track(spark, sf), KEYS, "start", ["start", "end", "gene_id"], W)
    blocks = stretch_blocks(indexed.filter(F.col("kind") != "purchase"), KEYS, "gene_idx", 3)
    return (
        blocks.groupBy(*KEYS, "stretch", "block")
        .agg(F.min("gene_id").alias("first_gene"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == 3)
        .drop("genome_id")
    )


@query(
    "final_order",
    f"""WITH {TRACK} SELECT genome_id, gene_id, row_number() OVER (PARTITION BY genome_id ORDER BY scaffold, "start", "end", gene_id) AS number
    FROM track""",
)
def final_order(spark, sf):
    from ..operators.islands import number_regions

    return number_regions(track(spark, sf), "genome_id", ["scaffold"], ["start", "end", "gene_id"], "number").select(
        "genome_id", "gene_id", "number"
    )


@query(
    "contig_tiles",
    """WITH t AS (SELECT *, unnest(range(0, greatest(1, (length(text) + 999) // 1000))) AS tile_idx FROM documents)
    SELECT doc_id, tile_idx, tile_idx * 1000 AS core_start, least(tile_idx * 1000 + 1000, length(text)) AS core_end,
      greatest(0, tile_idx * 1000 - 50) AS tile_start,
      md5(substr(text, greatest(0, tile_idx * 1000 - 50) + 1,
        least(length(text), tile_idx * 1000 + 1050) - greatest(0, tile_idx * 1000 - 50))) AS tile_md5 FROM t""",
)
def contig_tiles(spark, sf):
    docs = load(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("seq"), F.length("text").cast("bigint").alias("seq_len")
    )
    return iv.tile(docs, 1000, 50).select(
        "doc_id", "tile_idx", "core_start", "core_end", "tile_start", F.md5("tile_seq").alias("tile_md5")
    )


@query(
    "branch_union",
    f"""WITH {TRACK}, {GENES} SELECT genome_id, scaffold, gene_id, "start", "end", 'track' AS branch FROM track
    UNION ALL SELECT genome_id, scaffold, gene_id, "start", "end", 'genes' FROM genes""",
)
def branch_union(spark, sf):
    cols = [*KEYS, "gene_id", "start", "end"]
    return (
        track(spark, sf).select(*cols).withColumn("branch", F.lit("track"))
        .unionByName(genes(spark, sf).select(*cols).withColumn("branch", F.lit("genes")))
    )


@query(
    "surface_difference",
    f"""WITH {TRACK} SELECT genome_id, scaffold, "start", "end" FROM track
    EXCEPT SELECT genome_id, scaffold, "start", "end" FROM track WHERE kind = 'view' OR score < 20""",
)
def surface_difference(spark, sf):
    cols = [*KEYS, "start", "end"]
    rows = track(spark, sf)
    return rows.select(*cols).subtract(rows.filter((F.col("kind") == "view") | (F.col("score") < 20)).select(*cols))


@query(
    "region_slices",
    """SELECT doc_id, md5(substr(text, CAST(n_chars // 4 AS BIGINT) + 1, CAST(n_chars // 2 - n_chars // 4 AS BIGINT))) AS slice_md5
    FROM documents""",
)
def region_slices(spark, sf):
    docs = load(spark, sf, "documents")
    quarter, half = F.floor(F.col("n_chars") / 4), F.floor(F.col("n_chars") / 2)
    regions = docs.select("doc_id", quarter.alias("start"), half.alias("end"))
    contigs = docs.select("doc_id", F.col("text").alias("seq"))
    return iv.slice_join(regions, contigs, ["doc_id"]).select("doc_id", F.md5("region_seq").alias("slice_md5"))

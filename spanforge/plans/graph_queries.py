"""Similarity, clusters, propagation and evidence coherence."""

from pyspark.sql import functions as F

from ..operators import evidence as ev
from ..operators import graph as gr
from ..operators import similarity as sm
from .registry import query
from .sequence_queries import CONTIGS, contigs
from .tables import load, track

K = 16

#: All k-mers of all records, without any threshold.
SKETCH = f"""{CONTIGS}, tl AS (SELECT doc_id, substr(seq, t + 1, 200 + {K} - 1) AS s FROM (SELECT doc_id, seq, unnest(range(0, length(seq) - {K} + 1, 200)) AS t
    FROM contigs WHERE length(seq) >= {K})),
  mer AS (SELECT doc_id, substr(s, i, {K}) AS m FROM (SELECT doc_id, s, unnest(range(1, length(s) - {K} + 2)) AS i FROM tl)),
  sk AS (SELECT DISTINCT doc_id % 2 AS genome_id, doc_id, least(m, reverse(translate(m, 'ACGT', 'TGCA'))) AS h FROM mer WHERE NOT contains(m, 'N')),
  per AS (SELECT genome_id, doc_id, count(*) AS n, min(doc_id) OVER (PARTITION BY genome_id, string_agg(h, ',' ORDER BY h)) AS rep FROM sk GROUP BY genome_id, doc_id),
  lead AS (SELECT sk.genome_id, sk.doc_id, h, n FROM sk JOIN per USING (doc_id) WHERE rep = sk.doc_id),
  c AS (SELECT x.genome_id, x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS c FROM lead x JOIN lead y ON x.genome_id = y.genome_id AND x.h = y.h
     AND x.doc_id < y.doc_id GROUP BY ALL),
  ed AS (SELECT genome_id, a, b, 100 * pow(c / least(na, nb), 1e0 / {K}) AS ani, 100e0 * c / na AS af_a, 100e0 * c / nb AS af_b FROM c
     WHERE 100 * pow(c / least(na, nb), 1e0 / {K}) >= 80 AND greatest(c / na, c / nb) >= 0.5
     UNION ALL SELECT genome_id, rep, doc_id, 100, 100, 100 FROM per WHERE rep <> doc_id)"""


def edges(spark, sf):
    """Similar documents of two genomes, by number."""
    c = contigs(spark, sf).select((F.col("doc_id") % 2).alias("genome_id"), "doc_id", "seq")
    return sm.similar_pairs(c, "doc_id", "genome_id", K)


@query("similarity_edges", f"WITH {SKETCH} SELECT genome_id, a, b, round(ani, 6) AS ani, round(af_a, 6) AS af_a, round(af_b, 6) AS af_b FROM ed")
def similarity_edges(spark, sf):
    return edges(spark, sf).select("genome_id", "a", "b", *[F.round(c, 6).alias(c) for c in ("ani", "af_a", "af_b")])


NODES = """nodes AS (SELECT d.doc_id AS id, d.doc_id % 2 AS genome_id, coalesce(l.quality = 1, false) AS from_capsid,
   CASE WHEN l.quality = 1 THEN CASE WHEN lang IN ('en', 'fr') THEN 'PPV' ELSE 'NCLDV' END WHEN l.quality = 0 THEN 'VIRAL_UNKNOWN' ELSE 'UNKNOWN' END AS cls,
   CASE WHEN l.toxic = 0 THEN 1 ELSE 0 END AS hallmark_count FROM documents d LEFT JOIN labels l USING (doc_id))"""


def nodes(spark, sf):
    q = F.col("quality")
    named = F.when(F.col("lang").isin("en", "fr"), "PPV").otherwise("NCLDV")
    return load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id", "left").select(
        F.col("doc_id").alias("id"), (F.col("doc_id") % 2).alias("genome_id"), F.coalesce(q == 1, F.lit(False)).alias("from_capsid"),
        F.when(q == 1, named).when(q == 0, "VIRAL_UNKNOWN").otherwise("UNKNOWN").alias("taxonomy_class"),
        F.when(F.col("toxic") == 0, 1).otherwise(0).alias("hallmark_count"),
    )


COMP = f"""{SKETCH.replace('lead AS', 'ld AS').replace('FROM lead x JOIN lead y', 'FROM ld x JOIN ld y')}, st AS (SELECT a, b FROM ed WHERE ani >= 95),
  sy AS (SELECT a, b FROM st UNION SELECT b, a FROM st),
  reach(a, b) AS (SELECT a, b FROM sy UNION SELECT r.a, s.b FROM reach r JOIN sy s ON r.b = s.a),
  comp AS (SELECT d.doc_id AS id, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS root FROM documents d LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id)"""


@query("connected_components", f"WITH RECURSIVE {COMP} SELECT id, root FROM comp")
def connected_components(spark, sf):
    d = load(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return gr.components(d, edges(spark, sf).filter(F.col("ani") >= 95)).select("id", "root")


@query(
    "cluster_numbers",
    f"""WITH RECURSIVE {COMP}, sz AS (SELECT root, count(*) AS n FROM comp GROUP BY root),
    nm AS (SELECT root, n, row_number() OVER (PARTITION BY root % 2 ORDER BY n DESC, root) - 1 AS cid FROM sz WHERE n > 1),
    mx AS (SELECT id, max(ani) AS ani FROM (SELECT a AS id, ani FROM ed WHERE ani >= 95 UNION ALL SELECT b, ani FROM ed WHERE ani >= 95) GROUP BY id)
    SELECT c.id % 2 AS genome_id, c.id, coalesce(cid, -1) AS cluster_id, coalesce(n, 1) AS cluster_size, round(CASE WHEN cid IS NULL THEN 0 ELSE coalesce(ani, 0) END, 6) AS max_ani
    FROM comp c LEFT JOIN nm USING (root) LEFT JOIN mx USING (id)""",
)
def cluster_numbers(spark, sf):
    d = gr.cluster(nodes(spark, sf), edges(spark, sf))
    return d.select("genome_id", "id", F.col("cluster_id").cast("bigint").alias("cluster_id"), "cluster_size", F.round("max_ani", 6).alias("max_ani"))


@query(
    "class_propagation",
    f"""WITH RECURSIVE {COMP}, {NODES}, n AS (SELECT n.*, root, count(*) OVER (PARTITION BY root) AS sz FROM nodes n JOIN comp USING (id)),
    dn AS (SELECT root, min(cls) AS cls FROM n WHERE sz > 1 AND from_capsid GROUP BY root HAVING count(DISTINCT cls) = 1),
    p AS (SELECT n.*, CASE WHEN dn.cls IS NOT NULL AND NOT from_capsid THEN dn.cls ELSE n.cls END AS new_cls FROM n LEFT JOIN dn USING (root)),
    ok AS (SELECT DISTINCT root FROM p WHERE sz > 1 AND hallmark_count > 0),
    kept AS (SELECT id, new_cls FROM p WHERE new_cls <> 'UNKNOWN' OR (sz > 1 AND root IN (SELECT root FROM ok))),
    ns AS (SELECT doc_id, count(*) AS n FROM sk GROUP BY doc_id),
    every AS (SELECT x.doc_id AS a, y.doc_id AS b, 100 * pow(count(*) / least(any_value(p.n), any_value(q.n)), 1e0 / {K}) AS ani FROM sk x JOIN sk y ON x.h = y.h AND x.genome_id = y.genome_id AND x.doc_id < y.doc_id
       JOIN ns p ON p.doc_id = x.doc_id JOIN ns q ON q.doc_id = y.doc_id GROUP BY ALL HAVING count(*) / least(any_value(p.n), any_value(q.n)) >= 0.5),
    lv AS (SELECT a, b, ani FROM every WHERE ani >= 95 AND a IN (SELECT id FROM kept) AND b IN (SELECT id FROM kept)),
    ly AS (SELECT a, b FROM lv UNION SELECT b, a FROM lv),
    again(a, b) AS (SELECT a, b FROM ly UNION SELECT r.a, s.b FROM again r JOIN ly s ON r.b = s.a),
    rt AS (SELECT k.id, least(k.id, coalesce(min(r.b), k.id)) AS root FROM kept k LEFT JOIN again r ON r.a = k.id GROUP BY k.id),
    sz2 AS (SELECT root, count(*) AS n FROM rt GROUP BY root), nm2 AS (SELECT root, n, row_number() OVER (PARTITION BY root % 2 ORDER BY n DESC, root) - 1 AS cid FROM sz2 WHERE n > 1),
    mx2 AS (SELECT id, max(ani) AS ani FROM (SELECT a AS id, ani FROM lv UNION ALL SELECT b, ani FROM lv) GROUP BY id)
    SELECT k.id % 2 AS genome_id, k.id, new_cls AS taxonomy_class, coalesce(cid, -1) AS cluster_id, coalesce(n, 1) AS cluster_size, round(CASE WHEN cid IS NULL THEN 0 ELSE coalesce(ani, 0) END, 6) AS max_ani
    FROM kept k JOIN rt USING (id) LEFT JOIN nm2 USING (root) LEFT JOIN mx2 USING (id)""",
)
def class_propagation(spark, sf):
    """The check lists all pairs of records, copies too, and clusters the survivors anew."""
    d = gr.cluster_and_propagate(nodes(spark, sf), edges(spark, sf))
    return d.select("genome_id", "id", "taxonomy_class", F.col("cluster_id").cast("bigint").alias("cluster_id"), "cluster_size", F.round("max_ani", 6).alias("max_ani"))


@query(
    "vector_nearest",
    """WITH p AS (SELECT q.vec_id AS q_id, d.vec_id AS d_id, list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]) AS c
       FROM embeddings q JOIN embeddings d ON q.vec_id <> d.vec_id), b AS (SELECT q_id, first(d_id ORDER BY c DESC, d_id) AS d_id, max(c) AS c FROM p GROUP BY q_id)
    SELECT q_id, d_id, round(c, 6) AS cosine FROM b WHERE c >= 0.3""",
)
def vector_nearest(spark, sf):
    e = load(spark, sf, "embeddings")
    q, b = e.select(F.col("vec_id").alias("q_id"), F.col("embedding").alias("vec")), e.select(F.col("vec_id").alias("d_id"), F.col("embedding").alias("vec"))
    return sm.nearest(sm.unique_vectors(q), b, 0.3).withColumn("cosine", F.round("cosine", 6))


@query(
    "marker_set_distance",
    """WITH e AS (SELECT user_id, event_type || CAST(floor(value / 100) AS INT) AS item FROM events), s AS (SELECT user_id, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM e GROUP BY user_id),
    d AS (SELECT items, count(*) AS nk, min(user_id) AS rep FROM s GROUP BY items), r AS (SELECT rep, nk, len(string_split(items, ',')) AS n, unnest(string_split(items, ',')) AS i FROM d)
    SELECT x.rep AS a, y.rep AS b, x.nk AS n_a, y.nk AS n_b, round(1 - count(*) / (x.n + y.n - count(*)), 6) AS distance FROM r x JOIN r y ON x.i = y.i AND x.rep < y.rep
    GROUP BY x.rep, y.rep, x.nk, y.nk, x.n, y.n""",
)
def marker_set_distance(spark, sf):
    rows = track(spark, sf).withColumn("item", F.concat("kind", F.floor(F.col("score") / 100).cast("string")))
    return sm.set_distances(rows, "scaffold", "item").withColumn("distance", F.round("distance", 6))


# ------------------------------------------------------------------ evidence

EVID = """ev AS (SELECT DISTINCT user_id AS cand, (epoch_us(ts) // 1000000 - 1704067200) // 43200 AS idx, CASE event_type WHEN 'view' THEN 'hallmark_mcp' WHEN 'signup' THEN 'hallmark_polb'
     WHEN 'purchase' THEN 'high_kfd' WHEN 'error' THEN 'high_novelty' ELSE 'crf_core_viral' END AS type FROM events
   UNION SELECT user_id, (epoch_us(ts) // 1000000 - 1704067200) // 43200, 'viral_structure' FROM events WHERE value > 60),
  nw AS (SELECT cand, max(idx) - min(idx) + 1 AS n FROM ev GROUP BY cand),
  co AS (SELECT cand, least(t1, t2) AS u, greatest(t1, t2) AS v, sum(w) AS weight FROM (
     SELECT x.cand, x.type AS t1, y.type AS t2, 1e0 AS w FROM ev x JOIN ev y ON x.cand = y.cand AND x.idx = y.idx AND x.type < y.type
     UNION ALL SELECT x.cand, x.type, y.type, 0.5e0 FROM ev x JOIN ev y ON x.cand = y.cand AND y.idx = x.idx + 1 AND x.type <> y.type) GROUP BY ALL)"""


def evidence(spark, sf):
    t = track(spark, sf).withColumn("idx", F.floor((F.col("start") - 1704067200) / 43200))
    kind = F.when(F.col("kind") == "view", "hallmark_mcp").when(F.col("kind") == "signup", "hallmark_polb").when(
        F.col("kind") == "purchase", "high_kfd").when(F.col("kind") == "error", "high_novelty").otherwise("crf_core_viral")
    a = t.select(F.col("scaffold").alias("cand"), "idx", kind.alias("type"))
    b = t.filter(F.col("score") > 60).select(F.col("scaffold").alias("cand"), "idx", F.lit("viral_structure").alias("type"))
    w = a.unionByName(b).distinct()
    return w, w.groupBy("cand").agg((F.max("idx") - F.min("idx") + 1).alias("n"))


@query("evidence_co_occurrence", f"WITH {EVID} SELECT cand, u, v, weight FROM co")
def evidence_co_occurrence(spark, sf):
    return ev.co_occurrence(evidence(spark, sf)[0])


@query(
    "evidence_strongest",
    f"""WITH {EVID}, r AS (SELECT *, row_number() OVER (PARTITION BY cand ORDER BY weight DESC, u, v) AS pos FROM co) SELECT cand, u, v, weight, pos FROM r WHERE pos <= 5""",
)
def evidence_strongest(spark, sf):
    return ev.strongest(ev.co_occurrence(evidence(spark, sf)[0]))


EXPECTED_SQL = ", ".join("'" + "|".join(sorted(p)) + "'" for p in ev.EXPECTED)


@query(
    "evidence_coherence",
    f"""WITH {EVID}, t AS (SELECT cand, count(DISTINCT type) AS n, count(DISTINCT type) FILTER (type = 'hallmark_mcp') AS s FROM ev GROUP BY cand),
    e AS (SELECT cand, count(*) AS m, sum(CASE WHEN u || '|' || v IN ({EXPECTED_SQL}) THEN 0.0375e0 * least(1, weight / nw.n) ELSE 0 END) AS b FROM co JOIN nw USING (cand) GROUP BY cand),
    c AS (SELECT cand, least(0.25e0, n / 20e0) + coalesce(0.25e0 * m / nullif(n * (n - 1) / 2e0, 0), 0) + coalesce(b, 0) + 0.2e0 * s / 4 AS coherence FROM t LEFT JOIN e USING (cand))
    SELECT cand, round(coherence, 6) AS coherence, CASE WHEN coherence >= 0.7 THEN 'high' WHEN coherence >= 0.5 THEN 'medium' WHEN coherence >= 0.3 THEN 'low' ELSE 'reject' END AS level FROM c""",
)
def evidence_coherence(spark, sf):
    w, n = evidence(spark, sf)
    return ev.coherence(w, n).select("cand", F.round("coherence", 6).alias("coherence"), "level")


@query(
    "evidence_profile",
    f"WITH {EVID} SELECT cand, type, count(*) AS n_seen, round(count(*) / any_value(nw.n), 6) AS coverage FROM ev JOIN nw USING (cand) GROUP BY cand, type",
)
def evidence_profile(spark, sf):
    return ev.evidence_profile(*evidence(spark, sf)).withColumn("coverage", F.round("coverage", 6))

"""Ranked hits, validation, arbitration, lookups and scalar functions on them."""

from pyspark.sql import functions as F

from ..functions import hits as hx
from ..functions import text, vocab
from ..operators import hits as ho
from .registry import query
from .tables import GENES, HITS, KEYS, LABELS, MARKERS, MODELS, RANKED, VIRAL_LIST, genes, hits, labels, load, markers

VALIDATED = ", ".join(f"'{p}'" for p in vocab.VALIDATED_PREFIXES)
CAPSID = (
    "regexp_matches(lower(model), '^(og1352|og484|vs000086|vs000309|gamadvirusmcp|gvogm0003|mcp|"
    "(gamadvirusmcp|mcp_mirus|mcp_poli|mirus_mcp|plv_mcp|vp_mcp)[a-z0-9_]*)$')"
)

SUMMARY = f"""summary AS (SELECT gene_id, count(*) AS n_hits,
  string_agg(target, ',' ORDER BY rank) AS targets,
  min_by(target, rank) AS top1_target, min_by(prefix, rank) AS top1_prefix, min_by(pident, rank) AS top1_pident,
  min_by(evalue, rank) AS top1_evalue,
  bool_or(prefix = 'NCLDV__') AS has_ncldv, bool_or(prefix = 'MIRUS__') AS has_mirus,
  bool_or(prefix = 'PPV__') AS has_plv, bool_or(prefix = 'GVMAG__') AS has_gvmag,
  bool_or(prefix IN ({VIRAL_LIST})) AS has_viral,
  bool_or(prefix IN ({VIRAL_LIST}) AND pident >= 25) AS has_qualified,
  coalesce(max(CASE WHEN prefix IN ({VALIDATED}) THEN pident END), 0) AS max_validated_pident
  FROM ranked GROUP BY gene_id)"""


def ranked_hits(spark, sf):
    return ho.rank_hits(hits(spark, sf))


def summary(spark, sf):
    return ho.gene_hits(ranked_hits(spark, sf))


@query("top10_hits", f"WITH {HITS}, {RANKED} SELECT gene_id, rank, target, bits FROM ranked")
def top10_hits(spark, sf):
    return ranked_hits(spark, sf).select("gene_id", F.col("rank").cast("bigint").alias("rank"), "target", "bits")


@query(
    "gene_hit_summary",
    f"""WITH {HITS}, {RANKED}, {SUMMARY} SELECT gene_id, n_hits, targets, top1_target, has_ncldv, has_mirus, has_plv,
    has_gvmag, has_viral, has_qualified, max_validated_pident FROM summary""",
)
def gene_hit_summary(spark, sf):
    return summary(spark, sf).select(
        "gene_id",
        "n_hits",
        F.array_join(F.transform("top10", lambda h: h["target"]), ",").alias("targets"),
        "top1_target",
        "has_ncldv",
        "has_mirus",
        "has_plv",
        "has_gvmag",
        "has_viral",
        "has_qualified",
        "max_validated_pident",
    )


@query(
    "genes_without_hits",
    f"""WITH {GENES}, {HITS}, {RANKED}, {SUMMARY} SELECT g.gene_id, coalesce(n_hits, 0) AS n_hits,
    n_hits IS NOT NULL AS has_hit, coalesce(top1_target, 'unknown') AS top1_target
    FROM genes g LEFT JOIN summary s ON s.gene_id = g.gene_id""",
)
def genes_without_hits(spark, sf):
    d = ho.with_no_hits(genes(spark, sf), summary(spark, sf))
    return d.fillna("unknown", ["top1_target"]).select("gene_id", "n_hits", "has_hit", "top1_target")


@query(
    "best_profile_hit",
    f"""WITH {MARKERS}, b AS (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY score DESC, ordinal) AS rn FROM markers)
    SELECT gene_id, model, score FROM b WHERE rn = 1 AND score >= 50 AND evalue <= 1e-5""",
)
def best_profile_hit(spark, sf):
    return ho.best_profile_hits(markers(spark, sf)).select("gene_id", "model", "score")


@query(
    "capsid_preferred_hit",
    f"""WITH {MARKERS}, b AS (SELECT *, row_number() OVER (PARTITION BY gene_id
      ORDER BY CASE WHEN {CAPSID} THEN 0 ELSE 1 END, score DESC, ordinal) AS rn FROM markers)
    SELECT gene_id, model, score FROM b WHERE rn = 1""",
)
def capsid_preferred_hit(spark, sf):
    return ho.prefer_capsid(markers(spark, sf), ["gene_id"]).select("gene_id", "model", "score")


VALID = f"""valid AS (SELECT g.genome_id, g.scaffold, g."start", g."end", g.strand, m.gene_id, m.model, m.score, m.evalue, m.ordinal,
    coalesce(n_hits, 0) AS n_hits, coalesce(has_ncldv, false) AS has_ncldv, coalesce(has_mirus, false) AS has_mirus,
    coalesce(has_plv, false) AS has_plv, coalesce(has_qualified, false) AS has_qualified,
    CASE WHEN n_hits IS NULL THEN CASE WHEN score >= 30 AND least(1, (q_end - q_start + 1) / 300.0) >= 0.5
           AND count(*) OVER (PARTITION BY g.genome_id, g.scaffold) > 1 THEN 'validated_novel' ELSE 'unvalidated' END
         WHEN max_validated_pident >= 25 THEN 'validated' WHEN has_gvmag THEN 'supported' ELSE 'unvalidated' END AS status
  FROM markers m JOIN genes g ON g.gene_id = m.gene_id LEFT JOIN summary s ON s.gene_id = m.gene_id)"""

VALID_CTES = f"{GENES}, {HITS}, {RANKED}, {SUMMARY}, {MARKERS}, {VALID}"


def placed_markers(spark, sf):
    g = genes(spark, sf).select(*KEYS, "gene_id", "start", "end", "strand")
    return markers(spark, sf).join(g, "gene_id")


def validated(spark, sf):
    return ho.validate_markers(placed_markers(spark, sf), summary(spark, sf), KEYS)


@query("marker_validation", f"WITH {VALID_CTES} SELECT gene_id, ordinal, model, status, n_hits FROM valid")
def marker_validation(spark, sf):
    return validated(spark, sf).select("gene_id", "ordinal", "model", "status", "n_hits")


@query(
    "validation_by_group",
    f"""WITH {VALID_CTES} SELECT CASE WHEN model ILIKE 'gvogm%' THEN 'GVOGm' WHEN model ILIKE 'og%' THEN 'OG' ELSE 'OTHER' END AS grp,
    status, count(*) AS n, count(DISTINCT gene_id) AS genes FROM valid GROUP BY ALL""",
)
def validation_by_group(spark, sf):
    return (
        validated(spark, sf)
        .groupBy(text.marker_group(F.col("model")).alias("grp"), "status")
        .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("gene_id").alias("genes"))
    )


@query(
    "marker_roles",
    f"""WITH {VALID_CTES}, arms AS (SELECT unnest(['A0', 'A2']) AS arm)
    SELECT arm, status, CASE WHEN status IN ('validated', 'validated_novel') THEN 'production_validated'
      WHEN arm = 'A2' AND score >= 50 AND evalue <= 1e-5 THEN 'tier1_bypassed' ELSE 'rejected' END AS role, count(*) AS n
    FROM valid CROSS JOIN arms GROUP BY ALL""",
)
def marker_roles(spark, sf):
    d = validated(spark, sf).withColumn("arm", F.explode(F.array(F.lit("A0"), F.lit("A2"))))
    role = hx.marker_role(F.col("arm"), F.col("status"), F.col("score"), F.col("evalue"))
    return d.groupBy("arm", "status", role.alias("role")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "seedable_markers",
    f"""WITH {VALID_CTES} SELECT gene_id, ordinal, status = 'validated' OR (status = 'validated_novel' AND {CAPSID}) AS seedable,
    {CAPSID} AS capsid FROM valid""",
)
def seedable_markers(spark, sf):
    return validated(spark, sf).select(
        "gene_id",
        "ordinal",
        hx.is_seedable(F.lit(False), F.col("status"), F.col("model")).alias("seedable"),
        text.is_capsid(F.col("model")).alias("capsid"),
    )


def _annotations(spark):
    rows = [(m, ["Gemini_AL1"] if m.startswith("VS") else [f"PF{i % 6}"]) for i, m in enumerate(MODELS)]
    return spark.createDataFrame(rows, "model string, required array<string>")


ANNOT = "annot(model, domain) AS (VALUES " + ", ".join(
    f"('{m}', '{'Gemini_AL1' if m.startswith('VS') else f'PF{i % 6}'}')" for i, m in enumerate(MODELS)
) + ")"


@query(
    "model_arbitration",
    f"""WITH {MARKERS}, {ANNOT}, doms AS (SELECT DISTINCT l_orderkey AS gene_id, 'PF' || (l_suppkey % 6) AS domain
       FROM lineitem WHERE l_linestatus = 'F'),
    last AS (SELECT gene_id, model, max_by(score, ordinal) AS score FROM markers GROUP BY ALL),
    amb AS (SELECT gene_id, count(*) AS n_models, first(model ORDER BY score DESC, model) AS original_model
       FROM last GROUP BY gene_id HAVING count(*) >= 2),
    ok AS (SELECT l.gene_id, count(DISTINCT l.model) AS n_ok, min(l.model) AS only_ok FROM last l JOIN annot a USING (model)
       JOIN doms d ON d.gene_id = l.gene_id AND d.domain = a.domain GROUP BY l.gene_id),
    obs AS (SELECT gene_id, count(*) AS n_obs FROM doms GROUP BY gene_id),
    o AS (SELECT a.*, coalesce(n_ok, 0) AS n_ok, only_ok, CASE WHEN n_obs IS NULL THEN 'unresolved_no_domain'
       WHEN n_ok = 1 AND only_ok = original_model THEN 'confirmed' WHEN n_ok = 1 THEN 'reassigned'
       WHEN n_ok > 1 THEN 'unresolved_shared_domain' ELSE 'contradicted' END AS outcome
       FROM amb a LEFT JOIN ok USING (gene_id) LEFT JOIN obs USING (gene_id))
    SELECT gene_id, n_models, original_model, outcome, CASE WHEN outcome = 'contradicted' THEN NULL
      WHEN n_ok = 1 THEN only_ok ELSE original_model END AS final_model FROM o""",
)
def model_arbitration(spark, sf):
    doms = load(spark, sf, "lineitem").filter(F.col("l_linestatus") == "F").select(
        F.col("l_orderkey").alias("gene_id"), F.concat(F.lit("PF"), F.col("l_suppkey") % 6).alias("domain")
    )
    return ho.arbitrate_models(markers(spark, sf), doms, _annotations(spark))


@query(
    "rescue_confirmation",
    f"""WITH {VALID_CTES}, cov AS (SELECT gene_id, max(CASE WHEN prefix IN ({VALIDATED}) AND pident >= 25 THEN qcov END) AS q
       FROM hits GROUP BY gene_id),
    e AS (SELECT DISTINCT ON (gene_id) v.*, (v.score / 500) AS model_cov FROM valid v JOIN cov USING (gene_id)
       WHERE status = 'validated' AND q >= 50 AND v.score / 500 >= 0.1 ORDER BY gene_id, score DESC, ordinal),
    p AS (SELECT *, max("end") OVER (PARTITION BY genome_id, scaffold, strand ORDER BY "start", gene_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e),
    b AS (SELECT *, CASE WHEN reach IS NULL OR "start" >= reach THEN 1 ELSE 0 END AS brk FROM p),
    c AS (SELECT *, sum(brk) OVER (PARTITION BY genome_id, scaffold, strand ORDER BY "start", gene_id) AS island FROM b)
    SELECT scaffold, strand, first(gene_id ORDER BY score DESC, gene_id) AS gene_id, count(*) AS members
    FROM c GROUP BY genome_id, scaffold, strand, island""",
)
def rescue_confirmation(spark, sf):
    from ..operators.islands import confirm_rescues

    marks = validated(spark, sf).withColumn("model_coverage", F.col("score") / 500)
    return confirm_rescues(marks, hits(spark, sf), KEYS, width=16384, min_model_coverage=0.1).select(
        "scaffold", "strand", "gene_id", "members"
    )


@query(
    "query_coverage",
    f"""WITH {HITS} SELECT gene_id, max(CASE WHEN prefix IN ({VALIDATED}) AND pident >= 25 THEN qcov END) AS max_qcov
    FROM hits GROUP BY gene_id""",
)
def query_coverage(spark, sf):
    return ho.query_coverage(hits(spark, sf))


RESOLVED = f"""names AS (SELECT DISTINCT split_part(target, '|', 1) AS org FROM ranked),
  cand AS (SELECT org, unnest(range(1, len(string_split(substr(org, strpos(org, '__') + 2), '_')) + 1)) AS n FROM names),
  cand2 AS (SELECT org, n, split_part(org, '__', 1) || '__' ||
     array_to_string(list_slice(string_split(substr(org, strpos(org, '__') + 2), '_'), 1, n), '_') AS id FROM cand),
  pick AS (SELECT org, max_by(org_id, n) AS org_id, max_by(lineage, n) AS lineage FROM cand2 JOIN labelled ON org_id = id GROUP BY org),
  resolved AS (SELECT r.*, coalesce(p.org_id, split_part(target, '|', 1)) AS org_id, p.lineage FROM ranked r
     LEFT JOIN pick p ON p.org = split_part(r.target, '|', 1))"""


def resolved(spark, sf):
    return ho.resolve_organisms(ranked_hits(spark, sf), labels(spark, sf), every=hits(spark, sf))


@query(
    "longest_prefix_lookup",
    f"WITH {HITS}, {RANKED}, {LABELS}, {RESOLVED} SELECT gene_id, rank, org_id, lineage FROM resolved",
)
def longest_prefix_lookup(spark, sf):
    return resolved(spark, sf).select("gene_id", F.col("rank").cast("bigint").alias("rank"), "org_id", "lineage")


@query(
    "hits_of_validated_genes",
    f"""WITH {VALID_CTES} SELECT gene_id, target FROM ranked WHERE gene_id IN (SELECT gene_id FROM valid WHERE status = 'validated')""",
)
def hits_of_validated_genes(spark, sf):
    good = validated(spark, sf).filter(F.col("status") == "validated").select("gene_id")
    return ranked_hits(spark, sf).join(good, "gene_id", "left_semi").select("gene_id", "target")


@query(
    "genes_away_from_markers",
    f"""WITH {GENES}, {MARKERS} SELECT gene_id FROM genes WHERE gene_id NOT IN (SELECT gene_id FROM markers)""",
)
def genes_away_from_markers(spark, sf):
    return genes(spark, sf).join(markers(spark, sf), "gene_id", "left_anti").select("gene_id")


@query(
    "model_annotation_lookup",
    f"""WITH {MARKERS}, {ANNOT} SELECT domain, count(*) AS n, round(avg(score), 6) AS mean_score
    FROM markers JOIN annot USING (model) GROUP BY domain""",
)
def model_annotation_lookup(spark, sf):
    dim = _annotations(spark).select("model", F.explode("required").alias("domain"))
    return (
        markers(spark, sf).join(F.broadcast(dim), "model").groupBy("domain")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("mean_score"))
    )


@query(
    "structure_query_contains",
    """SELECT p_partkey, min_by(word, pos) AS first_word FROM part,
      (SELECT * FROM (VALUES ('red', 0), ('ring', 1), ('bolt', 2), ('blue', 3), ('gear', 4)) v(word, pos))
    WHERE contains(p_name, word) GROUP BY p_partkey""",
)
def structure_query_contains(spark, sf):
    from ..operators.similarity import contains_first

    words = spark.createDataFrame(
        [("red", 0), ("ring", 1), ("bolt", 2), ("blue", 3), ("gear", 4)], "word string, pos int"
    )
    return contains_first(load(spark, sf, "part").select("p_partkey", "p_name"), "p_name", words, "word", "pos").select(
        "p_partkey", F.col("word").alias("first_word")
    )


@query(
    "target_namespaces",
    f"""WITH {HITS} SELECT split_part(target, '__', 1) AS raw,
      CASE WHEN prefix IN ({VIRAL_LIST}, 'EUK__', 'BAC__', 'ARC__') THEN prefix ELSE 'UNKNOWN' END AS known,
      CASE WHEN split_part(target, '__', 1) IN ('MITO', 'PLASTID') THEN 'EUK' ELSE split_part(target, '__', 1) END AS folded,
      split_part(substr(target, strpos(target, '__') + 2), '|', 1) AS organism, count(*) AS n FROM hits GROUP BY ALL""",
)
def target_namespaces(spark, sf):
    t = F.col("target")
    return hits(spark, sf).groupBy(
        text.raw_prefix(t).alias("raw"), text.known_prefix(t).alias("known"), text.folded_prefix(t).alias("folded"),
        text.organism(t).alias("organism"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "best_hit_partition",
    f"""WITH {GENES}, {HITS}, {RANKED}, {SUMMARY}, q AS (SELECT gene_id, min_by(prefix, rank) AS p FROM ranked
      WHERE prefix IN ({VIRAL_LIST}) AND pident >= 25 GROUP BY gene_id),
    b AS (SELECT g.genome_id, CASE WHEN top1_target IS NULL THEN 'NO_HITS' WHEN q.p IS NOT NULL THEN replace(q.p, '__', '')
      WHEN top1_prefix IN ('MITO__', 'EUK__', 'BAC__', 'ARC__') THEN replace(top1_prefix, '__', '') ELSE 'UNK' END AS bucket
      FROM genes g LEFT JOIN summary s ON s.gene_id = g.gene_id LEFT JOIN q ON q.gene_id = g.gene_id)
    SELECT genome_id, bucket, count(*) AS n FROM b GROUP BY ALL""",
)
def best_hit_partition(spark, sf):
    d = ho.with_no_hits(genes(spark, sf), summary(spark, sf))
    bucket = hx.best_hit_bucket(F.col("top10"), F.col("top1_target"), text.folded_prefix(F.col("top1_target")))
    return d.groupBy("genome_id", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


CLASSES = f"""classes AS (SELECT gene_id, count(DISTINCT cls) AS n_cls, min(cls) AS one FROM (SELECT gene_id,
    CASE WHEN prefix = 'GVMAG__' THEN 'NCLDV' ELSE replace(prefix, '__', '') END AS cls FROM ranked
    WHERE prefix IN ({VIRAL_LIST}) AND pident >= 25) GROUP BY gene_id)"""


@query(
    "gene_class_vote",
    f"""WITH {HITS}, {RANKED}, {CLASSES} SELECT gene_id, n_cls, CASE WHEN n_cls = 1 THEN one ELSE 'VIRAL_UNKNOWN' END AS vote FROM classes""",
)
def gene_class_vote(spark, sf):
    d = summary(spark, sf).withColumn("cls", hx.qualified_classes(F.col("top10"))).filter(F.size("cls") > 0)
    return d.select("gene_id", F.size("cls").cast("bigint").alias("n_cls"), hx.single_vote(F.col("cls")).alias("vote"))


@query(
    "phage_lineage_class",
    f"""WITH {HITS}, {RANKED}, {LABELS}, {RESOLVED} SELECT CASE WHEN prefix = 'GVMAG__' THEN 'NCLDV' ELSE replace(prefix, '__', '') END AS cls,
     lineage ILIKE '%asia%' AS asian, count(*) AS n FROM resolved WHERE prefix IN ({VIRAL_LIST}) AND pident >= 25 GROUP BY ALL""",
)
def phage_lineage_class(spark, sf):
    d = resolved(spark, sf).filter(hx.qualifies(F.col("prefix"), F.col("pident")))
    cls = hx.class_of_prefix(F.col("prefix"), F.col("lineage"))
    return d.groupBy(cls.alias("cls"), F.col("lineage").ilike("%asia%").alias("asian")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "hit_list_round_trip",
    f"""WITH {HITS}, {RANKED} SELECT gene_id, count(*) AS n, round(sum(bits), 4) AS bits, round(sum(pident), 4) AS pident FROM ranked GROUP BY gene_id""",
)
def hit_list_round_trip(spark, sf):
    s = summary(spark, sf)

    def joined(field):
        return F.array_join(F.transform("top10", lambda h: h[field].cast("string")), ",")

    flat = s.select("gene_id", "top1_target", "top1_bits", *[joined(f).alias(f) for f in ("target", "bits", "pident", "evalue")])
    parsed = flat.withColumn(
        "top10", hx.parse_top10(F.col("target"), F.col("bits"), F.col("pident"), F.col("evalue"), F.col("top1_target"), F.col("top1_bits"))
    )

    def total(field):
        return F.round(F.aggregate(F.transform("top10", lambda h: h[field]), F.lit(0.0), lambda a, x: a + x), 4)

    return parsed.select("gene_id", F.size("top10").cast("bigint").alias("n"), total("bits").alias("bits"), total("pident").alias("pident"))


@query(
    "namespace_migration",
    f"""WITH {LABELS}, old AS (SELECT CASE WHEN org_id LIKE 'PPV__%' THEN replace(org_id, 'PPV__', 'VP__') WHEN org_id LIKE 'PHAGE__%'
         THEN replace(org_id, 'PHAGE__', 'PLV__') ELSE org_id END AS org_id, lineage FROM labelled
      UNION ALL SELECT replace(org_id, 'PPV__', 'PLV__'), 'PLV|x|' || replace(org_id, 'PPV__', 'PLV__') FROM labelled
        WHERE org_id LIKE 'PPV__%' AND lineage LIKE '%ASIA%')
    SELECT org_id, CASE WHEN org_id LIKE 'PLV\\_\\_%' ESCAPE '\\' THEN 'PPV__' || substr(org_id, 6)
      WHEN org_id LIKE 'VP\\_\\_%' ESCAPE '\\' THEN 'PPV__' || substr(org_id, 5) ||
        CASE WHEN 'PLV__' || substr(org_id, 5) IN (SELECT org_id FROM old) THEN '__vpdup' ELSE '' END ELSE org_id END AS new_id,
      CASE WHEN lineage LIKE 'PLV|x|%' THEN 'PPV|x|PPV__' || substr(org_id, 6) ELSE lineage END AS new_lineage FROM old""",
)
def namespace_migration(spark, sf):
    lab = labels(spark, sf)
    org = F.col("org_id")
    old = lab.select(
        F.when(org.startswith("PPV__"), F.replace(org, F.lit("PPV__"), F.lit("VP__")))
        .when(org.startswith("PHAGE__"), F.replace(org, F.lit("PHAGE__"), F.lit("PLV__"))).otherwise(org).alias("org_id"),
        "lineage",
    )
    copy = F.replace(org, F.lit("PPV__"), F.lit("PLV__"))
    twins = lab.filter(org.startswith("PPV__") & F.col("lineage").contains("ASIA")).select(
        copy.alias("org_id"), F.concat(F.lit("PLV|x|"), copy).alias("lineage")
    )
    return ho.migrate_labels(old.unionByName(twins))

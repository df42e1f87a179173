"""Identifiers, namespaces, lineage tokens and keyword tags as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab


def any_prefix(c: Column, prefixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | c.startswith(p)
    return out


# ------------------------------------------------------------- namespaces


def raw_prefix(target: Column) -> Column:
    """Text before the first double underscore, else ``UNKNOWN``."""
    return F.when(F.contains(target, F.lit("__")), F.split_part(target, F.lit("__"), F.lit(1))).otherwise("UNKNOWN")


def known_prefix(target: Column) -> Column:
    """Namespace with its underscores when it is a known one, else ``UNKNOWN``."""
    ns = F.concat(raw_prefix(target), F.lit("__"))
    return F.when(ns.isin(vocab.VIRAL_PREFIXES + vocab.CELLULAR_PREFIXES), ns).otherwise("UNKNOWN")


def folded_prefix(target: Column) -> Column:
    """Known namespace without underscores; organelles count as their host."""
    raw = raw_prefix(target)
    known = [p[:-2] for p in vocab.VIRAL_PREFIXES + vocab.CELLULAR_PREFIXES]
    return F.when(raw.isin(vocab.ORGANELLE_PREFIXES), "EUK").when(raw.isin(known), raw).otherwise("UNKNOWN")


def organism(target: Column) -> Column:
    rest = F.regexp_extract(target, r"(?s)^.*?__([^|]*)", 1)
    return F.when(F.contains(target, F.lit("__")) & (rest != ""), rest).otherwise("unknown")


def base_gene_id(c: Column) -> Column:
    return F.split_part(c, F.lit("|aa"), F.lit(1))


def domain_span(c: Column) -> tuple[Column, Column]:
    """Domain coordinates from a ``|aaS-E`` suffix, null when there is none."""
    return (
        F.nullif(F.regexp_extract(c, r"\|aa(\d+)-(\d+)$", 1), F.lit("")).try_cast("bigint"),
        F.nullif(F.regexp_extract(c, r"\|aa(\d+)-(\d+)$", 2), F.lit("")).try_cast("bigint"),
    )


def content_id(prefix: Column, *fields: Column) -> Column:
    """``prefix`` plus 16 hex digits over the NUL-joined fields."""
    joined = F.concat_ws("\u0000", *[f.cast("string") for f in fields])
    return F.concat(prefix, F.lit("_VSR"), F.substring(F.sha2(joined, 256), 1, 16))


def is_content_id(c: Column) -> Column:
    return base_gene_id(c).rlike(r"_VSR[0-9a-f]{16}$")


def gff_escape(c: Column) -> Column:
    """Percent-encode everything outside letters, digits and ``._:-|~``."""
    out = F.url_encode(c)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%3A", ":"), ("%7C", "|"), ("%7E", "~")):
        out = F.replace(out, F.lit(found), F.lit(wanted))
    return out


# ---------------------------------------------------------------- lineages


def lineage_levels(lineage: Column) -> Column:
    return F.filter(F.transform(F.split(lineage, r"\|"), lambda t: F.trim(t)), lambda t: t != "")


def lineage_tokens(lineage: Column, min_len: int = 3) -> Column:
    """Lower-cased informative levels of a pipe-delimited lineage."""
    levels = F.transform(F.split(F.coalesce(lineage, F.lit("")), r"\|"), lambda t: F.lower(F.trim(t)))
    return F.filter(
        levels,
        lambda t: (F.length(t) >= min_len) & ~t.isin(vocab.PLACEHOLDER_TOKENS) & ~t.endswith("_x"),
    )


def tokens_or_prefix(lineage: Column, org: Column, min_len: int = 3) -> Column:
    """Lineage tokens; the namespace alone when the lineage yields none."""
    tokens = lineage_tokens(lineage, min_len)
    ns = F.lower(F.split_part(org, F.lit("__"), F.lit(1)))
    fallback = F.when(F.contains(org, F.lit("__")) & (F.length(ns) >= min_len), F.array(ns)).otherwise(
        F.array().cast("array<string>")
    )
    return F.when(F.size(tokens) > 0, tokens).otherwise(fallback)


# ------------------------------------------------------- classes, families


def canonical_family(c: Column) -> Column:
    token = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(token.isin("VP", "PLV"), "PPV").otherwise(token)


def published_class(c: Column) -> Column:
    token = canonical_family(c)
    return (
        F.when(token == "MIXED", "VIRAL_UNKNOWN").when(token.isin(vocab.PUBLISHED_CLASSES), token).otherwise("UNKNOWN")
    )


def gate_class_token(c: Column) -> Column:
    token = canonical_family(c)
    return F.when(token.isin(vocab.GATE_CLASSES), token).otherwise("UNKNOWN")


def gate_class(tier: Column, region: Column, classification: Column, likely: Column) -> Column:
    """Class seen by the acceptance gate; LOW candidates trust the family label first."""
    r, k, f = gate_class_token(region), gate_class_token(classification), gate_class_token(likely)
    concrete = vocab.CONCRETE_CLASSES
    upper = (
        F.when(r.isin(concrete), r)
        .when(k.isin(concrete), k)
        .when(f.isin(concrete), f)
        .when((r == "MIXED") | (k == "MIXED") | (f == "MIXED"), "MIXED")
        .otherwise("UNKNOWN")
    )

    def blank(c: Column) -> Column:
        return F.nullif(F.upper(F.trim(F.coalesce(c, F.lit("")))), F.lit(""))

    family = gate_class_token(F.coalesce(blank(likely), blank(classification), F.lit("")))
    low = F.when(family != "UNKNOWN", family).when(upper == "MIXED", "MIXED").otherwise("UNKNOWN")
    return F.when(F.upper(F.trim(F.coalesce(tier, F.lit("")))) == "LOW", low).otherwise(upper)


# ------------------------------------------------------------ marker names


# fixed values: capsid profile names
CAPSID_EXACT = ["og1352", "og484", "vs000086", "vs000309", "gamadvirusmcp", "gvogm0003", "mcp"]
CAPSID_PREFIX = ["gamadvirusmcp", "mcp_mirus", "mcp_poli", "mirus_mcp", "plv_mcp", "vp_mcp"]


def is_capsid(name: Column) -> Column:
    n = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    return n.isin(CAPSID_EXACT) | n.rlike(r"\A(?:" + "|".join(CAPSID_PREFIX) + r")[a-z0-9_]*\z")


def is_host_marker(name: Column) -> Column:
    n = F.coalesce(name, F.lit(""))
    return n.startswith("COG") | F.contains(n, F.lit("at2759"))


def is_atpase(name: Column) -> Column:
    n = F.lower(F.coalesce(name, F.lit("")))
    return n.isin(vocab.ATPASE_EXACT) | F.contains(n, F.lit("atpase"))


def marker_group(name: Column) -> Column:
    n = F.lower(F.coalesce(name, F.lit("")))
    return F.when(n.startswith("gvogm"), "GVOGm").when(n.startswith("og"), "OG").otherwise("OTHER")


def marker_family(name: Column) -> Column:
    """Diagnostic lineage of a profile name, null when it names none."""
    n = F.lower(name)
    return (
        F.when(n.isin(vocab.NCLDV_EXACT) | any_prefix(n, vocab.NCLDV_PREFIXES), "NCLDV")
        .when(n.startswith("vp_"), "VP")
        .when(n.startswith("plv_"), "PLV")
        .when(n.startswith("mirus_"), "MIRUS")
    )


def model_family(name: Column, source: Column, description: Column) -> Column:
    n, s, d = (F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in (name, source, description))

    def has(c: Column, text: str) -> Column:
        return F.contains(c, F.lit(text))

    return (
        F.when(n.startswith("vp_") | has(d, "virophage") | has(s, "virophage"), "PPV")
        .when(n.startswith("plv_") | has(d, "polinton-like") | has(s, "plv"), "PPV")
        .when(n.startswith("mirus_") | has(s, "mirus") | has(d, "mirus"), "MIRUS")
        .when(any_prefix(n, ["gvogm", "gamadvirus"]) | n.isin(vocab.NCLDV_EXACT), "NCLDV")
        .when(has(d, "ncldv") | has(s, "ncldv"), "NCLDV")
        .otherwise("UNKNOWN")
    )


def keyword_tags(text: Column, keywords: Mapping[str, Sequence[str]] = vocab.CATEGORY_KEYWORDS) -> Column:
    """Sorted names of every category with a keyword inside the text."""
    t = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    flags = []
    for name, words in sorted(keywords.items()):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(t, F.lit(w))
        flags.append(F.when(hit, F.lit(name)))
    return F.array_compact(F.array(*flags))


# ---------------------------------------------------------- counted blobs


def blob_of(counts: Column) -> Column:
    """``a:2,b:1`` from a map, by count descending then name."""
    entries = F.transform(F.map_entries(counts), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("k")))
    return F.array_join(F.transform(F.array_sort(entries), lambda e: F.concat(e["k"], F.lit(":"), -e["n"])), ",")


def blob_map(blob: Column) -> Column:
    """Map of a counted blob; empty and ``.`` give an empty map."""
    parts = F.when(blob.isNull() | blob.isin("", "."), F.array().cast("array<string>")).otherwise(F.split(blob, ","))
    return F.map_from_entries(
        F.transform(
            parts,
            lambda p: F.struct(
                F.trim(F.regexp_extract(p, r"^(.*):[^:]*$", 1)).alias("k"),
                F.regexp_extract(p, r":\s*(\d+)\s*$", 1).try_cast("bigint").alias("v"),
            ),
        )
    )


# ----------------------------------------------------- namespace migration


def migrate_id(c: Column, collides: Column) -> Column:
    """``VP__x`` / ``PLV__x`` to ``PPV__x``; a colliding ``VP__`` one is marked."""
    is_old = c.startswith("VP__") | c.startswith("PLV__")
    rest = F.regexp_replace(c, r"^(VP|PLV)__", "")
    mark = F.when(c.startswith("VP__") & collides, F.lit("__vpdup")).otherwise("")
    return F.when(is_old, F.concat(F.lit("PPV__"), rest, mark)).otherwise(c)


def migrate_header(c: Column, collides: Column) -> Column:
    """Sequence header: the id before the first bar is migrated, the rest kept."""
    head, tail = F.split_part(c, F.lit("|"), F.lit(1)), F.regexp_extract(c, r"^[^|]*(\|.*)$", 1)
    return F.concat(migrate_id(head, collides), tail)


# ------------------------------------------------------------------ numbers


def _four_decimals(values: pa.Array) -> pa.Array:
    return pa.array([None if v is None else f"{v:.4f}" for v in values.to_pylist()], pa.string())


def four_decimals(value: Column) -> Column:
    """Four decimals of the exact value of a double, as C and Python print it.

    ``format_string`` rounds the shortest decimal form half up, which lifts a double just below the middle.
    """
    return F.arrow_udf(_four_decimals, "string")(value)

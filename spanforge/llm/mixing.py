"""Mixing sources to target weights: tempered token shares, realised as budgeted block permutations.

Only DataFrame functions are used. Nothing but sums per source is gathered in one place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..session import cut, shared_path

#: Sources up to which the plan of passes is broadcast; beyond, it is joined.
FEW = 100_000
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Weights are shares to the power of an exponent between 0 (alike) and 1 (as they are).

    The exponent is the largest whose weights reach ``entropy`` of the greatest possible entropy,
    or more if else a source would be read over ``repeats`` times as often as another. ``budget``
    is the number of tokens to draw; without one it is the least that draws every document.
    ``block`` is the size of a block, in tokens; ``steps`` halvings find the exponent.
    """

    entropy: float = 0.9
    repeats: float = 4.0
    budget: int | None = None
    block: int = 100_000
    steps: int = 50
    seed: int = 11


#: Leading hex digits of a permutation key that deal a source's rows into parts of their own for running sums.
PART = 3


def tokens(text: Column) -> Column:
    """Words of a text; a null one has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _total(values: Column, f) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + f(x))


def _entropy(shares: Column, alpha: Column) -> Column:
    z = _total(shares, lambda s: F.pow(s, alpha))
    return F.log(z) - _total(shares, lambda s: F.pow(s, alpha) * F.log(F.pow(s, alpha))) / z


def _bisect(good, steps: int) -> Column:
    """Bounds of the point between 0 and 1 up to which ``good`` holds."""
    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        mid = (s["lo"] + s["hi"]) / 2
        ok = good(mid)
        return F.struct(F.when(ok, mid).otherwise(s["lo"]).alias("lo"), F.when(ok, s["hi"]).otherwise(mid).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)


def weights(rows: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``source, total, alpha, weight, budget, full, rest, blocks`` from rows of ``source, tokens``.

    ``full`` whole passes over a source and ``rest`` tokens of one more make up its ``budget``. A
    source without any token has weight 0 and is passed once. An empty table gives an empty one.
    """
    sums = rows.groupBy("source").agg(F.sum("tokens").alias("total"))
    # one number per source, sorted so that sums of doubles don't depend on the partitions
    every = sums.filter("total > 0").agg(F.sort_array(F.collect_list("total")).alias("totals"))
    n = F.size("totals")
    shares = F.transform("totals", lambda t: t / _total(F.col("totals"), lambda x: x))
    every = every.filter(n > 0).select("totals", shares.alias("shares"))
    flat = F.greatest(F.log(n.cast("double")), F.lit(0.0)) * F.lit(mix.entropy) - F.lit(1e-12)
    by_entropy = F.when(_entropy(F.col("shares"), F.lit(1.0)) >= flat, F.lit(1.0)).otherwise(_bisect(lambda a: _entropy(F.col("shares"), a) >= flat, mix.steps)["lo"])
    spread = F.element_at("shares", -1) / F.element_at("shares", 1)
    by_repeats = F.when(spread <= mix.repeats, F.lit(0.0)).otherwise(_bisect(lambda a: F.pow(spread, 1 - a) > mix.repeats, mix.steps)["hi"])
    every = every.select("totals", "shares", F.greatest(by_entropy, by_repeats).alias("alpha"))
    every = every.select("totals", "alpha", _total(F.col("shares"), lambda s: F.pow(s, F.col("alpha"))).alias("z"), _total(F.col("totals"), lambda t: t).alias("all"))
    weight = F.pow(F.col("total") / F.col("all"), F.col("alpha")) / F.col("z")
    need = F.lit(float(mix.budget)) if mix.budget is not None else F.array_max(F.transform("totals", lambda t: t / (F.pow(t / F.col("all"), F.col("alpha")) / F.col("z"))))
    every = every.withColumn("draw", need)
    joined = sums.join(F.broadcast(every), F.lit(True), "left")  # one row
    has = F.col("total") > 0
    out = joined.select("source", "total", "alpha", F.when(has, weight).otherwise(0.0).alias("weight"), F.when(has, F.floor(weight * F.col("draw") + 1e-6)).otherwise(F.lit(0)).cast("long").alias("budget"), F.col("draw"))
    out = out.withColumn("full", F.when(has, F.floor(F.col("budget") / F.col("total"))).otherwise(F.lit(1)).cast("long"))
    return out.select(
        "source", "total", "alpha", "weight", "budget", "full", F.when(has, F.col("budget") - F.col("full") * F.col("total")).otherwise(F.lit(0)).cast("long").alias("rest"),
        F.greatest(F.ceil(F.coalesce("draw", F.lit(0.0)) / mix.block), F.lit(1)).cast("long").alias("blocks"),
    )


def mixture(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", mix: Mix = Mix()) -> DataFrame:
    """``key, source, pass, tokens, block, position``: every draw of every document, in the order of training.

    Each pass over a source is a permutation of its own, by a hash of key and pass; the last takes
    documents in that order while they fit into the rest of the budget. A source's passes are spread
    evenly over all blocks, so each block holds the sources by weight; a hash orders a block.
    Running sums are taken in parts of a permutation and carried over part by part, so that a source
    with most rows is many tasks. A null text has no tokens, a null source is the source ``''``, null
    keys and repeated rows are drawn each; other columns are not read; an empty table gives an empty one.
    The rows of a source without any token are dealt over the blocks by hash.
    """
    drawn = _draws(docs, key, text, source, mix, F.lit(0))
    return drawn.select(F.col("key").alias(key), "source", F.col("pass").cast("int").alias("pass"), "tokens", "block", "position")


def _draws(docs: DataFrame, key: str, text: str, source: str, mix: Mix, row: Column) -> DataFrame:
    """``row, key, source, pass, tokens, block, position`` of every draw; ``row`` tells equal rows apart."""
    rows = docs.select(row.alias("row"), F.col(key).alias("key"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), tokens(F.col(text)).alias("tokens"))
    rows = cut(rows)  # numbers only; texts are read once
    plan = cut(weights(rows, mix).select("source", "total", "budget", "full", "rest", "blocks"))
    plan = F.broadcast(plan) if plan.count() <= FEW else plan
    passes = F.sequence(F.lit(0).cast("long"), F.col("full") - F.when(F.col("rest") > 0, F.lit(0)).otherwise(F.lit(1)))
    passes = F.when((F.col("full") > 0) | (F.col("rest") > 0), passes).otherwise(F.array().cast("array<bigint>"))
    drawn = rows.join(plan, "source").select("*", F.explode(passes).alias("pass"))
    order = F.md5(F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("pass"), F.lit(mix.seed)).cast("binary"))
    drawn = drawn.withColumn("order", order).withColumn("part", F.substring("order", 1, PART))
    sums = drawn.groupBy("source", "pass", "part").agg(F.sum("tokens").alias("in_part"))
    earlier = Window.partitionBy("source", "pass").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "pass", "part", F.coalesce(F.sum("in_part").over(earlier), F.lit(0)).alias("before_part"))
    inside = Window.partitionBy("source", "pass", "part").orderBy("order", "key", "tokens", "row").rowsBetween(Window.unboundedPreceding, -1)
    drawn = drawn.withColumn("before", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(sums, ["source", "pass", "part"])
    drawn = drawn.withColumn("before", F.col("before") + F.col("before_part"))
    drawn = drawn.filter((F.col("pass") < F.col("full")) | (F.col("before") + F.col("tokens") <= F.col("rest")))
    at = (F.col("pass") * F.col("total") + F.col("before")) / F.greatest(F.col("budget"), F.lit(1)) * F.col("blocks")
    dealt = F.conv(F.substring("order", 1, 8), 16, 10).cast("long") % F.col("blocks")
    drawn = drawn.withColumn("block", F.when(F.col("total") > 0, F.least(F.floor(at), F.col("blocks") - 1).cast("long")).otherwise(dealt))
    shuffled = F.md5(F.concat_ws(":", F.col("order"), F.col("source")).cast("binary"))
    position = F.row_number().over(Window.partitionBy("block").orderBy(shuffled, "key", "tokens", "row"))
    return drawn.select("row", "key", "source", "pass", "tokens", "block", (position - 1).cast("long").alias("position"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", mix: Mix = Mix()) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture draws it, in the order of blocks and positions; all columns kept.

    A row is known by its file and place there, so repeated rows and null keys are drawn each by
    itself; rows that come from no Parquet file are written to one first. Partitions follow
    the order of blocks and are sorted, so a table written from this holds the block permutations.
    """
    try:
        found = docs.select(F.struct("*").alias("doc"), F.struct("_metadata.file_name", "_metadata.row_index").alias("row"))
    except AnalysisException:
        path = shared_path(docs.sparkSession, "to-mix")
        docs.write.parquet(path)
        docs = docs.sparkSession.read.parquet(path)
        found = docs.select(F.struct("*").alias("doc"), F.struct("_metadata.file_name", "_metadata.row_index").alias("row"))
    drawn = _draws(docs, key, text, source, mix, F.struct("_metadata.file_name", "_metadata.row_index"))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.sparkSession.sparkContext.defaultParallelism)
    placed = found.join(cut(drawn.select("row", "block", "position")), "row")
    return placed.repartitionByRange(parts, "block", "position").sortWithinPartitions("block", "position").select("doc.*")


def mixture_sql(mix: Mix = Mix()) -> str:
    """The same rows in DuckDB, for a mix without a budget."""
    return rf"""
WITH RECURSIVE r AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS tokens FROM documents),
sums AS (SELECT source, sum(tokens)::BIGINT AS total FROM r GROUP BY source),
every AS (SELECT list_sort(list(total)) AS totals FROM sums WHERE total > 0),
s AS (SELECT totals, list_transform(totals, lambda t: t::DOUBLE / list_sum(list_transform(totals, lambda x: x::DOUBLE))) AS shares FROM every),
one AS (SELECT unnest(shares) AS s FROM s),
target AS (SELECT greatest(ln(len(totals)), 0) * {mix.entropy} - 1e-12 AS flat, shares[len(shares)] / shares[1] AS spread FROM s),
h1 AS (SELECT ln(sum(s)) - sum(s * ln(s)) / sum(s) AS h FROM one),
bis AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, 0.0::DOUBLE AS rlo, 1.0::DOUBLE AS rhi
  UNION ALL
  SELECT i + 1, CASE WHEN e >= flat THEN m ELSE lo END, CASE WHEN e >= flat THEN hi ELSE m END,
    CASE WHEN pow(spread, 1 - rm) > {mix.repeats} THEN rm ELSE rlo END, CASE WHEN pow(spread, 1 - rm) > {mix.repeats} THEN rhi ELSE rm END
  FROM (SELECT i, lo, hi, rlo, rhi, (lo + hi) / 2 AS m, (rlo + rhi) / 2 AS rm,
          (SELECT ln(sum(pow(s, (lo + hi) / 2))) - sum(pow(s, (lo + hi) / 2) * ln(pow(s, (lo + hi) / 2))) / sum(pow(s, (lo + hi) / 2)) FROM one) AS e
        FROM bis WHERE i < {mix.steps}), target),
alpha AS (SELECT greatest(CASE WHEN h >= flat THEN 1.0 ELSE lo END, CASE WHEN spread <= {mix.repeats} THEN 0.0 ELSE rhi END) AS a FROM bis, target, h1 WHERE i = {mix.steps}),
z AS (SELECT a, (SELECT sum(pow(s, a)) FROM one) AS z, (SELECT sum(total)::DOUBLE FROM sums) AS whole FROM alpha),
draw AS (SELECT a, z, whole, (SELECT max(total / (pow(total / whole, a) / z)) FROM sums WHERE total > 0) AS draw FROM z),
plan AS (
  SELECT source, total, CASE WHEN total > 0 THEN floor(pow(total / whole, a) / z * draw + 1e-6)::BIGINT ELSE 0 END AS budget, greatest(ceil(draw / {mix.block}), 1)::BIGINT AS blocks
  FROM sums, draw),
plan2 AS (SELECT *, CASE WHEN total > 0 THEN budget // total ELSE 1 END AS n_full FROM plan),
plan3 AS (SELECT *, CASE WHEN total > 0 THEN budget - n_full * total ELSE 0 END AS rest FROM plan2),
drawn AS (SELECT r.*, p.total, p.budget, p.blocks, p.n_full, p.rest, unnest(range(0, n_full + (rest > 0)::BIGINT)) AS pass FROM r JOIN plan3 p USING (source)),
keyed AS (SELECT *, md5(doc_id::VARCHAR || ':' || pass::VARCHAR || ':{mix.seed}') AS ord FROM drawn),
summed AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source, pass ORDER BY ord, doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM keyed),
kept AS (SELECT *, CASE WHEN total > 0 THEN least(floor((pass * total + before)::DOUBLE / greatest(budget, 1) * blocks)::BIGINT, blocks - 1) ELSE ('0x' || ord[1:8])::BIGINT % blocks END AS block FROM summed WHERE pass < n_full OR before + tokens <= rest)
SELECT doc_id, source, pass::INTEGER AS pass, tokens, block, row_number() OVER (PARTITION BY block ORDER BY md5(ord || ':' || source), doc_id, tokens) - 1 AS position FROM kept
"""

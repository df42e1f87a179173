"""Ordered scans that do not put a whole key in one task.

``Window.partitionBy(scaffold)`` sends a scaffold to one task, however many rows
it holds.  The helpers here cut each key into coordinate chunks instead, run the
window inside a chunk, reduce every chunk to one summary row, scan the summaries
and add the carried value back.  The large table is shuffled once, on
``(keys, chunk)``; only the summaries (key extent / chunk width rows) are ordered
per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

CHUNK = "_chunk"

_AGG = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}


def chunk_of(pos: Column, width: float) -> Column:
    return F.floor(pos / F.lit(width)).cast("bigint")


def prefix_scan(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    order: Sequence[str],
    scans: Mapping[str, tuple[str, Column]],
    width: float,
    inclusive: bool = False,
    descending: bool = False,
    keep_chunk: bool = False,
) -> DataFrame:
    """Add running values per key.

    ``scans`` maps an output column to ``(kind, expression)``; kind is one of
    ``sum max min count lag``.  Values cover the rows before the current one, and
    the current one too when ``inclusive``.  ``order`` must be a total order that
    starts with ``pos``; ``descending`` scans it from the other end.

    The shuffle by ``(keys, chunk)`` is asked for outright: a window alone would accept
    an input already split by the keys, and run a crowded key in one task.  A second
    scan over the same positions keeps the chunks (``keep_chunk``) and moves nothing.
    """
    keys = list(keys)
    direction = (lambda c: F.col(c).desc()) if descending else F.col
    fresh = CHUNK not in df.columns
    base = df.withColumn(CHUNK, chunk_of(F.col(pos), width)) if fresh else df
    for name, (_, expr) in scans.items():
        base = base.withColumn(f"_v_{name}", expr)
    # the summaries are added up map-side, before the rows themselves move
    d = base.repartition(*keys, CHUNK) if fresh else base
    local = Window.partitionBy(*keys, CHUNK).orderBy(*[direction(c) for c in order])
    frame = local.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    carry_order = Window.partitionBy(*keys).orderBy(direction(CHUNK))
    carry_frame = carry_order.rowsBetween(Window.unboundedPreceding, -1)

    totals, carries, locals_ = [], [], {}
    for name, (kind, _) in scans.items():
        value = F.col(f"_v_{name}")
        if kind == "lag":
            edge = F.min_by if descending else F.max_by
            totals.append(edge(F.struct(value), F.struct(*order)).alias(f"_t_{name}"))
            carries.append(F.lag(f"_t_{name}").over(carry_order).alias(f"_k_{name}"))
            locals_[name] = F.lag(F.struct(value)).over(local)
        else:
            agg = _AGG[kind]
            totals.append(agg(value).alias(f"_t_{name}"))
            carry_agg = F.sum if kind == "count" else agg
            carries.append(carry_agg(f"_t_{name}").over(carry_frame).alias(f"_k_{name}"))
            locals_[name] = agg(value).over(frame)
    carried = base.groupBy(*keys, CHUNK).agg(*totals).select(*keys, CHUNK, *carries)
    for name, expr in locals_.items():
        d = d.withColumn(f"_l_{name}", expr)
    out = d.join(carried, [*keys, CHUNK], "inner")
    for name, (kind, _) in scans.items():
        loc, car = F.col(f"_l_{name}"), F.col(f"_k_{name}")
        if kind == "lag":
            merged = F.coalesce(loc, car).getField(f"_v_{name}")
        elif kind in ("sum", "count"):
            zero = F.lit(0)
            merged = F.coalesce(loc, zero) + F.coalesce(car, zero)
        else:
            merged = F.greatest(loc, car) if kind == "max" else F.least(loc, car)
        out = out.withColumn(name, merged)
    drop = [f"_{p}_{n}" for n in scans for p in "vlk"]
    return out.drop(*drop) if keep_chunk else out.drop(CHUNK, *drop)


def ordinal(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    order: Sequence[str],
    width: int,
    out: str = "gene_idx",
) -> DataFrame:
    """Zero-based position of every row inside its key, in ``order``."""
    return prefix_scan(df, keys, pos, order, {out: ("count", F.lit(1))}, width)


def halo_rows(df: DataFrame, keys: Sequence[str], idx: str, halo: int, chunk: int) -> DataFrame:
    """Copy rows near a chunk edge into the neighbouring chunk.

    The result has ``_chunk`` and ``_core``; a window over ``(keys, _chunk)`` sees
    ``halo`` ordinals on both sides of every core row, so row frames up to that
    size are exact after keeping the core rows.  The copied share is
    ``2 * halo / chunk``.
    """
    home = F.floor(F.col(idx) / chunk)
    return (
        df.withColumn("_home", home)
        .withColumn(
            CHUNK,
            F.explode(
                F.sequence(
                    F.floor((F.col(idx) - halo) / chunk),
                    F.floor((F.col(idx) + halo) / chunk),
                )
            ),
        )
        .withColumn("_core", F.col(CHUNK) == F.col("_home"))
        .drop("_home")
    )


def halo_window(
    df: DataFrame,
    keys: Sequence[str],
    idx: str,
    columns: Mapping[str, "callable"],
    halo: int,
    chunk: int = 4096,
    keep_chunk: bool = False,
) -> DataFrame:
    """Evaluate bounded row-frame expressions without one task per key.

    ``columns`` maps an output name to a function of a ``WindowSpec`` ordered by
    ``idx``; the function may look at most ``halo`` rows away. A scan over ``idx`` by the same
    ``chunk`` may follow where the rows are (``keep_chunk``).
    """
    d = halo_rows(df, keys, idx, halo, chunk).repartition(*keys, CHUNK)
    spec = Window.partitionBy(*keys, CHUNK).orderBy(idx)
    for name, build in columns.items():
        d = d.withColumn(name, build(spec))
    d = d.filter("_core").drop("_core")
    return d if keep_chunk else d.drop(CHUNK)


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str) -> DataFrame:
    """Zero-based number of every row inside its key, in an order by columns of any type.

    Rows are dealt to ranges of (keys, order) by sampled bounds and sorted there; the rows of a range
    are counted, ranges are added up, and each key's first place is taken off. A key with
    most rows lies on many ranges, so neither it nor anything larger is sorted in one task. The order
    should be total; null keys are not numbered.
    """
    spark, keys = df.sparkSession, list(keys)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ranged = stage(df).repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
    # the id has the range in its upper bits and the place in the range in the 33 lower ones
    d = stage(ranged.withColumn("_id", F.monotonically_increasing_id()))
    d = d.withColumn("_range", F.shiftright("_id", 33)).withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    offset = d.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    d = d.join(offset, "_range").withColumn("_at", F.col("_off") + F.col("_place"))
    first = d.groupBy(*keys).agg(F.min("_at").alias("_first_at"))
    return d.join(first, keys).withColumn(out, (F.col("_at") - F.col("_first_at")).cast("bigint")).drop("_id", "_range", "_place", "_off", "_at", "_first_at")

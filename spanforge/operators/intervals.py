"""Half-open interval algebra: joins, merges, gap clusters, windows, tiles.

Every join is an equi-join on ``(keys, bin)``.  A record is copied once per bin it
touches, and a pair is kept only in the bin of its first shared base, so no pair
appears twice and no ``distinct`` is needed.  Bins also split a crowded scaffold;
``salt`` splits one crowded bin further.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import overlapping_tiles
from ..session import cut, stage
from .ordered import prefix_scan

BIN = "_bin"
SALT = "_salt"


def bin_of(pos: Column, width: int) -> Column:
    return F.floor(pos / F.lit(width)).cast("bigint")


def _spread(df: DataFrame, first: Column, last: Column, width: int) -> DataFrame:
    return df.withColumn(BIN, F.explode(F.sequence(bin_of(first, width), bin_of(last, width))))


def _sorted(df: DataFrame) -> DataFrame:
    """Ask for a sort-merge join: the size check doesn't see that a side was copied per bin, so it would broadcast a large one."""
    return df.hint("merge")


def _salted(left: DataFrame, right: DataFrame, salt: int, by: Sequence[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Scatter the left rows over ``salt`` lanes and copy the right rows to each."""
    if salt <= 1:
        return left, right, []
    left = left.withColumn(SALT, F.pmod(F.xxhash64(*by), F.lit(salt)).cast("int"))
    right = right.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return left, right, [SALT]


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    width: int,
    left_span: tuple[str, str] = ("start", "end"),
    right_span: tuple[str, str] = ("r_start", "r_end"),
    salt: int = 1,
) -> DataFrame:
    """Pairs with ``l.start < r.end and l.end > r.start``.

    Apart from ``keys`` the two sides must not share column names.  A zero-length
    record strictly inside the other side matches; touching ends do not.
    """
    ls, le = (F.col(c) for c in left_span)
    rs, re_ = (F.col(c) for c in right_span)
    left, right, lanes = _salted(left, right, salt, left_span)
    a = _spread(left, ls, F.greatest(ls, le - 1), width)
    b = _spread(right, rs, F.greatest(rs, re_ - 1), width)
    return (
        a.join(_sorted(b), [*keys, BIN, *lanes], "inner")
        .filter((ls < re_) & (le > rs))
        .filter(F.col(BIN) == bin_of(F.greatest(ls, rs), width))
        .drop(BIN, SALT)
    )


def point_join(
    points: DataFrame,
    spans: DataFrame,
    keys: Sequence[str],
    width: int,
    pos: str = "mid",
    span: tuple[str, str] = ("r_start", "r_end"),
    closed: bool = False,
    salt: int = 1,
) -> DataFrame:
    """Points inside spans; the right end counts only when ``closed``."""
    p, s, e = F.col(pos), F.col(span[0]), F.col(span[1])
    points, spans, lanes = _salted(points, spans, salt, [pos])
    a = points.withColumn(BIN, bin_of(p, width))
    b = _spread(spans, s, F.greatest(s, e), width)
    upper = (p <= e) if closed else (p < e)
    return a.join(_sorted(b), [*keys, BIN, *lanes], "inner").filter((p >= s) & upper).drop(BIN, SALT)


def containment_join(
    inner: DataFrame,
    outer: DataFrame,
    keys: Sequence[str],
    width: int,
    inner_span: tuple[str, str] = ("start", "end"),
    outer_span: tuple[str, str] = ("r_start", "r_end"),
    salt: int = 1,
) -> DataFrame:
    """Inner records lying fully inside an outer one; only the outer side is copied."""
    s, e = (F.col(c) for c in inner_span)
    os_, oe = (F.col(c) for c in outer_span)
    inner, outer, lanes = _salted(inner, outer, salt, inner_span)
    a = inner.withColumn(BIN, bin_of(s, width))
    b = _spread(outer, os_, F.greatest(os_, oe), width)
    return a.join(_sorted(b), [*keys, BIN, *lanes], "inner").filter((s >= os_) & (e <= oe)).drop(BIN, SALT)


def short_span(start: Column, end: Column, window: int) -> Column:
    """Whether a record is at most a quarter of the window long."""
    return F.coalesce((end - start).between(0, window // 4), F.lit(False))


def near_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    window: int,
    left_span: tuple[str, str] = ("start", "end"),
    right_span: tuple[str, str] = ("r_start", "r_end"),
    salt: int = 1,
    long_left: bool = True,
    long_right: bool = True,
) -> DataFrame:
    """Pairs whose starts or whose ends lie within ``window``; adds ``distance``.

    A pair found through its starts is not reported again through its ends.  Two records of at most
    a quarter of the window whose ends are near have starts within one and a quarter, so both kinds of pairs
    are found by one join on starts; only pairs with a longer record are looked up by their ends.
    A side whose records are known to be all ``short_span`` is told by ``long_left`` or ``long_right``.
    """
    ls, le = (F.col(c) for c in left_span)
    rs, re_ = (F.col(c) for c in right_span)
    left, right, lanes = _salted(left, right, salt, left_span)
    near_s, near_e = F.abs(ls - rs) <= window, F.abs(le - re_) <= window
    def side(left: DataFrame, right: DataFrame, lpos: Column, rpos: Column, reach: int, keep: Column) -> DataFrame:
        # bins of two windows: a row on the right is copied to two or three, and a row on the left to one
        a = left.withColumn(BIN, bin_of(lpos, 2 * window))
        b = _spread(right, rpos - reach, rpos + reach, 2 * window)
        return a.join(_sorted(b), [*keys, BIN, *lanes], "inner").filter(keep)

    l_short, r_short = short_span(ls, le, window), short_span(rs, re_, window)
    both = side(left, right, ls, rs, window + window // 4, near_s | (near_e & l_short & r_short))
    if long_right:
        both = both.unionByName(side(left, right.filter(~r_short), le, re_, window, near_e & ~near_s))
    if long_left:
        both = both.unionByName(side(left.filter(~l_short), right.filter(r_short), le, re_, window, near_e & ~near_s))
    return both.withColumn("distance", F.least(F.abs(ls - rs), F.abs(le - re_))).drop(BIN, SALT)


def text_tiles(contigs: DataFrame, size: int = 1 << 14) -> DataFrame:
    """Contigs as rows of at most ``size`` characters: all columns but ``seq``, with ``tile_idx`` and ``tile_seq``."""
    keep = [c for c in contigs.columns if c != "seq"]
    return contigs.select(*keep, F.posexplode(overlapping_tiles(F.col("seq"), size)).alias("tile_idx", "tile_seq")).withColumn("tile_idx", F.col("tile_idx").cast("bigint"))


def read_ranges(ranges: DataFrame, tiles: DataFrame, keys: Sequence[str], size: int = 1 << 14) -> DataFrame:
    """``_range, place, piece``: the parts of each range's text, one per tile it touches.

    ``ranges``: keys, _range (unique), start, end. A range meets only the tiles it lies on, and a part is
    no longer than a tile, so no row grows with a contig or a range.
    """
    first, last = F.floor(F.greatest(F.col("start"), F.lit(0)) / size), F.floor((F.col("end") - 1) / size)
    wanted = ranges.filter((F.col("end") > F.col("start")) & (F.col("end") > 0)).select(*keys, "_range", "start", "end", F.explode(F.sequence(first, last)).alias("tile_idx"))
    s, e = F.greatest(F.col("start") - F.col("tile_idx") * size, F.lit(0)), F.least(F.col("end") - F.col("tile_idx") * size, F.lit(size))
    piece = F.substring(F.col("tile_seq"), (s + 1).cast("int"), (e - s).cast("int"))
    return wanted.join(tiles.select(*keys, "tile_idx", "tile_seq"), [*keys, "tile_idx"]).select("_range", F.col("tile_idx").alias("place"), piece.alias("piece"))


def slice_join(regions: DataFrame, contigs: DataFrame, keys: Sequence[str], size: int = 1 << 14) -> DataFrame:
    """Cut each region out of its contig; adds the contig's other columns and ``region_seq``.

    The contig is cut into tiles where it stands, and a region gathers the parts of its own length;
    the whole text is never copied to a region. Regions without a contig are dropped; one on a null text is null.
    """
    keys = list(keys)
    numbered = cut(regions.withColumn("_range", F.monotonically_increasing_id()))
    parts = read_ranges(numbered.select(*keys, "_range", "start", "end"), text_tiles(contigs.select(*keys, "seq"), size), keys, size)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "piece"))), lambda x: x["piece"]), "")
    whole = parts.groupBy("_range").agg(text.alias("region_seq"))
    rest = contigs.withColumn("_none", F.col("seq").isNull()).drop("seq")
    d = numbered.join(rest, keys).join(whole, "_range", "left").drop("_range")
    return d.withColumn("region_seq", F.when(~F.col("_none"), F.coalesce("region_seq", F.lit("")))).drop("_none")


# ---------------------------------------------------------------- gaps, islands


def _number(df: DataFrame, keys, order, width, breaks: str, out: str) -> DataFrame:
    flag = F.col(breaks).cast("bigint")
    d = prefix_scan(df, keys, order[0], order, {out: ("sum", flag)}, width, inclusive=True)
    return d.drop(breaks)


def gap_cluster(
    df: DataFrame,
    keys: Sequence[str],
    width: int,
    max_gap: int,
    tie: Sequence[str],
    near: Column | None = None,
    out: str = "island",
) -> DataFrame:
    """Number clusters by comparing each row with the *previous row's* end.

    ``near`` (over ``prev_start``/``prev_end`` and the current row) is a second way
    to stay in the cluster.
    """
    order = ["start", *tie]
    d = prefix_scan(
        df,
        keys,
        "start",
        order,
        {"prev_start": ("lag", F.col("start")), "prev_end": ("lag", F.col("end"))},
        width,
        keep_chunk=True,
    )
    stay = (F.col("start") - F.col("prev_end")) <= max_gap
    if near is not None:
        stay = stay | near
    d = d.withColumn("_break", F.col("prev_end").isNull() | ~F.coalesce(stay, F.lit(False)))
    return _number(d, keys, order, width, "_break", out).drop("prev_start", "prev_end")


def mark_islands(
    df: DataFrame,
    keys: Sequence[str],
    width: int,
    tie: Sequence[str],
    max_gap: int = 0,
    strict: bool = False,
    out: str = "island",
) -> DataFrame:
    """Number islands by the running maximum end.

    A row joins while ``start <= running_end + max_gap`` (``<`` when strict).
    """
    order = ["start", *tie]
    d = prefix_scan(df, keys, "start", order, {"_reach": ("max", F.col("end"))}, width, keep_chunk=True)
    bound = F.col("_reach") + max_gap
    joins = (F.col("start") < bound) if strict else (F.col("start") <= bound)
    d = d.withColumn("_break", F.col("_reach").isNull() | ~F.coalesce(joins, F.lit(False)))
    return _number(d, keys, order, width, "_break", out).drop("_reach")


def merge_intervals(
    df: DataFrame,
    keys: Sequence[str],
    width: int,
    max_gap: int = 0,
    strict: bool = False,
) -> DataFrame:
    """Union of intervals per key, with ``n_merged`` input rows each.

    Rows sharing a start are folded map-side first, so a chunk never holds more
    than ``width`` rows, whatever the skew.
    """
    folded = df.groupBy(*keys, "start").agg(F.max("end").alias("end"), F.count(F.lit(1)).alias("_n"))
    # two scans follow, each reads its input for the rows and for the summaries
    marked = mark_islands(stage(folded), keys, width, [], max_gap, strict)
    return (
        marked.groupBy(*keys, "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("_n").alias("n_merged"))
        .drop("island")
    )


def typed_islands(
    df: DataFrame,
    keys: Sequence[str],
    width: int,
    tie: Sequence[str],
    kind: str,
    joinable: Column,
    out: str = "island",
    keep_run: bool = False,
) -> DataFrame:
    """Merge overlapping neighbours of one kind; a different kind ends the run.

    Merging compares with the running record only, and a blocked pair starts a new
    running record.  That record always has the kind of the row before, so the
    fold is the same as islands inside maximal runs of one kind.
    """
    order = ["start", *tie]
    # three scans follow; a stage boundary keeps them from replanning their input each time
    d = prefix_scan(cut(df), keys, "start", order, {"_pk": ("lag", F.col(kind))}, width)
    d = d.withColumn("_break", F.col("_pk").isNull() | (F.col("_pk") != F.col(kind)))
    d = _number(d, keys, order, width, "_break", "_run").drop("_pk")
    run_keys = [*keys, "_run"]
    d = prefix_scan(d, run_keys, "start", order, {"_reach": ("max", F.col("end"))}, width)
    d = d.withColumn(
        "_break",
        F.col("_reach").isNull() | ~joinable | (F.col("start") >= F.coalesce(F.col("_reach"), F.lit(0))),
    )
    d = _number(d, run_keys, order, width, "_break", out).drop("_reach")
    return d.withColumnRenamed("_run", "run") if keep_run else d.withColumn(out, F.struct("_run", out)).drop("_run")


def non_overlapping_count(df: DataFrame, keys: Sequence[str], width: int, tie: Sequence[str], max_overlap: float = 0.5) -> DataFrame:
    """Count spans whose overlap with everything before them stays under a share."""
    d = prefix_scan(df, keys, "start", ["start", *tie], {"_reach": ("max", F.col("end"))}, width)
    length = F.col("end") - F.col("start")
    overlap = F.greatest(F.lit(0).cast("bigint"), F.col("_reach") - F.col("start"))
    fresh = F.col("_reach").isNull() | ((length > 0) & (overlap < length * max_overlap))
    return d.groupBy(*keys).agg(F.count_if(fresh).alias("n_domains"))


# ---------------------------------------------------------------- windows, tiles


def sliding_windows(df: DataFrame, size: int, step: int) -> DataFrame:
    """Fixed windows over each record; the last ones are clipped to its end."""
    starts = F.sequence(F.col("start"), F.col("end") - 1, F.lit(step).cast("bigint"))
    return (
        df.filter(F.col("end") > F.col("start"))
        .withColumn("w_start", F.explode(starts))
        .withColumn("w_end", F.least(F.col("w_start") + size, F.col("end")))
    )


def tile(df: DataFrame, size: int, halo: int) -> DataFrame:
    """Cut long records into tiles with a halo on both sides.

    ``core_start``/``core_end`` are owned coordinates, ``tile_start`` is where the
    tile text begins.
    """
    windows = overlapping_tiles(F.col("seq"), size, halo, halo)
    zero = F.lit(0).cast("bigint")
    keep = [F.col(c) for c in df.columns if c != "seq"]
    return (
        df.select(*keep, F.posexplode_outer(windows).alias("_pos", "_text"))
        .withColumn("tile_idx", F.coalesce(F.col("_pos"), F.lit(0)).cast("bigint"))
        .withColumn("core_start", F.col("tile_idx") * size)
        .filter((F.col("core_start") < F.col("seq_len")) | (F.col("tile_idx") == 0))
        .withColumn("core_end", F.least(F.col("core_start") + size, F.col("seq_len")))
        .withColumn("tile_start", F.greatest(zero, F.col("core_start") - halo))
        .withColumn("tile_end", F.least(F.col("seq_len"), F.col("core_end") + halo))
        .withColumn("tile_seq", F.coalesce(F.col("_text"), F.lit("")))
        .drop("_pos", "_text")
    )


def owns_midpoint(start: Column, end: Column, core_start: Column, core_end: Column) -> Column:
    """Half-open ownership of a prediction by its integer midpoint."""
    mid = F.floor((start + end) / 2)
    return (mid >= core_start) & (mid < core_end)


def rebase(start: Column, end: Column, offset: Column) -> tuple[Column, Column]:
    return start + offset, end + offset


def renumber(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, width: int, pos: str = "start") -> DataFrame:
    """One-based number per key in a total order that starts with ``pos``."""
    d = prefix_scan(df, keys, pos, order, {"_n": ("count", F.lit(1))}, width)
    return d.withColumn(out, (F.col("_n") + 1).cast("bigint")).drop("_n")

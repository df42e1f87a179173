"""SimHash near-duplicates: fingerprints of word shingles, pigeonhole blocks, verified Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .links import components
from .text import pieces, texts

#: First bit and width of the six blocks a fingerprint is cut into.
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))


def _ones(bits) -> int:
    return sum(1 << b for b in bits)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def block_masks(distance: int) -> list[int]:
    """Masks of ``6 - distance`` blocks each: words that differ in at most ``distance`` bits agree on one of them."""
    if not 0 <= distance < len(BLOCKS):
        raise ValueError("distance must be below the number of blocks")
    return [_ones(b for at, width in chosen for b in range(at, at + width)) for chosen in combinations(BLOCKS, len(BLOCKS) - distance)]


def finer_masks(mask: int, distance: int) -> list[int]:
    """``mask`` widened by each of ``distance + 1`` parts of the bits it leaves out; again close pairs agree on one."""
    rest = [b for b in range(64) if not mask >> b & 1]
    return [mask | _ones(part.tolist()) for part in np.array_split(rest, distance + 1)]


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all shingles of ``words`` words; shorter texts are one shingle, no word gives 0."""
    digest, counts, total, last = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0, []
    for part in pieces(text):
        w = last + part.lower().split()
        if len(w) >= words:
            h = np.array([digest(s, seed) for s in map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False))], np.uint64)
            counts += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
            total += len(h)
            last = w[1 - words :] if words > 1 else []
        else:
            last = w
    if not total and last:
        return digest(b" ".join(last), seed)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """``key, fp``: one signed 64-bit fingerprint per row. Null text is empty; only A-Z are lower-cased."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, words, seed) for t in texts(b.column(1))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=[key, "fp"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, fp long")


def _near(fps: np.ndarray, distance: int) -> Iterator[tuple[int, np.ndarray]]:
    """A spanning forest of the links among distinct fingerprints: (member, positions it brings in)."""
    left = np.arange(len(fps))
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            i = todo.pop()
            hit = np.bitwise_count(fps[left] ^ fps[i]) <= distance
            if hit.any():
                new, left = left[hit], left[~hit]
                todo += new.tolist()
                yield i, new


def forest(fps: np.ndarray, distance: int, mask: int, most: int = 4096) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join what is within ``distance`` among distinct fingerprints that agree on ``mask``.

    More than ``most`` of them are first cut by finer blocks, so a very full block isn't compared pair by pair.
    """
    finer = finer_masks(mask, distance) if len(fps) > most else [mask]
    if mask in finer:
        return [(np.full(len(new), fps[i]), fps[new]) for i, new in _near(fps, distance)]
    out = []
    for m in finer:
        part = fps[np.argsort(fps & np.uint64(m), kind="stable")]
        cuts = np.flatnonzero(np.diff(part & np.uint64(m))) + 1
        for run in np.split(part, cuts):
            if len(run) > 1:
                out += forest(run, distance, m, most)
    return out


def _linked(batches: Iterator[pa.RecordBatch], distance: int, masks: list[int]) -> Iterator[pa.RecordBatch]:
    """Rows (c, block, fp) sorted by (c, block) to the links within each block."""
    rest: tuple = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))

    def links(c, block, fp) -> pa.RecordBatch:
        a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        start = np.flatnonzero(np.r_[True, (np.diff(c) != 0) | (np.diff(block) != 0)])
        size = np.diff(np.r_[start, len(c)])
        u = fp.view(np.uint64)
        small = np.repeat(np.where(size <= 8, np.arange(len(size)), -1 - np.arange(len(size))), size)
        for lag in range(1, 8):
            hit = np.flatnonzero((small[lag:] == small[:-lag]) & (small[lag:] >= 0) & (np.bitwise_count(u[lag:] ^ u[:-lag]) <= distance))
            a.append(u[hit])
            b.append(u[hit + lag])
        for s, n in zip(start[size > 8], size[size > 8], strict=True):
            for x, y in forest(u[s : s + n], distance, masks[c[s]]):
                a.append(x)
                b.append(y)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).view(np.int64)) for v in (a, b)], names=["a", "b"])

    for batch in batches:
        now = [np.concatenate([old, batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)]) for i, old in enumerate(rest)]
        same = (now[0] == now[0][-1:]) & (now[1] == now[1][-1:])
        cut_at = len(same) - int(same[::-1].argmin()) if len(same) and not same.all() else 0
        if cut_at:
            yield links(*(v[:cut_at] for v in now))
        rest = tuple(v[cut_at:] for v in now)
    if len(rest[0]) > 1:
        yield links(*rest)


def block_links(distinct: DataFrame, distance: int = 4, most: int = 4096) -> DataFrame:
    """``a, b``: enough verified links among the distinct ``fp`` to connect all that are within ``distance``.

    A block with more than ``most`` fingerprints is dealt out by finer blocks before the shuffle,
    once here and again inside a task where that is not enough; no pair within reach is lost.
    """
    masks = block_masks(distance)
    parts = {c: finer_masks(m, distance) for c, m in enumerate(masks)}
    all_masks = masks + [m for c in range(len(masks)) for m in parts[c]]

    def block(c: int, m: int) -> Column:
        return F.struct(F.lit(c).alias("c"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("block"))

    keyed = distinct.select("fp", F.inline(F.array(*[block(c, m) for c, m in enumerate(masks)])))
    full = keyed.groupBy("c", "block").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select("c", "block", F.lit(True).alias("full"))
    finer = F.lit(None)
    for c in range(len(masks)):
        first = len(masks) + c * (distance + 1)
        finer = F.when(F.col("c") == c, F.array(*[block(first + i, m) for i, m in enumerate(parts[c])])).otherwise(finer)
    own = F.array(F.struct("c", "block"))
    dealt = keyed.join(full, ["c", "block"], "left").select("fp", F.inline(F.when(F.col("full"), finer).otherwise(own)))
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.select("c", "block", "fp").repartition(n, "c", "block").sortWithinPartitions("c", "block")
    return dealt.mapInArrow(lambda it: _linked(it, distance, all_masks), "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, distance: int = 4, seed: int = 42) -> DataFrame:
    """``key, fp, component_id``: fingerprints linked at ``distance`` or fewer differing bits, and their components.

    Equal fingerprints are folded to one before blocks are formed, so exact copies never meet
    pair by pair. Rows without a word have fingerprint 0 and are linked like any other; rows
    with a null key take part and keep it; repeated rows give repeated rows; an empty table
    gives an empty one. ``component_id`` is the smallest key reachable, the row's own included.
    Other columns of ``docs`` are not read.
    """
    fps = cut(fingerprints(docs, key, text, words, seed))
    distinct = cut(fps.groupBy("fp").agg(F.min(key).alias("least")))
    roots = components(block_links(distinct.select("fp"), distance))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = cut(named.groupBy("root").agg(F.min("least").alias("component_id")))  # written, so that a large group's rows can be split
    of = cut(named.select("fp", "root").join(least, "root").select("fp", "component_id"))
    return fps.join(of, "fp").select(key, "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose (integer) key is the smallest of its group, one row of each such key, all columns kept.

    Rows with one key are one document, of which any one row stays. A row without a key is known by
    its text: it goes if its group has a document with a key, else one row of the group stays.
    """
    own = F.coalesce(F.col(key).cast("long"), F.shiftrightunsigned(F.xxhash64(text), 2) + F.lit(1 << 62))
    named = docs.withColumn("_dedup_key", own)
    groups = near_duplicates(named, "_dedup_key", text, **how).filter("_dedup_key = component_id").select("_dedup_key").distinct()
    return named.join(groups, "_dedup_key", "left_semi").dropDuplicates(["_dedup_key"]).select(*[F.col(f"`{c}`") for c in docs.columns])

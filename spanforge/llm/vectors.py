"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations, multiprobe buckets, verified pairs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .links import components


@dataclass(frozen=True)
class Hashing:
    """``tables`` tables of ``joined`` cross-polytope hashes; each vector asks its ``probes`` likeliest buckets.

    The defaults find a pair at cosine 0.93 in 64 dimensions with a probability above 0.999.
    """

    tables: int = 8
    joined: int = 2
    probes: int = 3
    seed: int = 1


def hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, safe for very large and very small components."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def bucket_codes(x: np.ndarray, how: Hashing) -> np.ndarray:
    """(rows, tables, probes) bucket numbers, the own bucket first; -1 where there are fewer buckets than probes.

    A hash is the nearest signed axis after three rounds of random signs and Hadamard transform.
    Probes are the combinations of axes that lose least of the squared length.
    """
    n, d = x.shape
    width = 1 << max(0, d - 1).bit_length()
    x = np.pad(x, ((0, 0), (0, width - d)))
    top = min(how.probes, width)
    out = np.full((n, how.tables, how.probes), -1, np.int64)
    for t in range(how.tables):
        code, loss = np.zeros((n, 1), np.int64), np.zeros((n, 1))
        for k in range(how.joined):
            y = x
            for turn in range(3):
                y = hadamard(y * np.random.default_rng([how.seed, t, k, turn]).choice([-1.0, 1.0], width))
            axis = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :top]
            value = np.take_along_axis(y, axis, 1)
            lost = (np.abs(value[:, :1]) - np.abs(value)) ** 2
            code = (code[:, :, None] * (2 * width) + (2 * axis + (value < 0))[:, None, :]).reshape(n, -1)
            loss = (loss[:, :, None] + lost[:, None, :]).reshape(n, -1)
        best = np.argsort(loss, axis=1, kind="stable")[:, : how.probes]
        out[:, t, : best.shape[1]] = np.take_along_axis(code, best, 1)
    return out


def _coded(batches: Iterator[pa.RecordBatch], how: Hashing) -> Iterator[pa.RecordBatch]:
    """(u, vec) to (u, codes)."""
    for b in batches:
        lists = b.column(1)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.r_[0, np.cumsum(size)]
        codes = np.empty((len(size), how.tables, how.probes), np.int64)
        for d in np.unique(size):
            rows = np.flatnonzero(size == d)
            codes[rows] = bucket_codes(unit(flat[at[rows][:, None] + np.arange(d)]), how)
        width = how.tables * how.probes
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.ListArray.from_arrays(np.arange(len(size) + 1, dtype=np.int32) * width, pa.array(codes.ravel()))], names=["u", "codes"]
        )


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the sets of a and b; ``root`` holds the smallest position of each set."""
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def _verified(batches: Iterator[pa.RecordBatch], least: float, how: Hashing) -> Iterator[pa.RecordBatch]:
    """Bucket rows sorted by bucket to (u, v, links): weight of u's links first met here, and whom it is tied to."""
    rest: list[pa.RecordBatch] = []

    def of(rows: pa.Table) -> pa.RecordBatch:
        col = {c: rows.column(c).combine_chunks() for c in rows.column_names}
        key = {c: col[c].to_numpy(zero_copy_only=False) for c in ("label", "d", "t", "bucket", "lo", "hi")}
        u, n, mine, own = (col[c].to_numpy(zero_copy_only=False) for c in ("u", "n", "mine", "own"))
        new = np.zeros(len(u), bool)
        new[0] = True
        for v in key.values():
            new[1:] |= v[1:] != v[:-1]
        start = np.flatnonzero(new)
        end = np.r_[start[1:], len(u)]
        vec, codes = col["vec"].flatten().to_numpy(zero_copy_only=False), col["codes"].flatten().to_numpy(zero_copy_only=False)
        vec_at, codes_at = np.r_[0, np.cumsum(key["d"])], how.tables * how.probes
        out: tuple[list, list, list] = ([], [], [])
        for s, e in zip(start, end, strict=True):
            if e - s < 2 or not own[s:e].any():
                continue
            d = int(key["d"][s])
            x = unit(vec[vec_at[s] : vec_at[e]].reshape(-1, d).astype(np.float64))
            c = codes[s * codes_at : e * codes_at].reshape(-1, how.tables, how.probes)
            t, bucket, split = int(key["t"][s]), key["bucket"][s], key["lo"][s] != key["hi"][s]
            root, links = np.arange(e - s), np.zeros(e - s, np.int64)
            for i in range(0, e - s, 256):
                j = slice(i, min(i + 256, e - s))
                hit = x[j] @ x.T >= least
                hit &= (own[s:e][j, None] | own[s:e][None]) & (np.arange(j.start, j.stop)[:, None] < np.arange(e - s)[None])
                if split:
                    hit &= mine[s:e][j, None] != mine[s:e][None]
                for a, b in zip(*(np.array_split(v, 1 + len(v) // 65536) for v in np.nonzero(hit)), strict=True):
                    a = a + i
                    p, q = c[a], c[b]
                    by_a, by_b = (p[:, :, :1] == q).any(2), (q[:, :, :1] == p).any(2)
                    here = np.minimum(np.where(by_a[:, t], p[:, t, 0], np.iinfo(np.int64).max), np.where(by_b[:, t], q[:, t, 0], np.iinfo(np.int64).max))
                    first = ((by_a | by_b).argmax(1) == t) & (here == bucket)
                    a, b = a[first], b[first]
                    if len(a):
                        np.add.at(links, a, n[s:e][b])
                        np.add.at(links, b, n[s:e][a])
                        root = _join(root, a, b)
            tied = np.flatnonzero(links)
            if len(tied):
                out[0].append(u[s:e][tied])
                out[1].append(u[s:e][root[tied]])
                out[2].append(links[tied])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *v])) for v in out], names=["u", "v", "links"])

    for b in batches:
        rows = pa.Table.from_batches([*rest, b])
        same = np.ones(rows.num_rows, bool)
        for k in ("label", "d", "t", "bucket", "lo", "hi"):
            v = rows.column(k).to_numpy()
            same &= v == v[-1:]
        at = 0 if same.all() else rows.num_rows - int(same[::-1].argmin())
        if at:
            yield of(rows.slice(0, at))
        rest = rows.slice(at).combine_chunks().to_batches()
    if rest:
        yield of(pa.Table.from_batches(rest))


def near_vectors(df: DataFrame, key: str = "vec_id", vec: str = "embedding", label: str = "label", least: float = 0.93, how: Hashing = Hashing(), block: int = 2048) -> DataFrame:
    """``key, n_links, component_id, kept`` for each row: rows of one label linked at cosine >= ``least``.

    Vectors that are null, empty, all zero or hold a null, NaN or infinity, and rows without a
    label, link with nothing: 0 links, their own component, kept. Vectors of different length
    don't link. Equal vectors of a label are folded to one with a count, so copies are counted
    and not paired. A bucket of more than ``block`` vectors is dealt out as pairs of blocks. Each
    pair is verified in double precision and counted in the first bucket where it meets. Rows
    with one key twice count as two vectors; a null key gives its group's smallest key, or null.
    Labels may have any type; only equal ones meet. ``n_links`` needs every pair of a dense label
    looked at, so a bucket's vectors are copied once per block of it.
    """
    v = F.col("_v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("_label").isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = df.select(F.col(key).alias("_key"), F.col(label).alias("_label"), F.col(vec).alias("_v"))
    rows = rows.withColumn("_label", F.when(usable, F.col("_label"))).withColumn("_v", F.when(F.col("_label").isNotNull(), v))
    one = rows.filter("_label is not null").groupBy("_label", "_v").agg(F.min("_key").alias("least"), F.count(F.lit(1)).alias("n"))
    # labels of any type, by number
    number = cut(one.select("_label").distinct().select("_label", F.monotonically_increasing_id().alias("label")))
    one = cut(one.join(number, "_label").select("label", F.col("_v").alias("vec"), F.size("_v").cast("long").alias("d"), "least", "n", F.monotonically_increasing_id().alias("u")))
    codes = cut(one.select("u", "vec").mapInArrow(lambda it: _coded(it, how), "u long, codes array<long>"))
    keyed = one.join(codes, "u").select("*", F.posexplode("codes").alias("pos", "bucket")).filter("bucket >= 0")
    keyed = keyed.withColumn("t", F.floor(F.col("pos") / how.probes)).withColumn("own", F.col("pos") % how.probes == 0)
    spot = ["label", "d", "t", "bucket"]
    crowded = keyed.groupBy(*spot).agg(F.ceil(F.count(F.lit(1)) / block).alias("parts")).filter("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    dealt = keyed.join(crowded, spot, "left").withColumn("parts", parts).withColumn("mine", F.pmod(F.xxhash64("u"), F.col("parts")))
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda x: F.struct(F.least("mine", x).alias("lo"), F.greatest("mine", x).alias("hi")))
    dealt = dealt.select(*spot, "u", "n", "own", "mine", "vec", "codes", F.inline(pair))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(partitions, *spot, "lo", "hi").sortWithinPartitions(*spot, "lo", "hi")
    met = cut(dealt.mapInArrow(lambda it: _verified(it, least, how), "u long, v long, links long"))
    roots = components(met.select("u", "v"), "u", "v").withColumnRenamed("node", "u")
    named = one.join(met.groupBy("u").agg(F.sum("links").alias("links")), "u", "left").join(roots, "u", "left")
    named = cut(named.select("label", "vec", "least", "n", "links", F.coalesce("root", "u").alias("root")))
    component = cut(named.groupBy("root").agg(F.min("least").alias("component_id")))  # written, so that a large group's rows can be split
    known = named.join(component, "root").join(number, "label").select("_label", F.col("vec").alias("_v"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.join(cut(known), ["_label", "_v"], "left").withColumn("component_id", F.coalesce("component_id", "_key"))
    return out.select(F.col("_key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("_key").eqNullSafe(F.col("component_id")).alias("kept"))

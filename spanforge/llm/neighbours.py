"""Approximate nearest neighbours: cross-polytope hashing, multiprobe tables, exact reranking."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .vectors import hadamard, unit


@dataclass(frozen=True)
class Tables:
    """How vectors are hashed and how far a query looks.

    ``recall`` is the chance that a neighbour as far off as the ``k``-th one found in the first round
    of ``first`` buckets a table is met; each query asks as many more buckets as that takes.
    ``joined`` hashes make a bucket; 0 takes as many as keep a mean bucket under ``crowd`` rows.
    Rows of a bucket are dealt into blocks of about ``block``.
    """

    tables: int = 4
    joined: int = 0
    first: int = 4
    recall: float = 0.98
    crowd: int = 1 << 16
    block: int = 4096
    seed: int = 5

    def depth(self, rows: int, width: int) -> int:
        deep = 1
        while not self.joined and rows / (2.0 * width) ** deep > self.crowd:
            deep += 1
        return self.joined or deep

    def widest(self, width: int, deep: int) -> int:
        """Buckets a table from which asking them all together costs as much as reading every row."""
        return max(1, (2 * width) ** deep // self.tables)


def _width(d: int) -> int:
    return 1 << max(0, d - 1).bit_length()


@functools.cache
def _signs(seed: int, table: int, place: int, width: int) -> np.ndarray:
    return np.random.default_rng([seed, table, place]).choice([-1.0, 1.0], (3, width))


def _axes(x: np.ndarray, how: Tables, table: int, place: int) -> np.ndarray:
    """(rows, 2 * width) length along each signed axis after three rounds of random signs and Hadamard transform."""
    for signs in _signs(how.seed, table, place, x.shape[1]):
        x = hadamard(x * signs)
    return np.stack([x, -x], 2).reshape(len(x), -1)


def _padded(x: np.ndarray) -> np.ndarray:
    return np.pad(unit(x), ((0, 0), (0, _width(x.shape[1]) - x.shape[1])))


def own_buckets(x: np.ndarray, how: Tables, deep: int) -> np.ndarray:
    """(rows, tables) bucket of each vector: its nearest signed axes."""
    x = _padded(x)
    out = np.zeros((len(x), how.tables), np.int64)
    for t in range(how.tables):
        for place in range(deep):
            out[:, t] = out[:, t] * (2 * x.shape[1]) + _axes(x, how, t, place).argmax(1)
    return out


def probes(x: np.ndarray, how: Tables, deep: int, most: int, table: int) -> np.ndarray:
    """(rows, up to ``most``) buckets of one table, those first that lose least length against the nearest axes."""
    x = _padded(x)
    code, loss = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
    for place in range(deep):
        along = _axes(x, how, table, place)
        lost = (along.max(1, keepdims=True) - along) ** 2
        code = (code[:, :, None] * along.shape[1] + np.arange(along.shape[1])[None, None]).reshape(len(x), -1)
        loss = (loss[:, :, None] + lost[:, None, :]).reshape(len(x), -1)
        best = np.argsort(loss, axis=1, kind="stable")[:, :most]
        code, loss = np.take_along_axis(code, best, 1), np.take_along_axis(loss, best, 1)
    return code


#: Cosines at which the number of buckets to ask is measured, falling.
GRID = np.linspace(1.0, 0.0, 41)


@functools.cache
def needed(how: Tables, d: int, deep: int, pairs: int = 512) -> np.ndarray:
    """Buckets a table to ask at each cosine of ``GRID``, measured on random pairs; one more than ``widest`` where none suffice.

    A neighbour is missed if its bucket is asked in no table, so one table need find it with
    probability ``1 - (1 - recall) ** (1 / tables)``.
    """
    r = np.random.default_rng([how.seed, 99])
    width, most = _width(d), how.widest(_width(d), deep)
    share = 1 - (1 - how.recall) ** (1 / how.tables)
    a = unit(r.normal(size=(pairs, d)) + 1e-9)
    b = r.normal(size=(pairs, d))
    b = b - (a * b).sum(1, keepdims=True) * a
    b = b / np.maximum(np.sqrt((b * b).sum(1, keepdims=True)), 1e-12)
    asked = np.concatenate([probes(a, how, deep, most, t) for t in range(how.tables)])
    out = []
    for c in GRID:
        y = c * a + np.sqrt(1 - c * c) * b
        own = own_buckets(y, how, deep).T.reshape(-1, 1)
        met = asked == own
        rank = np.sort(np.where(met.any(1), met.argmax(1), most))
        out.append(rank[min(len(rank) - 1, int(np.ceil(share * len(rank))))] + 1)
    return np.minimum(np.maximum.accumulate(np.array(out)), most + 1)


def least_cosine(norm: np.ndarray, low: np.ndarray, high: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Smallest cosine that a vector of length ``low`` to ``high`` within ``distance`` of one of length ``norm`` can have."""
    with np.errstate(all="ignore"):
        gap = norm**2 - distance**2
        at = np.clip(np.sqrt(np.maximum(gap, 0)), low, high)
        # a vector within the distance is no longer and no shorter than this
        at = np.clip(at, np.maximum(norm - distance, 0), norm + distance)
        return np.where(at > 0, (gap + at**2) / (2 * norm * at), -1.0)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _lists(values: np.ndarray, size: int) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(values) // size + 1, dtype=np.int32) * size, pa.array(values))


def _of_one_length(batch: pa.RecordBatch, d: str = "d") -> Iterator[pa.RecordBatch]:
    """Rows of a batch by the length of their vectors."""
    size = batch.column(batch.schema.get_field_index(d)).to_numpy()
    for n in np.unique(size):
        yield batch.take(pa.array(np.flatnonzero(size == n)))


def _hashed(batches: Iterator[pa.RecordBatch], how: Tables, rows: int) -> Iterator[pa.RecordBatch]:
    """(u, id, d, vec) with the bucket in each table."""
    for b in batches:
        for part in _of_one_length(b):
            x = _matrix(part.column(3))
            own = own_buckets(x, how, how.depth(rows, _width(x.shape[1])))
            yield pa.RecordBatch.from_arrays([*part.columns, _lists(own.ravel(), how.tables)], names=[*part.schema.names, "buckets"])


def _asked(batches: Iterator[pa.RecordBatch], how: Tables, rows: int, later: bool) -> Iterator[pa.RecordBatch]:
    """(q, d, vec, norm, low, high, kth) to (q, t, bucket); t is -1 for a query that has to see every row.

    The first round asks ``first`` buckets a table, the later one as many more as the distance found calls for.
    """
    for b in batches:
        for part in _of_one_length(b):
            x = _matrix(part.column(2))
            d, q = x.shape[1], part.column(0).to_numpy()
            deep = how.depth(rows, _width(d))
            most = how.widest(_width(d), deep)
            start, stop = np.zeros(len(q), np.int64), np.full(len(q), min(how.first, most))
            if later:
                norm, low, high, kth = (part.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in (3, 4, 5, 6))
                cosine = least_cosine(norm, low, high, kth)
                at = np.searchsorted(-GRID, -np.nan_to_num(cosine, nan=-1.0), side="left")
                start, stop = stop, np.where(at < len(GRID), needed(how, d, deep)[np.minimum(at, len(GRID) - 1)], most + 1)
            every = stop > most
            out = [(q[every], np.full(every.sum(), -1), np.zeros(every.sum(), np.int64))]
            ask = np.flatnonzero(~every & (stop > start))
            for s in range(0, len(ask), 64):  # a few queries at a time: deep tables have many combinations
                rows_ = ask[s : s + 64]
                for t in range(how.tables):
                    code = probes(x[rows_], how, deep, int(stop[rows_].max()), t)
                    place = np.arange(code.shape[1])[None]
                    i, j = np.nonzero((place >= start[rows_][:, None]) & (place < stop[rows_][:, None]))
                    out.append((q[rows_][i], np.full(len(i), t), code[i, j]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).astype(np.int64)) for v in zip(*out, strict=True)], names=["q", "t", "bucket"])


def _closest(x: np.ndarray, u: np.ndarray, ids: np.ndarray, asked: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query place, row place, distance) of the ``k`` rows nearest to each query, ties to smaller ids."""
    squares, own = (x * x).sum(1), (asked * asked).sum(1)
    with np.errstate(all="ignore"):
        rough = own[:, None] + squares[None] - 2 * (asked @ x.T)
        same = q[:, None] == u[None]
        rough[same] = np.inf
        bound = np.inf
        if len(x) > k:
            # what rounding of the rough distances could hide is kept
            bound = (np.partition(rough, k - 1, 1)[:, k - 1] + 1e-10 * (own + squares.max()))[:, None]
        near = ~(rough > bound) & ~same
    found: list[tuple[np.ndarray, ...]] = []
    step = max(1, (1 << 16) // max(1, int(near.sum(1).max(initial=1))))
    for s in range(0, len(q), step):
        a, b = np.nonzero(near[s : s + step])
        away = np.sqrt(((asked[a + s] - x[b]) ** 2).sum(1))
        order = np.lexsort((ids[b], away, a))
        a, b, away = a[order], b[order], away[order]
        rank = np.arange(len(a)) - np.searchsorted(a, a, "left")
        found.append((a[rank < k] + s, b[rank < k], away[rank < k]))
    return tuple(np.concatenate(v) for v in zip(*found, strict=True))


def _met(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows and then queries of each block, sorted by block, to (q, u, id, away): the nearest rows of the block."""
    keys = ("d", "t", "bucket", "chunk")
    key: tuple = ()
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        number = {n: col[n].to_numpy(zero_copy_only=False) for n in (*keys, "kind", "u", "id")}
        change = np.zeros(batch.num_rows, bool)
        for n in (*keys, "kind"):
            change[1:] |= number[n][1:] != number[n][:-1]
        out: list[tuple[np.ndarray, ...]] = []
        starts = np.r_[0, np.flatnonzero(change)]
        for s, e in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
            now = tuple(int(number[n][s]) for n in keys)
            if now != key:
                key, held = now, []
            x, u, ids = _matrix(col["vec"].slice(s, e - s)), number["u"][s:e], number["id"][s:e]
            if number["kind"][s] == 0:
                held.append((x, u, ids))
                continue
            if not held:
                continue
            if len(held) > 1:
                held = [tuple(np.concatenate(v) for v in zip(*held, strict=True))]
            for at in range(0, e - s, 256):
                a, b, away = _closest(*held[0], x[at : at + 256], u[at : at + 256], k)
                out.append((u[at : at + 256][a], held[0][1][b], held[0][2][b], away))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in zip(*out, strict=True)], names=["q", "u", "id", "away"])


def _search(blocks: DataFrame, asks: DataFrame, k: int) -> DataFrame:
    """The nearest rows of every block that a query asks; both have d, t, bucket, chunk, u, id, vec."""
    spot = ["d", "t", "bucket", "chunk"]
    both = blocks.select(*spot, F.lit(0).alias("kind"), "u", "id", "vec").unionByName(asks.select(*spot, F.lit(1).alias("kind"), "u", "id", "vec"))
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(parts, *spot).sortWithinPartitions(*spot, "kind")
    return dealt.mapInArrow(lambda it: _met(it, k), "q long, u long, id long, away double")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy("away", "id", "u")
    return found.dropDuplicates(["q", "u"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(df: DataFrame, queries: Column, key: str = "vec_id", vec: str = "embedding", k: int = 10, how: Tables = Tables()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest other rows of each row where ``queries`` holds.

    Nearness is Euclidean distance in double precision, on the vectors as they are; ties go to the
    smaller key. Every row is hashed into every table. A query first asks a few buckets; the distance
    of its ``k``-th find and the range of lengths of all vectors bound the angle of anything nearer,
    and it then asks as many buckets as catch that angle with probability ``recall``. Where that is
    as much work as reading all rows, or fewer than ``k`` rows were met, it reads all rows, in blocks.

    Rows whose key is null or whose vector is null, empty, all zero or holds a null, NaN or infinity
    take no part. Vectors of different length are never compared. A row that repeats another is a
    row of its own, also if the keys are equal, and each query row answers for itself. With fewer
    than ``k`` other rows, all are returned; an empty table gives an empty one.
    """
    spark = df.sparkSession
    v = F.col(vec)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col(key).isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = df.filter(usable).select(F.monotonically_increasing_id().alias("u"), F.col(key).cast("long").alias("id"), F.size(v).cast("long").alias("d"), v.cast("array<double>").alias("vec"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = cut(rows)
    n = rows.count()
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    # sums of squares differ in their last bits by order of summation
    spread = rows.groupBy("d").agg((F.min(length) * (1 - 1e-9)).alias("low"), (F.max(length) * (1 + 1e-9)).alias("high"))
    asking = cut(rows.filter("asks").join(spread, "d").select(F.col("u").alias("q"), "id", "d", "vec", length.alias("norm"), "low", "high"))

    coded = cut(rows.select("u", "id", "d", "vec").mapInArrow(lambda it: _hashed(it, how, n), "u long, id long, d long, vec array<double>, buckets array<long>"))
    spot = ["d", "t", "bucket"]
    places = coded.select("u", "d", F.posexplode("buckets").alias("t", "bucket")).withColumn("t", F.col("t").cast("long"))
    sizes = cut(places.groupBy(*spot).agg(F.ceil(F.count(F.lit(1)) / how.block).alias("parts")))
    table = coded.select("u", "id", "d", "vec", F.posexplode("buckets").alias("t", "bucket")).withColumn("t", F.col("t").cast("long"))
    crowded = table.join(sizes.filter("parts > 1"), spot, "left")
    blocks = crowded.withColumn("chunk", F.pmod(F.xxhash64("u"), F.coalesce("parts", F.lit(1))))

    def ask(found: DataFrame | None) -> DataFrame:
        kth = asking.withColumn("kth", F.lit(None).cast("double")) if found is None else asking.join(found.filter(F.col("rank") == k).select("q", F.col("away").alias("kth")), "q", "left")
        given = kth.select("q", "d", "vec", "norm", "low", "high", "kth")
        later = found is not None
        return cut(given.mapInArrow(lambda it: _asked(it, how, n, later), "q long, t long, bucket long"))

    def in_tables(asked: DataFrame) -> DataFrame:
        spots = asked.filter("t >= 0").join(asking, "q").join(sizes, spot)
        spots = spots.select(*spot, F.col("q").alias("u"), "id", "vec", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("chunk"))
        return _search(blocks, spots, k)

    early = cut(_best(in_tables(ask(None)), k))
    asked = ask(early)
    found = early.drop("rank").unionByName(in_tables(asked))
    every = asked.filter("t < 0").join(asking, "q")
    total = max(1, -(-n // how.block))
    nowhere = [F.lit(-1).cast("long").alias("t"), F.lit(0).cast("long").alias("chunk")]
    whole = rows.select("d", "u", "id", "vec", F.pmod(F.xxhash64("u"), F.lit(total)).alias("bucket"), *nowhere)
    whole_asks = every.select("d", F.col("q").alias("u"), "id", "vec", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(total - 1).cast("long"))).alias("bucket"), *nowhere)
    if not asked.filter("t < 0").isEmpty():
        found = found.unionByName(_search(whole, whole_asks, k))
    best = _best(found, k).join(asking.select("q", F.col("id").alias("query_id")), "q")
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), F.col("away").alias("score"))


def nearest_sql(every: int = 100, k: int = 10) -> str:
    """All distances in DuckDB; equal to the search where every query reads all rows or misses none."""
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS u, vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
pairs AS (SELECT a.u, a.vec_id AS query_id, b.vec_id, list_distance(a.x, b.x) AS score FROM v a JOIN v b ON a.u <> b.u AND a.vec_id % {every} = 0 AND len(a.x) = len(b.x)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY score, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}
"""

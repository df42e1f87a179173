"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands with elite migration."""

from __future__ import annotations

import base64
import functools
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

RANKS = "byte_bpe_50k.tiktoken"
#: The vocabulary's one special token and its id.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
#: White space as the vocabulary's own splitting rule has it.
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_ODD = re.compile(rf" (?={_SPACE}|\Z)")
_CHUNKS = re.compile(rf" ?[^{_SPACE[1:-1]}]+|{_SPACE}+(?![^{_SPACE[1:-1]}])|{_SPACE}+")


class _Parts(dict):
    """Ids of parts of texts, encoded when first asked for; emptied when it holds ``most``."""

    def __init__(self, encode, head: str, most: int):
        self.encode, self.head, self.most = encode, head, most

    def __missing__(self, part: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        self[part] = ids = array("I", self.encode(self.head + part)).tobytes()
        return ids


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers, those of ``byte_bpe_50k.json``.

    The same vocabulary is read as a table of ranks, which encodes single words several times
    faster; tests hold the ids against the other library's. Its rule never joins a character and
    a single space after it, so a text can be encoded between single spaces and the ids of the
    parts, which repeat a lot, be reused. The special token in a text is ordinary text or, with
    ``special``, has its own id and parts the text, as in the other library's default setting.
    """

    def __init__(self, path: str | None = None, most: int = 250_000, special: bool = False):
        self.special = special
        with open(path or public_tokenizers.path(RANKS), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        encode = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.after, self.alone = _Parts(encode, " ", most), _Parts(encode, "", most // 4)

    def ids(self, text: str) -> bytes:
        if self.special and SPECIAL in text:
            return SPECIAL_ID.to_bytes(4, "little").join(map(self._plain, text.split(SPECIAL)))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if _ODD.search(text):
            return b"".join(map(self.alone.__getitem__, _CHUNKS.findall(text)))
        first, *rest = text.split(" ")
        lead = b"".join(map(self.alone.__getitem__, _CHUNKS.findall(first)))
        return lead + b"".join(map(self.after.__getitem__, rest))


@functools.cache
def _encoder(path: str | None, special: bool) -> Encoder:
    """One per worker process, so that tasks share what it has learned."""
    return Encoder(path, special=special)


def spans(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones at its end, what is left over in the first."""
    first = length % capacity or capacity if length > capacity else length
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 2048, path: str | None = None, with_ids: bool = True, special: bool = False) -> DataFrame:
    """``key, piece, start, length, ids_crc32`` and, if asked for, ``ids``: a row per piece of each document.

    A document is its ids and an id 0 at the end; a null text is empty and has only that. With
    ``special`` the special token in a text has its own id, else it is ordinary text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, special)
        for b in batches:
            at, rows, ids = [], [], []
            for i, cell in enumerate(b.column(1)):
                whole = encoder.ids(cell.as_py() or "") + bytes(4)
                for k, (start, length) in enumerate(spans(len(whole) // 4, capacity)):
                    part = whole[4 * start : 4 * (start + length)]
                    at.append(i)
                    rows.append((k, start, length, zlib.crc32(part)))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            cols = [pa.array([r[k] for r in rows], pa.int32() if k == 0 else pa.int64()) for k in range(4)]
            more = [pa.array(ids, pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *cols, *more], names=[key, *NAMES, *["ids"] * with_ids])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


NAMES = ("piece", "start", "length", "ids_crc32")


@dataclass(frozen=True)
class Evolution:
    """``group``: pieces that are packed together, in expectation; ``islands`` populations work on each
    group apart and ``epochs`` times pass their best to the next island. ``injected``: share of a
    parent's bins, from its fullest, that crossover hands over. ``dissolved``: emptiest bins that a
    child gives up."""

    group: int = 2048
    islands: int = 2
    epochs: int = 2
    population: int = 4
    children: int = 12
    injected: float = 0.15
    dissolved: int = 3
    seed: int = 5


class Bins:
    """Bins by space left, so that the fullest bin that still takes a piece is found at once."""

    def __init__(self, capacity: int, left: list[int]):
        self.capacity, self.left, self.at, self.mask = capacity, left, [[] for _ in range(capacity + 1)], 0
        for b, space in enumerate(left):
            self.at[space].append(b)
            self.mask |= 1 << space

    def put(self, size: int) -> int:
        fits = self.mask >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            b = self.at[space].pop()
            if not self.at[space]:
                self.mask ^= 1 << space
        else:
            b, space = len(self.left), self.capacity
            self.left.append(space)
        self.left[b] = space = space - size
        self.at[space].append(b)
        self.mask |= 1 << space
        return b


def best_fit(sizes: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece when pieces come in ``order`` and go to the fullest bin that takes them."""
    bins, out = Bins(capacity, []), np.empty(len(sizes), np.int64)
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        out[i] = bins.put(size)
    return out


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first; then the sum of squared fills, which favours full bins beside empty ones."""
    fill = np.bincount(bins, sizes)
    return len(fill), -float(((fill / capacity) ** 2).sum())


def crossover(sizes: np.ndarray, a: np.ndarray, b: np.ndarray, capacity: int, r: np.random.Generator, how: Evolution) -> np.ndarray:
    """Well-filled bins of ``b`` go whole into ``a``; bins of ``a`` that share a piece with them fall,
    a few of the emptiest too, and the pieces set free are put back by best fit, the largest first."""
    fill = np.bincount(b, sizes)
    many = max(1, int(how.injected * len(fill)))
    chosen = np.zeros(len(fill), bool)
    chosen[r.permutation(np.argsort(-fill, kind="stable")[: 3 * many])[:many]] = True
    brought = chosen[b]
    own = np.bincount(a, sizes)
    falls = np.zeros(len(own), bool)
    falls[a[brought]] = True
    falls[np.argsort(own + capacity * falls, kind="stable")[: how.dissolved]] = True
    child = np.full(len(a), -1, np.int64)
    stays = ~falls[a] & ~brought
    child[stays] = a[stays]
    child[brought] = len(own) + b[brought]
    placed = np.flatnonzero(child >= 0)
    _, child[placed] = np.unique(child[placed], return_inverse=True)
    free = np.flatnonzero(child < 0)
    left = (capacity - np.bincount(child[placed], sizes[placed]).astype(np.int64)).tolist() if len(placed) else []
    bins = Bins(capacity, left)
    for i in free[np.argsort(-sizes[free], kind="stable")].tolist():
        child[i] = bins.put(int(sizes[i]))
    return child


def evolve(sizes: np.ndarray, capacity: int, r: np.random.Generator, how: Evolution, known: list[np.ndarray] = ()) -> np.ndarray:
    """Best packing found from ``known`` ones, best fit decreasing and shuffled variants; stops at the least possible number of bins."""
    least = -(-int(sizes.sum()) // capacity)
    pool = list(known) or [best_fit(sizes, np.argsort(-sizes, kind="stable"), capacity)]
    scored = sorted(((fitness(sizes, x, capacity), i) for i, x in enumerate(pool)), key=lambda x: x[0])
    if scored[0][0][0] > least:
        while len(pool) < how.population:
            pool.append(best_fit(sizes, np.argsort(-(sizes * r.uniform(0.9, 1.1, len(sizes))), kind="stable"), capacity))
        people = sorted(((fitness(sizes, x, capacity), i, x) for i, x in enumerate(pool)), key=lambda x: x[:2])
        for born in range(how.children):
            if people[0][0][0] <= least:
                break
            i, j = r.choice(min(len(people), how.population), 2, replace=False)
            child = crossover(sizes, people[min(i, j)][2], people[max(i, j)][2], capacity, r, how)
            people = sorted([*people, (fitness(sizes, child, capacity), len(pool) + born, child)], key=lambda x: x[:2])[: how.population]
        return people[0][2]
    return pool[scored[0][1]]


def _epoch(capacity: int, how: Evolution, epoch: int):
    """Rows (shard, island, uid, length, own, migrant) sorted by shard and island to the island's elite."""

    def one(shard: int, island: int, uid: np.ndarray, length: np.ndarray, own: np.ndarray, migrant: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(uid)
        uid, length, known = uid[order], length[order], [x[order] for x in (own, migrant) if len(x) and (x >= 0).all()]
        r = np.random.default_rng([how.seed, epoch, island, abs(shard)])
        bins = evolve(length, capacity, r, how, known)
        n = len(uid)
        by_bin = np.argsort(bins, kind="stable")
        ends = np.cumsum(length[by_bin])
        first = np.r_[True, bins[by_bin][1:] != bins[by_bin][:-1]]
        offset = np.empty(n, np.int64)
        offset[by_bin] = ends - length[by_bin] - (ends - length[by_bin])[first][np.cumsum(first) - 1]
        lead = np.empty(n, np.int64)
        lead[by_bin] = uid[by_bin][first][np.cumsum(first) - 1]
        cols = [np.full(n, shard), np.full(n, island), uid, length, bins, lead, offset, np.full(n, bins.max() + 1)]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=list(ELITE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for b in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            rest = now if rest is None else [np.concatenate(x) for x in zip(rest, now, strict=True)]
            change = np.flatnonzero((np.diff(rest[0]) != 0) | (np.diff(rest[1]) != 0)) + 1
            for s, e in zip(np.r_[0, change[:-1]], change, strict=True) if len(change) else ():
                yield one(int(rest[0][s]), int(rest[1][s]), *(v[s:e] for v in rest[2:]))
            if len(change):
                rest = [v[change[-1] :] for v in rest]
        if rest is not None and len(rest[0]):
            yield one(int(rest[0][0]), int(rest[1][0]), *rest[2:])

    return run


ELITE = ("shard", "island", "uid", "length", "bin", "lead", "offset", "bins")


def pack(parts: DataFrame, capacity: int = 2048, how: Evolution = Evolution()) -> DataFrame:
    """The rows of ``parts`` (with a ``length`` of 1 to ``capacity``) and their ``sequence_id`` and ``offset``.

    A full piece is a sequence of its own. The others are dealt by a hash into groups of about
    ``how.group``; islands evolve packings of a group in tasks of their own, then each also gets the
    best one of its neighbour and evolves on. The best packing of a group is its result. Only
    numbers of pieces move, never their ids. An empty table gives an empty one.
    """
    parts = cut(parts.withColumn("uid", F.monotonically_increasing_id()))
    part = parts.filter(F.col("length") < capacity)
    shards = max(1, round(part.count() / how.group))
    none = F.lit(-1).cast("long")
    base = part.select(F.pmod(F.xxhash64("uid"), F.lit(shards)).alias("shard"), "uid", F.col("length").cast("long").alias("length"))
    rows = base.select("shard", F.explode(F.array(*[F.lit(i).cast("long") for i in range(how.islands)])).alias("island"), "uid", "length", none.alias("own"), none.alias("migrant"))
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = ", ".join(f"{c} long" for c in ELITE)
    for epoch in range(how.epochs):
        dealt = rows.repartition(n, "shard", "island").sortWithinPartitions("shard", "island")
        elite = cut(dealt.mapInArrow(_epoch(capacity, how, epoch), schema))
        stays = elite.select("shard", "island", "uid", "length", F.col("bin").alias("own"), none.alias("migrant"))
        moves = elite.select("shard", F.pmod(F.col("island") + 1, F.lit(how.islands)).alias("island"), "uid", "length", none.alias("own"), F.col("bin").alias("migrant"))
        rows = stays.unionByName(moves).groupBy("shard", "island", "uid").agg(F.max("length").alias("length"), F.max("own").alias("own"), F.max("migrant").alias("migrant"))
    best = elite.groupBy("shard").agg(F.min(F.struct("bins", "island")).alias("b")).select("shard", F.col("b.island").alias("island"))
    place = elite.join(best, ["shard", "island"]).select("uid", (F.col("lead") * 2 + 1).alias("sequence_id"), "offset")
    full = parts.filter(F.col("length") >= capacity).select("*", (F.col("uid") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(parts.filter(F.col("length") < capacity).join(place, "uid")).drop("uid")

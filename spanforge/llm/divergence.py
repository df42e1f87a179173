"""How far the sources of a language differ: frequent terms recounted through broadcast minimal perfect hashes."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, shared_path
from .text import pieces, texts


@dataclass(frozen=True)
class Audit:
    """Terms in at least ``least_docs`` documents of a language count; ``prior`` is added to each count.

    A perfect hash holds about ``shard`` terms. Hashes of up to ``most_bytes`` are sent out at one
    time; a larger vocabulary takes as many passes over the texts as it needs. A task holds up to
    ``cells`` dense counters. Sources are compared in blocks of ``sources``.
    """

    least_docs: int = 30
    scale: int = 1_000_000_000
    prior: int = 5
    top: int = 50
    shard: int = 2048
    most_bytes: int = 48 << 20
    cells: int = 1 << 23
    sources: int = 128


#: ASCII bytes that are no letters become spaces and A-Z small letters; bytes of other characters stay.
TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b > 0x7F or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
#: A task sends on what it has gathered after so many terms or bytes of text.
GATHER, GATHER_BYTES = 200_000, 64 << 20
#: Longer terms are stored for verification as a digest, so that the size of a hash is bounded.
LONGEST = 1024


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a piece at a time."""
    for part in pieces(text):
        yield part.translate(TERMS).split()


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, term, documents)."""
    seen: dict[str, Counter] = {}
    read = 0

    def sent() -> Iterator[pa.RecordBatch]:
        for lang, found in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["lang", "term", "docs"])

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), texts(b.column(1)), strict=True):
            words: set[bytes] = set()
            for part in terms(text):
                words.update(part)
            seen.setdefault(lang, Counter()).update(words)
            read += len(text)
            if read > GATHER_BYTES or len(words) > GATHER:
                yield from sent()
                seen, read = {}, 0
        if sum(map(len, seen.values())) > GATHER:
            yield from sent()
            seen, read = {}, 0
    yield from sent()


# ---------------------------------------------------------------- minimal perfect hashes


def _mix(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over all places."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slot(h: np.ndarray, pilot: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    return (_mix(h ^ _mix(pilot.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))) % np.asarray(n, np.uint64)).astype(np.int64)


def _buckets(n: int) -> int:
    return max(1, n // 4)


def _bucket(h: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    return ((h & np.uint64(0xFFFFFFFF)) % np.asarray(m, np.uint64)).astype(np.int64)


def perfect(h: np.ndarray) -> np.ndarray | None:
    """Pilots of the buckets by which n hashes take the slots 0 to n - 1 once each; None if two hashes are equal.

    Buckets are settled from the fullest down: each takes the first pilot that sends all its hashes to free slots.
    """
    n = len(h)
    if len(np.unique(h)) < n:
        return None
    m = _buckets(n)
    bucket = _bucket(h, m)
    order = np.argsort(bucket, kind="stable")
    size = np.bincount(bucket, minlength=m)
    first = np.cumsum(size) - size
    pilots, taken = np.zeros(m, np.int32), np.zeros(n, bool)
    free = n
    for b in np.argsort(-size, kind="stable"):
        if not size[b]:
            break
        keys = h[order[first[b] : first[b] + size[b]]]
        tries, at = int(min(4096, max(16, 2 * (n / free) ** size[b]))), 0
        while True:
            slots = _slot(keys[None], np.arange(at, at + tries)[:, None], n)
            fit = ~taken[slots].any(1)
            if size[b] > 1:
                fit &= (np.diff(np.sort(slots, 1), axis=1) > 0).all(1)
            if fit.any():
                break
            at += tries
        i = int(fit.argmax())
        pilots[b] = at + i
        taken[slots[i]] = True
        free -= size[b]
    return pilots


def _hash(words: list[bytes], seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _stored(word: bytes) -> bytes:
    return word if len(word) <= LONGEST else b"\0" + hashlib.sha256(word).digest()


def build(words: list[bytes], hashed: Callable[[list[bytes], int], np.ndarray] = _hash) -> tuple[int, np.ndarray, list[bytes]]:
    """Seed and pilots of a perfect hash, and the words by slot."""
    seed = 42
    while (pilots := perfect(h := hashed(words, seed))) is None:
        seed += 1
    slots = _slot(h, pilots[_bucket(h, len(pilots))], len(words))
    return seed, pilots, [words[i] for i in np.argsort(slots)]


def _built(group: pa.Table) -> pa.Table:
    """All terms of one shard to its hash."""
    seed, pilots, words = build(sorted(group.column("term").to_pylist()))
    row = {"lang": group.column("lang")[0].as_py(), "shard": group.column("shard")[0].as_py(), "shards": group.column("shards")[0].as_py(), "seed": seed}
    lists = {"pilots": pa.array([pilots.tolist()], pa.list_(pa.int32())), "terms": pa.array([words], pa.list_(pa.binary())), "keys": pa.array([[_stored(w) for w in words]], pa.list_(pa.binary()))}
    return pa.table({**{k: [v] for k, v in row.items()}, **lists})


@dataclass
class Shards:
    """Perfect hashes of one language: those sent out in this pass."""

    shards: int
    n: np.ndarray = field(init=False)
    parts: list[tuple[int, int, np.ndarray, list[bytes]]] = field(default_factory=list)

    def ready(self) -> Shards:
        self.n = np.zeros(self.shards, np.int64)
        self.first, self.at, self.seed = (np.zeros(self.shards, np.int64) for _ in range(3))
        first = at = 0
        for shard, seed, pilots, keys in self.parts:
            self.n[shard], self.first[shard], self.at[shard], self.seed[shard] = len(keys), first, at, seed
            first, at = first + len(keys), at + len(pilots)
        self.pilots = np.concatenate([p[2] for p in self.parts])
        self.keys = pa.array([k for p in self.parts for k in p[3]], pa.binary())
        self.shard_of = np.repeat([p[0] for p in self.parts], [len(p[3]) for p in self.parts])
        self.parts = []
        return self

    def find(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Which words are kept terms, and their places among the dense counters. The stored key decides."""
        h = _hash(words, 42)
        shard = ((h >> np.uint64(32)) % np.uint64(self.shards)).astype(np.int64)
        live = np.flatnonzero(self.n[shard])
        h, shard = h[live], shard[live]
        for seed in np.unique(self.seed[shard][self.seed[shard] != 42]):
            again = np.flatnonzero(self.seed[shard] == seed)
            h[again] = _hash([words[live[i]] for i in again], int(seed))
        n = self.n[shard]
        pilot = self.pilots[self.at[shard] + _bucket(h, np.maximum(1, n // 4))]
        place = self.first[shard] + _slot(h, pilot, n)
        asked = pa.array([_stored(words[i]) for i in live], pa.binary())
        same = pc.equal(self.keys.take(pa.array(place)), asked).to_numpy(zero_copy_only=False).astype(bool)
        return live[same], place[same]


def _recounted(batches: Iterator[pa.RecordBatch], hashes: dict[str, Shards], cells: int) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to (lang, source, shard, slot, n): dense counters of each group, sent when many or at the end."""
    dense: dict[tuple[str, str], np.ndarray] = {}

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in dense.items():
            place, h = np.flatnonzero(counts), hashes[lang]
            shard = h.shard_of[place]
            numbers = [pa.array(v) for v in (shard.astype(np.int64), place - h.first[shard], counts[place])]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(place), pa.string()), pa.array([source] * len(place), pa.string()), *numbers], names=["lang", "source", "shard", "slot", "n"])

    for b in batches:
        met: dict[tuple[str, str], Counter] = {}
        for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b.column(2)), strict=True):
            if lang in hashes:
                found = met.setdefault((lang, source), Counter())
                for part in terms(text):
                    found.update(part)
        for group, found in met.items():
            if not found:
                continue
            words = list(found)
            which, place = hashes[group[0]].find(words)
            if group not in dense:
                size = len(hashes[group[0]].keys)
                if dense and size + sum(map(len, dense.values())) > cells:
                    yield from sent()
                    dense.clear()
                dense[group] = np.zeros(size, np.int64)
            counts = np.fromiter(found.values(), np.int64, len(found))
            dense[group][place] += counts[which]  # places of different terms differ
    yield from sent()


def recount(docs: DataFrame, hashes: DataFrame, audit: Audit) -> DataFrame:
    """``lang, source, shard, slot, n`` of every kept term, in one pass per ``most_bytes`` of hashes."""
    spark = docs.sparkSession
    cells, path = audit.cells, shared_path(spark, "recount")
    size = F.aggregate("keys", F.lit(0).cast("long"), lambda s, k: s + F.octet_length(k) + 16) + 4 * F.size("pilots")
    sized = hashes.withColumn("bytes", size)
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    passes = -(-total // audit.most_bytes)
    while passes > 1 and sized.groupBy(F.pmod(F.xxhash64("lang", "shard"), F.lit(passes))).agg(F.sum("bytes").alias("b")).agg(F.max("b")).first()[0] > audit.most_bytes:
        passes *= 2
    schema = "lang string, source string, shard long, slot long, n long"
    spark.createDataFrame([], schema).write.parquet(path)
    for i in range(passes):
        mine = sized.filter(F.pmod(F.xxhash64("lang", "shard"), F.lit(passes)) == i).select("lang", "shard", "shards", "seed", "pilots", "keys")
        held: dict[str, Shards] = {}
        for r in mine.toLocalIterator():  # at most ``most_bytes``, counted above
            held.setdefault(r.lang, Shards(r.shards)).parts.append((r.shard, r.seed, np.array(r.pilots, np.int32), [bytes(k) for k in r.keys]))
        sent = spark.sparkContext.broadcast({lang: s.ready() for lang, s in held.items()})
        docs.mapInArrow(lambda it, sent=sent: _recounted(it, sent.value, cells), schema).groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n")).write.mode("append").parquet(path)
        sent.destroy()
    return spark.read.schema(schema).parquet(path)  # a term is in one pass only


# ---------------------------------------------------------------- shares and differences


def _apart(group: pa.Table) -> pa.Table:
    """Shares of two blocks of sources over the slots of one shard to the summed differences of each pair."""
    no, slot, p, side = (group.column(c).to_numpy() for c in ("no", "slot", "p", "block"))
    lo, hi, n = (group.column(c)[0].as_py() for c in ("lo", "hi", "n"))
    base = slot < 0
    who, at = np.unique(no[base], return_index=True)
    block = side[base][at]
    shares = np.repeat(p[base][at][:, None], n, 1)
    shares[np.searchsorted(who, no[~base]), slot[~base]] = p[~base]
    left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    out: tuple[list, list, list] = ([], [], [])
    for i in left:
        others = right[right > i] if lo == hi else right
        if len(others):
            out[0].append(np.full(len(others), who[i]))
            out[1].append(who[others])
            out[2].append(np.abs(shares[others] - shares[i]).sum(1))
    a, b, value = (np.concatenate([np.empty(0, np.int64), *v]) for v in out)
    return pa.table({"lang": pa.array([group.column("lang")[0].as_py()] * len(a), pa.string()), "a": a, "b": b, "value": value})


def _share(count: Column, total: Column, kept: Column, audit: Audit) -> Column:
    """1 + floor(scale * (count + prior) / (total + prior * kept)), exact."""
    wide = "decimal(20,0)"
    above = F.lit(audit.scale).cast(wide) * (count + audit.prior).cast("decimal(18,0)")
    return 1 + F.call_function("div", above, F.nullif(total + audit.prior * kept, F.lit(0)).cast(wide))


def source_divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", audit: Audit = Audit()) -> DataFrame:
    """``lang, source, part, item, value, rank``: how the sources of each language differ in their terms.

    A term is a run of ASCII letters and non-ASCII characters, with A-Z lower-cased; each language
    keeps those in at least ``least_docs`` of its documents. With ``p`` the smoothed share of a term in
    a (language, source) group, in parts of ``scale``: part ``pair`` has every other source of the
    language with the sum of differences of ``p`` over all kept terms; part ``term`` the ``top`` terms
    that the group has and uses more than its language. Ranks go by falling value, then item in UTF-8 order.

    A null text, language or source counts as empty; repeated rows count each; other columns are not
    read. A group without terms takes part with a count of 0, a language that keeps no term gives
    pairs of value 0, one with one source gives no pair, an empty table gives an empty one. Texts are
    read twice, piece by piece: once for the documents of each term, once per pass of the recount.
    """
    spark = docs.sparkSession
    given = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(text).cast("string").alias("text"))
    met = given.select("lang", "text").mapInArrow(_document_counts, "lang string, term binary, docs long")
    kept = cut(met.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= audit.least_docs).select("lang", "term"))
    number = cut(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept")))
    high = F.shiftrightunsigned(F.xxhash64(F.col("term").cast("string")), 32)
    dealt = kept.join(number, "lang").withColumn("shards", F.ceil(F.col("kept") / audit.shard)).withColumn("shard", high % F.col("shards"))
    schema = "lang string, shard long, shards long, seed long, pilots array<int>, terms array<binary>, keys array<binary>"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # dealt by shard as well: a language alone would be one task after the join above
    dealt = dealt.select("lang", "shard", "shards", "term").repartition(parts, "lang", "shard")
    hashes = cut(dealt.groupBy("lang", "shard").applyInArrow(_built, schema))

    counts = cut(recount(given, hashes, audit))
    groups = given.select("lang", "source").distinct().join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    groups = groups.join(number, "lang", "left").fillna(0, ["total", "kept"])
    groups = cut(groups.withColumn("no", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1))

    # pairs: sources in blocks over the slots of a shard
    spot = ["lang", "shard"]
    blocks = groups.withColumn("block", F.floor(F.col("no") / audit.sources))
    many = blocks.groupBy("lang").agg(F.max("block").alias("last"))
    blocks = blocks.join(many, "lang").select("lang", "source", "total", "kept", "no", "block", "last")
    width = hashes.select(*spot, F.size("terms").alias("n"))
    none = blocks.join(width, "lang").select(*spot, "no", "block", "last", "n", F.lit(-1).cast("long").alias("slot"), _share(F.lit(0), F.col("total"), F.col("kept"), audit).alias("p"))
    some = counts.withColumnRenamed("n", "count").join(blocks, ["lang", "source"]).join(width, spot)
    some = some.select(*spot, "no", "block", "last", "n", "slot", _share(F.col("count"), F.col("total"), F.col("kept"), audit).alias("p"))
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col("last")), lambda x: F.struct(F.least("block", x).alias("lo"), F.greatest("block", x).alias("hi")))
    tiles = none.unionByName(some).select(*spot, "no", "block", "n", "slot", "p", F.inline(pair))
    apart = tiles.repartition(parts, *spot, "lo", "hi").groupBy(*spot, "lo", "hi").applyInArrow(_apart, "lang string, a long, b long, value long")
    apart = cut(apart.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    name = groups.select("lang", "source", "no")
    other = name.select("lang", F.col("source").alias("item"), F.col("no").alias("other"))
    pairs = name.join(other, "lang").filter("no <> other")
    pairs = pairs.withColumn("a", F.least("no", "other")).withColumn("b", F.greatest("no", "other")).join(apart, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))

    # terms: against the language as a whole
    whole = counts.groupBy("lang", "shard", "slot").agg(F.sum("n").alias("count"))
    totals = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("kept").alias("kept"))
    q = whole.join(totals, "lang").select("lang", "shard", "slot", _share(F.col("count"), F.col("total"), F.col("kept"), audit).alias("q"))
    named = hashes.select("lang", "shard", F.posexplode("terms").alias("slot", "item")).withColumn("item", F.col("item").cast("string"))
    named = named.withColumn("slot", F.col("slot").cast("long")).join(q, ["lang", "shard", "slot"])
    used = counts.withColumnRenamed("n", "count").join(groups, ["lang", "source"]).withColumn("p", _share(F.col("count"), F.col("total"), F.col("kept"), audit))
    more = used.join(named, ["lang", "shard", "slot"]).filter("p > q").select("lang", "source", F.lit("term").alias("part"), "item", (F.col("p") - F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = more.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= audit.top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(ranked)


def divergence_sql(audit: Audit = Audit()) -> str:
    """The same rows in DuckDB."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    share = f"1 + ({audit.scale}::HUGEINT * ({{0}} + {audit.prior})) // nullif({{1}} + {audit.prior} * v, 0)"
    return rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{capitals}', '{capitals.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
met AS (SELECT lang, unnest(list_distinct(w)) AS term FROM d),
kept AS (SELECT lang, term FROM met GROUP BY lang, term HAVING count(*) >= {audit.least_docs}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
words AS (SELECT lang, source, unnest(w) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
n AS (SELECT lang, source, sum(c)::BIGINT AS n FROM c GROUP BY lang, source),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT g.lang, g.source, coalesce(n, 0) AS n, v FROM g LEFT JOIN n USING (lang, source) JOIN v USING (lang)),
p AS (SELECT gn.lang, gn.source, term, coalesce(c, 0) AS c, {share.format("coalesce(c, 0)", "n")} AS p FROM gn JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
ln AS (SELECT lang, sum(n)::BIGINT AS n, max(v) AS v FROM gn GROUP BY lang),
lc AS (SELECT lang, term, sum(c)::BIGINT AS c FROM c GROUP BY lang, term),
q AS (SELECT lang, term, {share.format("c", "n")} AS q FROM lc JOIN ln USING (lang)),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
more AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM more))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {audit.top}
"""

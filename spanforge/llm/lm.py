"""Language-model scores of whole documents: a gated recurrent network over words, trained by truncated
backpropagation in numpy, with a class-factored softmax and its state carried over windows.

Exact counts of every training word are gathered from the whole corpus. They give the base score, the
frequent words with an output of their own, the classes of all others (by ending) and their shares in a
class. All words never seen in training are one more type, as in the base; the model leaves it the base's
probability, so that nothing is won or lost by unknown words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import shared_path
from .text import pieces, texts

END = b""
ADD = 0.1


@dataclass(frozen=True)
class Shape:
    """``head`` words have outputs of their own, ``in_class`` in each class; ``endings`` classes hold the others.

    The training documents are dealt over ``rounds``, so each is trained on once at any corpus size.
    A round starts a copy of the network per chunk, everywhere at once, and averages what the copies have learned.
    ``chunk_tokens`` and ``chunk_words`` bound a chunk, which is what a task holds at one time.
    """

    head: int = 1024
    in_class: int = 64
    endings: int = 48
    ending: int = 3
    hidden: int = 16
    inner: int = 16
    rounds: int = 2
    streams: int = 256
    window: int = 8
    rate: float = 0.03
    score_streams: int = 256
    score_window: int = 16
    chunk_tokens: int = 4_000_000
    chunk_words: int = 400_000
    seed: int = 3


# ---------------------------------------------------------------- the network


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _softmax(logits: np.ndarray, at: np.ndarray, slope: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log of the softmax of each row at one place, and its slope on the logits, negated; ``logits`` is used up."""
    rows = np.arange(len(logits))
    logits -= logits.max(1, keepdims=True)
    mine = logits[rows, at].copy()
    e = np.exp(logits, out=logits)
    total = e.sum(1)
    if slope:
        e /= total[:, None]
        e[rows, at] -= 1
    return mine - np.log(total), e if slope else None


@dataclass
class Network:
    """Input rows ``E``; gates update, reset, candidate from ``Wx, b`` and ``Wh``; classes ``Wc, bc``; words of a class ``Ww, bw``."""

    p: dict[str, np.ndarray]
    order: tuple[str, ...] = field(default=("E", "Wx", "b", "Wh", "Wc", "bc", "Ww", "bw"), repr=False)

    @classmethod
    def new(cls, shape: Shape, class_mass: np.ndarray, head_mass: np.ndarray) -> Network:
        """Starts as the unigram model: biases are log shares."""
        r, h, d = np.random.default_rng(shape.seed), shape.hidden, shape.inner
        k, c = head_mass.shape[0], len(class_mass)
        n = k * shape.in_class + shape.endings
        p = {
            "E": r.normal(0, 0.5, (n, d)), "Wx": r.normal(0, d**-0.5, (d, 3 * h)), "b": np.r_[np.full(h, 2.0), np.zeros(2 * h)], "Wh": r.normal(0, h**-0.5, (h, 3 * h)),
            "Wc": np.zeros((h, c)), "bc": np.log(class_mass / class_mass.sum()), "Ww": np.zeros((k, h, shape.in_class)), "bw": np.log(head_mass / head_mass.sum(1, keepdims=True)),
        }
        return cls({name: v.astype(np.float32) for name, v in p.items()})

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[n].ravel() for n in self.order])

    def filled(self, flat: np.ndarray) -> Network:
        cuts = np.cumsum([self.p[n].size for n in self.order])[:-1]
        return Network({n: v.reshape(self.p[n].shape).astype(np.float32) for n, v in zip(self.order, np.split(flat, cuts), strict=True)})

    def states(self, symbols: np.ndarray, h: np.ndarray, keep: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(steps, streams) symbols and the state before them: the states before each step, and the last one."""
        n, size = symbols.shape[0], h.shape[1]
        into = (self.p["E"] @ self.p["Wx"] + self.p["b"])[symbols]
        before = np.empty((n, *h.shape), np.float32)
        wh = self.p["Wh"]
        if keep is not None:
            keep |= {name: np.empty((n, *h.shape), np.float32) for name in ("z", "r", "cand", "from_h")}
        for t in range(n):
            before[t] = h
            from_h, x = h @ wh, into[t]
            gates = sigmoid(x[:, : 2 * size] + from_h[:, : 2 * size])
            z, r = gates[:, :size], gates[:, size:]
            cand = np.tanh(x[:, 2 * size :] + r * from_h[:, 2 * size :])
            h = cand + z * (h - cand)
            if keep is not None:
                keep["z"][t], keep["r"][t], keep["cand"][t], keep["from_h"][t] = z, r, cand, from_h[:, 2 * size :]
        return before, h

    def log_probabilities(self, h: np.ndarray, cls: np.ndarray, word: np.ndarray, grads: dict | None = None) -> np.ndarray:
        """Natural log of class and, in classes of head words, of the word, for each row of states; fills ``grads`` if given."""
        out, d = _softmax(h @ self.p["Wc"] + self.p["bc"], cls, grads is not None)
        if grads is not None:
            grads["Wc"], grads["bc"], grads["h"] = h.T @ d, d.sum(0), d @ self.p["Wc"].T
            grads["Ww"], grads["bw"] = np.zeros_like(self.p["Ww"]), np.zeros_like(self.p["bw"])
        # rows by class, so that each class is one product and all share one softmax
        order = np.argsort(cls, kind="stable")
        ends = np.searchsorted(cls[order], np.arange(len(self.p["Ww"]) + 1))
        order = order[: ends[-1]]
        own = h[order]
        logits = np.empty((len(order), self.p["bw"].shape[1]), np.float32)
        live = [k for k in range(len(self.p["Ww"])) if ends[k] < ends[k + 1]]
        for k in live:
            at = slice(ends[k], ends[k + 1])
            np.matmul(own[at], self.p["Ww"][k], out=logits[at])
            logits[at] += self.p["bw"][k]
        log, d = _softmax(logits, word[order], grads is not None)
        out[order] += log
        if grads is not None:
            back = np.empty_like(own)
            for k in live:
                at = slice(ends[k], ends[k + 1])
                grads["Ww"][k], grads["bw"][k] = own[at].T @ d[at], d[at].sum(0)
                np.matmul(d[at], self.p["Ww"][k].T, out=back[at])
            grads["h"][order] += back
        return out

    def backward(self, symbols: np.ndarray, before: np.ndarray, kept: dict, on_states: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the recurrent part over one window, by those of the states before each step."""
        steps, streams, size = before.shape
        wh, z, r, cand = self.p["Wh"].T, kept["z"], kept["r"], kept["cand"]
        # what each gate makes of a slope on the next state, for all steps at once
        to_cand, to_z, to_r = (1 - z) * (1 - cand * cand), (before - cand) * z * (1 - z), kept["from_h"] * r * (1 - r)
        on_gates, back = (np.empty((steps, streams, 3 * size), np.float32) for _ in range(2))
        d = np.zeros((streams, size), np.float32)  # what comes after the window isn't followed
        for t in range(steps - 1, -1, -1):
            g, b = on_gates[t], back[t]
            np.multiply(d, to_z[t], out=g[:, :size])
            np.multiply(d, to_cand[t], out=g[:, 2 * size :])
            np.multiply(g[:, 2 * size :], to_r[t], out=g[:, size : 2 * size])
            b[:, : 2 * size] = g[:, : 2 * size]
            np.multiply(g[:, 2 * size :], r[t], out=b[:, 2 * size :])
            d *= z[t]
            d += b @ wh
            d += on_states[t]
        grad_wh = before.reshape(-1, size).T @ back.reshape(-1, 3 * size)
        g = on_gates.reshape(-1, 3 * size)
        flat = symbols.ravel()
        per_symbol = np.zeros((len(self.p["E"]), 3 * size), np.float32)
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.diff(flat[order], prepend=-1))
        per_symbol[flat[order[first]]] = np.add.reduceat(g[order], first, 0)
        return {"Wh": grad_wh, "b": g.sum(0), "Wx": self.p["E"].T @ per_symbol, "E": per_symbol @ self.p["Wx"].T}


class Streams:
    """Documents laid side by side: each stream takes the next document when its own has ended.

    Every window is (steps, streams) of positions in the joined documents, -1 where a stream rests,
    and tells which streams begin a document, so that their state starts from zero.
    """

    def __init__(self, sizes: np.ndarray, streams: int, window: int):
        self.start, self.sizes, self.window = np.r_[0, np.cumsum(sizes)], sizes, window
        self.streams = min(streams, max(1, len(sizes)))

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        todo = np.argsort(self.sizes, kind="stable").tolist()  # the longest first
        at, end = np.zeros(self.streams, np.int64), np.zeros(self.streams, np.int64)
        steps = np.arange(self.window)[:, None]
        while True:
            new = at >= end
            for s in np.flatnonzero(new).tolist():
                while todo and at[s] >= end[s]:
                    doc = todo.pop()
                    at[s], end[s] = self.start[doc], self.start[doc + 1]
            if (at >= end).all():
                return
            where = at[None] + steps
            yield np.where(where < end[None], where, -1), new
            at = np.minimum(at + self.window, end)


def train(net: Network, docs: list[np.ndarray], shape: Shape, classes: np.ndarray, words: np.ndarray) -> Network:
    """Truncated backpropagation over windows of the documents' symbols; Adam with clipped gradients.

    The rate falls to zero over the symbols, so that a copy ends settled however few it has, and with the
    share of streams that still run.
    """
    net = Network({k: v.copy() for k, v in net.p.items()})
    m, v = ({k: np.zeros_like(x) for k, x in net.p.items()} for _ in range(2))
    flat, step, done = np.concatenate(docs), 0, 0
    lanes = Streams(np.array([len(x) for x in docs]), shape.streams, shape.window)
    h = np.zeros((lanes.streams, shape.hidden), np.float32)
    for where, new in lanes:
        h = np.where(new[:, None], np.float32(0), h)
        symbols, live = flat[where], where >= 0
        kept: dict = {}
        before, h = net.states(symbols, h, kept)
        grads: dict = {}
        net.log_probabilities(before[live], classes[symbols[live]], words[symbols[live]], grads)
        on_states = np.zeros_like(before)
        on_states[live] = grads.pop("h")
        grads |= net.backward(symbols, before, kept, on_states)
        n, step = int(live.sum()), step + 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads.values()))) / n
        rate = float(shape.rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)) * (1 - done / len(flat)) * min(1.0, n / live.size * 2)
        done += n
        for k, g in grads.items():
            g = g / n * min(1.0, 1.0 / max(norm, 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            net.p[k] -= (rate * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)
    return net


def score(net: Network, docs: list[np.ndarray], shape: Shape, classes: np.ndarray, words: np.ndarray, seen: list[np.ndarray] | None = None) -> np.ndarray:
    """Natural log probability of the symbols of each whole document; those not ``seen`` are read but don't count."""
    sizes = np.array([len(x) for x in docs])
    flat = np.concatenate(docs) if docs else np.empty(0, np.int64)
    out = np.empty(len(flat))
    lanes = Streams(sizes, shape.score_streams, shape.score_window)
    h = np.zeros((lanes.streams, shape.hidden), np.float32)
    for where, new in lanes:
        h = np.where(new[:, None], np.float32(0), h)
        live = where >= 0
        use = live.any(0)
        symbols = flat[where[:, use]]
        before, h[use] = net.states(symbols, h[use])
        on = symbols[live[:, use]]
        out[where[live]] = net.log_probabilities(before[live[:, use]], classes[on], words[on])
    if seen:
        out[~np.concatenate(seen)] = 0
    return np.add.reduceat(out, np.r_[0, np.cumsum(sizes)[:-1]]) if len(flat) else np.zeros(len(docs))


# ---------------------------------------------------------------- the vocabulary


@dataclass
class Vocabulary:
    """Head words in classes by falling count, the endings of the others with the mass of each, and totals."""

    shape: Shape
    head: dict[bytes, int]
    head_count: np.ndarray
    endings: dict[bytes, int]
    mass: np.ndarray
    tokens: int
    types: int

    @property
    def classes(self) -> np.ndarray:
        """Class of each symbol."""
        k = self.shape.head // self.shape.in_class
        return np.r_[np.arange(self.shape.head) // self.shape.in_class, k + np.arange(self.shape.endings)]

    @property
    def words(self) -> np.ndarray:
        """Place of each symbol in its class."""
        return np.r_[np.arange(self.shape.head) % self.shape.in_class, np.zeros(self.shape.endings, np.int64)]

    @property
    def total(self) -> float:
        return self.tokens + ADD * (self.types + 1)

    def symbol(self, word: bytes) -> int:
        s = self.head.get(word)
        return s if s is not None else self.shape.head + self.endings.get(word[-self.shape.ending :], self.shape.endings - 1)

    def network(self) -> Network:
        heads = np.maximum(self.head_count, 1e-3).reshape(-1, self.shape.in_class)
        return Network.new(self.shape, np.maximum(np.r_[heads.sum(1), self.mass], 1e-3), heads)

    def of(self, words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of words, their base log10 probabilities, and what the model adds to the network's log10 for each."""
        symbols = np.fromiter(map(self.symbol, words), np.int64, len(words))
        base = np.log10((counts + ADD) / self.total)
        extra = np.full(len(words), np.log10(1 - ADD / self.total))
        tail = symbols >= self.shape.head
        share = self.mass[np.maximum(symbols - self.shape.head, 0)]
        extra[tail] += np.log10((counts[tail] + ADD) / np.maximum(share[tail], counts[tail] + ADD))
        extra[counts == 0] = base[counts == 0]
        return symbols, base, extra


# ---------------------------------------------------------------- over the corpus


STAGED = T.StructType([T.StructField(n, k) for n, k in (("chunk", T.LongType()), ("kind", T.IntegerType()), ("held", T.BooleanType()), ("n", T.LongType()), ("blob", T.BinaryType()), ("counts", T.BinaryType()))])


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _staged(batches: Iterator[pa.RecordBatch], shape: Shape, keys: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Texts (key, held, text) to chunks: a row with the different words and their training counts, then a row per document."""
    task, made = TaskContext.get().partitionId(), 0
    squeeze = zstandard.ZstdCompressor(level=1).compress
    words, n, docs, counts = _Words(), 0, [], np.zeros(0, np.int64)

    def rows(of: list[tuple], key: list) -> pa.RecordBatch:
        chunk = task << 24 | made
        cols = [pa.array([chunk] * len(of), pa.int64()), *(pa.array([r[i] for r in of], k) for i, k in enumerate((pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary())))]
        return pa.RecordBatch.from_arrays([*cols, pa.array(key, keys.field(0).type)], names=[*(f.name for f in STAGED.fields), "key"])

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal words, n, docs, counts, made
        if docs:
            held = np.zeros(len(words), np.int64)
            held[: len(counts)] = counts
            yield rows([(0, None, len(words), squeeze(b"\n".join(words)), squeeze(held.tobytes()))], [None])
            for at in range(0, len(docs), 1000):
                some = docs[at : at + 1000]
                yield rows([(2, *d[1:], None) for d in some], [d[0] for d in some])
        words, n, docs, counts, made = _Words(), 0, [], np.zeros(0, np.int64), made + 1

    for b in batches:
        for key, held, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b.column(2)), strict=True):
            ids = np.concatenate([np.zeros(0, np.int32), *(np.fromiter(map(words.__getitem__, part.lower().split()), np.int32) for part in pieces(text))])
            if not held and len(ids):
                if len(words) > len(counts):
                    counts = np.r_[counts, np.zeros(len(words), np.int64)]
                np.add.at(counts, ids, 1)
            docs.append((key, held, len(ids), squeeze(ids.tobytes())))
            n += len(ids)
            if n > shape.chunk_tokens or len(words) > shape.chunk_words:
                counts = counts[: len(words)]
                yield from close()
    counts = counts[: len(words)]
    yield from close()


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word rows (chunk, blob, counts) to (chunk, id, word, n)."""
    expand = zstandard.ZstdDecompressor().decompress
    for b in batches:
        for chunk, blob, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
            n = np.frombuffer(expand(counts), np.int64)
            words = expand(blob).split(b"\n") if len(n) else []
            for at in range(0, len(n), 50_000):
                some = words[at : at + 50_000]
                cols = [pa.array(np.full(len(some), chunk)), pa.array(np.arange(at, at + len(some))), pa.array(some, pa.binary()), pa.array(n[at : at + len(some)])]
                yield pa.RecordBatch.from_arrays(cols, names=["chunk", "id", "word", "n"])


def _by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, id, c) to one packed row per chunk and batch."""
    for b in batches:
        chunk, ids, c = (x.to_numpy(zero_copy_only=False) for x in b.columns)
        order = np.argsort(chunk, kind="stable")
        chunk, ids, c = chunk[order], ids[order].astype(np.int32), c[order].astype(np.int64)
        start = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]]) if len(chunk) else np.empty(0, np.int64)
        end = np.r_[start[1:], len(chunk)]
        cols = [pa.array(chunk[start]), pa.array([ids[s:e].tobytes() for s, e in zip(start, end, strict=False)], pa.binary()), pa.array([c[s:e].tobytes() for s, e in zip(start, end, strict=False)], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["chunk", "blob", "counts"])


def vocabulary(counts: DataFrame, train_docs: int, shape: Shape) -> Vocabulary:
    """Everything about words that a task needs, of a size fixed by ``shape``."""
    sums = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.col("c") + ADD).alias("mass")).first()
    top = counts.orderBy(F.col("c").desc(), "word").limit(shape.head - 1).collect()
    heads = sorted([(train_docs, END), *((r.c, bytes(r.word)) for r in top)], key=lambda x: (-x[0], x[1]))
    head_count = np.zeros(shape.head)
    head_count[: len(heads)] = [n for n, _ in heads]
    spark = counts.sparkSession
    known = spark.createDataFrame([(bytearray(w),) for _, w in heads], "word binary")  # of a fixed size
    tail = counts.join(F.broadcast(known), "word", "left_anti").groupBy(F.substring("word", -shape.ending, shape.ending).alias("e")).agg(F.sum(F.col("c") + ADD).alias("mass"))
    best = tail.orderBy(F.col("mass").desc(), "e").limit(shape.endings - 1).collect()
    mass = np.zeros(shape.endings)
    mass[: len(best)] = [r.mass for r in best]
    mass[-1] = max(0.0, (sums["mass"] or 0.0) - sum(r.c + ADD for r in top) - mass[:-1].sum())
    return Vocabulary(
        shape, {w: i for i, (_, w) in enumerate(heads)}, head_count, {bytes(r.e): i for i, r in enumerate(best)}, mass,
        (sums["n"] or 0) + train_docs, sums["v"] + (train_docs > 0),
    )


def _parameters(rows: list[tuple[np.ndarray, float]]) -> pa.RecordBatch:
    """One row: the sum of parameters times tokens, and the tokens."""
    return pa.RecordBatch.from_arrays([pa.array([sum(x for x, _ in rows).tobytes()], pa.binary()), pa.array([float(sum(n for _, n in rows))])], names=["x", "n"])


def _learned(batches: Iterator[pa.RecordBatch], vocab: Vocabulary, net: Network, shape: Shape, turn: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows of chunks to the summed parameters of the copies that learned from them: documents of one turn."""
    expand = zstandard.ZstdDecompressor().decompress
    classes, places, end = vocab.classes, vocab.words, vocab.symbol(END)
    now, symbols, docs, made = None, np.empty(0, np.int64), [], []

    def close() -> None:
        if docs:
            own = [x for _, x in sorted(docs, key=lambda d: (len(d[1]), d[0]))]  # in any order they come
            n = sum(map(len, own))
            made.append((train(net, own, shape, classes, places).flat().astype(np.float64) * n, n))
            if len(made) > 1:
                made[:] = [(sum(x for x, _ in made), sum(k for _, k in made))]

    for b in batches:
        for chunk, kind, n, blob in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if chunk != now:
                close()
                now, docs = chunk, []
            if kind == 0:
                symbols = np.fromiter(map(vocab.symbol, expand(blob).split(b"\n") if n else []), np.int64)
            elif (mark := zlib.crc32(blob)) % shape.rounds == turn:
                docs.append((mark, np.r_[symbols[np.frombuffer(expand(blob), np.int32)], end]))
    close()
    if made:
        yield _parameters(made)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [(np.frombuffer(x, np.float64), n) for b in batches for x, n in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    if rows:
        yield _parameters(rows)


def _learn(staged: DataFrame, vocab: Vocabulary, net: Network, shape: Shape, turn: int) -> Network:
    """One round: a copy per chunk trains on the chunk's documents of this turn; the mean by tokens is the result.

    Parameters travel as one blob per task and are added up in groups of 32 until few are left.
    """
    spark = staged.sparkSession
    kind = "x binary, n double"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = staged.filter("kind = 0 or (kind = 2 and not held)").select("chunk", "kind", "n", "blob")
    dealt = rows.repartition(parts, "chunk").sortWithinPartitions("chunk", "kind")
    path = shared_path(spark, "lm-learned")
    dealt.mapInArrow(lambda it: _learned(it, vocab, net, shape, turn), kind).write.parquet(path)
    sums = spark.read.parquet(path)
    while (left := sums.count()) > 32:
        path = shared_path(spark, "lm-learned")
        sums.repartition(-(-left // 32)).mapInArrow(_added, kind).write.parquet(path)
        sums = spark.read.parquet(path)
    got = [(np.frombuffer(r.x, np.float64), r.n) for r in sums.collect()]  # at most 32 networks
    return net.filled(sum(x for x, _ in got) / sum(n for _, n in got)) if got else net


def _scored(batches: Iterator[pa.RecordBatch], vocab: Vocabulary, net: Network, shape: Shape, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted rows of chunks (words, packed counts, documents) to scores."""
    expand = zstandard.ZstdDecompressor().decompress
    classes, places = vocab.classes, vocab.words
    end_symbol, end_base = vocab.symbol(END), np.log10((vocab.head_count[vocab.symbol(END)] + ADD) / vocab.total)
    end_known = vocab.head_count[end_symbol] > 0
    now, words, counts, docs = None, [], np.zeros(0, np.int64), []

    def close() -> pa.RecordBatch:
        symbols, base, extra = vocab.of(words, counts)
        known = counts > 0
        ids = [np.frombuffer(expand(d[3]), np.int32) for d in docs]
        seen = [np.r_[known[x], end_known] for x in ids]
        logs = score(net, [np.r_[symbols[x], end_symbol] for x in ids], shape, classes, places, seen) / np.log(10) + (np.log10(1 - ADD / vocab.total) if end_known else end_base)
        out = [
            pa.array([d[0] for d in docs], schema.field(0).type), pa.array([d[1] for d in docs], pa.bool_()), pa.array([len(x) + 1 for x in ids], pa.int64()),
            pa.array([int(known[x].sum()) + int(end_known) for x in ids], pa.int64()), pa.array([int(vocab.tokens)] * len(docs), pa.int64()),
            pa.array([float(base[x].sum() + end_base) for x in ids], pa.float64()), pa.array([float(s + extra[x].sum()) for s, x in zip(logs, ids, strict=True)], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(out, schema=schema)

    for b in batches:
        for chunk, kind, held, n, blob, packed, key in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if chunk != now:
                if docs:
                    yield close()
                now, words, counts, docs = chunk, [], np.zeros(0, np.int64), []
            if kind == 0:
                words, counts = expand(blob).split(b"\n") if n else [], np.zeros(n, np.int64)
            elif kind == 1:
                counts[np.frombuffer(blob, np.int32)] = np.frombuffer(packed, np.int64)
            else:
                docs.append((key, held, n, blob))
    if docs:
        yield close()


def score_documents(docs: DataFrame, held: Column, key: str = "doc_id", text: str = "text", shape: Shape = Shape()) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score``: a row per row of ``docs``.

    Words are runs of anything but ASCII white space, A-Z lower-cased; an end follows, counted as a
    token. Rows with ``held`` true are scored and not learned from. A null text is empty and has only
    the end; null keys and repeated rows give a row each; an empty table gives an empty one. Nothing
    to learn from leaves the uniform start. Other columns are not read. ``score`` is the log10
    probability of the whole text, word by word, with the state carried through all its windows.

    Texts become numbers once, in chunks with a word list of their own. Counts travel by word, then
    back to the chunks that hold the word; so no task needs the whole vocabulary.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(held, F.lit(False)).alias("held"), F.col(text).alias("text"))
    keys = pa.schema([("key", to_arrow_type(docs.schema[key].dataType))])
    path = shared_path(spark, "lm-chunks")
    rows.mapInArrow(lambda it: _staged(it, shape, keys), T.StructType([*STAGED.fields, T.StructField("key", docs.schema[key].dataType)])).write.parquet(path)
    staged = spark.read.parquet(path)
    pairs = staged.filter("kind = 0").select("chunk", "blob", "counts").mapInArrow(_unpacked, "chunk long, id long, word binary, n long")
    path = shared_path(spark, "lm-counts")
    pairs.groupBy("word").agg(F.sum("n").alias("c")).filter("c > 0").write.parquet(path)
    counts = spark.read.parquet(path)
    of_docs = staged.filter("kind = 2 and not held").agg(F.count(F.lit(1)).alias("docs")).first()
    vocab = vocabulary(counts, of_docs["docs"], shape)
    net = vocab.network()
    for turn in range(shape.rounds):
        net = _learn(staged, vocab, net, shape, turn)
    found = pairs.join(counts, "word").select("chunk", "id", "c").mapInArrow(_by_chunk, "chunk long, blob binary, counts binary")
    none = F.lit(None)
    found = found.select("chunk", F.lit(1).alias("kind"), none.cast("boolean").alias("held"), none.cast("long").alias("n"), "blob", "counts", none.cast(docs.schema[key].dataType).alias("key"))
    dealt = staged.unionByName(found).repartition(n, "chunk").sortWithinPartitions("chunk", "kind")
    schema = pa.schema([(key, keys.field(0).type), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    ddl = f"`{key}` {docs.schema[key].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.mapInArrow(lambda it: _scored(it, vocab, net, shape, schema), ddl)

"""Language identification: unigram pieces per language, summed over all segmentations of a text.

Pieces are those of a fixed public byte-level vocabulary. A word (with a space before it) has the
probability of all ways to cut it into pieces; words are independent, as no piece reaches over a
space, so a text's log probability is the sum over its words. Piece probabilities are estimated by
expectation maximisation on word counts of labelled rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from .text import pieces, texts

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: ASCII bytes other than letters only part words.
_WORDS = bytes(b if b >= 0x80 or 97 <= b <= 122 else 32 for b in range(256))
#: Labels up to which their sampling shares are broadcast.
FEW = 10_000
#: Words up to this many bytes can't underflow; longer ones are rescaled on the way or summed as logarithms.
SHORT = 24


@dataclass(frozen=True)
class Fit:
    """``per_language``: labelled rows a language is learned from, in expectation, chosen by a hash of the key.

    ``longest``: bytes of the longest piece used, if there is a limit. ``shared``: weight of the mean of all languages
    in each one's probabilities, ``floor`` that of the bytes, so that no word has probability 0.
    """

    per_language: int = 3000
    rounds: int = 4
    longest: int | None = None
    shared: float = 0.02
    floor: float = 1e-4
    prune: float = 1e-7


def vocabulary(path: str | None = None, longest: int | None = None) -> list[bytes]:
    """Pieces that can occur in normalised words: the single bytes and those of lower-case letters and other scripts."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
        found = {base64.b64decode(line.split()[0]) for line in f if line.strip()}
    ok = set(range(97, 123)) | set(range(0x80, 0x100))
    single = {bytes([b]) for b in ok | {32}}
    return sorted(single | {p for p in found if 1 < len(p) <= (longest or len(p)) and set(p[1:]) <= ok and p[0] in ok | {32}})


class Pieces:
    """A trie over pieces and, at the node of each piece, its probability per language."""

    def __init__(self, vocab: list[bytes], probability: np.ndarray, langs: list[str]):
        self.langs, self.vocab, self.reach = langs, vocab, max(map(len, vocab))
        self.symbol = np.zeros(256, np.uint8)
        used = sorted(set(b"".join(vocab)))
        self.symbol[used] = np.arange(1, len(used) + 1)
        nodes: dict[bytes, int] = {b"": 1}
        for p in vocab:
            for k in range(1, len(p) + 1):
                nodes.setdefault(p[:k], len(nodes) + 1)
        self.next = np.zeros((len(nodes) + 1, len(used) + 1), np.int32)
        for p, node in nodes.items():
            if p:
                self.next[nodes[p[:-1]], self.symbol[p[-1]]] = node
        self.node = np.array([nodes[p] for p in vocab], np.int64)
        self.p = np.zeros((len(nodes) + 1, probability.shape[1]))
        self.p[self.node] = probability

    def _grid(self, words: list[bytes], at: np.ndarray, length: int) -> np.ndarray:
        return self.symbol[np.frombuffer(b"".join(words[i] for i in at), np.uint8).reshape(len(at), length)]

    def _walk(self, grid: np.ndarray, start: int) -> Iterator[tuple[int, np.ndarray]]:
        """Node of each word's piece from ``start`` to each end, as long as any word has one."""
        node = np.ones(len(grid), np.int32)
        for end in range(start, grid.shape[1]):
            node = self.next[node, grid[:, end]]
            if not node.any():
                return
            yield end + 1, node

    def log_probability(self, words: list[bytes]) -> np.ndarray:
        """(words, languages): natural log of the probability over all segmentations."""
        out = np.empty((len(words), self.p.shape[1]))
        size = np.fromiter(map(len, words), np.int64, len(words))
        for length in np.unique(size):
            for at in np.array_split(np.flatnonzero(size == length), 1 + int((size == length).sum() * length) // 500_000):
                grid, n = self._grid(words, at, length), len(at)
                ways = [np.zeros((n, self.p.shape[1])) for _ in range(length + 1)]
                ways[0] += 1
                scale = np.zeros((n, self.p.shape[1]))
                for start in range(length):
                    if length > SHORT and start:
                        most = np.maximum.reduce(ways[start : start + self.reach])
                        most[most <= 0] = 1
                        for w in ways[start : start + self.reach]:
                            w /= most
                        scale += np.log(most)
                    for end, node in self._walk(grid, start):
                        ways[end] += ways[start] * self.p[node]
                    ways[start] = None
                with np.errstate(divide="ignore"):
                    out[at] = np.log(ways[length]) + scale
        return out

    def expected(self, words: list[bytes], counts: np.ndarray, lang: int) -> np.ndarray:
        """Expected uses of each piece of the vocabulary in the words, under one language."""
        total, p = np.zeros(len(self.p)), self.p[:, lang]
        size = np.fromiter(map(len, words), np.int64, len(words))
        for length in np.unique(size[size > SHORT]):
            for at in np.array_split(np.flatnonzero(size == length), 1 + int((size == length).sum() * length) // 500_000):
                self._expected_long(self._grid(words, at, length), counts[at], p, total)
        for length in np.unique(size[size <= SHORT]):
            for at in np.array_split(np.flatnonzero(size == length), 1 + int((size == length).sum() * length) // 500_000):
                grid = self._grid(words, at, length)
                steps = [(s, e, node.copy()) for s in range(length) for e, node in self._walk(grid, s)]
                left, right = np.zeros((length + 1, len(at))), np.zeros((length + 1, len(at)))
                left[0], right[length] = 1, 1
                for s, e, node in steps:
                    left[e] += left[s] * p[node]
                for s, e, node in reversed(steps):
                    right[s] += right[e] * p[node]
                weight = counts[at] / left[length]
                for s, e, node in steps:
                    total += np.bincount(node, left[s] * p[node] * right[e] * weight, len(total))
        return total[self.node]

    def _expected_long(self, grid: np.ndarray, counts: np.ndarray, p: np.ndarray, total: np.ndarray) -> None:
        """Adds the expected uses to ``total``, by node; sums are logarithms and pieces are looked up twice, so that long words need little memory."""
        n, length = grid.shape
        with np.errstate(divide="ignore"):
            log_p = np.log(p)
        left, right = np.full((length + 1, n), -np.inf), np.full((length + 1, n), -np.inf)
        left[0], right[length] = 0, 0
        for s in range(length):
            for e, node in self._walk(grid, s):
                np.logaddexp(left[e], left[s] + log_p[node], out=left[e])
        for s in reversed(range(length)):
            for e, node in self._walk(grid, s):
                rest = log_p[node] + right[e]
                np.logaddexp(right[s], rest, out=right[s])
                np.add.at(total, node, counts * np.exp(left[s] + rest - left[length]))


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Lower-case words of a text, piece by piece, each with a space before it."""
    for part in pieces(text):
        yield [b" " + w for w in part.decode().lower().encode().translate(_WORDS).split()]


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode())


def train(rows: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", fit: Fit = Fit(), path: str | None = None) -> Pieces | None:
    """Piece probabilities of each value of ``label``; rows without one are left out. None if there are no rows.

    Only expected counts per piece and language come to the driver: at most the vocabulary times the languages.
    """
    rows = rows.filter(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(label).alias("l"), F.col(text).alias("t"))
    share = cut(rows.groupBy("l").agg((F.lit(float(fit.per_language)) / F.count(F.lit(1))).alias("share")))
    share = F.broadcast(share) if share.count() <= FEW else share  # else texts would move by language, most of them to one task
    chosen = rows.join(share, "l").filter(F.pmod(F.xxhash64("k"), F.lit(1 << 20)) < F.col("share") * (1 << 20)).select("l", "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n: dict[tuple, int] = {}
            for lang, t in zip(b.column(0).to_pylist(), texts(b.column(1)), strict=True):
                for words in words_of(t):
                    for w in words:
                        n[lang, w] = n.get((lang, w), 0) + 1
            cols = [pa.array([k[0] for k in n], pa.string()), pa.array([k[1] for k in n], pa.binary()), pa.array(list(n.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["l", "w", "n"])

    counts = cut(chosen.mapInArrow(count, "l string, w binary, n long").groupBy("l", "w").agg(F.sum("n").alias("n")))
    counts = counts.coalesce(rows.sparkSession.sparkContext.defaultParallelism)  # a bounded sample: each task loads the model once
    langs = [r.l for r in counts.select("l").distinct().orderBy("l").collect()]
    if not langs:
        return None
    vocab = vocabulary(path, fit.longest)
    at = {v: i for i, v in enumerate(langs)}
    p = np.full((len(vocab), len(langs)), 1 / len(vocab))
    for _ in range(fit.rounds):
        model = Pieces(vocab, p, langs)

        def expect(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(model.vocab), len(model.langs)))
            for b in batches:
                lang = np.array([at[x] for x in b.column(0).to_pylist()], np.int64)
                words, n = b.column(1).to_pylist(), b.column(2).to_numpy()
                for i in np.unique(lang):
                    rows = np.flatnonzero(lang == i)
                    total[:, i] += model.expected([words[r] for r in rows], n[rows], i)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], names=["piece", "lang", "n"])

        sums = counts.mapInArrow(expect, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).collect()
        p = np.zeros_like(p)
        for r in sums:
            p[r.piece, r.lang] = r.n
        single = np.array([len(v) == 1 for v in vocab])
        p /= np.maximum(p.sum(0), 1e-300)
        p = (1 - fit.shared - fit.floor) * p + fit.shared * p.mean(1, keepdims=True) + fit.floor * (single / single.sum())[:, None]
        stay = single | (p.max(1) > fit.prune)
        vocab, p = [v for v, s in zip(vocab, stay, strict=True) if s], p[stay]
    return Pieces(vocab, p, langs)


class _Ids(dict):
    """Numbers words as they come; ``fresh`` are those without a score so far."""

    def __init__(self):
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.fresh.append(word)
        self[word] = n = len(self)
        return n


class Scorer:
    """Sums word scores over texts; scores of up to ``most`` different words are kept for reuse."""

    def __init__(self, model: Pieces, most: int = 200_000):
        self.model, self.most = model, most
        self.ids, self.scores, self.n = _Ids(), np.empty((1024, len(model.langs))), 0

    def _sum(self, words: list[bytes]) -> np.ndarray:
        ids = list(map(self.ids.__getitem__, words))
        fresh = self.ids.fresh
        if fresh:
            need = self.n + len(fresh)
            if need > len(self.scores):
                self.scores = np.concatenate([self.scores, np.empty((max(need, len(self.scores)), self.scores.shape[1]))])
            self.scores[self.n : need] = self.model.log_probability(fresh)
            self.n, self.ids.fresh = need, []
        total = self.scores[ids]
        if self.n > self.most:
            self.ids, self.n = _Ids(), 0
        return total

    def __call__(self, batch: list[list[bytes]]) -> np.ndarray:
        """Log probability of each list of words, per language."""
        flat = self._sum([w for words in batch for w in words])
        at = np.r_[0, np.cumsum([len(w) for w in batch])]
        sums = np.zeros((len(batch), flat.shape[1]))
        full = np.flatnonzero(np.diff(at))
        if len(full):
            sums[full] = np.add.reduceat(flat, at[full], 0)
        return sums


def verdict(model: Pieces, logs: np.ndarray) -> tuple[str, float]:
    """Likeliest language, the first by name of equal ones, and its share of the probability."""
    best = int(logs.argmax())
    return model.langs[best], float(1 / np.exp(logs - logs[best]).sum())


def predict(docs: DataFrame, model: Pieces | None, keep: Sequence[str] = ("doc_id",), text: str = "text", together: int = 100_000) -> DataFrame:
    """Columns ``keep`` with ``lang_pred, score``: language of each whole text and its posterior probability, all languages alike before.

    A null text, one without a letter, and any text when there is no model is ``und`` with score 0.
    Repeated rows and null keys give a row each; an empty table gives an empty one. Columns outside
    ``keep`` and ``text`` are not read.
    """
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    columns = [docs[c] for c in keep] + [docs[text].alias("_text")] * (text not in keep)
    place = list(keep).index(text) if text in keep else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for b in batches:
            n = b.num_rows
            logs, known = np.zeros((n, len(model.langs) if model else 1)), np.zeros(n, bool)
            wait: list[tuple[int, list[bytes]]] = []
            held = 0

            def flush() -> None:
                if wait:
                    np.add.at(logs, [i for i, _ in wait], scorer([w for _, w in wait]))
                    wait.clear()

            for i, t in enumerate(texts(b.column(place)) if model else ()):
                for words in words_of(t):
                    if words:
                        known[i] = True
                        wait.append((i, words))
                        held += len(words)
                        if held > together:
                            flush()
                            held = 0
                if known[i] and not any(97 <= (c | 32) <= 122 for c in t[:256]) and not has_letter(t):
                    known[i] = False
            flush()
            found = [verdict(model, x) if k else ("und", 0.0) for x, k in zip(logs, known, strict=True)]
            more = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *more], names=schema.names)

    return docs.select(*columns).mapInArrow(run, schema)


def sure(docs: DataFrame, model: Pieces | None, text: str = "text", lang: str = "lang", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is found with a score of ``least`` or more, with it in ``lang``.

    The other columns stay as they are.
    """
    names = docs.columns
    held = docs.toDF(*[f"c{i}" for i in range(len(names))])
    found = predict(held, model, held.columns, f"c{names.index(text)}").filter((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return found.select(*[F.col("lang_pred" if c == lang else f"c{i}").alias(c) for i, c in enumerate(names)])

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from spanforge.llm import lm, queries
from spanforge.llm.text import fold

SMALL = lm.Shape(head=8, in_class=4, endings=3, hidden=5, inner=4, streams=3, window=4, score_streams=4, score_window=3)


def network(shape=SMALL, seed=0):
    r = np.random.default_rng(seed)
    net = lm.Network.new(shape, r.uniform(1, 9, shape.head // shape.in_class + shape.endings), r.uniform(1, 9, (shape.head // shape.in_class, shape.in_class)))
    return lm.Network({k: v.astype(np.float64) + r.normal(0, 0.3, v.shape) for k, v in net.p.items()})


def places(shape=SMALL):
    v = lm.Vocabulary(shape, {}, np.zeros(shape.head), {}, np.ones(shape.endings), 1, 1)
    return v.classes, v.words


def test_gradients():
    net, (classes, words) = network(), places()
    r = np.random.default_rng(1)
    symbols, h0 = r.integers(0, SMALL.head + SMALL.endings, (6, 3)), r.normal(size=(3, SMALL.hidden))

    def loss(n):
        before, _ = n.states(symbols, h0)
        return -n.log_probabilities(before.reshape(-1, SMALL.hidden).astype(np.float64), classes[symbols].ravel(), words[symbols].ravel()).sum()

    kept, grads = {}, {}
    before, _ = net.states(symbols, h0, kept)
    net.log_probabilities(before.reshape(-1, SMALL.hidden), classes[symbols].ravel(), words[symbols].ravel(), grads)
    on = grads.pop("h").reshape(before.shape)
    grads |= net.backward(symbols, before, kept, on)
    for name, g in grads.items():
        for _ in range(6):
            at = tuple(r.integers(0, s) for s in g.shape)
            values = []
            for step in (1e-2, -1e-2):
                p = {k: v.copy() for k, v in net.p.items()}
                p[name][at] += step
                values.append(loss(lm.Network(p)))
            assert math.isclose((values[0] - values[1]) / 2e-2, float(g[at]), rel_tol=0.03, abs_tol=0.02), (name, at)


def test_streams_visit_each_token_once():
    for sizes in ([1], [5, 1, 9, 3, 3, 20], [3] * 10):
        lanes, seen, doc = lm.Streams(np.array(sizes), 3, 4), [], {}
        for where, new in lanes:
            for s in range(where.shape[1]):
                if new[s]:
                    doc[s] = []
                doc.setdefault(s, []).extend(x for x in where[:, s] if x >= 0)
            seen += where[where >= 0].tolist()
        assert sorted(seen) == list(range(sum(sizes)))


def test_state_is_carried_through_whole_documents():
    net, (classes, words) = network(), places()
    r = np.random.default_rng(2)
    docs = [r.integers(0, SMALL.head + SMALL.endings, n) for n in (1, 40, 7, 3, 3, 11, 2)]
    want = []
    for d in docs:
        before, _ = net.states(d[:, None], np.zeros((1, SMALL.hidden)))
        want.append(net.log_probabilities(before[:, 0], classes[d], words[d]).sum())
    assert np.allclose(lm.score(net, docs, SMALL, classes, words), want, rtol=1e-4)
    seen = [np.arange(len(d)) % 2 == 0 for d in docs]
    assert (lm.score(net, docs, SMALL, classes, words, seen) > want).any()


def test_probabilities_sum_to_one():
    net, (classes, words) = network(), places()
    counts = {w: c for w, c in zip([b"aa", b"ab", b"xyz", b"kxyz", b"q", b"mno"], [9, 7, 3, 2, 1, 4])}
    heads = sorted([(5, lm.END), (9, b"aa"), (7, b"ab")], key=lambda x: (-x[0], x[1]))
    tail = {w: c for w, c in counts.items() if w not in (b"aa", b"ab")}
    mass = np.array([sum(c + lm.ADD for w, c in tail.items() if w[-3:] == b"xyz"), tail[b"mno"] + lm.ADD, tail[b"q"] + lm.ADD])
    v = lm.Vocabulary(SMALL, {w: i for i, (_, w) in enumerate(heads)}, np.array([n for n, _ in heads] + [0] * 5), {b"xyz": 0, b"mno": 1}, mass, sum(counts.values()) + 5, 7)
    h = np.random.default_rng(3).normal(size=(1, SMALL.hidden))
    all_words = [*counts, b"never"]
    symbols, base, extra = v.of(all_words, np.array([*counts.values(), 0]))
    model = [10 ** (extra[i] + net.log_probabilities(h, classes[[s]], words[[s]])[0] / math.log(10)) for i, s in enumerate(symbols[:-1])]
    end = v.symbol(lm.END)
    model.append(10 ** (math.log10(1 - lm.ADD / v.total) + net.log_probabilities(h, classes[[end]], words[[end]])[0] / math.log(10)))
    spare = sum(math.exp(net.log_probabilities(h, classes[[s]], words[[s]])[0]) for s in range(3, SMALL.head))  # head places without a word
    spare *= 1 - lm.ADD / v.total
    assert math.isclose(sum(model) + spare + 10 ** extra[-1], 1, abs_tol=1e-5) and extra[-1] == base[-1]
    assert math.isclose(sum(10**base) + 10 ** math.log10((5 + lm.ADD) / v.total), 1)


def plain_base(rows):
    docs = [(i, [*(t or "").encode().lower().split(), lm.END]) for i, t in rows]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for i, _ in docs]
    counts = Counter(w for (_, ws), h in zip(docs, held) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [(i, h, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for (i, ws), h in zip(docs, held)]


@pytest.mark.parametrize("chunk", [60, 4_000_000])
def test_counts_and_base(spark, chunk):
    r = np.random.default_rng(5)
    texts = [" ".join(r.choice(["The", "the", "of", "É", "é", "word", "longer\x0bx", *map(str, range(30))], r.integers(0, 60))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, None), (101, ""), (7, "the twice"), (7, "the twice"), (None, "the null key"), (102, "rare " * 3000)]
    df = spark.createDataFrame([(i, t, False, 5) for i, t in rows], "doc_id long, text string, held boolean, n long").repartition(3)
    got = lm.score_documents(df, fold("doc_id", 10) == 0, shape=lm.Shape(head=8, in_class=4, endings=3, hidden=4, inner=4, chunk_tokens=chunk)).collect()
    key = lambda x: (str(x[0]), x[2:])
    assert sorted(((*x[:5], round(x[5], 6)) for x in got), key=key) == sorted(plain_base(rows), key=key)
    assert all(math.isfinite(x.score) and x.score < 0 for x in got)


def test_empty_and_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    assert lm.score_documents(df.limit(0), fold("doc_id", 10) == 0).count() == 0
    got = lm.score_documents(df, F.lit(True)).collect()
    assert [(x.n_known, x.train_tokens) for x in got] == [(0, 0)] * 2 and all(x.held_out for x in got)


def test_model_beats_the_base_on_held_out_texts(spark):
    got = queries.op4_lm_score(spark, "/root/testdata/sf0.01").filter("held_out").agg(F.sum("n_tokens").alias("n"), F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got.s > got.b + 0.1 * got.n


def test_each_document_is_trained_on_in_one_round(monkeypatch):
    squeeze = zstandard.ZstdCompressor().compress
    words = [b"a", b"b", b"c"]
    texts = [[i % 3, (i // 3) % 3, (i // 9) % 3, 0, 1][: 1 + i % 5] for i in range(200)] + [[], [0], [0]]
    learned = []
    monkeypatch.setattr(lm, "train", lambda net, docs, *_: learned.append([tuple(x) for x in docs]) or net)
    shape = lm.Shape(head=8, in_class=4, endings=3, hidden=4, inner=4)
    vocab = lm.Vocabulary(shape, {lm.END: 0, **{w: i + 1 for i, w in enumerate(words)}}, np.ones(8), {}, np.ones(3), 100, 4)
    for turn in range(shape.rounds):
        rows = [(7, 0, 3, squeeze(b"\n".join(words)))] + [(7, 2, len(x), squeeze(np.array(x, np.int32).tobytes())) for x in texts]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], k) for i, k in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.binary()))], names=["chunk", "kind", "n", "blob"]) for part in (rows[:50], rows[50:])]
        out = list(lm._learned(iter(batches), vocab, vocab.network(), shape, turn))
        assert len(out) == 1 and out[0].column(1)[0].as_py() == sum(map(len, learned[-1]))
    both = sorted(learned[0] + learned[1])
    assert both == sorted(tuple(w + 1 for w in x) + (0,) for x in texts) and all(learned)


def test_parameters_are_added_up_in_groups():
    rows = [(np.arange(4.0) * i, i) for i in range(1, 6)]
    one = lm._parameters(rows[:3]), lm._parameters(rows[3:])
    (out,) = lm._added(iter(one))
    assert np.frombuffer(out.column(0)[0].as_py()).tolist() == sum(x for x, _ in rows).tolist() and out.column(1)[0].as_py() == 15

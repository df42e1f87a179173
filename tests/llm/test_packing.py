import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from spanforge.llm import packing, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


TEXTS = ["", " ", "a", " a", "a ", "a  b", "a \n b", "a\n b\n\nc", "it's I'll x'", "\x1c a\x1f b", "ünï 12 3,4 |x", "<|endoftext|> b <|endoftext|>", "tab\t x \t", "a\xa0 b", "  x　", "x" * 3000, "a\r\n b", "  lead", "😀 é 的"]


def test_ids_are_the_tokenizers(tokenizer):
    r = np.random.default_rng(1)
    mixed = ["".join(r.choice(list(" \n\tab'1.,é\x1c\xa0"), 40)) for _ in range(400)]
    for most in (3, 400_000):
        e = packing.Encoder(most=most)
        for t in TEXTS + mixed:
            assert np.frombuffer(e.ids(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_spans():
    for n in (1, 7, 8, 9, 16, 17, 40):
        got = packing.spans(n, 8)
        assert sum(x for _, x in got) == n and all(x == 8 for _, x in got[1:]) and [s for s, _ in got] == list(np.cumsum([0, *(x for _, x in got)])[:-1])


def valid(sizes, bins, capacity):
    return (np.bincount(bins, sizes) <= capacity).all() and (np.bincount(bins) > 0).all()


@pytest.mark.parametrize("top", [30, 60, 100])
def test_evolution_is_valid_and_no_worse(top):
    r, how = np.random.default_rng(3), packing.Evolution()
    for _ in range(5):
        sizes = r.integers(1, top, 300)
        start = packing.best_fit(sizes, np.argsort(-sizes), 100)
        got = packing.evolve(sizes, 100, r, how)
        assert valid(sizes, start, 100) and valid(sizes, got, 100) and got.max() <= start.max()
        assert got.max() + 1 >= -(-sizes.sum() // 100)
    a, b = (packing.best_fit(sizes, r.permutation(300), 100) for _ in range(2))
    assert valid(sizes, packing.crossover(sizes, a, b, 100, r, how), 100)


def test_evolution_beats_best_fit():
    r = np.random.default_rng(0)
    better = 0
    for _ in range(10):
        parts = np.concatenate([r.multinomial(97, [1 / 3] * 3) + 1 for _ in range(40)])  # forty bins fit exactly
        better += packing.evolve(parts, 100, r, packing.Evolution(children=60)).max() < packing.best_fit(parts, np.argsort(-parts), 100).max()
    assert better >= 1


def test_pack_rows(spark, tokenizer):
    texts = TEXTS + [None, "word " * 5000, "same text", "same text"]
    rows = [(i if i != 3 else None, t, "x", 1) for i, t in enumerate(texts)] + [(1, "twice", "x", 1), (1, "twice", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, uid string, piece int")
    got = packing.pack(packing.tokens(df, capacity=64), 64, packing.Evolution(group=10)).collect()
    by_doc, by_seq = {}, {}
    for g in got:
        assert zlib.crc32(np.array(g.ids, "<u4").tobytes()) == g.ids_crc32 and len(g.ids) == g.length <= 64
        by_doc.setdefault(g.doc_id, []).append(g)
        by_seq.setdefault(g.sequence_id, []).append(g)
    for s in by_seq.values():
        s.sort(key=lambda g: g.offset)
        assert [g.offset for g in s] == np.cumsum([0, *(g.length for g in s)])[:-1].tolist() and sum(g.length for g in s) <= 64
    for i, t, *_ in rows[:-2]:
        if i != 1:
            ids = sum((list(g.ids) for g in sorted(by_doc[i], key=lambda g: g.piece)), [])
            assert ids == tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
    assert sum(g.length for g in by_doc[1]) == 1 + 1 + 2 * (len(tokenizer.encode("twice").ids) + 1)
    assert packing.pack(packing.tokens(df.limit(0))).count() == 0


def test_query(spark, tokenizer):
    got = queries.op6_pack(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").toPandas()
    n = {i: len(e.ids) + 1 for i, e in zip(docs.doc_id, tokenizer.encode_batch(list(docs.text), add_special_tokens=False), strict=True)}
    assert got.groupby("doc_id").length.sum().to_dict() == n
    fill = got.groupby("sequence_id").length.sum()
    assert fill.max() <= 2048 and len(fill) <= 1.01 * -(-sum(n.values()) // 2048) + 1


SPECIALS = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y ", "a  <|endoftext|>  b\n<|endoftext|>", "<|endoftext|", "é <|ENDOFTEXT|> b"]


def test_special_token_has_its_id_in_query_and_pipeline(spark, tmp_path):
    import corpus_pipeline

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    e = packing.Encoder(special=True)
    for x in TEXTS + SPECIALS:
        assert np.frombuffer(e.ids(x), "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)
    docs = spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in enumerate(SPECIALS)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = {i: zlib.crc32(np.array([*t.encode(x, add_special_tokens=False).ids, 0], "<u4").tobytes()) for i, x in enumerate(SPECIALS)}
    for got in (queries.op6_pack(spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, str(tmp_path))):
        assert {r.doc_id: r.ids_crc32 for r in got.collect()} == want

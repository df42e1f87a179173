import functools
import zlib

import corpus_pipeline
import numpy as np
import pytest
import public_tokenizers
from plain_links import roots
from tokenizers import Tokenizer

from spanforge.llm import langid, lines, mixing, packing, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, with extra columns and awkward rows in the input."""
    top = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**6, "", "en", "src0", 0), (10**6 + 1, "12 34 .", None, None, 7), (10**6 + 2, "the of and in to is that was. " * 3 + "word " * 30000, "en", "src1", 5)], docs.schema)
    out = [docs.unionByName(odd).selectExpr("*", "doc_id AS uid", "'x' AS kept")]
    for name, function in corpus_pipeline.STAGES:
        function(spark, out[-1], SF).write.parquet(f"{top}/{name}")
        out.append(spark.read.parquet(f"{top}/{name}"))
    return out


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "simhash_dedup", "mix_sources", "pack"]
    assert all(d.columns == stages[0].columns for d in stages[1:-1])


def test_language(stages):
    model = langid.train(stages[0])
    want = {}
    for r in stages[0].collect():
        words = [w for part in langid.words_of((r.text or "").encode()) for w in part]
        if words:
            lang, score = langid.verdict(model, model.log_probability(words).sum(0))
            if score >= 0.5:
                want[r.doc_id] = (lang, r.text, r.source, r.n_chars)
    assert {r.doc_id: (r.lang, r.text, r.source, r.n_chars) for r in stages[1].collect()} == want and len(want) >= 195


def test_quality(stages):
    want = {}
    for r in stages[1].collect():
        found, text = lines.clean(r.text.encode(), lines.Rules())
        if found[6]:
            want[r.doc_id] = (text.decode(), len(text.decode()), r.lang)
    assert {r.doc_id: (r.text, r.n_chars, r.lang) for r in stages[2].collect()} == want and 100 < len(want) < 200


def test_dedup(stages):
    rows = stages[2].collect()
    fp = {r.doc_id: simhash.fingerprint(r.text.encode()) for r in rows}
    root = roots(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4])
    got = {r.doc_id: r.text for r in stages[3].collect()}
    assert got == {r.doc_id: r.text for r in rows if root[r.doc_id] == r.doc_id} and len(got) < len(rows)


def test_mix(stages):
    plan = {r.source: r for r in mixing.weights(stages[3].select("source", mixing.tokens(stages[3].text).alias("tokens"))).collect()}
    before, after = {r.doc_id: r for r in stages[3].collect()}, {}
    for r in stages[4].collect():
        assert r == before[r.doc_id]
        after[r.doc_id] = after.get(r.doc_id, 0) + 1
    assert set(after) == set(before)
    for i, n in after.items():
        p = plan[before[i].source]
        assert n in ((p.full, p.full + 1) if p.rest else (p.full,))


def test_pack(stages):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    draws, want = {}, []
    for r in stages[4].collect():
        ids = np.array([*t.encode(r.text, add_special_tokens=False).ids, 0], "<u4")
        draws[r.doc_id] = draws.get(r.doc_id, 0) + 1
        want += [(r.doc_id, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(packing.spans(len(ids), 2048))]
    got = stages[5].toPandas()
    assert sorted(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(want)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.values == np.r_[0, np.cumsum(g.length.values)[:-1]]).all() and g.length.sum() <= 2048


def test_run(spark):
    docs = functools.reduce(lambda d, s: s[1](spark, d, SF), corpus_pipeline.STAGES[:-1], spark.read.parquet(f"{SF}/documents.parquet"))
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

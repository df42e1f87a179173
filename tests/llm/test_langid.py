import itertools

import numpy as np
import pytest

from spanforge.llm import langid, queries

SF = "/root/testdata/sf0.01"


def all_ways(word, p):
    """Probability by listing every segmentation."""
    total = 0.0
    for cuts in itertools.product((False, True), repeat=len(word) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        total += np.prod([p.get(word[a:b], 0.0) for a, b in itertools.pairwise(at)])
    return total


def small_model():
    r = np.random.default_rng(1)
    vocab = sorted({bytes([b]) for b in b" abc"} | {b"ab", b"abc", b" a", b"bc", b"cab", b" ca"})
    p = r.dirichlet(np.ones(len(vocab)), 2).T
    return langid.Pieces(vocab, p, ["x", "y"]), [dict(zip(vocab, p[:, i], strict=True)) for i in (0, 1)]


def test_forward_sums_all_segmentations():
    model, p = small_model()
    words = [b" " + bytes(w) for n in (1, 3, 6) for w in itertools.product(b"abc", repeat=n)]
    got = model.log_probability(words)
    for i in (0, 1):
        assert np.allclose(got[:, i], [np.log(all_ways(w, p[i])) for w in words])


def test_long_words_do_not_underflow():
    model, p = small_model()
    for w in (b" " + b"cab" * 8, b" " + b"abc" * 70, b" " + b"abc" * 700):  # over the limit
        assert np.allclose(model.log_probability([w])[0], [float(np.log(forward(w, p[i]))) for i in (0, 1)])


def forward(word, p):
    ways = [np.longdouble(1)] + [np.longdouble(0)] * len(word)
    for e in range(1, len(word) + 1):
        ways[e] = sum(ways[s] * p.get(word[s:e], 0.0) for s in range(max(0, e - 4), e))
    return ways[-1]


def test_expected_counts():
    model, p = small_model()
    words, counts = [b" abc", b" cab"], np.array([3, 2])
    got = model.expected(words, counts, 0)
    want = np.zeros(len(model.vocab))
    for w, n in zip(words, counts, strict=True):
        for cuts in itertools.product((False, True), repeat=len(w) - 1):
            at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(w)]
            parts = [w[a:b] for a, b in itertools.pairwise(at)]
            q = np.prod([p[0].get(x, 0.0) for x in parts]) / all_ways(w, p[0])
            for x in parts:
                if x in model.vocab:
                    want[model.vocab.index(x)] += n * q
    assert np.allclose(got, want)


def test_vocabulary_is_a_parameter(tmp_path):
    f = tmp_path / "v.tiktoken"
    f.write_text("YQ== 0\nYWI= 1\nQUI= 2\n")
    v = langid.vocabulary(str(f))
    assert b"ab" in v and b"AB" not in v and b" " in v


@pytest.fixture(scope="module")
def model(spark):
    return langid.train(spark.read.parquet(f"{SF}/documents.parquet"), fit=langid.Fit(per_language=40))


def test_edge_cases(spark, model):
    rows = [(1, None, 5), (2, "", 5), (3, "12 !? …", 5), (4, "THE and of with. " * 20000, 5), (None, "der und die nicht ist einen", 5), (4, "x", 5), (6, "的 " * 3, 5), (7, "w" * 3000, 5)]
    got = langid.predict(spark.createDataFrame(rows, "doc_id long, text string, score int"), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    of = {r.doc_id: r.lang_pred for r in got[:4] + got[4:5]}
    assert of == {1: "und", 2: "und", 3: "und", 4: "en", None: "de"}
    assert [r.lang_pred != "und" for r in got[6:]] == [True, True]
    assert all(r.lang_pred == "und" for r in langid.predict(spark.createDataFrame(rows, "doc_id long, text string, score int"), None).collect())
    kept = langid.sure(spark.createDataFrame([(*r, "?") for r in rows], "doc_id long, text string, score int, lang string"), model)
    assert kept.columns == ["doc_id", "text", "score", "lang"] and {(r.doc_id, r.lang) for r in kept.collect()} >= {(4, "en"), (None, "de")}


def test_no_training_rows(spark):
    none = spark.createDataFrame([(1, None, "en"), (2, "words", None)], "doc_id long, text string, lang string")
    assert langid.train(none) is None and langid.train(none.limit(0)) is None


def test_scorer_forgets_and_agrees(model):
    words = [b" " + w for w in b"the and of with in is a that re was".split()]
    one, few = langid.Scorer(model), langid.Scorer(model, most=3)
    for batch in ([words[:4], [], words], [words[5:]], [[]]):
        assert np.allclose(one(batch), few(batch))
        assert np.allclose(one(batch), [model.log_probability(w).sum(0) if w else np.zeros(len(model.langs)) for w in batch])


def test_held_out_accuracy(spark):
    got = queries.op2_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == 1000 and (got.lang == got.lang_pred)[got.held_out].mean() > 0.98


def test_long_words_are_expected_like_short_ones(monkeypatch):
    model, _ = small_model()
    words, counts = [b" abc", b" cab", b" cabcabab", b" bcabcaba"], np.array([3, 2, 1, 5])
    want = model.expected(words, counts, 0)
    monkeypatch.setattr(langid, "SHORT", 3)
    assert np.allclose(model.expected(words, counts, 0), want) and want.sum() > 0
    monkeypatch.undo()
    used = model.expected([b" " + b"cab" * 3000], np.array([2]), 1)
    assert np.isclose(used @ [len(v) for v in model.vocab], 2 * 9001)


def test_scripts_without_spaces(spark):
    r = np.random.default_rng(4)
    kinds = {"zh": "的一是不了人我在有他这为之大来以个中上们", "ja": "のにはをたがでてとしれさある日本語東京都", "th": "กขคงจชซญดตถทนบปผพมยร"}

    def text(lang):
        return "".join("".join(r.choice(list(kinds[lang]), int(r.integers(10, 30)))) + "，。" for _ in range(3))

    rows = [(i, text(lang), lang) for i, lang in enumerate(list(kinds) * 20)] + [(100 + i, "the words of some english text", "en") for i in range(20)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    new = [(i, text(lang), lang) for i, lang in enumerate(list(kinds) * 5)]
    got = langid.predict(spark.createDataFrame(new, "doc_id long, text string, lang string"), model, keep=("doc_id", "lang")).collect()
    assert all(x.lang_pred == x.lang and x.score > 0.9 for x in got)
    assert any(len(v) > 8 for v in langid.vocabulary())

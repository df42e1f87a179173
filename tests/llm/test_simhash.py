import random

import pytest
import xxhash
from plain_links import roots

from spanforge.llm import links, simhash

WORDS = [f"w{i}" for i in range(60)]


def plain(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_cases():
    for t in ("", " \t\n", "One", "ONE two", "a b c d", "A b\x0bc d\x1ce f g h " * 40):
        assert simhash.fingerprint(t.encode()) == plain(t)
    assert simhash.fingerprint(b"A B C D") == simhash.fingerprint(b"a b c d")
    assert simhash.fingerprint("É B C D".encode()) != simhash.fingerprint("é b c d".encode())


def test_long_text_in_pieces(monkeypatch):
    t = " ".join(random.Random(1).choices(WORDS, k=900))
    monkeypatch.setattr(simhash, "pieces", lambda x: __import__("spanforge.llm.text", fromlist=["x"]).pieces(x, 50))
    assert simhash.fingerprint(t.encode()) == plain(t)


def test_near_duplicates_against_all_pairs(spark):
    r = random.Random(3)
    base = [" ".join(r.choices(WORDS, k=r.randint(3, 300))) for _ in range(60)]
    texts = list(base)
    for t in base:
        for _ in range(3):
            w = t.split()
            w[r.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    texts += ["", None, "  ", "one", "ONE", base[0], base[0]]
    rows = [(i, t, "x", 5) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    got = {x.doc_id: x for x in simhash.near_duplicates(df).collect()}
    fp = {i: plain(t) for i, t, *_ in rows}
    want = roots(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4])
    assert {i: x.component_id for i, x in got.items()} == want
    assert {i: x.fp % 2**64 for i, x in got.items()} == fp
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and sorted(x.doc_id for x in kept.collect()) == sorted(i for i in fp if want[i] == i)


@pytest.mark.parametrize("most", [2, 40, 4096])
def test_full_blocks_lose_no_link(spark, most, monkeypatch):
    r = random.Random(7)
    seeds = [r.getrandbits(64) for _ in range(6)]
    fps = {s ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 6))) for s in seeds for _ in range(40)}
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    inner = simhash.forest
    monkeypatch.setattr(simhash, "forest", lambda f, d, m, _=0: inner(f, d, m, most))
    found = [(x.a % 2**64, x.b % 2**64) for x in simhash.block_links(df, 4, most).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    assert roots(fps, found) == roots(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4])


def test_empty_and_null_keys(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(none).count() == 0
    rows = spark.createDataFrame([(None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (9, None)], "doc_id long, text string")
    assert sorted((x.doc_id or 0, x.component_id) for x in simhash.near_duplicates(rows).collect()) == [(0, 4), (4, 4), (4, 4), (9, 9)]
    assert sorted(x.doc_id for x in simhash.keep_one(rows).collect()) == [4, 9]
    keyless = spark.createDataFrame([(None, "a b c d e"), (None, "A B C D E"), (None, "quite other words here"), (4, "f g h i j")], "doc_id long, text string")
    assert sorted((x.doc_id or 0, x.text.lower()) for x in simhash.keep_one(keyless).collect()) == [(0, "a b c d e"), (0, "quite other words here"), (4, "f g h i j")]


def test_components_of_chains_and_hubs(spark):
    r = random.Random(5)
    order = list(range(400))
    r.shuffle(order)
    pairs = list(zip(order[:150], order[1:150])) + [(order[200], x) for x in order[201:300]] + [(1, 1)]
    got = {x.node: x.root for x in links.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots(range(400), pairs)
    touched = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {i: want[i] for i in touched if want[i] != i}

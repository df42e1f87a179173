import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from spanforge.llm import divergence as dv

SCHEMA = "doc_id long, text string, lang string, source string, n int, shard int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, rows):
    return spark.createDataFrame([(i, t, a, s, 1, 2) for i, (t, a, s) in enumerate(rows)], SCHEMA)


def plain(rows, least, top=50):
    docs, counts, groups = {}, {}, {}
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall((text or "").translate(LOWER))
        docs.setdefault(lang, Counter()).update(set(found))
        counts.setdefault((lang, source), Counter()).update(found)
        groups.setdefault(lang, set()).add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            more = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", more, top)):
                out += [(lang, s, part, item, -minus, r + 1) for r, (minus, _, item) in enumerate(sorted(items)[:most])]
    return sorted(out)


def corpus(n=300, seed=1):
    r = np.random.default_rng(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Ünder", "ß", "naïve", "中文", "a　b", "é"]
    out = []
    for i in range(n):
        some = r.choice(len(words), r.integers(0, 40), p=(w := 1 / (1 + np.arange(len(words)))) / w.sum())
        text = "".join(words[j] + r.choice([" ", "\n", ", ", "1", "_", "\x00"]) for j in some)
        out.append((text.upper() if i % 7 == 0 else text, ["en", "de", None][i % 3], [f"s{i % 5}", "s0", None, "Ä"][i % 4]))
    return out


def found(spark, rows, **more):
    return sorted(tuple(r) for r in dv.source_divergence(table(spark, rows), audit=dv.Audit(**more)).collect())


@pytest.mark.parametrize("more", [{}, {"shard": 16, "most_bytes": 3000, "cells": 40, "sources": 2}])
def test_against_plain_counts(spark, more):
    rows = corpus()
    rows += [("", "fr", "a"), (None, "fr", "b"), ("1 2 3", "fr", "c"), ("wab wab", "one", "x"), *[("only one source", "one", "x")] * 6, (None, None, None)]
    rows += [rows[0]] * 3
    assert found(spark, rows, least_docs=5, **more) == plain(rows, 5)


def test_empty_and_without_terms(spark):
    assert found(spark, []) == []
    rows = [("a b", "en", "x"), (None, "en", "y")]
    assert found(spark, rows) == plain(rows, 30) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_long_texts_and_long_terms(spark):
    long = "z" * 5000
    rows = [("wort " * 400_000, "de", "a"), (f"{long} {long}y wort", "de", "b"), (f"{long} x", "de", "b"), (f"x {long}y", "de", "a")]
    assert found(spark, rows, least_docs=2) == plain(rows, 2)


def test_exact_beyond_a_long(spark):
    from pyspark.sql import functions as F

    n, total, kept = 9 * 10**15, 10**16, 12345
    row = spark.range(1).select(dv._share(F.lit(n), F.lit(total), F.lit(kept), dv.Audit()).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * kept)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 3000])
def test_perfect_and_minimal(n):
    words = [f"term{i}".encode() for i in range(n)]
    seed, pilots, by_slot = dv.build(words)
    assert sorted(by_slot) == sorted(words) and len(pilots) == max(1, n // 4)
    s = dv.Shards(1)
    s.parts.append((0, seed, pilots, by_slot))
    which, place = s.ready().find([b"other", *words, b"term", b""])
    assert which.tolist() == list(range(1, n + 1)) and sorted(place) == list(range(n))
    assert [by_slot[i] for i in place] == words


def test_equal_hashes_take_another_seed():
    def hashed(words, seed):
        return np.zeros(len(words), np.uint64) if seed == 42 else dv._hash(words, seed)

    assert dv.perfect(np.zeros(2, np.uint64)) is None
    seed, pilots, by_slot = dv.build([b"a", b"b", b"c"], hashed)
    assert seed == 43
    s = dv.Shards(1)
    s.parts.append((0, seed, pilots, by_slot))
    which, place = s.ready().find([b"c", b"d", b"a"])
    assert [by_slot[i] for i in place] == [b"c", b"a"] and which.tolist() == [0, 2]


def test_a_task_sends_in_parts(monkeypatch):
    monkeypatch.setattr(dv, "GATHER", 10)
    texts = [" ".join(f"t{chr(97 + i)}{chr(97 + j)}" for j in range(8)) for i in range(6)] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(["x"] * 12), pa.array(texts)], names=["lang", "text"])
    sums = Counter()
    for out in dv._document_counts(iter([batch, batch])):
        for term, n in zip(out.column(1).to_pylist(), out.column(2).to_pylist(), strict=True):
            sums[term] += n
    assert len(sums) == 48 and set(sums.values()) == {4}

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.llm import licenses, queries

SF = "/root/testdata/sf0.01"
FILL = [f"word{i}" for i in range(300)]


def plain(text, templates=licenses.TEMPLATES, scan=licenses.Scan()):
    """Best containment of each template over all spans, by brute force."""
    w = licenses.words_of((text or "").encode())
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    out = {}
    for name, t in templates.items():
        v = licenses.words_of(t.encode())
        own = [tuple(v[i : i + 5]) for i in range(len(v) - 4)]
        span = math.ceil(scan.room * len(own))
        best = max((len(set(own) & set(runs[i : i + span])) / len(set(own)) for i, r in enumerate(runs) if r in own), default=0)
        if best >= scan.containment - 1e-9:
            out[name] = best
    return out


def changed(text, r, share):
    return " ".join("other" if r.random() < share else w for w in text.split())


def test_matches_against_all_spans():
    r, known = random.Random(2), licenses.Templates(licenses.TEMPLATES, licenses.Scan())
    wrong = total = 0
    for _ in range(150):
        parts = [" ".join(r.choices(FILL, k=r.randint(0, 60)))]
        for name in r.sample(list(licenses.TEMPLATES), r.randint(0, 3)):
            parts += [changed(licenses.TEMPLATES[name], r, r.choice([0, 0, 0.01, 0.04])), " ".join(r.choices(FILL, k=r.randint(0, 60)))]
        text = ". ".join(parts)
        got = {}
        for t, _, _, k in known.scan_text(text.encode()):
            got[known.names[t]] = max(got.get(known.names[t], 0), k / known.different[t])
        want = plain(text)
        total += len(want)
        wrong += got != want
    assert total > 100 and wrong == 0


def test_each_copy_is_found_once():
    known = licenses.Templates(licenses.TEMPLATES, licenses.Scan())
    line = "Released under the MIT License."
    text = " ".join([line, *FILL[:7], line.upper(), *FILL[:90], line])
    got = known.scan_text(text.encode())
    assert [(known.names[t], at, n) for t, at, n, _ in got] == [("mit line", 0, 5), ("mit line", 12, 5), ("mit line", 107, 5)]


def test_long_texts_in_parts(monkeypatch):
    r, known = random.Random(4), licenses.Templates(licenses.TEMPLATES, licenses.Scan())
    text = " ".join(x for _ in range(12) for x in (*r.choices(FILL, k=r.randint(50, 400)), licenses.TEMPLATES["mit text"], *r.choices(FILL, k=9), licenses.TEMPLATES["gpl-3.0 line"])).encode()
    whole = known.scan_text(text)
    monkeypatch.setattr(licenses, "pieces", lambda t: __import__("spanforge.llm.text", fromlist=["x"]).pieces(t, 3000))
    assert sorted(known.scan_text(text)) == sorted(whole) and len(whole) == 24


def test_bands_guarantee_collisions():
    scan = licenses.Scan()
    known = licenses.Templates(licenses.TEMPLATES, scan)
    worst = min(0.8 * d / (s + 0.2 * d) for d, s in zip(known.different, known.size))
    assert licenses.collision_probability(worst, scan.rows, known.bands) >= scan.found > licenses.collision_probability(worst, scan.rows, known.bands // 2)
    r, met = np.random.default_rng(1), 0
    for _ in range(300):
        a = r.integers(0, 1 << 63, 60, dtype=np.uint64)
        b = np.r_[a[:30], r.integers(0, 1 << 63, 30, dtype=np.uint64)]  # similarity one third
        met += any(x == y for x, y in zip(known.keys(a), known.keys(b)))
    assert met / 300 > licenses.collision_probability(1 / 3, scan.rows, known.bands) - 0.05


@pytest.mark.parametrize("n", range(1, 400))
def test_windows_hold_their_template(n):
    size = licenses.window_size(n)
    assert n <= 0.75 * size and (size == 2 or n > 0.5 * size)


def test_edges(spark):
    rows = [(1, None, 3), (1, "", 3), (None, "x Licensed under CC BY-NC 4.0 y", 3), (2, "Licensed under CC BY-NC", 3), (3, "same line. " * 100000 + "Released under the MIT License", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, licenses int")
    got = [(r.doc_id, r.n_matches, r.licenses) for r in licenses.scan_documents(df).collect()]
    assert got == [(1, 0, ""), (1, 0, ""), (None, 1, "cc-by-nc-4.0 line"), (2, 0, ""), (3, 1, "mit line")]
    assert licenses.scan_documents(df.limit(0)).count() == 0
    assert all(r.n_matches == 0 for r in licenses.scan_documents(df, templates={}).collect())
    with pytest.raises(ValueError):
        licenses.Templates({"short": "four words are few"}, licenses.Scan())


def test_query_against_brute_force(spark):
    got = {r.doc_id: r for r in queries.op3_license_scan(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").filter(F.lower("text").rlike("licen|permission")).collect()
    assert len(got) == 1000 and len(docs) > 5
    for d in docs:
        assert got[d.doc_id].licenses == ",".join(sorted(plain(d.text))) and got[d.doc_id].containment == max(plain(d.text).values(), default=0)
    assert sum(r.n_matches > 0 for r in got.values()) == sum(bool(plain(d.text)) for d in docs)

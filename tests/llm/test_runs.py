"""Periodic runs against plain loops."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm.data import DOCS, edge_docs, edge_rows, no_docs, sentence
from tradewind.llm import periodic_runs, queries


def runs_of(w, exponent=4, least=6):
    """Every period on its own: stretches of equal words that far apart, but for those of a smaller period."""
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                seen = w[i:j + q]
                if not any(seen[r:] == seen[:-r] for r in range(1, q)):
                    out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_equal_plain_loops():
    r = random.Random(1)
    for _ in range(1500):
        texts = []
        for _ in range(r.randint(1, 3)):
            letters, n = r.randint(1, 3), r.randint(0, 60)
            w = [r.randrange(letters) for _ in range(n)]
            if n and r.random() < 0.6:
                a, p = r.randrange(n), 1 + r.randrange(max(1, n // 3))
                w = [x if i < a else w[min(a + (i - a) % p, n - 1)] for i, x in enumerate(w)]
                w[r.randrange(n)] = r.randrange(letters)
            texts.append(w)
        exponent, want, before = r.choice([3, 4, 6]), [], 0
        for w in texts:
            want += [(s + before, n, q) for s, n, q in runs_of(w, exponent)]
            before += len(w)
        names = np.array([3 * t + x for t, w in enumerate(texts) for x in w], np.int64)
        got = periodic_runs.find_runs(names, max(map(len, texts)), exponent)
        assert list(zip(*(x.tolist() for x in got), strict=True)) == want


def test_long_text_in_log_levels():
    names = np.tile(np.arange(40_000), 5)
    assert [x.tolist() for x in periodic_runs.find_runs(names, len(names))] == [[0], [200_000], [40_000]]
    assert [x.tolist() for x in periodic_runs.find_runs(np.zeros(300_000, np.int64), 300_000)] == [[0], [300_000], [1]]


def digests(doc_id, text):
    """The contract, word by word."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 == 0 and n and doc_id is not None:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = runs_of(w)
    s, m, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (len(runs), s, m, q, 1000 * m // q if runs else None, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(collapsed(w, runs).encode()).hexdigest())


def test_query_follows_the_contract(spark, tmp_path):
    odd = ["", None, " \n", "x", "a " * 50, "\ta\x0bb a b\x0ca b a b a b  a b ", "no yes " * 9 + "no\x1cyes", "é é é é é é\r\né"]
    rows = [(i, odd[i % 8] if i % 3 == 0 else sentence(i, 10 + i % 90), "en", "s", 0) for i in range(400)] + [(None, "a b " * 9, "en", "s", 0)] * 2
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted((str(r[0]), *map(str, r[1:8])) for r in got) == sorted((str(i), *map(str, digests(i, t))) for i, t, *_ in rows)
    assert sum(r["n_runs"] > 0 for r in got) > 40


def test_edges(spark):
    docs = edge_docs(spark).withColumnRenamed("gone", "runs")
    got = periodic_runs.find(docs)
    assert got.columns == [*docs.columns, "n_words", "_runs", "collapsed"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == len(edge_rows()) and rows[12]["_runs"] == [(0, 40, 1)] and rows[12]["collapsed"] == "a"
    assert rows[5]["n_words"] == 0 and rows[5]["collapsed"] == rows[4]["collapsed"] == rows[7]["collapsed"] == "" and rows[5]["_runs"] == []
    assert rows[9]["n_words"] > 0 and periodic_runs.find(no_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find(docs, exponent=2)

"""Spelling variants against plain comparisons."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.data import DOCS, edge_docs, no_docs
from tradewind.llm import queries, spelling


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_of(counts, ratio=10):
    """word, form, root, n, n_near, form_n by comparing every pair."""
    partners = {w: [v for v in counts if v != w and near(v, w)] for w in counts}
    form = {}
    for w, vs in partners.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, str(form[w]), root(w), n, len(partners[w]), str(counts.get(form[w]))) for w, n in counts.items())


def words_of(r, n, letters="abé", sizes=(7, 12)):
    out = set()
    while len(out) < n:
        w = "".join(r.choice(letters) for _ in range(r.randint(*sizes)))
        out |= {w, w[:3] + w[4:], w + w[-1], "b" + w[1:]}
    return sorted(w for w in out if len(w) >= sizes[0])


def test_acceptor_is_minimal_and_numbers_words():
    words = sorted(["tap", "taps", "top", "tops"])
    made = spelling.Acceptor(words, np.array([0]))
    assert len(made.final) == 5  # t, a or o, p, s: equal ends are one state
    assert sorted(zip(*(x.tolist() for x in next(made.near(np.array([3]), np.array([True])))), strict=True)) == [(0, 1), (0, 2), (2, 3)]
    two = spelling.Acceptor(["ab", "b", "", "b"], np.array([0, 2]))
    assert sorted((int(a), int(b)) for x, y in two.near(np.array([1, 0]), np.array([True, True])) for a, b in zip(x, y, strict=True)) == [(1, 0), (2, 3)]


@pytest.mark.parametrize("most", [20_000, 6, 1])
def test_pairs_equal_plain_comparison(spark, most):
    r = random.Random(most)
    words = words_of(r, 250) + words_of(r, 60, "xyzÿ÷", (7, 8)) + ["q" * k + "w" * (40 - k) for k in range(12)] + ["n" * 5000, "n" * 5001, "n" * 2500 + "m" + "n" * 2499]
    vocabulary = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    got = [(row["a"], row["b"]) for row in spelling.near_pairs(vocabulary, most).collect()]
    want = {frozenset((a, b)) for i, a in enumerate(words) for b in words[i + 1:] if abs(len(a) - len(b)) < 2 and near(a, b)}
    assert len(got) == len(want) and {frozenset(p) for p in got} == want and len(want) > 200


def test_variants_equal_plain_comparison(spark):
    r = random.Random(3)
    counts = {w: r.choice([2, 2, 3, 20, 35, 200, 2500]) for w in words_of(r, 150)}
    words = spark.createDataFrame([(w,) for w, n in counts.items() for _ in range(n)] + [("short",), (None,), ("oncealone",)], "word string")
    got = sorted((x["word"], str(x["form"]), x["root"], x["n"], x["n_near"], str(x["form_n"])) for x in spelling.variants(words).collect())
    assert got == variants_of(counts)
    assert any(root != form != "None" for _, form, root, *_ in got)


def test_long_chain(spark):
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(21)], "word string, form string")
    assert {tuple(r) for r in spelling.roots(chain).collect()} == {(f"w{i}", "w21") for i in range(21)}


def test_query_follows_the_contract(spark, tmp_path):
    r = random.Random(5)
    base = ["Straße", "différence", "DIFFERENCE", "language", "languages", "Wörterbuch", "naïveté", "x÷y×zabcd", "aaaaaaaa", "aaaaaaa", "ÀÀÀÀÀÀÀ"]
    rows = [(i, " ".join(r.choices(base, [8, 300, 300, 500, 40, 90, 30, 40, 400, 30, 20], k=60)) + r.choice([".", "\n9", "'s"]), "en", "s", 0) for i in range(200)]
    rows += [(900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, "differenca " * 3, "en", "s", 0), (None, "language", "en", "s", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    got = queries.op13_spelling_variants(spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = sorted((x["word"], str(x["form"]), x["root"], x["n"], x["n_near"], str(x["form_n"])) for x in got.collect())
    assert found == variants_of(counts) and any(x[1] != "None" for x in found)


def test_edges(spark):
    words = spelling.runs(edge_docs(spark)).withColumnRenamed("run", "word")
    assert spelling.variants(words).filter("word = repeat('x', 50000)").count() == 0
    assert spelling.variants(words.unionAll(words)).filter("word = repeat('x', 50000) AND n = 2 AND form IS NULL AND root = word").count() == 1
    assert spelling.variants(spelling.runs(no_docs(spark)).withColumnRenamed("run", "word")).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(words, ratio=1)

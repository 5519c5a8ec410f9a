"""Small tables with everything that may go wrong in them."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use inside or add
CLASHING = ("k t m w h u id s d l n v q row rep band best host size mark key own gone language confidence accepted n_lines n_removed pieces "
            "n_pieces ids_crc32 round_trip class_id copies taken _key _mark _own _gone _n _total _scores _declared _host _logs").split()


def sentence(seed, n=12, words="the of and to in is that it was for on are with as his they at be this from have or one had by word".split()):
    r = random.Random(seed)
    return " ".join(r.choice(words) + str(r.randint(0, 40)) for _ in range(n)) + "."


def text(seed, n_lines=8):
    return "\n".join(sentence((seed, i).__hash__()) for i in range(n_lines))


def edge_rows():
    long_line = " ".join(f"word{i}" for i in range(30_000))
    rows = [(1, text(1), "en", "a.example.com"), (2, text(1), "en", "a.example.com"), (3, text(1).replace("word", "ward", 1), "en", None),
            (4, "", "en", "b"), (5, None, "en", "b"), (6, None, None, None), (7, "   \n\n \t ", "fr", "b"), (8, text(8), None, "b"),
            (None, text(9), "xx", "c"), (None, text(1), "fr-CA", "c"), (9, long_line + "\n" + text(2), "de", "c"), (9, text(3), "de", "c"),
            (10, "x" * 50_000, "en", "c"), (11, "one two", "en", "c"), (12, "a\n" * 40, "en", "c"), (13, "▁ two  spaces ▁", "es", ""),
            *[(14, text(4), "en", "hot")] * 30, *[(20 + i, text(1), "en", "hot") for i in range(30)]]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def edge_docs(spark, clashing=True):
    docs = spark.createDataFrame(edge_rows(), DOCS)
    for name in CLASHING if clashing else ():
        docs = docs.selectExpr("*", f"'kept' AS `{name}`")
    return docs


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def near(spark):
    """Documents in known classes: 0, 1, 2 copies and near copies of one text, 3 half of it, 4 apart."""
    words = [f"w{i}" for i in range(200)]
    edited, half = list(words), words[:100] + [f"v{i}" for i in range(100)]
    edited[100] = "other"
    return spark.createDataFrame([(i, " ".join(w), "en", "s", 0) for i, w in enumerate([words, words, edited, half, [f"z{i}" for i in range(60)]])], DOCS)

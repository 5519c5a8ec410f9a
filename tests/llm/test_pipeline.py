"""The pipeline's stages on small tables."""

import tracemalloc

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm.data import edge_docs, edge_rows, no_docs, text
from tradewind.llm import language, pieces, prob_minhash
from tradewind.llm.staging import written


def test_stages(spark):
    docs = spark.createDataFrame([(i, text(i), "en", f"s{i % 3}", 0) for i in range(30)] + [(100 + i, text(5), "en", "s1", 0) for i in range(5)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        names = docs.columns
        docs = written(stage(spark, docs, ""))
        seen.append((name, docs.count()))
        assert name == "pieces" or docs.columns == names
    assert dict(seen)["language"] == 35 and dict(seen)["lines"] == dict(seen)["near duplicates"] == 30
    assert docs.filter("not round_trip or n_pieces = 0").count() == 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stage_edges(spark, stage):
    docs = edge_docs(spark)
    got = stage(spark, docs, "")
    assert 0 < got.count() <= 3 * len(edge_rows())
    assert stage(spark, no_docs(spark), "").count() == 0


def most_bytes(work):
    """The most that ``work()`` held at a time; what it returns is part of it."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_tasks(spark):
    """What a Python worker takes beside its input does not depend on how large a batch or a bucket's texts are together."""
    texts = [text(i) for i in range(3_000)]
    size = sum(map(len, texts))
    scores = language.text_evidence(np.zeros((language.BUCKETS + 1, 7))).func
    assert size > 1_500_000 and most_bytes(lambda: list(scores(iter([pd.Series(texts)])))) < 40 << 20

    # shingles of a bucket, counted in cells: beside the cells only those of one text
    sets = [(np.arange(i, i + 40_000, dtype=np.uint64), np.ones(40_000, np.int64)) for i in range(50)]
    assert most_bytes(lambda: prob_minhash._counts(sets)) < 4 << 20

    model = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    ids, counts = model(pa.array(texts))
    want, base = len("".join(texts)), size + 100 * len(texts)
    assert sum(map(len, model.decode(ids, counts))) == want and most_bytes(lambda: model.decode(ids, counts)) - base < 24 << 20


def test_texts_of_a_bucket_come_in_parts(spark, monkeypatch):
    """Links of a bucket are the same however its texts are cut into batches."""
    words = [f"w{i}" for i in range(100)]
    rows = [(h, 0, 0, 0, bytes([h, i]), bytes([h, i]), [h], " ".join(words + [f"x{h}{i}"] if i % 2 else [f"z{h}_{j}_{i}" for j in words]))
            for h in (1, 2, 3) for i in range(9)]
    frame = spark.createDataFrame(rows, "h long, lo long, hi long, block long, u binary, l binary, bands array<long>, t string")

    def found():
        return sorted((bytes(r["a"]), bytes(r["b"])) for r in prob_minhash._links_within(frame, 0.8, 5).collect())

    whole = found()
    assert len(whole) == 9 and all(a[0] == b[0] and a[1] % 2 and b[1] % 2 for a, b in whole)
    monkeypatch.setattr(prob_minhash, "_CHUNK", 300)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)
    try:
        assert found() == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_send_small_batches(spark, stage):
    """Whatever the session had, a stage that is run by itself sets what its tasks take at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20)
    stage(spark, no_docs(spark), "")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20

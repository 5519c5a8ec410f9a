"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: signs of their principal components under rotations learned on a bounded sample
(each rotation brings the components as near as it can to the corners of a cube). A code is split into substrings of
16 bits, and each substring has an index from its value to the vectors that have it. Two codes within a radius r
agree in at least one of m substrings up to r // m bits, so probing all values that near finds every code within r.
Those are reranked by their exact distance.

Spark deals distinct vectors into slices and queries into blocks and brings each pair of a slice and a block
together once; nothing is collected but the sample.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.staging import written

SUBSTRING = 16
_POPCOUNT = np.bitwise_count(np.arange(1 << SUBSTRING, dtype=np.uint16))


@dataclass(frozen=True)
class Codes:
    """How vectors become codes, and the radius within which neighbours are looked for."""

    mean: np.ndarray
    directions: np.ndarray
    radius: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as rows of 16-bit substrings."""
        return np.packbits((vectors - self.mean) @ self.directions > 0, axis=1).view(np.uint16)


def learn(sample: np.ndarray, k: int, bits: int = 128, quantile: float = 0.95, rounds: int = 30, seed: int = 3) -> Codes:
    """Codes learned on a sample of rows.

    The radius is the ``quantile`` of the code distances between sampled vectors and their k nearest neighbours in the
    sample. Neighbours among all rows are nearer than those, so the radius errs on the wide side.
    """
    rng = np.random.default_rng(seed)
    mean = sample.mean(0)
    centred = sample - mean
    values, axes = np.linalg.eigh(centred.T @ centred / len(sample))
    axes = axes[:, ::-1]
    y, dims = centred @ axes, sample.shape[1]
    rotations = []
    for _ in range(-(-bits // dims)):
        r = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.where(y @ r > 0, 1.0, -1.0).T @ y)
            r = (u @ vt).T
        rotations.append(axes @ r)
    codes = Codes(mean, np.hstack(rotations)[:, :bits], bits)
    code, distances = codes.of(sample), []
    for i in range(min(len(sample), 200)):
        gaps = ((sample - sample[i]) ** 2).sum(1)
        gaps[i] = np.inf
        near = np.argsort(gaps)[:min(k, len(sample) - 1)]
        distances += list(np.bitwise_count(code[near] ^ code[i]).sum(1))
    # all radii up to a multiple of the number of substrings cost the same probes
    m = bits // SUBSTRING
    radius = int(np.quantile(distances, quantile)) if distances else bits
    return Codes(mean, codes.directions, min(bits, radius // m * m + m - 1))


class Index:
    """Multi-index over the codes of one slice."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.values, self.starts = [], []
        for j in range(codes.shape[1]):
            values, starts = np.unique(codes[self.order[:, j], j], return_index=True)
            self.values.append(values)
            self.starts.append(np.append(starts, len(codes)))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Positions of all codes within ``radius`` of ``code``."""
        m = len(code)
        seen = np.zeros(len(self.codes), bool)
        patterns = _patterns(radius // m)
        for j in range(m):
            values, starts = self.values[j], self.starts[j]
            if len(patterns) < len(values):  # look up every value that near
                probes = patterns ^ code[j]
                at = np.minimum(np.searchsorted(values, probes), len(values) - 1)
                hit = at[values[at] == probes]
            else:  # fewer values than probes: test each value of the index
                hit = np.flatnonzero(_POPCOUNT[values ^ code[j]] <= radius // m)
            sizes = starts[hit + 1] - starts[hit]
            flat = np.repeat(starts[hit] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum()) if len(hit) else hit
            seen[self.order[flat, j]] = True
        found = np.flatnonzero(seen)
        return found[self.distance(found, code) <= radius]

    def distance(self, rows: np.ndarray | slice, code: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.codes[rows] ^ code).sum(1)


_PATTERNS: dict[int, np.ndarray] = {}


def _patterns(bits: int) -> np.ndarray:
    if bits not in _PATTERNS:
        _PATTERNS[bits] = np.flatnonzero(_POPCOUNT <= bits).astype(np.uint16)
    return _PATTERNS[bits]


def _search(codes: Codes, keep: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def search(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, float]] = []
        if len(rows) and len(queries):
            vectors = np.stack(rows["v"].to_numpy()).astype(np.float64)
            ids, first = rows["ids"].to_numpy(), np.array([i[0] for i in rows["ids"]])
            index = Index(codes.of(vectors))
            wanted = np.stack(queries["v"].to_numpy()).astype(np.float64)
            for key, query, code in zip(queries["q"], wanted, codes.of(wanted), strict=True):
                near = index.within(code, codes.radius)
                if len(near) < keep:  # grow the radius as far as this slice needs for enough vectors
                    gaps = index.distance(slice(None), code)
                    near = np.flatnonzero(gaps <= np.partition(gaps, min(keep, len(gaps)) - 1)[min(keep, len(gaps)) - 1])
                score = np.sqrt(((vectors[near] - query) ** 2).sum(axis=1))
                best = np.lexsort((first[near], score))[:keep]
                pairs = sorted((s, int(i)) for s, at in zip(score[best], near[best], strict=True) for i in ids[at])[:keep]
                found += [(key, i, s) for s, i in pairs]
        return pd.DataFrame(found, columns=["q", "vec_id", "score"])

    return search


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
            bits: int = 128, max_sample: int = 5_000, slice_rows: int = 32_768, block_queries: int = 65_536) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for every row of ``vectors`` that ``is_query`` names.

    Candidates are all rows but those with the query's id; all of them come back if there are fewer than ``k``. Score is
    the Euclidean distance in double precision, ties go to the smaller id. Rows without an id and vectors that are null,
    zero or hold null or non-finite components take no part, nor do vectors of another length than the most common one.
    Equal rows count once. Equal vectors are searched and indexed once and keep their k + 1 smallest ids, which are all
    that can be in an answer; so a vector in a third of all rows is one entry. Codes are learned on about
    ``max_sample`` distinct vectors, picked by a hash; every vector is indexed. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_q"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v")))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("v") == (length["n"] if length else 0))
    keep = k + 1
    place = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
    index = written(rows.withColumn("place", place).filter(F.col("place") <= keep)
                    .groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids")))
    n = index.count()
    share = min(1.0, max_sample / max(n, 1))
    sample = index.filter(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < int(share * (1 << 30))).select("v").toPandas()["v"]
    named = written(rows.filter("is_q").groupBy("v").agg(F.count("*").alias("n")).select("v", F.monotonically_increasing_id().alias("q")))
    asked = rows.filter("is_q").select("id", "v").distinct().join(named, "v").select(F.col("id").alias("query_id"), "q")
    schema = "q long, vec_id long, score double"
    if len(sample):
        codes = learn(np.stack(sorted(sample.to_list(), key=tuple)).astype(np.float64), k, bits)
        # which vectors share a slice depends on the data alone, and so do the answers; more tasks come of smaller blocks of queries
        slices, asking = -(-n // slice_rows), named.count()
        spare = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // slices)
        blocks = max(-(-asking // block_queries), min(spare, -(-asking // 64)))
        spread = lambda column, parts, name: F.pmod(F.xxhash64(column, F.lit(name)), F.lit(max(parts, 1))).cast("int")
        left = index.withColumn("slice", spread("v", slices, "slice")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(blocks, 1) - 1))))
        right = named.withColumn("block", spread("v", blocks, "block")).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        pairs = left.groupBy("slice", "block").cogroup(right.groupBy("slice", "block")).applyInPandas(_search(codes, keep), schema)
    else:
        pairs = spark.createDataFrame([], schema)
    place = F.row_number().over(Window.partitionBy("q").orderBy("score", "vec_id"))
    best = pairs.withColumn("place", place).filter(F.col("place") <= keep).groupBy("q").agg(
        F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("found"))
    others = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    return asked.join(best, "q").select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))

"""Language identification by fusing evidence.

The posterior of a language is the product of four parts: the likelihood of the whole text under hashed byte trigrams,
how often documents of that language declare what this one declares, how often they stand under its address suffix,
and a prior of the host, smoothed towards its domain and that towards all documents. The last three are counted over all
documents by grouped aggregation, each document counting for the language of its text. An undetermined class, all
trigrams alike, stands for text of no known language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.staging import free_name, written

BUCKETS = 1 << 15
NOTHING = "und"
# other than letters become blanks; bytes of longer characters stay
_PLAIN = bytes(b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in range(256))
# characters at a time; each takes about 100 bytes while it is scored
_CHUNK = 200_000


def _buckets(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all trigrams of some texts (BUCKETS for those that touch no letter or leave a text), and where each text starts."""
    parts = [b"\0 " + (t or "").lower().encode("utf-8", "replace").translate(_PLAIN) + b" \0\0" for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])[:-1]
    b = np.frombuffer(b"".join(parts) + b"\0\0", np.uint8).astype(np.uint32)
    key = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    out = ((key * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int32)
    nothing = (b[:-2] == 0) | (b[1:-1] == 0) | (b[2:] == 0) | (key == 0x202020)
    out[nothing] = BUCKETS
    return out, starts


def _chunks(texts: pd.Series) -> Iterator[list[str | None]]:
    chunk, size = [], 0
    for t in texts:
        chunk.append(t)
        size += len(t or "")
        if size >= _CHUNK:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def learn(docs: DataFrame, languages: Sequence[str], id_col: str, text_col: str, declared_col: str,
          max_texts: int = 2_000, smoothing: float = 0.05) -> np.ndarray:
    """Log-probabilities [BUCKETS + 1, languages + 1] of trigrams; the last class is the undetermined one.

    Counted on about ``max_texts`` texts per language that declare it, picked by a hash of id and text (the
    documented bound). The last row, for trigrams that say nothing, is 0.
    """
    label = declared(F.col(declared_col), languages)
    rows = docs.select(label.alias("l"), F.col(text_col).alias("t"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h")).filter(F.col("l") < len(languages))
    n = {r["l"]: r["count"] for r in rows.groupBy("l").count().collect()}  # one row per language at most
    share = F.lit(0)
    for lang, count in n.items():
        share = F.when(F.col("l") == lang, int(min(1.0, max_texts / count) * (1 << 30))).otherwise(share)
    picked = rows.filter(F.pmod("h", F.lit(1 << 30)) < share).repartition(8, "h")

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(languages), BUCKETS + 1), np.int64)
        for batch in batches:
            for lang, texts in batch.groupby("l")["t"]:
                for chunk in _chunks(texts):
                    total[lang] += np.bincount(_buckets(chunk)[0], minlength=BUCKETS + 1)
        lang, bucket = np.nonzero(total[:, :BUCKETS])
        yield pd.DataFrame({"l": lang, "b": bucket, "n": total[lang, bucket]})

    table = np.zeros((BUCKETS, len(languages)))
    found = picked.select("l", "t").mapInPandas(counts, "l int, b int, n long").groupBy("l", "b").agg(F.sum("n").alias("n"))
    for lang, bucket, count in found.toPandas().itertuples(index=False):  # at most languages * BUCKETS numbers
        table[bucket, lang] = count
    total = table.sum(0)
    known = np.where(total > 0, np.log((table + smoothing) / (total + smoothing * BUCKETS).clip(1e-9)), -50.0)
    out = np.hstack([known, np.full((BUCKETS, 1), -np.log(BUCKETS))])
    return np.vstack([out, np.zeros((1, len(languages) + 1))])


def text_evidence(model: np.ndarray, trigrams_per_word: float = 3.0) -> Callable[[Column], Column]:
    """A column function: log-likelihoods of a text per class, and the number of trigrams behind them.

    Trigrams overlap, so three of them count as one observation.
    """
    table = np.hstack([model / trigrams_per_word, np.ones((len(model), 1))])
    table[-1] = 0

    @F.pandas_udf("array<double>")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out: list[np.ndarray] = []
            for chunk in _chunks(texts):
                buckets, starts = _buckets(chunk)
                out += list(np.add.reduceat(table[buckets], starts, axis=0))
            yield pd.Series(out, dtype=object)

    return scores


def declared(value: Column, languages: Sequence[str]) -> Column:
    """Number of the declared language (``fr-CA`` is ``fr``), the number of languages for any other, null for none."""
    code = F.lower(F.regexp_extract(value.cast("string"), r"^\s*([A-Za-z]+)", 1))
    out = F.lit(len(languages))
    for i, language in enumerate(languages):
        out = F.when(code == language, i).otherwise(out)
    return F.when(value.isNotNull() & (F.trim(value.cast("string")) != ""), out)


def _best(scores: Column, n: int) -> Column:
    """First position of the largest of the first ``n`` numbers."""
    return (F.array_position(F.slice(scores, 1, n), F.array_max(F.slice(scores, 1, n))) - 1).cast("int")


def _counts(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Documents per class for each group, as an array ``c``; combined before the shuffle."""
    per = [F.coalesce(F.sum(F.when(F.col("best") == i, 1.0).otherwise(0.0)), F.lit(0.0)) for i in range(n)]
    return rows.groupBy(*keys).agg(F.array(*per).alias("c"))


def _smoothed(counts: Column, parent: Column, strength: float) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, parent, lambda c, p: (c + strength * p) / (total + strength))


def identify(docs: DataFrame, languages: Sequence[str], id_col: str = "doc_id", text_col: str = "text",
             declared_col: str = "lang", host_col: str | None = "source", strength: float = 10.0,
             min_confidence: float = 0.5, max_texts: int = 2_000) -> DataFrame:
    """``docs`` with language, confidence (its posterior) and accepted.

    ``declared_col`` is the language that the markup or metadata states, ``host_col`` the host or another name of the
    origin; its last label is the address suffix, if it has several. The trigrams are learned from texts that declare
    one of ``languages``. A null declaration or host is no evidence. A document is accepted if the most probable class is one of ``languages``, with ``min_confidence``
    or more; a text without a letter, an empty and a null text are undetermined and not accepted. Whole texts are read; repeated
    rows count as often as they occur; the new columns get underscores in front where ``docs`` has such names; an
    empty table gives an empty one.
    """
    n = len(languages) + 1
    language, confidence, accepted = (free_name(docs, c) for c in ("language", "confidence", "accepted"))
    s, d, h, hk, logs, post = (free_name(docs, f"_{c}") for c in ("scores", "declared", "host", "host_key", "logs", "posterior"))
    text_of = text_evidence(learn(docs, languages, id_col, text_col, declared_col, max_texts))
    host = F.col(host_col) if host_col else F.lit(None)
    full = docs.withColumns({d: declared(F.col(declared_col), languages), h: F.lower(host.cast("string")), s: text_of(F.col(text_col))})

    # one narrow row per document: every count below is over all of them
    rows = written(full.select(F.col(d).alias("d"), F.col(h).alias("h"), F.when(F.get(s, n) > 0, _best(F.col(s), n)).alias("best")))
    uniform = [1.0 / n] * n
    whole = _counts(rows, [], n).select(_smoothed(F.col("c"), F.array(*map(F.lit, uniform)), strength).alias("p"))
    overall = whole.first()["p"]
    base = F.array(*map(F.lit, overall))
    domain = F.substring_index("h", ".", -2)
    suffix = F.when(F.instr("h", ".") > 0, F.substring_index("h", ".", -1))
    hosts = _counts(rows.filter("h is not null"), ["h"], n).withColumns({"dom": domain, "suf": suffix})
    sums = F.array(*[F.sum(F.get("c", i)) for i in range(n)])
    domains = hosts.groupBy("dom").agg(sums.alias("dc"))
    suffixes = hosts.filter("suf is not null").groupBy("suf").agg(sums.alias("sc"))
    totals = {i: v * max(rows.count(), 1) for i, v in enumerate(overall)}
    # P(suffix | class), relative to its share of all documents
    seen = F.aggregate("sc", F.lit(0.0), lambda a, x: a + x)
    given = F.transform("sc", lambda x, i: (x + strength * seen / sum(totals.values())) / (F.get(F.array(*map(F.lit, totals.values())), i) + strength))
    hosts = hosts.join(domains, "dom").join(suffixes.select("suf", given.alias("given")), "suf", "left")
    prior = _smoothed(F.col("c"), _smoothed(F.col("dc"), base, strength), strength)
    hosts = written(hosts.select(F.col("h").alias(hk), F.transform(F.zip_with(
        prior, F.coalesce("given", F.array(*[F.lit(1.0)] * n)), lambda p, g: p * g), lambda x: F.log(x)).alias(logs)))
    stated = {r["d"]: r["c"] for r in _counts(rows.filter("d is not null"), ["d"], n).collect()}  # one row per language
    all_stated = np.sum([stated.get(i, [0.0] * n) for i in range(n)], axis=0)
    evidence = F.array(*[F.lit(0.0)] * n)
    for i in range(n):
        row = np.log((np.array(stated.get(i, [0.0] * n)) + strength / n) / (all_stated + strength))
        evidence = F.when(F.col(d) == i, F.array(*[F.lit(float(x)) for x in row])).otherwise(evidence)

    # texts are scored again rather than shuffled by host
    joined = full.join(hosts, full[h] == hosts[hk], "left")
    no_host = F.array(*[F.lit(float(x)) for x in np.log(overall)])
    parts = F.zip_with(F.zip_with(F.slice(s, 1, n), F.coalesce(logs, no_host), lambda a, b: a + b), evidence, lambda a, b: a + b)
    joined = joined.withColumn(post, parts)
    top = F.array_max(post)
    share = 1 / F.aggregate(post, F.lit(0.0), lambda a, x: a + F.exp(x - top))
    best = F.when(F.get(s, n) > 0, _best(F.col(post), n)).otherwise(n - 1)
    name = F.get(F.array(*map(F.lit, [*languages, NOTHING])), best)
    out = joined.select(*[docs[c] for c in docs.columns], name.alias(language), F.when(F.get(s, n) > 0, share).otherwise(0.0).alias(confidence))
    return out.withColumn(accepted, (F.col(language) != NOTHING) & (F.col(confidence) >= min_confidence))

"""URL verdicts: listed rules first, gradient-boosted trees on lexical features and suffix statistics for the rest.

Everything on rows is built-in functions and Spark ML; there is no Python on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.staging import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEXICAL = ["f_length", "f_host_length", "f_labels", "f_depth", "f_digits", "f_hyphens", "f_entropy", "f_params", "f_escaped"]
FEATURES = [*LEXICAL, "f_last_seen", "f_last_rate", "f_site_seen", "f_site_rate"]

# Suffixes of a host by their column, and the features whose mean and spread are kept of each.
LEVELS = {"last": "s_last", "site": "s_site", "host": "h"}
SHAPE = ["length", "depth", "digits", "entropy", "params"]
COUNTS = {"r_last_often": "last_n", "r_site_often": "site_n", "r_host_often": "host_n", "r_last_hosts": "last_hosts",
          "r_site_hosts": "site_hosts"}
BESIDE = [*[f"r_{level}_{name}" for level in LEVELS for name in SHAPE], *COUNTS]

# A labelled URL takes the rates of its suffixes from the other folds; equal URLs share a fold.
FOLDS = 5


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the host (and its subdomains) and path prefix in ``pattern``, as in ``example.net/en/``."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (``A-Z`` lower-cased) and path of a URL; both empty for null and where ``://`` is missing."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null. ``rules`` is a short, hand-kept list."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.pattern)):
        at_host = (host == rule.host) | host.endswith(f".{rule.host}")
        out = F.when(at_host & path.startswith(rule.path), F.lit(value(rule))).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.char_length(text)
    chars = F.array_distinct(F.split(text, ""))

    def add(total: Column, char: Column) -> Column:
        n = (size - F.char_length(F.replace(text, char, F.lit("")))).cast("double")
        return total + F.when((char != "") & (n > 0), n * F.log2(F.greatest(n, F.lit(1.0)))).otherwise(0.0)

    total = F.aggregate(chars, F.lit(0.0), add)
    return F.when(size > 0, F.log2(F.greatest(size, F.lit(1)).cast("double")) - total / size).otherwise(0.0)


def lexical(df: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """Adds the features that a URL has by itself, and its suffixes: the last label and the last two labels of the host."""
    text = F.coalesce(F.col(url), F.lit(""))
    size = F.char_length(text)
    return df.withColumns({
        "f_length": size.cast("double"),
        "f_host_length": F.char_length(host).cast("double"),
        "f_labels": F.regexp_count(F.col(host), F.lit(r"[^.]+")).cast("double"),
        "f_depth": F.regexp_count(F.col(path), F.lit("/+[^/]")).cast("double"),
        "f_digits": F.when(size > 0, F.regexp_count(text, F.lit("[0-9]")) / size).otherwise(0.0),
        "f_hyphens": F.regexp_count(F.col(host), F.lit("[-_]")).cast("double"),
        "f_entropy": _entropy(text),
        "f_params": F.regexp_count(F.regexp_extract(text, r"\?([^#]*)", 1), F.lit("[^&;]+")).cast("double"),
        "f_escaped": F.regexp_count(text, F.lit("%[0-9A-Fa-f]{2}")).cast("double"),
        "s_last": F.substring_index(F.col(host), ".", -1),
        "s_site": F.substring_index(F.col(host), ".", -2),
    })


def _fold(url: Column) -> Column:
    return F.pmod(F.xxhash64(url, F.lit(FOLDS)), F.lit(FOLDS)).cast("int")


def suffix_statistics(rows: DataFrame) -> DataFrame:
    """One row per suffix of either kind: its URLs, and its labelled and blocked ones for each fold.

    ``rows`` has s_last, s_site, ``fold`` and ``blocked`` (null where unlabelled). Counts combine before the shuffle,
    so a suffix with a third of all rows costs one row per task.
    """
    def by_fold(value: Column) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col("fold") == i, value)), F.lit(0.0)) for i in range(FOLDS)])

    # either kind: counted separately, then read as one table
    kinds = [rows.select(F.lit(kind).alias("kind"), F.col(kind).alias("suffix"), "fold", "blocked") for kind in ("s_last", "s_site")]
    return kinds[0].unionAll(kinds[1]).groupBy("kind", "suffix").agg(
        F.count("*").alias("seen"), by_fold(F.col("blocked").isNotNull().cast("double")).alias("labelled"),
        by_fold(F.col("blocked")).alias("blocks"))


def _with_suffixes(rows: DataFrame, stats: DataFrame, prior: float, strength: float, held_out: bool) -> DataFrame:
    """Adds seen and rate of both suffixes; ``held_out`` takes the rate from the folds that a row is not in."""
    def total(counts: Column) -> Column:
        every = F.aggregate(counts, F.lit(0.0), lambda x, y: x + y)
        return every - F.get(counts, F.col("fold")) if held_out else every

    for kind, name in (("s_last", "last"), ("s_site", "site")):
        part = stats.filter(F.col("kind") == kind).select(
            F.col("suffix").alias(kind), F.col("seen").alias("n_seen"), F.col("labelled").alias("n_labelled"), F.col("blocks").alias("n_blocks"))
        rate = (total(F.col("n_blocks")) + prior * strength) / (total(F.col("n_labelled")) + strength)
        # as many rows as suffixes: a shuffle join if they are many, where AQE splits the rows of a hot suffix
        rows = rows.join(part, kind, "left").withColumns({
            f"f_{name}_seen": F.log1p(F.coalesce(F.col("n_seen"), F.lit(0)).cast("double")),
            f"f_{name}_rate": F.coalesce(rate, F.lit(prior))}).drop("n_seen", "n_labelled", "n_blocks")
    return rows


def _thousandths(name: str) -> Column:
    """A feature as a whole number, so that sums do not depend on the order of rows; by its logarithm if it has no bound."""
    value = F.col(f"f_{name}")
    return F.round(1000 * (value if name in ("digits", "entropy") else F.log1p(value))).cast("long")


def suffix_shapes(rows: DataFrame) -> DataFrame:
    """One row per host: for each of its suffixes (``LEVELS``) the hosts and URLs, and sum and sum of squares of ``SHAPE``.

    ``rows`` has h, s_last, s_site and the lexical features. Labels are not read.
    """
    keys = list(LEVELS.values())
    sums = [F.lit(1).cast("long").alias("hosts"), F.count("*").alias("n")]
    for name in SHAPE:
        sums += [F.sum(_thousandths(name)).alias(f"sum_{name}"), F.sum(_thousandths(name) * _thousandths(name)).alias(f"squares_{name}")]
    # counts combine before the shuffle; longer suffixes add up to the shorter ones, so URLs are dealt out once
    hosts = written(rows.groupBy(*keys).agg(*sums))
    names = [c for c in hosts.columns if c not in keys]
    out = hosts.select(*keys, *[F.col(c).alias(f"host_{c}") for c in names])
    for level in ("last", "site"):
        out = out.join(hosts.groupBy(LEVELS[level]).agg(*[F.sum(c).alias(f"{level}_{c}") for c in names]), LEVELS[level])
    return out.drop("s_last", "s_site")


def beside_suffixes(rows: DataFrame, strength: float) -> DataFrame:
    """Adds ``BESIDE``: how far a URL is from others of each of its suffixes, in whole standard deviations, and how many URLs
    and hosts the suffix has (0 to 3 for 1, 2, 4, 8 and more).

    Mean and spread of a suffix are drawn to those of the next shorter one with the weight of ``strength`` URLs. Deviations
    average to about zero over each suffix, so they tell little of which suffix it is, unless suffixes differ in their mixture.
    """
    shapes = suffix_shapes(rows)
    features = {}
    for name in SHAPE:
        mean, square = None, None
        for level in LEVELS:
            n, total, squares = (F.col(f"{level}_{c}") for c in ("n", f"sum_{name}", f"squares_{name}"))
            if mean is None:
                mean, square = total / n, squares / n
            else:
                mean, square = ((x + strength * y) / (n + strength) for x, y in ((total, mean), (squares, square)))
            spread = F.sqrt(F.greatest(square - mean * mean, F.lit(1.0)))  # a thousandth at least
            features[f"r_{level}_{name}"] = mean, spread
    counts = [F.least(F.floor(F.log2(n)), F.lit(3)).cast("double").alias(name) for name, n in COUNTS.items()]
    moments = [x.alias(f"{k}_{what}") for k, pair in features.items() for x, what in zip(pair, ("mean", "spread"), strict=True)]
    shapes = shapes.select("h", *counts, *moments)
    # one row per host: a shuffle join if they are many, where AQE splits the rows of a hot host
    return rows.join(shapes, "h").withColumns({
        k: F.round((_thousandths(k.rpartition("_")[2]) - F.col(f"{k}_mean")) / F.col(f"{k}_spread")) for k in features
    }).drop(*[f"{k}_{what}" for k in features for what in ("mean", "spread")])


def fit(labelled: DataFrame, n_labelled: int, features: Sequence[str] = FEATURES, max_labelled: int = 20_000, trees: int = 12,
        depth: int = 4, seed: int = 11) -> GBTClassificationModel:
    """Boosted trees on about ``max_labelled`` rows at most, picked by a hash of the URL (the documented bound).

    ``labelled`` has ``features``, ``blocked`` and the URL in ``u``.
    """
    share = min(1.0, max_labelled / max(n_labelled, 1))
    picked = labelled.filter(F.pmod(F.xxhash64("u", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    # equal URLs are equal rows for the trees, so a sample by URL stays bounded by weighing them instead
    rows = picked.groupBy(*features, "blocked").agg(F.count("*").cast("double").alias("weight"))
    rows = written(VectorAssembler(inputCols=list(features), outputCol="features").transform(rows).select("features", "blocked", "weight"))
    rows = rows.repartition(8, F.xxhash64("features")).sortWithinPartitions("features", "blocked")
    return GBTClassifier(featuresCol="features", labelCol="blocked", weightCol="weight", predictionCol="p_block",
                         maxIter=trees, maxDepth=depth, seed=seed, cacheNodeIds=False).fit(rows)


def judge(pages: DataFrame, id_col: str, url_col: str, rules: Sequence[Rule], labels: DataFrame | None = None,
          label_col: str = "blocked", prior: float = 0.5, strength: float = 20.0, **fit_args) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, source (rule, trees or default).

    The trees learn from ``labels`` (``url_col``, ``label_col`` 1 for block), on the shape of URLs and on what is known
    of their suffixes. Where there is none they learn from the URLs of ``pages`` that a rule decides, on the shape and on
    statistics of all URLs of each suffix that need no label: such a URL lies in the host its rule names, so each suffix with a
    label is one that a rule names, lies in or holds, and its rate of blocked URLs would tell the rule and not the URL. With
    labels of one class only, that class is the verdict of the rest; without any it is allow. Null and malformed URLs have
    empty host and path, fit no rule and are judged like others; repeated rows are judged alike; other columns of ``pages`` are
    not read. An empty table gives no rows.
    """
    def decided(df: DataFrame) -> DataFrame:
        return df.filter("by_rule is not null").withColumn("blocked", (F.col("by_rule") == "block").cast("double"))

    u, key = "u", "k"
    host, path = host_and_path(F.col(u))
    rows = pages.select(F.col(id_col).alias(key), F.col(url_col).alias(u)).withColumns({"h": host, "p": path})
    rows = rows.withColumn("rule", rule_of(F.col("h"), F.col("p"), rules, lambda r: r.pattern)) \
               .withColumn("by_rule", rule_of(F.col("h"), F.col("p"), rules, lambda r: r.verdict))
    rows = written(lexical(rows, u, "h", "p"))
    if labels is None:
        known, features = decided(rows), [*LEXICAL, *BESIDE]
    else:
        known = labels.select(F.col(url_col).alias(u), F.col(label_col).cast("double").alias("blocked")).filter("blocked is not null")
        known = written(lexical(known.withColumns({"h": host, "p": path}), u, "h", "p").withColumn("fold", _fold(F.col(u))))
        features = FEATURES
    n, blocks = known.agg(F.count("*"), F.sum("blocked")).first()
    if not n or blocks in (0, n):
        verdict = F.lit("block" if n and blocks == n else "allow")
        scored = rows.withColumn("guess", verdict).withColumn("source", F.lit("default"))
    else:
        if labels is None:
            full = written(beside_suffixes(rows, strength))
            known = decided(full)
        else:
            columns = ["s_last", "s_site", "fold", "blocked"]
            unlabelled = rows.withColumns({"fold": F.lit(None).cast("int"), "blocked": F.lit(None).cast("double")})
            stats = written(suffix_statistics(unlabelled.select(*columns).unionAll(known.select(*columns))))
            known = _with_suffixes(known, stats, prior, strength, True)
            full = _with_suffixes(rows, stats, prior, strength, False)
        model = fit(known, n, features, **fit_args)
        full = VectorAssembler(inputCols=features, outputCol="features").transform(full)
        scored = model.transform(full).withColumn("guess", F.when(F.col("p_block") > 0.5, "block").otherwise("allow")) \
            .withColumn("source", F.lit("trees"))
    return scored.select(
        F.col(key).alias(id_col), F.col("h").alias("host"), F.col("p").alias("path"), "rule",
        F.coalesce("by_rule", "guess").alias("verdict"),
        F.when(F.col("by_rule").isNotNull(), "rule").otherwise(F.col("source")).alias("decided_by"))


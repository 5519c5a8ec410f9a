"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package expects. All of them are runtime SQL settings, so they can
# also be applied to a session that somebody else created.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join also where a later step would have used its partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # what one task reads of a shuffle stays this small however large the input is, so sorts and hash tables fit and do not spill
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # rows go to Python workers in batches of some megabytes, however long their texts are
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

# For a large cluster: many small shuffle partitions that AQE merges back to about 256 MB.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app: str = "tradewind", master: str | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession, settings: dict[str, str] | None = None) -> SparkSession:
    for key, value in {**SQL_SETTINGS, **(settings or {})}.items():
        spark.conf.set(key, value)
    return spark


def working_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, a local folder is used in local mode only: on a cluster a folder of one
    machine would be lost with that machine, so it is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tradewind-")


# what this package stores is read a few times at most, so smaller files are worth more than fast compression
STORED = {"compression": "zstd"}
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: Counter[str] = Counter()
_freeing_lock = Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job in this block go when the job ends. Without it they lie on the executors' disks until the
    driver happens to collect its garbage, those of every earlier step beside those of the running one.

    For frames that are written or collected once: a second time they would have to make their shuffles again. Threads may nest and
    overlap; the setting goes back when the last block of a session ends."""
    own = spark._jsparkSession.sessionUUID()
    with _freeing_lock:
        # a session that frees them anyway is left alone
        mine = _freeing[own] > 0 or spark.conf.get(FREE_SHUFFLES) != "true"
        if mine:
            _freeing[own] += 1
            spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            if mine:
                _freeing[own] -= 1
                if not _freeing[own]:
                    del _freeing[own]
                    spark.conf.unset(FREE_SHUFFLES)


@contextmanager
def staged(df: DataFrame, reader: SparkSession | None = None) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back, in session ``reader`` if given; removed at
    the end of the block.

    Cuts the lineage of a frame that several jobs use, so that it is computed once, keeps its
    values, and does not depend on executors staying alive.
    """
    spark = reader or df.sparkSession
    path = f"{working_folder(spark)}/staged/{uuid.uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.write.options(**STORED).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def fixed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, for results that are read later than the caller returns. The
    folder goes when the application ends."""
    spark = df.sparkSession
    path = until_the_end(spark, f"{working_folder(spark)}/fixed/{uuid.uuid4().hex}")
    with shuffles_freed(spark):
        df.write.options(**STORED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def until_the_end(spark: SparkSession, path: str) -> str:
    """``path``, whatever is written there removed when the application ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path

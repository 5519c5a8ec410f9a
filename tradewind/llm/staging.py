"""Frames written once to the shared folder, so that later jobs neither recompute them nor depend on executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tradewind.session import working_folder


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back.

    The rows are fixed from then on, also values that would differ in a second run (row ids), and a
    lost executor loses none of them. The folder goes when the application ends, because the frame
    that an operator returns still reads it.
    """
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(*frames: DataFrame) -> None:
    """Deletes the folders of frames that ``written`` gave and that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for path in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (names are case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def new_folder(spark: SparkSession) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = f"{working_folder(spark)}/llm/{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path

"""Families of date-sharded tables: folders ``<name>_YYYYMMDD``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: a shard is any name that ends in eight digits.
SHARD = r"^(.+)[0-9]{8}$"


def read_shards(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """All shards of a family with the day of each row's shard as ``_shard``."""
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}_[0-9][0-9][0-9][0-9][0-9][0-9][0-9][0-9]")
    return df.withColumn("_shard", F.regexp_extract("_metadata.file_path", r"_([0-9]{8})/[^/]*$", 1))


def shard_summary(shards: DataFrame) -> DataFrame:
    """First and last shard, number of shards, rows and bytes of a family."""
    # one row per file first: its size must count once, not once per row
    files = shards.groupBy("_shard", F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.max("_metadata.file_size").alias("bytes"))
    return files.agg(
        F.min("_shard").alias("shard_min"), F.max("_shard").alias("shard_max"),
        F.count_distinct("_shard").alias("shard_count"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    )


def group_shards(tables: DataFrame, name: str = "table_name", rows: str = "row_count",
                 size: str = "size_bytes") -> DataFrame:
    """Fold a listing of tables so that the shards of a family become one row."""
    is_shard = F.col(name).rlike(SHARD)
    day = F.when(is_shard, F.substring(name, -8, 8))
    base = F.when(is_shard, F.regexp_extract(name, SHARD, 1)).otherwise(F.col(name))
    return (
        tables.select(base.alias("table_family"), day.alias("shard"), F.col(rows).alias("_rows"), F.col(size).alias("_size"))
        .groupBy("table_family", F.col("shard").isNotNull().alias("is_sharded"))
        .agg(F.min("shard").alias("shard_min"), F.max("shard").alias("shard_max"),
             F.count("shard").alias("shard_count"),
             F.sum("_rows").alias("row_count"), F.sum("_size").alias("size_bytes"))
    )

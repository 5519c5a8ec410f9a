"""Differences between the columns of a table and of new rows, and what to do about them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType, StructType

from tradewind.functions.casts import spark_type

POLICIES = ("ignore", "append_new_columns", "sync_all_columns", "fail")


class SchemaChanged(ValueError):
    pass


@dataclass(frozen=True)
class SchemaDiff:
    added: dict[str, DataType]
    removed: dict[str, DataType]
    retyped: dict[str, tuple[DataType, DataType]]

    def __bool__(self) -> bool:
        return bool(self.added or self.removed or self.retyped)


def policy_of(name: str) -> str:
    """An unknown policy means ``ignore``."""
    return name if name in POLICIES else "ignore"


def schema_diff(source: StructType, target: StructType) -> SchemaDiff:
    s = {f.name: f.dataType for f in source}
    t = {f.name: f.dataType for f in target}
    return SchemaDiff(
        {c: k for c, k in s.items() if c not in t},
        {c: k for c, k in t.items() if c not in s},
        {c: (t[c], k) for c, k in s.items() if c in t and t[c] != k},
    )


def add_columns(df: DataFrame, columns: Mapping[str, DataType | str]) -> DataFrame:
    return df.withColumns({
        c: F.lit(None).cast(spark_type(t) if isinstance(t, str) else t) for c, t in columns.items()
    }) if columns else df


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def change_column_type(df: DataFrame, column: str, kind: DataType | str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast(spark_type(kind) if isinstance(kind, str) else kind))


def reconcile(target: DataFrame, source: DataFrame, policy: str = "ignore") -> tuple[DataFrame, DataFrame]:
    """``target`` and ``source`` with equal columns.

    ``ignore`` keeps the table as it is: new columns are not stored, and a missing one is an error.
    ``append_new_columns`` adds columns and fills missing ones of new rows with NULL.
    ``sync_all_columns`` also drops and retypes, so that the table looks like the source.
    ``fail`` refuses any difference.
    """
    policy = policy_of(policy)
    diff = schema_diff(source.schema, target.schema)
    if policy == "fail" and diff:
        raise SchemaChanged(f"columns added: {diff.added}, removed: {diff.removed}, retyped: {diff.retyped}")
    if policy == "ignore":
        if diff.removed:
            raise SchemaChanged(f"new rows lack columns of the table: {sorted(diff.removed)}")
        return target, fit(source, target.schema)
    target = add_columns(target, diff.added)
    if policy == "sync_all_columns":
        target = drop_columns(target, list(diff.removed))
        for c, (_, new) in diff.retyped.items():
            target = change_column_type(target, c, new)
    return target, fit(add_columns(source, {} if policy == "sync_all_columns" else diff.removed), target.schema)


def fit(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types."""
    have = {f.name: f.dataType for f in df.schema}
    return df.select(*[
        F.col(f.name) if have[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name) for f in schema
    ])

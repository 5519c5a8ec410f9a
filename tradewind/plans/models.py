"""Models as Python functions: what they may read, how they are stored, and building them in order."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tradewind.operators import incremental as inc
from tradewind.operators.incremental import Incremental
from tradewind.operators.quality import ColumnRule, row_measures
from tradewind.plans.params import Params, Run
from tradewind.sources.raw import in_parallel
from tradewind.sources.tables import Warehouse

KINDS = ("view", "inline", "table", "incremental")


@dataclass(frozen=True)
class Model:
    """A named query. ``view`` and ``inline`` stay lazy frames, ``table`` is rebuilt on each run and
    ``incremental`` is changed as ``how`` says. A view with ``sql``, a function that gives the text of its query, is made in the
    catalog, where it outlives the session."""

    name: str
    query: Callable[["Context", SparkSession], DataFrame | pd.DataFrame]
    kind: str = "table"
    layer: str = "gold"
    how: Incremental = Incremental()
    config: Mapping[str, Any] = field(default_factory=dict)
    sql: Callable[["Context"], str] | None = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}: {self.kind}")

    @property
    def table(self) -> str:
        return f"{self.layer}.{self.name}"


class Context:
    """What a model sees: other models, source tables, its settings and its own stored rows."""

    def __init__(self, warehouse: Warehouse, models: Iterable[Model], run: Run | None = None,
                 params: Params = Params(), full_refresh: bool = False,
                 rules: Mapping[str, Mapping[str, ColumnRule]] | None = None) -> None:
        """``rules``: checks declared for models; those of single rows are counted by the jobs that write these, into
        ``observed`` (model -> check -> failures, and ``rows``)."""
        self.warehouse, self.run, self.params, self.full_refresh = warehouse, run, params, full_refresh
        self.rules, self.observed = rules or {}, {}
        self.models = {m.name: m for m in models}
        self._lazy: dict[str, DataFrame] = {}
        self._current: Model | None = None

    @property
    def spark(self) -> SparkSession:
        return self.warehouse.spark

    def for_model(self, model: Model) -> "Context":
        out = Context(self.warehouse, (), self.run, self.params, self.full_refresh)
        out.models, out._lazy, out._current = self.models, self._lazy, model
        out.rules, out.observed = self.rules, self.observed
        return out

    def source(self, table: str) -> DataFrame:
        return self.warehouse.read(f"bronze.{table}")

    def ref(self, name: str) -> DataFrame:
        """Another model: its stored rows, or its lazy frame if it is not stored."""
        model = self.models[name]
        if model.kind in ("table", "incremental") or (model.sql and self.warehouse.exists(model.table)):
            return self.warehouse.read(model.table)
        if name not in self._lazy:
            self._lazy[name] = evaluate(model, self)
        return self._lazy[name]

    @property
    def config(self) -> Mapping[str, Any]:
        return self._current.config

    @property
    def this(self) -> DataFrame:
        return self.warehouse.read(self._current.table)

    @property
    def is_incremental(self) -> bool:
        return self._current.kind == "incremental" and inc.is_incremental(
            self.warehouse, self._current.table, self.full_refresh)

    def max_partition(self):
        return inc.max_partition(self.warehouse, self._current.table)

    def newer(self, rows: DataFrame, column: str) -> DataFrame:
        """Rows above the stored maximum of ``column``."""
        return inc.newer_than_table(self.warehouse, self._current.table, rows, column, self._current.how.partition)


def evaluate(model: Model, context: Context) -> DataFrame:
    out = model.query(context.for_model(model), context.spark)
    return context.spark.createDataFrame(out) if isinstance(out, pd.DataFrame) else out


def build_model(model: Model, context: Context) -> None:
    warehouse = context.warehouse
    if model.kind == "view":
        body = model.sql(context.for_model(model)) if model.sql else context.ref(model.name)
        warehouse.create_view(model.table, body, context.full_refresh)
    elif model.kind == "table":
        measures = row_measures(model.name, context.rules.get(model.name, {}))
        context.observed[model.name] = warehouse.write_table(
            model.table, evaluate(model, context), model.how.partition, model.how.cluster, measures)
    elif model.kind == "incremental":
        measures, seen = row_measures(model.name, context.rules.get(model.name, {})), {}
        inc.build(warehouse, model.table, lambda change: evaluate(model, context), model.how, context.full_refresh, measures, seen)
        context.observed[model.name] = seen


def build_all(steps: Iterable[Iterable[Model]], context: Context) -> None:
    """Build models step by step; those of one step do not read each other and run side by side."""
    for step in steps:
        in_parallel(lambda m=m: build_model(m, context) for m in step)

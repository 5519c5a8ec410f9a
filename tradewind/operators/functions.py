"""Functions defined by users: scalar SQL functions and aggregates."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from tradewind.functions.casts import spark_type


def create_scalar_function(spark: SparkSession, name: str, arguments: Mapping[str, str], returns: str, body: str,
                           volatility: str = "deterministic") -> None:
    """A SQL function with typed arguments. Its body is put into the query that calls it, so it costs
    what the expression costs. ``volatility``: deterministic, stable or non-deterministic."""
    # Accepted volatilities and the clause each becomes.
    clauses = {"deterministic": "DETERMINISTIC", "stable": "NOT DETERMINISTIC", "non-deterministic": "NOT DETERMINISTIC"}
    if volatility not in clauses:
        raise ValueError(f"volatility must be one of {sorted(clauses)}: {volatility}")
    args = ", ".join(f"{a} {spark_type(t)}" for a, t in arguments.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {spark_type(returns)} "
              f"{clauses[volatility]} RETURN {body}")


# rows of a group that one step of an aggregate sees
PIECE = 100_000


@dataclass(frozen=True)
class Aggregate:
    """An aggregate with a name, declared argument types and a declared result type.

    ``step`` turns a frame of argument columns (some rows of one group) into one value per field of ``state``; values of
    a field from several steps combine by its built-in (``sum``, ``min`` or ``max``); ``finish`` makes results of a frame of states.
    """

    name: str
    arguments: Mapping[str, str]
    returns: str
    # field -> (type, how two values combine)
    state: Mapping[str, tuple[str, str]]
    step: Callable[[pd.DataFrame], Mapping[str, object]]
    finish: Callable[[pd.DataFrame], pd.Series]

    def __post_init__(self) -> None:
        unknown = {how for _, how in self.state.values()} - {"sum", "min", "max"}
        if unknown:
            raise ValueError(f"states combine by sum, min or max: {sorted(unknown)}")

    def _frame(self, columns: Sequence[pd.Series], kinds: Sequence[pa.DataType]) -> pd.DataFrame:
        """The arguments in their declared types; what cannot be one is an error."""
        if len(columns) != len(self.arguments):
            raise TypeError(f"{self.name} takes {len(self.arguments)} arguments, not {len(columns)}")
        cast = [pa.Array.from_pandas(c).cast(k).to_pandas() for c, k in zip(columns, kinds, strict=True)]
        return pd.DataFrame(dict(zip(self.arguments, cast, strict=True)))

    def _of_group(self, columns: Sequence[pd.Series], kinds: Sequence[pa.DataType]):
        rows = self._frame([c.reset_index(drop=True) for c in columns], kinds)
        states = pd.DataFrame([self.step(rows.iloc[i:i + PIECE]) for i in range(0, max(len(rows), 1), PIECE)])
        whole = {f: [getattr(states[f], how)()] for f, (_, how) in self.state.items()}
        return self.finish(pd.DataFrame(whole)).iloc[0]

    def register(self, spark: SparkSession) -> None:
        """Makes the name known to SQL and to ``call_function``. Spark hands such a function a group's arguments whole; for
        groups that do not fit into one task's memory there is :meth:`over`."""
        # types are read here, as tasks have no parser for them
        kinds = [to_arrow_type(DataType.fromDDL(spark_type(t))) for t in self.arguments.values()]

        def of_group(*columns: pd.Series) -> float:
            return self._of_group(columns, kinds)

        spark.udf.register(self.name, F.pandas_udf(of_group, spark_type(self.returns)))

    def __call__(self, *columns: Column | str) -> Column:
        """For ``groupBy(...).agg``, once registered."""
        typed = [(F.col(c) if isinstance(c, str) else c).cast(spark_type(t)) for c, t in zip(columns, self.arguments.values(), strict=True)]
        return F.call_function(self.name, *typed)

    def over(self, df: DataFrame, keys: Sequence[str], *columns: Column | str) -> DataFrame:
        """keys and the result, in a column of the aggregate's name, in bounded memory: rows of a group come to lie together (a
        group with most of the rows over several tasks), steps run on batches of them, and their states combine by built-in functions.
        So there are about as many steps as groups and batches, and no group is ever held whole."""
        typed = [(F.col(c) if isinstance(c, str) else c).cast(spark_type(t)).alias(a) for c, (a, t) in zip(columns, self.arguments.items(), strict=True)]
        fields, returns = list(self.state), spark_type(self.returns)

        def steps(batch: pd.DataFrame) -> pd.DataFrame:
            groups = batch.groupby(list(keys), dropna=False, sort=False)
            # a batch may hold the group without a key alone, whose NaN would be no text
            return pd.DataFrame([{**{c: None if pd.isna(v) else v for c, v in zip(keys, k, strict=True)}, **self.step(rows[list(self.arguments)])}
                                 for k, rows in groups])

        kinds = ", ".join([f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys] + [f"`{f}` {t}" for f, (t, _) in self.state.items()])
        merge = {f: getattr(F, how)(f) for f, (_, how) in self.state.items()}
        together = df.select(*keys, *typed).hint("rebalance", *[F.col(k) for k in keys]).sortWithinPartitions(*keys)
        states = python_aggregate(together, keys, steps, kinds, merge, {f: F.col(f) for f in fields})

        @F.pandas_udf(returns)
        def result(*parts: pd.Series) -> pd.Series:
            return self.finish(pd.DataFrame(dict(zip(fields, parts, strict=True))))

        return states.select(*keys, result(*fields).alias(self.name))


def python_aggregate(df: DataFrame, keys: Sequence[str], partial: Callable[[pd.DataFrame], pd.DataFrame],
                     state: str, merge: Mapping[str, Column], finish: Mapping[str, Column]) -> DataFrame:
    """An aggregate whose first step is Python.

    ``partial`` turns a batch of rows into one state row per key (schema ``state``, DDL, with the
    keys); it runs inside tasks on bounded batches. ``merge`` combines the states with built-in
    aggregates and ``finish`` computes the results, so no task ever holds a whole group.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield partial(batch)

    merged = df.mapInPandas(run, state).groupBy(*keys).agg(*[c.alias(n) for n, c in merge.items()])
    return merged.select(*keys, *[c.alias(n) for n, c in finish.items()])

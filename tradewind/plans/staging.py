"""Cleaning: raw text to typed, trimmed columns. One projection per table; a bad value is an error.

The projection exists as a frame and as SQL text, of which catalog views are made that other sessions can read."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradewind.functions.dates import time_literal
from tradewind.functions.text import WHITE_SPACE, clean_string
from tradewind.plans.params import Run
from tradewind.sources.schemas import COLUMNS
from tradewind.sources.tables import text_literal


def with_audit(df: DataFrame, run: Run | None) -> DataFrame:
    """Stamp rows with the time and id of the run."""
    if run is None:
        return df
    return df.withColumns({run.at_column: time_literal(run.at), run.id_column: F.lit(run.id)})


def clean(table: str, raw: DataFrame, run: Run | None = None) -> DataFrame:
    typed = [
        (clean_string(c) if t == "text" else F.col(c).cast(t)).alias(c) for c, t in COLUMNS[table].items()
    ]
    return with_audit(raw.select(*typed), run)


def clean_sql(table: str, source: str, run: Run | None = None) -> str:
    """The query of :func:`clean` over the catalog table ``source``."""
    spaces = "'" + "".join(f"\\u{ord(c):04x}" for c in WHITE_SPACE) + "'"
    typed = [f"btrim(CAST(`{c}` AS STRING), {spaces}) AS `{c}`" if t == "text" else f"CAST(`{c}` AS {t}) AS `{c}`" for c, t in COLUMNS[table].items()]
    if run:
        at = run.at.strftime("%Y-%m-%d %H:%M:%S.%f")
        typed += [f"CAST('{at}' AS TIMESTAMP) AS `{run.at_column}`", f"{text_literal(run.id)} AS `{run.id_column}`"]
    return f"SELECT {', '.join(typed)} FROM {source}"

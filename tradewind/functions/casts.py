"""Type names, casts, arrays and division."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tradewind.functions.text import _col

# Portable type names and the Spark type each stands for. ``int`` is 64 bits wide.
TYPES = {
    "string": "string",
    "timestamp": "timestamp",
    "datetime": "timestamp_ntz",
    "date": "date",
    "float": "double",
    "float64": "double",
    "numeric": "decimal(28,6)",
    "bigint": "bigint",
    "int": "bigint",
    "int64": "bigint",
    "boolean": "boolean",
    "bool": "boolean",
}


def spark_type(name: str) -> str:
    """Spark type for a portable type name, also inside ``array<...>``; others are passed on."""
    low = name.strip().lower()
    if low.startswith("array<") and low.endswith(">"):
        return f"array<{spark_type(low[6:-1])}>"
    return TYPES.get(low, name)


def cast(c: Column | str, type_name: str) -> Column:
    """A value that does not fit the type is an error."""
    return _col(c).cast(spark_type(type_name))


def safe_cast(c: Column | str, type_name: str) -> Column:
    """A value that does not fit the type becomes NULL; arrays are cast element by element."""
    target = spark_type(type_name)
    if target.startswith("array<"):
        return F.transform(_col(c), lambda x: x.try_cast(target[6:-1]))
    if type_name.lower() == "json":
        return F.try_parse_json(_col(c))
    return _col(c).try_cast(target)


def bool_to_text(c: Column | str) -> Column:
    return _col(c).cast("string")


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(spark_type(type_name))


def safe_divide(a: Column | str, b: Column | str) -> Column:
    """Quotient as double, NULL for a zero divisor."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def array_construct(*items: Column | str, type_name: str | None = None) -> Column:
    """Array of the given columns; with no items an empty array of ``type_name``."""
    out = F.array(*[_col(i) for i in items])
    return out.cast(f"array<{spark_type(type_name)}>") if type_name else out


def array_append(array: Column | str, item: Column | str) -> Column:
    return F.array_append(_col(array), _col(item))


def array_concat(first: Column | str, second: Column | str) -> Column:
    return F.concat(_col(first), _col(second))


def array_to_string(array: Column | str, delimiter: str) -> Column:
    return F.array_join(_col(array), delimiter)

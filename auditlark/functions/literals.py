"""Rule tables as constant columns.

A table of a rule pack enters a plan as one constant: an array of strings or
structs that array functions run over. It is handed over as one SQL expression,
as building it value by value would cost a call into the JVM for every word.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_value(value) -> str:
    """A Python value as Spark SQL: texts, numbers, lists as arrays, dicts as structs."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return f"{value}L"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, dict):
        return "named_struct(" + ", ".join(f"{sql_value(k)}, {sql_value(v)}" for k, v in value.items()) + ")"
    return "array(" + ", ".join(sql_value(v) for v in value) + ")"


def constant(value) -> Column:
    return F.expr(sql_value(value))

"""Turn column values into the text that fingerprints and reject rows are made of.

The text is chosen per data type when the plan is built, so a row is rendered by
plain expressions inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotable.functions.columns import quoted, text_literal

# Fixed value: the text that stands for a missing value.
NULL_TOKEN = "null"

_NESTED = (T.ArrayType, T.MapType, T.StructType)
_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def _value_sql(name: str, data_type: T.DataType) -> str:
    value = quoted(name)
    if isinstance(data_type, T.StringType):
        return value
    if isinstance(data_type, T.BinaryType):
        return f"hex({value})"
    if isinstance(data_type, _NESTED):
        return f"to_json({value})"
    text = f"CAST({value} AS STRING)"
    if isinstance(data_type, _TIMESTAMPS):
        return f"CASE WHEN contains({text}, '.') THEN {text} ELSE concat({text}, '.0') END"
    return text


def value_text(name: str, data_type: T.DataType) -> Column:
    """Text of one column's value; null stays null.

    Timestamps always show at least one fraction digit (``2021-01-01 00:00:00.0``).
    Binary becomes hex and nested values become JSON, as both need a stable text.
    """
    return F.expr(_value_sql(name, data_type))


def _joined(df: DataFrame, names: Sequence[str], sep: str, null_token: str) -> str:
    if not names:
        return "''"
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = [f"coalesce({_value_sql(n, types[n])}, {text_literal(null_token)})" for n in names]
    return f"concat_ws({text_literal(sep)}, {', '.join(texts)})"


def concat_values(
    df: DataFrame, names: Sequence[str], sep: str = "", null_token: str = NULL_TOKEN
) -> Column:
    """The values of ``names``, in the given order, run together.

    Without a separator ``('1', '2Bob')`` and ``('12', 'Bob')`` give the same text; pass
    ``sep`` where the values themselves cannot rule that out.
    """
    return F.expr(_joined(df, names, sep, null_token))


def row_text(df: DataFrame, names: Sequence[str] | None = None) -> Column:
    """A whole row as ``[v1,v2,...]``."""
    names = list(df.columns if names is None else names)
    return F.expr(f"concat('[', {_joined(df, names, ',', NULL_TOKEN)}, ']')")

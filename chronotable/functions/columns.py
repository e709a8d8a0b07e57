"""Name-level helpers shared by every operator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """Back-quote a column name so that dots in it are not read as struct access."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Reference a top-level column by its exact name."""
    return F.col(quoted(name))


def text_literal(text: str) -> str:
    """SQL for a string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def pick(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only the named columns, in that order."""
    return df.select([quoted(n) for n in names])


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types; a value that does not fit is an error."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        [
            quoted(f.name)
            if types.get(f.name) == f.dataType
            else col(f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def require_columns(df: DataFrame, names: Sequence[str], what: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} not in the frame: {missing}; it has {df.columns}")

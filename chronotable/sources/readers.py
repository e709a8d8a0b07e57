"""Batches in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from chronotable.functions.columns import as_schema, col


def normalize(df: DataFrame, casts: Mapping[str, str] | None = None) -> DataFrame:
    """Lower-case every column name, then cast the listed columns."""
    lowered = df.toDF(*[n.lower() for n in df.columns])
    return lowered.withColumns({n: col(n).cast(t) for n, t in (casts or {}).items()})


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    casts: Mapping[str, str] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """A CSV with a header, names in lower case.

    Types are inferred unless ``schema`` is given. Inference reads the data one more time and may
    differ between files of one feed, so name the schema for anything large or recurring.
    """
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return normalize(reader.csv(path), casts)


def inline_batch(
    spark: SparkSession, rows: Sequence[Sequence[object]], schema: T.StructType | str
) -> DataFrame:
    """A small literal batch."""
    return spark.createDataFrame(list(rows), schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A batch in the column order and types of ``schema``; missing or extra columns are an error.

    A value that does not fit its type fails the query instead of turning into null.
    """
    missing = [n for n in schema.fieldNames() if n not in df.columns]
    extra = [n for n in df.columns if n not in schema.fieldNames()]
    if missing or extra:
        raise ValueError(f"the batch does not fit: missing {missing}, not expected {extra}")
    return as_schema(df, schema)

"""Projections that prepare a batch and move columns in and out of join prefixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotable.functions.columns import col, pick, require_columns
from chronotable.functions.hashing import row_key, row_md5
from chronotable.functions.timestamps import bound_type, open_end

# Column names and the constant of rows that were not deleted.
ROW_KEY = "row_key"
ROW_MD5 = "row_md5"
VALID_FROM = "valid_from"
VALID_TO = "valid_to"
DELETE_INDICATOR = "delete_indicator"
STATUS = "status"
LEFT = "left_"
RIGHT = "right_"
NOT_DELETED = "NA"

RESERVED = (ROW_KEY, ROW_MD5, VALID_FROM, VALID_TO, DELETE_INDICATOR, STATUS)


def reject_reserved(df: DataFrame, names: Sequence[str] = RESERVED) -> None:
    taken = [n for n in df.columns if n.lower() in names]
    if taken:
        raise ValueError(f"these column names are reserved: {taken}")


def enrich(df: DataFrame, keys: Sequence[str], ignore: Sequence[str], sep: str = "") -> DataFrame:
    """Add ``row_md5`` (all but ``ignore``) and ``row_key`` (only ``keys``), both from the input."""
    reject_reserved(df, (ROW_KEY, ROW_MD5, STATUS))
    return df.select(
        "*",
        row_md5(df, ignore, sep).alias(ROW_MD5),
        row_key(df, keys, sep).alias(ROW_KEY),
    )


def add_validity(df: DataFrame, valid_from: str) -> DataFrame:
    """Open a row: valid from the named column until the far future, not deleted."""
    require_columns(df, [valid_from], "valid-from column")
    source_type = df.schema[valid_from].dataType
    return df.withColumns(
        {
            VALID_FROM: col(valid_from).cast(bound_type(source_type)),
            VALID_TO: open_end(source_type),
            DELETE_INDICATOR: F.lit(NOT_DELETED),
        }
    )


def prefix_columns(df: DataFrame, prefix: str | None) -> DataFrame:
    """``x`` becomes ``<prefix>x`` for every column; no prefix changes nothing."""
    return df.toDF(*[(prefix or "") + n for n in df.columns])


def select_prefix(df: DataFrame, prefix: str, extra: str | None = None) -> DataFrame:
    """Keep the columns whose name starts with ``prefix``, then ``extra`` unless it is blank."""
    names = [n for n in df.columns if n.startswith(prefix)]
    if extra and extra.strip():
        names.append(extra)
    return pick(df, names)


def strip_prefix(df: DataFrame, prefix: str | None) -> DataFrame:
    """Take ``prefix`` off the front of every name that has it, once."""
    return df.toDF(*[n.removeprefix(prefix or "") for n in df.columns])

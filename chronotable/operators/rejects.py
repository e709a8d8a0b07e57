"""Rows set aside, with the reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chronotable.functions.columns import col
from chronotable.functions.render import row_text
from chronotable.operators.columns import STATUS
from chronotable.operators.status import status_name

# The two columns of a reject table.
REJECT_SCHEMA = T.StructType(
    [
        T.StructField("reason", T.StringType(), False),
        T.StructField("rowData", T.StringType(), False),
    ]
)


def reject_rows(df: DataFrame) -> DataFrame:
    """``(reason, rowData)`` of classified rows: the status name and the whole row as text."""
    return df.select(status_name(col(STATUS)).alias("reason"), row_text(df).alias("rowData"))

"""Row fingerprints: MD5 over rendered column values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotable.functions.columns import require_columns
from chronotable.functions.render import NULL_TOKEN, concat_values


def md5_of(
    df: DataFrame,
    select: Sequence[str] | None = None,
    ignore: Sequence[str] | None = None,
    sep: str = "",
    null_token: str = NULL_TOKEN,
) -> Column:
    """Lower-case hex MD5 of some columns of ``df``, always taken in frame order.

    ``select`` names the columns to use, ``ignore`` those to leave out; giving both is an
    error and giving neither takes every column. Unknown names under ``ignore`` are allowed.
    """
    if select and ignore:
        raise ValueError("give either the columns to select or those to ignore, not both")
    if select:
        require_columns(df, select, "selected columns")
        names = [n for n in df.columns if n in set(select)]
    else:
        names = [n for n in df.columns if n not in set(ignore or ())]
    return F.md5(concat_values(df, names, sep, null_token))


def row_key(df: DataFrame, keys: Sequence[str], sep: str = "") -> Column:
    """Fingerprint of the business key."""
    if not keys:
        raise ValueError("a business key needs at least one column")
    return md5_of(df, select=keys, sep=sep)


def row_md5(df: DataFrame, ignore: Sequence[str], sep: str = "") -> Column:
    """Fingerprint of the payload: every column that is not ignored."""
    return md5_of(df, ignore=ignore, sep=sep)

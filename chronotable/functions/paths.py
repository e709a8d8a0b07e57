"""Path expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    """What follows the last ``/``; the whole path if there is none."""
    return F.substring_index(path, "/", -1)


def replace_prefix(path: Column, source: str, target: str) -> Column:
    """Swap a leading ``source`` for ``target``; any other path is left alone.

    The prefix is literal text, so dots and brackets in a path mean themselves.
    """
    rest = F.substring(path, len(source) + 1, 2**31 - 1)
    return F.when(F.startswith(path, F.lit(source)), F.concat(F.lit(target), rest)).otherwise(path)


def file_kind(path: Column) -> Column:
    """Which kind of table metadata file a path names, judged by its base name."""
    # The name patterns of the three kinds.
    name = base_name(path)
    return (
        F.when(F.endswith(name, F.lit(".json")), "metadata")
        .when(
            F.startswith(name, F.lit("snap")) & F.endswith(name, F.lit(".avro")), "manifest_list"
        )
        .otherwise("manifest")
    )

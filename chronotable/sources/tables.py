"""Catalog tables."""

from __future__ import annotations

import contextlib
import hashlib
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotable.functions.columns import as_schema, col, quoted, require_columns, text_literal
from chronotable.sources.workspace import create_once, names_in, remove

DAY = "day"


def _identifier(name: str) -> str:
    return ".".join(quoted(part) for part in name.split("."))


def day_column(name: str) -> str:
    """Name of the derived partition column for a day transform."""
    return f"{name}_day"


def with_days(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the derived day of each column."""
    require_columns(df, columns, "partition columns")
    return df.withColumns({day_column(n): F.to_date(col(n)) for n in columns})


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    base_location: str | None = None,
    transform: str | None = None,
) -> DataFrame:
    """The named table, created empty unless it is there.

    It is partitioned by the values of ``partition_by``, or by their days when ``transform`` is
    ``day`` (in any letter case), which adds one date column each. With ``base_location`` it lives
    in the folder of its own name below that.
    """
    by_day = (transform or "").lower() == DAY
    fields = list(schema.fields)
    if by_day:
        fields += [T.StructField(day_column(n), T.DateType()) for n in partition_by]
    partitions = [day_column(n) if by_day else n for n in partition_by]
    ddl = f"CREATE TABLE IF NOT EXISTS {_identifier(name)} ({T.StructType(fields).toDDL()})"
    ddl += " USING parquet"
    if partitions:
        ddl += f" PARTITIONED BY ({', '.join(quoted(n) for n in partitions)})"
    if base_location is not None:
        ddl += f" LOCATION {text_literal(base_location.rstrip('/') + '/' + name.split('.')[-1])}"
    spark.sql(ddl)
    return spark.table(_identifier(name))


def create_table_like(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    base_location: str | None = None,
    transform: str | None = None,
) -> DataFrame:
    """``create_table`` with the schema of a frame; no rows are written."""
    return create_table(
        df.sparkSession, name, df.schema, partition_by, base_location, transform
    )


def append(df: DataFrame, name: str) -> None:
    """Add rows to a table, by column name.

    Day columns of the table are derived here. Rows are first gathered by partition value, with
    large values split and small ones put together, so a partition gets few files of even size.
    """
    spark = df.sparkSession
    partitions = partition_columns(spark, name)
    days = [n.removesuffix("_day") for n in partitions if n not in df.columns]
    rows = with_days(df, days) if days else df
    if partitions:
        rows = rows.hint("rebalance", *[col(n) for n in partitions])
    rows.write.mode("append").partitionBy(*partitions).saveAsTable(_identifier(name))


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(_identifier(name)) if c.isPartition]


def derived_days(spark: SparkSession, name: str) -> list[str]:
    """The columns of a table whose days are its partition columns."""
    types = dict(spark.table(_identifier(name)).dtypes)
    partitions = partition_columns(spark, name)
    days = [n.removesuffix("_day") for n in partitions if n.endswith("_day") and types[n] == "date"]
    return [n for n in days if n in types]


def _location(spark: SparkSession, name: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {_identifier(name)}").where("col_name = 'Location'")
    return details.first()["data_type"].rstrip("/")


def contents(spark: SparkSession, name: str) -> str:
    """A digest of where a table's rows are: it changes with every file that is written, removed or replaced."""
    spark.catalog.refreshTable(_identifier(name))
    digest = hashlib.sha256(_location(spark, name).encode())
    for file in sorted(spark.table(_identifier(name)).inputFiles()):
        digest.update(file.encode())
    return digest.hexdigest()


def _claim(spark: SparkSession, name: str, seen: str) -> str:
    folder = _location(spark, name).rpartition("/")[0]
    return f"{folder}/_claims/{name.split('.')[-1]}-{seen}"


def abandon_change(spark: SparkSession, name: str) -> None:
    """Let a table be changed again after a driver died while it changed it."""
    remove(spark, _claim(spark, name, contents(spark, name)))


@contextlib.contextmanager
def changing(spark: SparkSession, name: str, seen: str) -> Iterator[None]:
    """Room for one change of a table whose ``contents`` were ``seen`` when the change was made up.

    Of several writers that saw the same contents one gets in; the others, and those that saw what is no longer there,
    fail and change nothing.
    """
    claim = _claim(spark, name, seen)
    if not create_once(spark, claim, ""):
        raise RuntimeError(f"{name} is being changed by another writer; if that one died, abandon_change lets others in")
    try:
        if contents(spark, name) != seen:
            raise RuntimeError(f"{name} has changed since its rows were read; nothing has been written")
        yield
    finally:
        remove(spark, claim)


def replace_rows(df: DataFrame, name: str, seen: str | None = None) -> DataFrame:
    """Give an unpartitioned table these rows, which may be made from the table's own.

    They are written to a folder of their own beside the table's, and the catalog then moves the table there
    in one step. What is read meanwhile is the old folder, which is left as it is until ``remove_replaced``. ``seen`` are the table's
    ``contents`` from before ``df`` was made; if they have changed, nothing is.
    """
    spark = df.sparkSession
    identifier = _identifier(name)
    if partition_columns(spark, name):
        raise ValueError(f"{name} is partitioned; its rows cannot be replaced in one step")
    location = _location(spark, name)
    path = f"{_VERSION.sub('', location)}-{uuid.uuid4().hex}"
    seen = seen or contents(spark, name)
    as_schema(df, spark.table(identifier).schema).write.parquet(path)
    try:
        with changing(spark, name, seen):
            spark.sql(f"ALTER TABLE {identifier} SET LOCATION {text_literal(path)}")
    except RuntimeError:
        remove(spark, path)
        raise
    spark.catalog.refreshTable(identifier)
    return spark.table(identifier)


_VERSION = re.compile(r"-[0-9a-f]{32}$")


def remove_replaced(spark: SparkSession, name: str) -> int:
    """Delete the folders that ``replace_rows`` left behind; returns how many. Frames that still read them fail afterwards."""
    location = _location(spark, name)
    folder, _, stem = _VERSION.sub("", location).rpartition("/")
    found = [n for n in names_in(spark, folder) if _VERSION.sub("", n) == stem and _VERSION.search(n)]
    old = [n for n in found if f"{folder}/{n}" != location and f"{folder}/{n}" != location.removeprefix("file:")]
    for n in old:
        remove(spark, f"{folder}/{n}")
    return len(old)


def _in_partitions(columns: Sequence[str], values: Sequence[str]) -> Column:
    """Whether a row is in one of the partitions given as ``partition_key``; Spark prunes the others."""
    return partition_key(columns).isin(list(values)) if values else F.lit(False)


def partition_key(columns: Sequence[str]) -> Column:
    """The partition values of a row as text, nulls included."""
    return F.to_json(F.struct(*[col(n) for n in columns]), {"ignoreNullFields": "false"})


def rows_in_partitions(spark: SparkSession, name: str, values: Sequence[str]) -> DataFrame:
    """A table's rows in some of its partitions; the files of others are not read."""
    return spark.table(_identifier(name)).where(_in_partitions(partition_columns(spark, name), values))


def replace_partitions(df: DataFrame, name: str, old: Sequence[str], seen: str) -> DataFrame:
    """Give the partitions ``old`` of a table, and those that ``df`` has rows of, the rows of ``df``; others are left alone.

    ``df`` must not read the table. One job writes all partitions by Spark's dynamic overwrite; those that have no row any more are dropped after it.
    """
    spark = df.sparkSession
    identifier = _identifier(name)
    columns = partition_columns(spark, name)
    rows = as_schema(df, spark.table(identifier).schema).hint("rebalance", *[col(n) for n in columns])
    key = partition_key(columns).alias("key")
    kept = {r.key for r in df.select(key).distinct().collect()}  # as many as partitions are touched
    gone = spark.table(identifier).select(*[col(n) for n in columns], key).distinct().where(F.col("key").isin([v for v in old if v not in kept]))
    with changing(spark, name, seen):
        # By paths: the catalog does not take every value, null among them, in a statement.
        emptied = {unquote(file.rpartition("/")[0]) for r in gone.collect() for file in rows_in_partitions(spark, name, [r.key]).inputFiles()}
        # By location: an insert into the table heeds the mode of the session alone.
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(_location(spark, name))
        for folder in emptied:
            remove(spark, folder)
        spark.sql(f"MSCK REPAIR TABLE {identifier} SYNC PARTITIONS")
    spark.catalog.refreshTable(identifier)
    return spark.table(identifier)


def create_bucketed_as(
    df: DataFrame,
    name: str,
    buckets: int,
    key: str,
    base_location: str | None = None,
) -> DataFrame:
    """Write a frame as a table clustered and sorted by ``key``.

    Joins and aggregates on the key then read it without a shuffle, one task per bucket, so choose
    a key whose values are many and even. Rows are gathered by key before the write, with large
    groups split, so that even a hot key would be written by several tasks.
    """
    writer = df.hint("rebalance", col(key)).write.bucketBy(buckets, key).sortBy(key)
    if base_location is not None:
        writer = writer.option("path", f"{base_location.rstrip('/')}/{name.split('.')[-1]}")
    writer.saveAsTable(_identifier(name))
    return df.sparkSession.table(_identifier(name))


def set_properties(spark: SparkSession, name: str, properties: Mapping[str, str]) -> None:
    pairs = ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {_identifier(name)} SET TBLPROPERTIES ({pairs})")


def get_property(spark: SparkSession, name: str, key: str) -> str | None:
    """Value of a table property, or None."""
    found = spark.sql(f"SHOW TBLPROPERTIES {_identifier(name)}").where(F.col("key") == key)
    row = found.first()
    return None if row is None else row["value"]

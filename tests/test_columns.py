import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronotable.operators.checks import assert_non_null, assert_single_value, assert_unique
from chronotable.operators.columns import (
    add_validity,
    enrich,
    prefix_columns,
    select_prefix,
    strip_prefix,
)
from chronotable.operators.rejects import REJECT_SCHEMA, reject_rows
from chronotable.operators.status import Status, status_name


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, "a", datetime.datetime(2021, 1, 1)), (2, None, datetime.datetime(2021, 1, 2))],
        "id int, name string, ts timestamp",
    )


def test_enrich_adds_md5_then_key(rows):
    enriched = enrich(rows, ["id"], ["id", "ts"])
    assert enriched.columns == ["id", "name", "ts", "row_md5", "row_key"]
    assert enriched.select("row_md5").collect()[0][0] == "0cc175b9c0f1b6a831c399e269772661"


@pytest.mark.parametrize("name", ["row_key", "ROW_MD5", "status"])
def test_reserved_names_are_refused(rows, name):
    with pytest.raises(ValueError, match="reserved"):
        enrich(rows.withColumn(name, F.lit(1)), ["id"], [])


def test_validity(rows):
    first = add_validity(rows, "ts").first()
    assert first.valid_from == datetime.datetime(2021, 1, 1)
    assert first.valid_to == datetime.datetime(9999, 12, 31)
    assert first.delete_indicator == "NA"


def test_prefixes(rows):
    joined = prefix_columns(rows, "right_")
    assert joined.columns == ["right_id", "right_name", "right_ts"]
    assert prefix_columns(rows, None).columns == rows.columns
    mixed = joined.withColumn("status", F.lit(1)).withColumn("left_x", F.lit(1))
    assert select_prefix(mixed, "right_", "status").columns[-1] == "status"
    assert select_prefix(mixed, "right_", " ").columns == joined.columns
    assert strip_prefix(joined, "right_").columns == rows.columns
    assert strip_prefix(joined, None).columns == joined.columns
    # Only the front, and only once.
    odd = rows.select(F.col("id").alias("right_right_id"), F.col("name").alias("a_right_"))
    assert strip_prefix(odd, "right_").columns == ["right_id", "a_right_"]


def test_non_null(rows, spark):
    checked = assert_non_null(rows, ["id", "ts"])
    assert [f.nullable for f in checked.schema.fields] == [False, True, False]
    assert checked.collect() == rows.collect()
    with pytest.raises(PySparkException, match="null in column name"):
        assert_non_null(rows).collect()


def test_unique(rows):
    assert_unique(rows, ["id"], "rows")
    with pytest.raises(ValueError, match="rows: more than one row"):
        assert_unique(rows.union(rows), ["id"], "rows")


def test_single_value(spark):
    files = spark.createDataFrame(
        [(2, "S3://Lake"), (2, "s3://lake"), (2, "S3://LAKE")], "v int, loc string"
    )
    assert assert_single_value(files, ["v"], ["loc"]).collect() == [(2, "S3://LAKE")]
    # Unlike a check that stops at the second agreeing file, a late difference is found.
    late = files.unionByName(spark.createDataFrame([(2, "s3://other")], files.schema))
    with pytest.raises(PySparkException, match="column loc holds more than one value"):
        assert_single_value(late, ["v"], ["loc"]).collect()
    gap = files.unionByName(spark.createDataFrame([(None, "s3://lake")], files.schema))
    with pytest.raises(PySparkException, match="column v holds more than one value"):
        assert_single_value(gap, ["v"], ["loc"]).collect()
    assert assert_single_value(files.limit(0), ["v"], ["loc"]).collect() == [(None, None)]


def test_status_names(spark):
    codes = spark.createDataFrame([(int(s),) for s in Status], "code int")
    names = [r[0] for r in codes.select(status_name(F.col("code"))).collect()]
    assert names == [s.name for s in Status]
    assert [int(s) for s in Status] == [0, 1, 2, 3, 4, 5, 6]
    with pytest.raises(PySparkException, match=r"unknown status code \d+"):
        codes.select(status_name(F.col("code") + 9)).collect()
    with pytest.raises(ValueError):
        Status(9)


def test_reject_rows(rows):
    rejected = reject_rows(rows.withColumn("status", F.lit(1)))
    assert rejected.columns == REJECT_SCHEMA.fieldNames()
    assert rejected.collect() == [
        ("DUPLICATE_IN_MICRO_BATCH", "[1,a,2021-01-01 00:00:00.0,1]"),
        ("DUPLICATE_IN_MICRO_BATCH", "[2,null,2021-01-02 00:00:00.0,1]"),
    ]

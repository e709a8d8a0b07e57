import datetime
import uuid
from collections import Counter

import pytest
from pyspark.errors import PySparkException

from chronotable.operators.merge import Merge
from chronotable.sources.readers import conform, inline_batch, read_csv
from chronotable.sources.tables import (
    append,
    create_bucketed_as,
    create_table,
    create_table_like,
    get_property,
    replace_rows,
    set_properties,
)


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


@pytest.fixture(scope="module")
def rows(spark):
    return inline_batch(
        spark,
        [
            (1, "a", datetime.datetime(2021, 1, 1, 5)),
            (2, "b", datetime.datetime(2021, 1, 1, 9)),
            (3, "a", datetime.datetime(9999, 12, 31)),
        ],
        "id int, kind string, valid_to timestamp",
    )


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def partitions(spark, name):
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def test_created_empty_and_once(spark, rows, name, tmp_path):
    made = create_table_like(rows, name, ["kind"], str(tmp_path))
    assert made.count() == 0
    assert {(f.name, f.dataType) for f in made.schema} == {
        (f.name, f.dataType) for f in rows.schema
    }
    append(rows, name)
    again = create_table(spark, name, rows.schema, ["kind"], str(tmp_path))
    assert again.count() == 3
    assert partitions(spark, name) == {"kind=a", "kind=b"}
    assert (tmp_path / name).is_dir()


@pytest.mark.parametrize("transform", ["day", "DAY"])
def test_day_partitions(spark, rows, name, tmp_path, transform):
    create_table_like(rows, name, ["valid_to"], str(tmp_path), transform)
    append(rows, name)
    append(rows.select("valid_to", "kind", "id"), name)
    assert spark.table(name).count() == 6
    assert partitions(spark, name) == {"valid_to_day=2021-01-01", "valid_to_day=9999-12-31"}
    assert spark.table(name).where("valid_to_day = DATE'2021-01-01'").count() == 4


def test_any_other_transform_means_the_values(spark, rows, name, tmp_path):
    create_table_like(rows, name, ["kind"], str(tmp_path), "month")
    append(rows, name)
    assert partitions(spark, name) == {"kind=a", "kind=b"}


def test_unpartitioned(spark, rows, name, tmp_path):
    create_table_like(rows, name, [], str(tmp_path))
    append(rows, name)
    assert bag(spark.table(name)) == bag(rows)


def test_properties(spark, rows, name, tmp_path):
    create_table_like(rows, name, [], str(tmp_path))
    set_properties(spark, name, {"test": "it's set", "other": "1"})
    assert get_property(spark, name, "test") == "it's set"
    assert get_property(spark, name, "nope") is None


def test_bucketed_table_is_read_without_a_shuffle(spark, rows, name, tmp_path):
    table = create_bucketed_as(rows, name, 4, "id", str(tmp_path))
    assert bag(table) == bag(rows)
    plan = table.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def write_csv(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


HEADER = "EMP_ID,First_Name,EMAIL,Salary,BOSS_ID,DEPARTMENT_ID"
FULL = [
    HEADER,
    "198,Dora,DORA,2600,124,50",
    "199,Dina,DINA,2600,124,50",
    "200,Jan,JAN,4400, - ,10",
]
UPDATE = [HEADER, "198,Dora,DORA,2600,124,50", "199,Dina,new@mail,1,124,50", "990,Di,DI,1,9,50"]


def test_csv(spark, tmp_path):
    full = read_csv(
        spark, write_csv(tmp_path / "full.csv", FULL), {"department_id": "string"}
    )
    assert full.dtypes == [
        ("emp_id", "int"), ("first_name", "string"), ("email", "string"),
        ("salary", "int"), ("boss_id", "string"), ("department_id", "string"),
    ]
    update = read_csv(spark, write_csv(tmp_path / "update.csv", UPDATE))
    # The same column is inferred as a number here: batches of one feed are made to agree.
    assert dict(update.dtypes)["boss_id"] == "int"
    assert conform(update, full.schema).schema == full.schema
    named = read_csv(spark, str(tmp_path / "update.csv"), schema="a int, b string, c string")
    assert named.columns == ["a", "b", "c"]


def test_conversion_that_fails_is_an_error(spark, tmp_path):
    full = read_csv(spark, write_csv(tmp_path / "full.csv", FULL))
    update = read_csv(spark, write_csv(tmp_path / "update.csv", UPDATE))
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        conform(full, update.schema).collect()


def test_merge_of_an_update_file(spark, tmp_path):
    full = read_csv(spark, write_csv(tmp_path / "full.csv", FULL), {"department_id": "string"})
    update = read_csv(spark, write_csv(tmp_path / "update.csv", UPDATE))
    done = (
        Merge(full, "i")
        .using(conform(update, full.schema), "d")
        .on("i.EMP_ID = d.EMP_ID")
        .when_matched("i.FIRST_NAME = 'Dora'")
        .delete()
        .when_matched()
        .update_expr({"EMAIL": "d.EMAIL"})
        .when_not_matched()
        .insert_all()
        .result()
    )
    assert {(r.emp_id, r.email, r.salary) for r in done.collect()} == {
        (199, "new@mail", 2600),
        (200, "JAN", 4400),
        (990, "DI", 1),
    }


def test_rows_are_replaced_by_ones_made_from_them(spark, tmp_path):
    name = "replaced"
    create_table(spark, name, spark.range(0).schema, base_location=str(tmp_path))
    append(spark.range(5), name)
    old = spark.table(name)
    assert replace_rows(old.where("id > 2").selectExpr("CAST(id AS INT) AS id"), name).count() == 2
    assert replace_rows(spark.table(name).union(spark.table(name)), name).count() == 4
    assert spark.sql(f"SELECT sum(id) FROM {name}").first()[0] == 14
    append(spark.range(1), name)
    assert spark.table(name).count() == 5
    create_table(spark, "in_parts", spark.range(0).selectExpr("id", "id AS p").schema, ["p"], str(tmp_path))
    with pytest.raises(ValueError, match="partitioned"):
        replace_rows(spark.range(1).selectExpr("id", "id AS p"), "in_parts")

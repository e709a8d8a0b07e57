import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronotable.plans.history import merge_history, merge_source, superseded

AS_OF = datetime.datetime(2024, 6, 1)
EARLIER = datetime.datetime(2020, 1, 1)
BASE = "custkey long, name string, active_ind string, end_dt timestamp"


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame(
        [(1, "old", "Y", None), (1, "older", "N", EARLIER), (2, "b", "Y", None)], BASE
    )


@pytest.fixture(scope="module")
def landing(spark):
    return spark.createDataFrame([(1, "new"), (3, "c")], "custkey long, name string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_landing(base, landing):
    done = merge_history(base, landing, "custkey", F.lit(AS_OF))
    assert rows(done) == sorted(
        [
            (1, "old", "N", AS_OF),
            (1, "older", "N", EARLIER),
            (1, "new", "Y", None),
            (2, "b", "Y", None),
            (3, "c", "Y", None),
        ],
        key=str,
    )


def test_landing_the_same_again_makes_another_version(base, landing):
    once = merge_history(base, landing, "custkey", F.lit(AS_OF))
    later = AS_OF + datetime.timedelta(days=1)
    twice = merge_history(once, landing, "custkey", F.lit(later))
    assert twice.where("custkey = 3").count() == 2
    assert rows(twice.where("custkey = 3 AND active_ind = 'N'")) == [(3, "c", "N", later)]


def test_source(base, landing):
    assert rows(superseded(base, landing, "custkey").select(base.columns)) == [
        (1, "old", "Y", None)
    ]
    merge_keys = [r.key_match for r in merge_source(base, landing, "custkey", F.lit(AS_OF)).collect()]
    assert sorted(merge_keys, key=str) == [1, None, None]


def test_landing_must_not_carry_the_flag(base, landing):
    with pytest.raises(ValueError, match="active_ind"):
        merge_history(base, landing.withColumn("active_ind", F.lit("Y")), "custkey", F.lit(AS_OF))


def test_two_open_versions_of_one_key(base, landing):
    broken = base.unionByName(base.where("name = 'old'"))
    with pytest.raises(PySparkException, match="more than one source row"):
        merge_history(broken, landing, "custkey", F.lit(AS_OF)).collect()

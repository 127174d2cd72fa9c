"""Each suite names its failures, and a clean table passes."""

import pytest

from meterline.operators.quality import passed
from meterline.plans import suites


def test_clean_dimension_passes(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "code int, name string")
    passed(suites.dimension(rows, "code"))
    with pytest.raises(ValueError, match=r"not_null\(code\): 1; unique\(code\): 1"):
        passed(suites.dimension(rows.unionAll(rows.where("code = 1").limit(1)).unionAll(
            spark.createDataFrame([(None, "c")], rows.schema)
        ), "code"))


def test_name_counts(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 1)], "name string, player_count bigint")
    passed(suites.name_counts(counts))
    with pytest.raises(ValueError, match=r"positive\(player_count\): 1; row count is greater than zero: 1"):
        passed(suites.name_counts(spark.createDataFrame([("a", 0)], counts.schema)))
    with pytest.raises(ValueError, match="row count is greater than zero: 1"):
        passed(suites.name_counts(counts.limit(0)))

"""What the driver holds while a warehouse is loaded and published."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlake.plans.registry import REGISTRY
from ledgerlake.session import LOAD_CONF, loading


def test_settings_of_a_load_end_with_it(spark):
    key = next(iter(LOAD_CONF))
    spark.conf.set(key, "false")
    with pytest.raises(ValueError), loading(spark):
        assert spark.conf.get(key) == "true"
        raise ValueError
    assert spark.conf.get(key) == "false"
    spark.conf.unset(key)
    with loading(spark):
        pass
    assert spark.conf.get(key, None) != "true"


def test_a_dimension_small_on_disk_only_is_not_broadcast(spark, tmp_path):
    name = F.concat(F.lit("a product of the same brand and season "), (F.col("id") % 9).cast("string"))
    spark.range(500_000).select("id", name.alias("name")).write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    plan = lambda: spark.range(10**9).join(dim, "id").groupBy("name").count()._jdf.queryExecution().executedPlan().toString()
    with loading(spark):
        assert "BroadcastHashJoin" not in plan()


def test_the_views_are_not_counted_by_one_plan(spark):
    df = REGISTRY["publish_views"](spark, SF_SMALL)
    assert "Scan parquet" not in df._jdf.queryExecution().executedPlan().toString() and df.count() == 16
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema] == [("view_name", "string", False), ("row_count", "bigint", False)]

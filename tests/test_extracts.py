"""The eight extracts are derived in one scan of their tables, to the cent."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlake.sources import testdata


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("dataset", list(testdata.RULES))
def test_an_extract_reads_its_table_once(spark, dataset):
    plan = _plan(testdata.raw_frame(spark, SF_SMALL, dataset))
    counted = dataset == "pos_transactions_raw"  # suppliers, as a scalar
    assert "Union" not in plan and plan.count("Relation [") == len(testdata._SOURCE_TABLES[dataset]) + counted


@pytest.mark.parametrize("dataset", ["pos_items_raw", "pos_transactions_raw", "returns_raw"])
def test_copies_of_a_row(spark, dataset):
    rule = testdata.RULES[dataset]
    source = testdata._source_frame(spark, SF_SMALL, dataset).filter(F.expr(rule.where))
    once, again, refused = source.count(), source.filter(F.expr(rule.repeat or "false")).count(), source.filter(F.expr(rule.refused[0])).count()
    out = testdata.raw_frame(spark, SF_SMALL, dataset)
    assert out.count() == once + again + refused and refused > 0
    assert out.filter(F.col(rule.refused[1]).eqNullSafe(F.expr(rule.refused[2]))).count() == refused


def test_cents_become_money_without_a_division(spark):
    rule = "CAST(CAST(CAST(n AS DECIMAL(18,0)) / 100 AS DECIMAL(12,2)) AS STRING)"
    fast = testdata._spark_sql(rule)
    assert fast != rule and not any("/ 100" in testdata._spark_sql(c) and "DECIMAL(18,0)) / 100" in testdata._spark_sql(c)
                                    for r in testdata.RULES.values() for c in r.columns.values())
    df = spark.createDataFrame([(n,) for n in (0, 1, -1, 99, 100, -12345, 999999999999, -999999999999, None)], "n long")
    assert df.filter(~F.expr(fast).eqNullSafe(F.expr(rule))).count() == 0

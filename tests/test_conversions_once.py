"""Conversions are evaluated once a row, not once for each mention in a filter."""

import pytest

from conftest import SF_SMALL
from helpers import PRODUCT, STORE, pos_header, pos_item, rows, warehouse
from ledgerlake.functions import convert as cv
from ledgerlake.plans.registry import warehouse_for
from pyspark.sql import functions as F


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("table", ["pos_transactions", "pos_items", "ecom_orders", "ecom_items", "inventory_snapshots", "returns", "stores"])
def test_no_filter_repeats_a_conversion(spark, table):
    w = warehouse_for(spark, SF_SMALL)
    filters = [line for line in _plan(w.silver(table)).splitlines() if "Filter " in line]
    assert filters and not any("RLIKE" in line for line in filters)


def test_sales_lines_are_converted_before_they_are_filtered(spark):
    plan = _plan(warehouse_for(spark, SF_SMALL).fact_sales_items())
    assert not any("RLIKE" in line for line in plan.splitlines() if "Filter " in line and "price" in line)


def test_with_once_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("1",)], "a string")
    out = cv.with_once(df, _n=cv.try_id("a"), _c=F.lit("k"))
    assert out.columns == ["a", "_n", "_c"] and dict(out.dtypes)["_n"] == "bigint"
    assert sorted(out.collect(), key=str) == sorted([("1", 1, "k"), ("x", None, "k"), (None, None, "k"), ("1", 1, "k")], key=str)
    assert out.filter("_n = 1").count() == 2


def test_lines_with_unreadable_or_missing_values(spark):
    w = warehouse(spark, stores=[STORE], products=[PRODUCT], pos_transactions=[pos_header("T1")],
                  pos_items=[pos_item("T1"), pos_item("T2", qty="1.5"), pos_item("T3", price="2.00", total="9.99"), dict(pos_item("T4"), product_id="12x"),
                             dict(pos_item("T5"), unit_price=None)])
    got = rows(w.silver("pos_items"), "transaction_id", "is_bad_qty", "is_bad_price", "is_line_total_mismatch")
    assert got == [("T1", 0, 0, 0), ("T2", 1, 0, 0), ("T3", 0, 0, 1), ("T5", 0, 1, 0)]

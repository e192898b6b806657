"""Facts that take no duplicates find them without a second reading of their rows."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import PRODUCT, STORE, pos_header, pos_item, raw, rows, warehouse
from ledgerlake.operators import gold, silver
from ledgerlake.operators.dedup import dedup_flag, dedup_once
from ledgerlake.plans.registry import warehouse_for


def test_sales_lines_are_converted_once(spark):
    plan = warehouse_for(spark, SF_SMALL).fact_sales_items()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE(unit_price#") == 2  # one for each extract


def test_once_is_what_the_mark_leaves(spark):
    df = spark.createDataFrame([("a", 1, None, "x"), ("a", 2, 5, None), ("a", 2, None, "y"), ("b", 1, 7, "z"), ("b", 3, None, None), ("b", 3, None, None)],
                               "k string, n int, v int, s string")
    want = dedup_flag(df, ["k", "n"]).filter("is_duplicate = 0")
    got = dedup_once(df, ["k", "n"])
    assert got.columns == want.columns and rows(got) == rows(want) == [("a", 1, None, "x", 0), ("b", 1, 7, "z", 0)]


def test_rows_not_valid_count_as_copies_and_refused_ones_do_not(spark):
    # T1 has a copy with a bad quantity, T2 one whose product cleaning refuses.
    items = [pos_item("T1"), pos_item("T1", qty="1.5"), pos_item("T2"), dict(pos_item("T2"), product_id="12x"), pos_item("T3"), pos_item("T3")]
    df = raw(spark, "pos_items_raw", items)
    assert [r[0] for r in rows(silver.unique_rows(df, "pos_items"), "transaction_id")] == ["T2"]
    w = warehouse(spark, stores=[STORE], products=[PRODUCT], pos_transactions=[pos_header(t) for t in ("T1", "T2", "T3", "T3")], pos_items=items)
    marked = gold.fact_sales_items(w.silver("pos_items"), w.silver("pos_transactions"), w.silver("ecom_items"), w.silver("ecom_orders"),
                                   w.dim_product(), w.dim_store(), w.dim_date())
    assert rows(w.fact_sales_items()) == rows(marked) and rows(marked.select("transaction_id")) == [("T2",)]


def test_a_key_that_may_be_null_is_refused(spark):
    with pytest.raises(ValueError):
        silver.unique_rows(raw(spark, "inventory_snapshots_raw", []), "inventory_snapshots")


def test_written_silver_is_read(spark):
    w = warehouse(spark, pos_items=[pos_item("T1")])
    again = type(w)(spark, {}, w.date_range, {"silver_pos_items": w.silver("pos_items").withColumn("is_duplicate", F.lit(0))})
    assert rows(again.unique("pos_items"), "transaction_id") == [("T1",)]

"""What is derived once instead of once for each use."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import PRODUCT, STORE, inv, pos_header, pos_item, warehouse
from ledgerlake.operators import quality
from ledgerlake.plans import views
from ledgerlake.plans.registry import warehouse_for


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("table, column", [("pos_items", "line_total"), ("ecom_items", "line_total"), ("pos_transactions", "store_id"),
                                           ("inventory_snapshots", "inventory_value"), ("returns", "refund_amount")])
def test_duplicate_marking_converts_only_what_it_needs(spark, table, column):
    assert _plan(warehouse_for(spark, SF_SMALL).silver(table)).count(f"RLIKE({column}#") == 1


def test_revenue_summary_builds_the_fact_once(spark):
    w = warehouse_for(spark, SF_SMALL)
    lines = lambda df: _plan(df).count("l_extendedprice#")
    assert lines(views.view_revenue_summary(w)) == lines(views.sq2_revenue_by_channel(w))


def test_revenue_summary_counts_orders_and_lines(spark):
    two = dict(PRODUCT, product_id="2")
    w = warehouse(spark, stores=[STORE], products=[PRODUCT, PRODUCT, two], pos_transactions=[pos_header("T1"), pos_header("T2")],
                  pos_items=[pos_item("T1"), pos_item("T2"), dict(pos_item("T2"), product_id="2")])
    fact, p = w.fact_sales_items(), w.dim_product()
    want = fact.join(p.select("product_sk", "margin"), "product_sk").agg(F.sum("quantity"), F.sum("line_revenue"), F.sum(F.col("margin") * F.col("quantity"))).first()
    got = views.view_revenue_summary(w).collect()
    assert [r["source_system"] for r in got] == ["POS"] and got[0]["total_transactions"] == 2
    assert (got[0]["total_units_sold"], got[0]["total_revenue"], got[0]["total_margin"]) == tuple(want)


def test_silver_key_audit_reads_a_table_once_and_keeps_empty_ones(spark):
    w = warehouse(spark, stores=[STORE], products=[PRODUCT], inventory_snapshots=[
        inv("2024-03-01", store="1", pid=PRODUCT["product_id"]), inv("2024-03-02", store="77", pid="88"), inv("no day", store="1", pid="88")])
    silver, gold = ({t: get(t) for t in names} for get, names in (
        (w.silver, ["pos_transactions", "pos_items", "ecom_orders", "ecom_items", "inventory_snapshots", "returns"]), (w.gold, ["dim_product", "dim_store", "dim_date"])))
    got = {r["relation"]: tuple(r)[1:] for r in quality.silver_key_audit(silver, gold).collect()}
    assert len(got) == len(quality.SILVER_RELATIONS)
    assert got["silver_inventory_snapshots.product_id -> dim_product"] == (3, 0, 2)
    assert got["silver_inventory_snapshots.store_id -> dim_store"] == (3, 0, 1)
    assert got["silver_inventory_snapshots.day -> dim_date"] == (3, 1, 0)
    assert got["silver_returns.day -> dim_date"] == (0, 0, 0)
    big = warehouse_for(spark, SF_SMALL)
    plan = _plan(quality.silver_key_audit({t: big.silver(t) for t in silver}, {t: big.gold(t) for t in gold}))
    assert plan.count("RLIKE(inventory_value#") == 1


@pytest.mark.parametrize("table", ["pos_items", "ecom_orders"])
def test_refused_rows_are_found_by_one_conversion(spark, table):
    plan = _plan(warehouse_for(spark, SF_SMALL).quarantine(table))
    assert not any("try_cast" in line for line in plan.splitlines() if "Filter " in line)

"""Plan-shape checks for the scale properties the design relies on."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import STORE, inv, warehouse
from ledgerlake.operators import quality
from ledgerlake.plans import views
from ledgerlake.plans.registry import warehouse_for


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def w(spark):
    return warehouse_for(spark, SF_SMALL)


def test_duplicate_marking_uses_no_window(w):
    # A window over the key would put a hot key's rows into one task.
    for t in ("pos_transactions", "pos_items", "inventory_snapshots", "returns"):
        assert "Window" not in _plan(w.silver(t)), t


def test_hot_key_is_flagged(spark):
    # One key holds a third of the rows.
    rows = [inv(f"2024-03-{d:02d}", store="1", pid=str(d)) for d in range(1, 21)]
    rows += [inv("2024-04-01", store="2", pid="7") for _ in range(10)]
    s = warehouse(spark, stores=[STORE], inventory_snapshots=rows).silver("inventory_snapshots")
    got = {r["store_id"]: r["n"] for r in s.filter("is_duplicate = 1").groupBy("store_id").agg(F.count("*").alias("n")).collect()}
    assert got == {2: 10}


def test_view_scans_are_pruned(spark, w, tmp_path):
    built = w.materialize(str(tmp_path / "wh"))
    plan = _plan(views.sq2_revenue_by_channel(built))
    read = [line for line in plan.splitlines() if "ReadSchema" in line or "FileScan" in line]
    assert read and all("unit_price" not in line and "transaction_id" not in line for line in read)


def test_fk_audit_has_no_cartesian_join(w):
    plan = _plan(quality.fk_audit({t: w.gold(t) for t in ("dim_date", "dim_product", "dim_store",
                                                        "fact_pos_transactions", "fact_ecom_orders",
                                                        "fact_sales_items", "fact_returns",
                                                        "fact_inventory_snapshots")}))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_keep_latest_hot_key_without_window(spark):
    from ledgerlake.operators.dedup import dedup_keep_latest

    rows = [dict(STORE, store_id=str(i)) for i in range(1, 11)]
    rows += [dict(STORE, store_id="99", store_name=f"v{i}", _ts=dt.datetime(2024, 1, 1 + i)) for i in range(10)]
    typed = warehouse(spark, stores=rows).silver_typed("stores")
    latest = dedup_keep_latest(typed, ["store_id"])
    assert "Window" not in _plan(latest)
    got = {r["store_id"]: r["store_name"] for r in latest.collect()}
    assert len(got) == 11 and got[99] == "v9"

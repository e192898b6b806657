"""Golden counts on the sf0.001 testdata frames (FIXTURES section 4)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlake.operators import quality
from ledgerlake.plans.registry import warehouse_for


@pytest.fixture(scope="module")
def w(spark):
    return warehouse_for(spark, SF_SMALL)


def _count(df, cond):
    return df.filter(cond).count()


def test_silver_flags(w):
    pt = w.silver("pos_transactions")
    assert [_count(pt, F.col(c) == 1) for c in ("is_duplicate", "is_bad_date", "is_bad_store", "is_bad_total")] == [16, 14, 16, 15]
    assert _count(pt, F.col("total_amount").isNull() & (F.col("is_bad_total") == 0)) == 12
    eo = w.silver("ecom_orders")
    assert [_count(eo, F.col(c) == 1) for c in ("is_duplicate", "is_bad_date", "is_bad_total")] == [16, 13, 15]
    assert _count(eo, F.col("total_amount") < 0) == 12
    for t, exp in (("pos_items", [45, 40, 35, 264]), ("ecom_items", [1317, 60, 25, 244])):
        df = w.silver(t)
        got = [_count(df, F.col("is_duplicate") == 1), _count(df, F.col("is_bad_qty") == 1),
               _count(df, F.col("quantity").isNull() & (F.col("is_bad_qty") == 0)),
               _count(df, F.col("is_line_total_mismatch") == 1)]
        assert got == exp, t
    inv = w.silver("inventory_snapshots")
    assert [_count(inv, F.col("is_duplicate") == 1), _count(inv, F.col("is_bad_date") == 1),
            _count(inv, F.col("is_below_safety_stock") == 1), _count(inv, F.col("ending_inventory").isNull())] == [222, 92, 2138, 1031]
    r = w.silver("returns")
    assert [_count(r, F.col("is_duplicate") == 1), _count(r, F.col("is_bad_return_date") == 1),
            _count(r, F.col("is_bad_qty") == 1), _count(r, F.col("is_bad_refund") == 1),
            _count(r, F.col("quantity_returned").isNull() & (F.col("is_bad_qty") == 0))] == [28, 11, 36, 14, 13]
    p = w.silver("products")
    assert [_count(p, F.col("is_negative_margin") == 1), _count(p, F.col("price").isNull())] == [36, 2]


def test_gold_sizes(w):
    assert (w.dim_store().count(), w.dim_product().count()) == (9, 200)
    assert w.fact_pos_transactions().count() == 621
    assert w.fact_ecom_orders().count() == 714
    f = w.fact_sales_items()
    assert (_count(f, F.col("source_system") == "POS"), _count(f, F.col("source_system") == "ECOM")) == (2171, 1473)
    fr = w.fact_returns()
    assert (fr.count(), fr.select("return_id").distinct().count()) == (649, 644)
    assert w.fact_inventory_snapshots().count() == 5213
    audit = quality.grain_audit({"fact_sales_items": f}, {"fact_sales_items": quality.FACT_GRAINS["fact_sales_items"]})
    assert audit.collect()[0]["duplicate_keys"] == 6


def test_invariants(w):
    from ledgerlake.plans import views

    # Channel revenues add up to the total; shares sum to 1.
    rs = views.view_revenue_summary(w).collect()
    total = w.fact_sales_items().agg(F.sum("line_revenue")).collect()[0][0]
    assert sum(r["total_revenue"] for r in rs) == total
    assert abs(sum(r["revenue_share_pct"] for r in rs) - 1.0) < 1e-3
    # Fan-out form never reports fewer returns than the safe form.
    fan = {r["product_id"]: r["total_returns"] for r in views.view_returns_summary(w).collect()}
    safe = {r["product_id"]: r["total_returns"] for r in views.returns_summary_safe(w).collect()}
    assert all(fan[k] >= safe[k] for k in safe)
    # Dimension grains hold.
    gold = {t: w.gold(t) for t in ("dim_product", "dim_store", "dim_date")}
    assert all(r["duplicate_keys"] == 0 for r in quality.grain_audit(gold, quality.DIM_GRAINS).collect())

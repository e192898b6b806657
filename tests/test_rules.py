"""One test per semantic finding (hand-written rows, FIXTURES rule tables)."""

from decimal import Decimal

from pyspark.sql import functions as F

from helpers import (PRODUCT, STORE, ecom_item, ecom_order, inv, pos_header, pos_item, raw, ret, rows,
                     warehouse)
from ledgerlake.operators import quality
from ledgerlake.operators.dedup import dedup_keep_latest
from ledgerlake.plans import views
from ledgerlake.plans.registry import gold_natural


def test_q1_q2_duplicates_flag_every_copy(spark):
    import datetime as dt
    a = dict(STORE, store_id="1")
    b1 = dict(STORE, store_id="2", store_name="old", _ts=dt.datetime(2024, 1, 1))
    b2 = dict(STORE, store_id="2", store_name="new", _ts=dt.datetime(2024, 2, 1))
    w = warehouse(spark, stores=[a, b1, b2])
    assert rows(w.silver("stores"), "store_id", "is_duplicate") == [(1, 0), (2, 1), (2, 1)]
    assert rows(w.dim_store(), "store_id") == [(1,)]
    latest = dedup_keep_latest(w.silver_typed("stores"), ["store_id"])
    assert rows(latest, "store_id", "store_name") == [(1, "S"), (2, "new")]


def test_q3_null_keys_never_flagged(spark):
    w = warehouse(spark, inventory_snapshots=[inv("bad"), inv("bad")])
    assert rows(w.silver("inventory_snapshots"), "is_duplicate", "is_bad_date") == [(0, 1), (0, 1)]


def test_q4_products_not_deduplicated(spark):
    w = warehouse(spark, products=[PRODUCT, dict(PRODUCT, sku="other")])
    assert w.dim_product().count() == 2
    audit = quality.grain_audit({"dim_product": w.dim_product()}, {"dim_product": ["product_id"]})
    assert rows(audit, "duplicate_keys", "duplicate_rows") == [(1, 2)]


def test_q5_silver_and_core_net_revenue(spark):
    w = warehouse(spark, ecom_orders=[ecom_order("E1", total="100", disc="10", ship="5")])
    assert rows(w.silver("ecom_orders"), "net_revenue") == [(Decimal("95.00"),)]
    assert rows(w.fact_ecom_orders(), "net_revenue") == [(Decimal("85.00"),)]


def test_q6_q7_pos_net_revenue(spark):
    w = warehouse(spark, stores=[STORE], pos_transactions=[
        pos_header("T1", total="100", disc="10", tax="7"),
        pos_header("T2", total="-1.00", disc="2", tax="3"),
    ])
    s = rows(w.silver("pos_transactions"), "transaction_id", "total_amount", "is_bad_total")
    assert s == [("T1", Decimal("100.00"), 0), ("T2", None, 0)]
    f = rows(w.fact_pos_transactions(), "transaction_id", "net_revenue")
    assert f == [("T1", Decimal("97.00")), ("T2", Decimal("1.00"))]


def test_q8_ecom_negative_total_kept(spark):
    w = warehouse(spark, ecom_orders=[ecom_order("E1", total="-20.00")])
    assert rows(w.silver("ecom_orders"), "total_amount") == [(Decimal("-20.00"),)]


def test_q9_q10_line_items(spark):
    w = warehouse(spark, pos_items=[
        pos_item("T1", qty="-2", price="3.00", total="-6.00"),
        pos_item("T2", qty="2", price="5.00", total="10.05"),
        pos_item("T3", qty="2", price="5.00", total="10.06"),
        pos_item("T4", qty="2", price="5.00", total="x"),
        pos_item("T5", qty="2", price="abc", total="x"),
    ])
    got = rows(w.silver("pos_items"), "transaction_id", "quantity", "line_total", "calculated_line_total",
               "is_line_total_mismatch", "is_bad_qty", "is_bad_price", "is_bad_line_total")
    assert got == [
        ("T1", None, None, Decimal("-6.00"), 0, 0, 0, 0),
        ("T2", 2, Decimal("10.05"), Decimal("10.00"), 0, 0, 0, 0),
        ("T3", 2, Decimal("10.06"), Decimal("10.00"), 1, 0, 0, 0),
        ("T4", 2, None, Decimal("10.00"), 0, 0, 0, 1),
        ("T5", 2, None, Decimal("0.00"), 0, 0, 1, 1),
    ]


def test_q11_return_quantity_flags(spark):
    w = warehouse(spark, returns=[ret("R1", "T1", qty="0"), ret("R2", "T1", qty=None), ret("R3", "T1", qty="3")])
    got = rows(w.silver("returns"), "return_id", "is_bad_qty", "quantity_returned")
    assert got == [("R1", 1, None), ("R2", 0, None), ("R3", 0, 3)]


def _sales_world(spark, n_lines=3, units="10", returns_units=("1", "1")):
    headers = [pos_header(f"T{i}") for i in range(n_lines)]
    items = [pos_item(f"T{i}", qty=units, price="1.00") for i in range(n_lines)]
    rets = [ret(f"R{i}", "T0", qty=q) for i, q in enumerate(returns_units)]
    return warehouse(spark, products=[PRODUCT], stores=[STORE], pos_transactions=headers, pos_items=items,
                     returns=rets)


def test_q12_returns_summary_fan_out(spark):
    w = _sales_world(spark)
    got = rows(views.view_returns_summary(w), "total_returns", "units_returned", "return_rate")
    assert got == [(6, 6, 0)]
    safe = rows(views.returns_summary_safe(w), "total_returns", "units_returned", "units_sold", "return_rate")
    assert safe == [(2, 2, 30, 0.0667)]


def test_q13_q14_truncating_averages(spark):
    w = warehouse(spark, products=[PRODUCT], stores=[STORE], pos_transactions=[pos_header("T1")],
                  pos_items=[pos_item("T1", qty="10", price="1.00")],
                  inventory_snapshots=[inv("2024-03-01", end="3"), inv("2024-03-02", end="4")])
    kpi = views.view_kpi_overview(w).collect()[0]
    assert kpi["inventory_turnover"] == 3
    t = views.view_inventory_turnover(w).collect()[0]
    assert (t["avg_inventory_units"], t["inventory_turnover_ratio"]) == (3, 3.33)


def test_q15_duplicated_header_fans_out_returns(spark):
    w = warehouse(spark, products=[PRODUCT], stores=[STORE],
                  pos_transactions=[pos_header("T1"), pos_header("T1")], returns=[ret("R1", "T1")])
    assert w.fact_returns().count() == 2
    audit = quality.grain_audit({"fact_returns": w.fact_returns()}, {"fact_returns": ["return_id"]})
    assert rows(audit, "duplicate_keys") == [(1,)]


def test_q16_ecom_grain_violation(spark):
    w = warehouse(spark, products=[PRODUCT], ecom_orders=[ecom_order("E1")],
                  ecom_items=[ecom_item("1", "E1"), ecom_item("2", "E1")])
    assert w.fact_sales_items().count() == 2
    grain = {"fact_sales_items": quality.FACT_GRAINS["fact_sales_items"]}
    audit = quality.grain_audit({"fact_sales_items": w.fact_sales_items()}, grain)
    assert rows(audit, "duplicate_keys", "duplicate_rows") == [(1, 2)]


def test_q17_quarantine_not_null(spark):
    w = warehouse(spark, pos_items=[pos_item("T1", pid="abc"), pos_item("T2")])
    accepted, rejected = quality.quarantine_split(w.silver_typed("pos_items"), "pos_items")
    assert rows(rejected, "transaction_id", "reject_reason") == [("T1", "product_id IS NULL")]
    assert rows(w.silver("pos_items"), "transaction_id") == [("T2",)]


def test_q18_csv_quoted_commas(spark, tmp_path):
    from ledgerlake.sources.csv_loader import load_raw_csv

    p = tmp_path / "stores_raw.csv"
    p.write_text("store_id,store_name,store_type,region,address,opening_date,manager_id\n"
                 '1,S,Mall,Ontario,"1 King St, Toronto, ON",2020-01-01,M1\n')
    got = load_raw_csv(spark, "stores_raw", str(p)).collect()[0]
    assert got["address"] == "1 King St, Toronto, ON"
    assert (got["opening_date"], got["manager_id"]) == ("2020-01-01", "M1")


def test_q19_full_refresh_is_idempotent(spark, tmp_path):
    from ledgerlake.plans.warehouse import GOLD_TABLES, SILVER_TABLES

    def content(wh):
        out = {t: rows(wh.silver(t).drop("load_timestamp")) for t in SILVER_TABLES}
        out.update({t: rows(gold_natural(wh, t)) for t in GOLD_TABLES})
        return out

    w = _sales_world(spark)
    first = content(w.materialize(str(tmp_path / "wh"), parallel=2))
    second = content(w.materialize(str(tmp_path / "wh"), parallel=2))
    assert first == second
    assert first["fact_sales_items"]


def test_q21_outside_calendar_dropped(spark):
    w = warehouse(spark, stores=[STORE], pos_transactions=[pos_header("T1", ts="2025-01-01 10:00:00")])
    assert w.fact_pos_transactions().count() == 0


def test_q22_b30_refund_through_silver(spark):
    from ledgerlake.plans.questions import b30_traffic_net_after_returns

    w = warehouse(spark, products=[PRODUCT], ecom_orders=[ecom_order("E1", total="100")],
                  returns=[ret("R1", "E1", refund="30.00")])
    got = rows(b30_traffic_net_after_returns(w), "refunds", "net_after_returns")
    assert got == [(Decimal("30.00"), Decimal("70.00"))]


def test_q23_products_sharing_a_name(spark):
    p2 = dict(PRODUCT, product_id="6", sku="S6")
    w = warehouse(spark, products=[PRODUCT, p2], stores=[STORE], pos_transactions=[pos_header("T1")],
                  pos_items=[pos_item("T1", pid="5", qty="1", price="2.00"), pos_item("T1", pid="6", qty="1", price="3.00")])
    assert rows(views.sq3_top10_products(w)) == [("X", Decimal("5.00"))]


def test_q24_return_rate_by_channel_repeats_returns(spark):
    w = warehouse(spark, products=[PRODUCT], stores=[STORE], pos_transactions=[pos_header("T1")],
                  pos_items=[pos_item("T1", qty="4", price="1.00")], ecom_orders=[ecom_order("E1")],
                  ecom_items=[ecom_item("1", "E1", qty="6", price="1.00")], returns=[ret("R1", "T1", qty="2")])
    got = rows(views.sq5_return_rate_by_channel(w), "source_system", "returned_units", "sold_units", "return_rate")
    assert got == [("ECOM", 2, 6, Decimal("0.33")), ("POS", 2, 4, Decimal("0.50"))]


def test_q25_surrogate_keys_independent_of_order(spark):
    stores = [dict(STORE, store_id=str(i), store_name=f"S{i}") for i in range(20)]
    a = warehouse(spark, stores=stores).dim_store()
    b = warehouse(spark, stores=list(reversed(stores))).dim_store()
    assert rows(a, "store_id", "store_sk") == rows(b, "store_id", "store_sk")

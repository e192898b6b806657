"""Tier 2: the defined KPI formulas, one function per metric.

All aggregate on the fact tables with map-side partial aggregation; the
only windows are per (product, store) snapshot series, whose size is
bounded by the calendar (one snapshot per day by grain).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.ratios import long_sum, money_sum, ratio
from ledgerlake.plans.warehouse import Warehouse


def _channel_headers(w: Warehouse) -> DataFrame:
    """Order headers of both channels with one id column."""
    pos = w.fact_pos_transactions().select(
        F.lit("POS").alias("channel"), F.col("transaction_id").alias("order_id"), "date_sk", "net_revenue"
    )
    ecom = w.fact_ecom_orders().select(F.lit("ECOM").alias("channel"), "order_id", "date_sk", "net_revenue")
    return pos.unionByName(ecom)


def m_total_revenue(w: Warehouse) -> DataFrame:
    return w.fact_sales_items().agg(money_sum("line_revenue").alias("total_revenue"))


def m_net_revenue(w: Warehouse) -> DataFrame:
    return _channel_headers(w).groupBy("channel").agg(money_sum("net_revenue").alias("net_revenue"))


def m_aov(w: Warehouse) -> DataFrame:
    g = _channel_headers(w).groupBy("channel").agg(
        F.sum("net_revenue").alias("_net"), F.count_distinct("order_id").alias("order_count")
    )
    return g.select(
        "channel", F.col("_net").cast("decimal(38,2)").alias("net_revenue"), "order_count",
        ratio("_net", "order_count", 2).alias("aov"),
    )


def m_units_sold(w: Warehouse) -> DataFrame:
    return w.fact_sales_items().agg(long_sum("quantity").alias("units_sold"))


def m_order_count(w: Warehouse) -> DataFrame:
    per = _channel_headers(w).groupBy("channel").agg(F.count_distinct("order_id").alias("order_count"))
    total = per.agg(F.lit("ALL").alias("channel"), F.sum("order_count").cast("bigint").alias("order_count"))
    return per.unionByName(total)


def m_unit_margin(w: Warehouse) -> DataFrame:
    return w.dim_product().select("product_id", "product_name", "price", "cost", F.col("margin").alias("unit_margin"))


def m_contribution_margin(w: Warehouse) -> DataFrame:
    per = w.fact_sales_items().groupBy("product_sk").agg(F.sum("quantity").alias("_qty"))
    p = w.dim_product().select("product_sk", "product_id", "product_name", "margin")
    j = per.join(p, "product_sk")
    return j.groupBy("product_id", "product_name").agg(
        long_sum("_qty").alias("units_sold"),
        money_sum(F.col("margin") * F.col("_qty")).alias("contribution_margin"),
    )


def m_inventory_value(w: Warehouse) -> DataFrame:
    per_day = w.fact_inventory_snapshots().groupBy("date_sk").agg(money_sum("inventory_value").alias("inventory_value"))
    d = F.broadcast(w.dim_date().select("date_sk", "full_date"))
    return per_day.join(d, "date_sk").select("full_date", "inventory_value")


def _snapshots(w: Warehouse, rows: DataFrame | None = None) -> DataFrame:
    """Snapshots (or ``rows`` made of them) with day, store and product ids."""
    i = w.fact_inventory_snapshots() if rows is None else rows
    return (
        i.join(w.dim_product().select("product_sk", "product_id"), "product_sk")
        .join(w.dim_store().select("store_sk", "store_id"), "store_sk")
        .join(F.broadcast(w.dim_date().select("date_sk", "full_date")), "date_sk")
    )


def m_inventory_delta(w: Warehouse) -> DataFrame:
    return _snapshots(w).select(
        "full_date", "store_id", "product_id", "beginning_inventory", "ending_inventory",
        (F.col("ending_inventory") - F.col("beginning_inventory")).alias("inventory_delta"),
    )


def m_inventory_change(w: Warehouse) -> DataFrame:
    # One row per (product, store, date) by grain: the series is bounded by
    # the calendar length, so this window never holds an unbounded group. It
    # works on the fact's own keys; names are attached to what it returns.
    series = Window.partitionBy("product_sk", "store_sk").orderBy("date_sk")
    s = w.fact_inventory_snapshots().select("product_sk", "store_sk", "date_sk", "ending_inventory")
    s = s.withColumn("previous_ending", F.lag("ending_inventory").over(series))
    return _snapshots(w, s).select(
        "full_date", "store_id", "product_id", "ending_inventory", "previous_ending",
        (F.col("ending_inventory") - F.col("previous_ending")).alias("inventory_change"),
    )


def m_return_count(w: Warehouse) -> DataFrame:
    return w.fact_returns().agg(F.count_distinct("return_id").alias("return_count"))


def _returned_and_sold(w: Warehouse):
    r = w.fact_returns().agg(long_sum("quantity_returned").alias("units_returned"),
                             F.sum("refund_amount").alias("_refund"))
    s = w.fact_sales_items().agg(long_sum("quantity").alias("units_sold"), F.sum("line_revenue").alias("_rev"))
    return r, s


def m_unit_return_rate(w: Warehouse) -> DataFrame:
    r, s = _returned_and_sold(w)
    returned = r.select("units_returned").scalar()
    return s.select(
        returned.alias("units_returned"), "units_sold",
        ratio(returned, F.col("units_sold"), 4).alias("unit_return_rate"),
    )


def m_revenue_return_rate(w: Warehouse) -> DataFrame:
    r, s = _returned_and_sold(w)
    refund = r.select("_refund").scalar()
    return s.select(
        refund.cast("decimal(38,2)").alias("refund_amount"),
        F.col("_rev").cast("decimal(38,2)").alias("gross_revenue"),
        ratio(refund, F.col("_rev"), 4).alias("revenue_return_rate"),
    )


METRICS = {
    "m_total_revenue": m_total_revenue,
    "m_net_revenue": m_net_revenue,
    "m_aov": m_aov,
    "m_units_sold": m_units_sold,
    "m_order_count": m_order_count,
    "m_unit_margin": m_unit_margin,
    "m_contribution_margin": m_contribution_margin,
    "m_inventory_value": m_inventory_value,
    "m_inventory_delta": m_inventory_delta,
    "m_inventory_change": m_inventory_change,
    "m_return_count": m_return_count,
    "m_unit_return_rate": m_unit_return_rate,
    "m_revenue_return_rate": m_revenue_return_rate,
}

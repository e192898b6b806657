"""Gold -> semantic layer: the nine KPI views, their repaired variants and
the five sample queries. Each is a function ``Warehouse -> DataFrame``.

Output typing (identical in the SQL oracle): counts and unit sums BIGINT,
money sums DECIMAL(38,2), ratios DOUBLE rounded half-up from exact
decimals, truncating INT/INT results BIGINT.

Share-of-total columns are windowed over the *grouped* frame (a handful of
rows), never over the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.ratios import int_avg, int_div, long_sum, money_sum, product, ratio, ratio_decimal, safe_den
from ledgerlake.plans.warehouse import Warehouse


def _all() -> Window:
    """Window over the whole (already grouped, small) frame."""
    return Window.partitionBy()


def view_revenue_summary(w: Warehouse) -> DataFrame:
    f = w.fact_sales_items()
    # The fact is built once: grouping sets sum its lines per order and per
    # product, and the products' rows meet the product. COUNT(DISTINCT
    # source||'-'||id) within one source = its orders' rows.
    ids, sk = F.col("transaction_id"), F.col("product_sk")
    per = f.groupingSets([["source_system", "transaction_id"], ["source_system", "product_sk"]],
                         "source_system", "transaction_id", "product_sk").agg(
        F.grouping("product_sk").alias("_order"), F.sum("quantity").alias("_qty"), F.sum("line_revenue").alias("_rev"))
    # An order's row takes its own hash as key, so that such rows spread; it matches no product.
    per = per.withColumn("_key", F.when(F.col("_order") == 1, F.xxhash64(ids)).otherwise(sk))
    p = w.dim_product().select(F.col("product_sk").alias("_key"), F.lit(0).alias("_order"), "margin", F.lit(1).alias("_hit"))
    per = per.join(p, ["_key", "_order"], "left")
    hit = F.col("_hit") == 1
    g = per.groupBy("source_system").agg(
        F.count_if((F.col("_order") == 1) & ids.isNotNull()).alias("total_transactions"),
        long_sum(F.when(hit, F.col("_qty"))).alias("total_units_sold"),
        F.sum(F.when(hit, F.col("_rev"))).alias("_rev"),
        money_sum(F.when(hit, F.col("margin") * F.col("_qty"))).alias("total_margin"),
        F.count("_hit").alias("_hits"),
    ).filter((F.col("_hits") > 0) & F.col("source_system").isNotNull())
    return g.select(
        "source_system",
        "total_transactions",
        "total_units_sold",
        F.col("_rev").cast("decimal(38,2)").alias("total_revenue"),
        "total_margin",
        ratio(F.col("_rev"), F.sum("_rev").over(_all()), 4).alias("revenue_share_pct"),
    )


def _kpi_parts(w: Warehouse):
    f = w.fact_sales_items()
    sales = f.agg(
        F.count_distinct("source_system", "transaction_id").alias("total_transactions"),
        F.sum("line_revenue").alias("total_revenue"),
        long_sum("quantity").alias("units_sold"),
    )
    returned = w.fact_returns().agg(long_sum("quantity_returned").alias("units_returned"))
    inventory = w.fact_inventory_snapshots()
    return sales, returned, inventory


def view_kpi_overview(w: Warehouse) -> DataFrame:
    """One row. Average inventory is AVG over INT (truncated) and the
    turnover is INT / INT (truncated), as the reference computes them."""
    sales, returned, inventory = _kpi_parts(w)
    units_returned = returned.scalar()
    avg_inv = inventory.agg(int_avg("ending_inventory")).scalar()
    return sales.select(
        F.col("total_revenue").cast("decimal(38,2)").alias("total_revenue"),
        ratio("total_revenue", "total_transactions", 2).alias("avg_order_value"),
        "units_sold",
        ratio(units_returned, F.col("units_sold"), 4).alias("return_rate"),
        int_div(F.col("units_sold"), avg_inv).alias("inventory_turnover"),
    )


def kpi_overview_exact(w: Warehouse) -> DataFrame:
    """Repaired variant: decimal average inventory and decimal turnover."""
    sales, returned, inventory = _kpi_parts(w)
    units_returned = returned.scalar()
    inv = inventory.agg(F.sum("ending_inventory").alias("s"), F.count("ending_inventory").alias("n"))
    inv_sum, inv_n = inv.select("s").scalar(), inv.select("n").scalar()
    return sales.select(
        F.col("total_revenue").cast("decimal(38,2)").alias("total_revenue"),
        ratio("total_revenue", "total_transactions", 2).alias("avg_order_value"),
        "units_sold",
        ratio(units_returned, F.col("units_sold"), 4).alias("return_rate"),
        ratio(inv_sum, inv_n, 4).alias("avg_inventory_units"),
        ratio(product("units_sold", inv_n), inv_sum, 2).alias("inventory_turnover"),
    )


def view_daily_revenue(w: Warehouse) -> DataFrame:
    d = w.dim_date().select("date_sk", "full_date", "year_num", "month_num", "month_name")
    f = w.fact_sales_items()
    # Aggregate on the fact's own key first, then attach calendar columns
    # (the calendar is a bounded broadcast lookup).
    g = f.groupBy("date_sk", "source_system").agg(
        F.count_distinct("transaction_id").alias("total_transactions"),
        long_sum("quantity").alias("units_sold"),
        money_sum("line_revenue").alias("daily_revenue"),
    )
    return g.join(F.broadcast(d), "date_sk").select(
        "full_date", "year_num", "month_num", "month_name", "source_system",
        "total_transactions", "units_sold", "daily_revenue",
    )


def view_product_performance(w: Warehouse) -> DataFrame:
    keys = ["product_id", "product_name", "category", "subcategory", "brand"]
    f = w.fact_sales_items().groupBy("product_sk").agg(
        long_sum("quantity").alias("units_sold"),
        F.sum("line_revenue").alias("_rev"),
        F.sum("unit_price").alias("_price_sum"),
        F.count("unit_price").alias("_price_n"),
        F.sum("quantity").alias("_qty"),
    )
    # Pre-aggregate per product on the fact, then join the dimension once
    # per product. margin * quantity summed = margin * sum(quantity) per
    # product since margin is constant per product row.
    p = w.dim_product().select("product_sk", "margin", *keys)
    j = f.join(p, "product_sk").withColumn("_m", F.col("margin") * F.col("_qty"))
    g = j.groupBy(*keys).agg(
        long_sum("units_sold").alias("units_sold"),
        F.sum("_rev").alias("_rev"),
        F.sum("_price_sum").alias("_price_sum"),
        F.sum("_price_n").alias("_price_n"),
        F.sum("_m").alias("_margin"),
    )
    return g.select(
        *keys,
        "units_sold",
        F.col("_rev").cast("decimal(38,2)").alias("total_revenue"),
        ratio("_price_sum", "_price_n", 2).alias("avg_selling_price"),
        F.col("_margin").cast("decimal(38,2)").alias("total_margin"),
        ratio("_margin", "_rev", 4).alias("gross_margin_pct"),
    )


def _per_product_sales(w: Warehouse) -> DataFrame:
    """Fact pre-aggregated to product grain (one shuffle of partial sums)."""
    return w.fact_sales_items().groupBy("product_sk").agg(
        F.sum("quantity").alias("_qty"),
        F.sum("line_revenue").alias("_rev"),
        F.count(F.lit(1)).alias("_lines"),
    )


def view_category_performance(w: Warehouse) -> DataFrame:
    per_product = _per_product_sales(w)
    p = w.dim_product().select("product_sk", "category", "subcategory", "margin")
    j = per_product.join(p, "product_sk").withColumn("_m", F.col("margin") * F.col("_qty"))
    g = j.groupBy("category", "subcategory").agg(
        long_sum("_qty").alias("units_sold"),
        F.sum("_rev").alias("_rev"),
        F.sum("_m").alias("_margin"),
    )
    return g.select(
        "category", "subcategory", "units_sold",
        F.col("_rev").cast("decimal(38,2)").alias("category_revenue"),
        ratio("_margin", "_rev", 4).alias("category_gross_margin_pct"),
        ratio(F.col("_rev"), F.sum("_rev").over(_all()), 4).alias("category_revenue_share"),
    )


def view_store_performance(w: Warehouse) -> DataFrame:
    f = w.fact_pos_transactions().groupBy("store_sk").agg(
        F.count_distinct("transaction_id").alias("total_transactions"),
        F.sum("net_revenue").alias("_rev"),
    )
    s = w.dim_store().select("store_sk", "store_id", "store_name", "region")
    g = f.join(s, "store_sk").groupBy("store_id", "store_name", "region").agg(
        F.sum("total_transactions").cast("bigint").alias("total_transactions"),
        F.sum("_rev").alias("_rev"),
    )
    return g.select(
        "store_id", "store_name", "region", "total_transactions",
        F.col("_rev").cast("decimal(38,2)").alias("total_revenue"),
        ratio("_rev", "total_transactions", 2).alias("avg_transaction_value"),
    )


def view_inventory_snapshot(w: Warehouse) -> DataFrame:
    i = w.fact_inventory_snapshots()
    j = (
        i.join(w.dim_product().select("product_sk", "product_id"), "product_sk")
        .join(w.dim_store().select("store_sk", "store_id"), "store_sk")
        .join(F.broadcast(w.dim_date().select("date_sk", "full_date")), "date_sk")
    )
    return j.select(
        "full_date", "store_id", "product_id",
        "beginning_inventory", "ending_inventory", "safety_stock", "stock_status", "inventory_value",
        F.when(F.col("ending_inventory") == 0, 1).otherwise(0).alias("is_stock_out"),
        F.when(F.col("ending_inventory") < F.col("safety_stock"), 1).otherwise(0).alias("is_below_safety_stock"),
    )


def view_inventory_turnover(w: Warehouse) -> DataFrame:
    sales = w.fact_sales_items().groupBy("product_sk").agg(long_sum("quantity").alias("total_units_sold"))
    inv = w.fact_inventory_snapshots().groupBy("product_sk").agg(
        int_avg("ending_inventory").alias("avg_inventory_units")
    )
    p = w.dim_product().select("product_sk", "product_id", "product_name")
    j = sales.join(inv, "product_sk").join(p, "product_sk")
    return j.select(
        "product_id", "product_name", "total_units_sold", "avg_inventory_units",
        ratio("total_units_sold", "avg_inventory_units", 2).alias("inventory_turnover_ratio"),
    )


def _returns_per_product(w: Warehouse) -> DataFrame:
    return w.fact_returns().groupBy("product_sk").agg(
        F.count("return_id").alias("_n_returns"),
        F.count(F.lit(1)).alias("_return_rows"),
        F.sum("quantity_returned").alias("_units"),
        F.sum("refund_amount").alias("_refund"),
    )


def view_returns_summary(w: Warehouse) -> DataFrame:
    """As written: returns LEFT JOIN sales lines per product multiplies both
    sides. Computed algebraically from per-product aggregates - identical
    numbers without materialising returns x sales rows:
    return measures x max(1, sales lines), sales units x return rows.

    The products of counts are decimals: a hot product's lines x returns may
    exceed BIGINT. A count that does so even per product is reported as NULL."""
    r = _returns_per_product(w)
    s = _per_product_sales(w)
    p = w.dim_product().select("product_sk", "product_id", "product_name")
    j = r.join(p, "product_sk").join(s, "product_sk", "left")
    fan = F.greatest(F.coalesce(F.col("_lines"), F.lit(0)), F.lit(1))
    g = j.groupBy("product_id", "product_name").agg(
        F.sum(product("_n_returns", fan)).alias("_total"),
        F.sum(product("_units", fan)).alias("_returned"),
        F.sum((F.col("_refund") * fan).cast("decimal(38,2)")).cast("decimal(38,2)").alias("total_refund_amount"),
        F.sum(product("_qty", "_return_rows")).alias("_sold"),
    )
    whole = (F.col("_returned") - F.col("_returned") % safe_den("_sold")) / safe_den("_sold")
    return g.select(
        "product_id", "product_name",
        F.col("_total").try_cast("bigint").alias("total_returns"),
        F.col("_returned").try_cast("bigint").alias("units_returned"),
        "total_refund_amount",
        whole.try_cast("bigint").alias("return_rate"),
    )


def returns_summary_safe(w: Warehouse) -> DataFrame:
    """Repaired variant: each side aggregated alone, decimal return rate."""
    r = _returns_per_product(w)
    s = _per_product_sales(w)
    p = w.dim_product().select("product_sk", "product_id", "product_name")
    j = r.join(p, "product_sk").join(s, "product_sk", "left")
    g = j.groupBy("product_id", "product_name").agg(
        F.sum("_n_returns").cast("bigint").alias("total_returns"),
        F.sum("_units").cast("bigint").alias("units_returned"),
        F.sum("_refund").cast("decimal(38,2)").alias("total_refund_amount"),
        F.sum("_qty").cast("bigint").alias("units_sold"),
    )
    return g.select(
        "product_id", "product_name", "total_returns", "units_returned", "total_refund_amount", "units_sold",
        ratio("units_returned", "units_sold", 4).alias("return_rate"),
    )


# ----------------------------------------------------------------- samples
def sq1_monthly_net_revenue(w: Warehouse) -> DataFrame:
    headers = w.fact_pos_transactions().select("date_sk", "net_revenue").unionByName(
        w.fact_ecom_orders().select("date_sk", "net_revenue")
    )
    per_day = headers.groupBy("date_sk").agg(F.sum("net_revenue").alias("_net"))
    d = F.broadcast(w.dim_date().select("date_sk", "year_num", "month_num", "month_name"))
    return (
        per_day.join(d, "date_sk")
        .groupBy("year_num", "month_num", "month_name")
        .agg(money_sum("_net").alias("monthly_net_revenue"))
        .orderBy("year_num", "month_num")
    )


def sq2_revenue_by_channel(w: Warehouse) -> DataFrame:
    return w.fact_sales_items().groupBy("source_system").agg(money_sum("line_revenue").alias("total_revenue"))


def sq3_top10_products(w: Warehouse) -> DataFrame:
    per_product = _per_product_sales(w)
    p = w.dim_product().select("product_sk", "product_name")
    return (
        per_product.join(p, "product_sk")
        .groupBy("product_name")
        .agg(money_sum("_rev").alias("total_revenue"))
        .orderBy(F.col("total_revenue").desc(), F.col("product_name"))
        .limit(10)
    )


def sq4_below_safety_stock(w: Warehouse) -> DataFrame:
    i = w.fact_inventory_snapshots().filter(F.col("ending_inventory") < F.col("safety_stock"))
    return (
        i.join(w.dim_product().select("product_sk", "product_name"), "product_sk")
        .join(w.dim_store().select("store_sk", "store_name"), "store_sk")
        .select("product_name", "store_name", "ending_inventory", "safety_stock")
    )


def sq5_return_rate_by_channel(w: Warehouse) -> DataFrame:
    sales = w.fact_sales_items().groupBy("product_sk", "source_system").agg(long_sum("quantity").alias("sold_units"))
    returns = w.fact_returns().groupBy("product_sk").agg(long_sum("quantity_returned").alias("returned_units"))
    p = w.dim_product().select("product_sk", "product_name")
    return (
        sales.join(returns, "product_sk")
        .join(p, "product_sk")
        .select(
            "product_name", "source_system", "returned_units", "sold_units",
            ratio_decimal("returned_units", "sold_units", 5, 2).alias("return_rate"),
        )
        .orderBy(F.col("return_rate").desc_nulls_last())
    )


VIEWS = {
    "view_revenue_summary": view_revenue_summary,
    "view_kpi_overview": view_kpi_overview,
    "kpi_overview_exact": kpi_overview_exact,
    "view_daily_revenue": view_daily_revenue,
    "view_product_performance": view_product_performance,
    "view_category_performance": view_category_performance,
    "view_store_performance": view_store_performance,
    "view_inventory_snapshot": view_inventory_snapshot,
    "view_inventory_turnover": view_inventory_turnover,
    "view_returns_summary": view_returns_summary,
    "returns_summary_safe": returns_summary_safe,
    "sq1_monthly_net_revenue": sq1_monthly_net_revenue,
    "sq2_revenue_by_channel": sq2_revenue_by_channel,
    "sq3_top10_products": sq3_top10_products,
    "sq4_below_safety_stock": sq4_below_safety_stock,
    "sq5_return_rate_by_channel": sq5_return_rate_by_channel,
}


#: The views that the reference publishes; the others are repaired variants and samples.
PUBLISHED = [name for name in VIEWS if name.startswith("view_")]


def publish_views(w: Warehouse, prefix: str = "") -> list[str]:
    """Register the nine views as temp views of this session, over whatever
    the warehouse is built from (``published.publish`` makes lasting ones)."""
    for name in PUBLISHED:
        VIEWS[name](w).createOrReplaceTempView(prefix + name)
    return [prefix + name for name in PUBLISHED]

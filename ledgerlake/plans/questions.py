"""Tier 3: the documented business questions, answered on the gold model.

Conventions: every question pre-aggregates the fact to the grain it needs
before joining dimensions; period comparisons join on a month index
(year * 12 + month) shifted by 1 or 12, so missing months never pair the
wrong periods; windows are only used over series whose length is bounded
by the calendar (one row per month or per day by grain) or over small
grouped frames; whole-population rankings use the distributed rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.ratios import div_round, long_sum, money_sum, product, ratio
from ledgerlake.operators.ranking import global_rank, percent_rank
from ledgerlake.plans import metrics
from ledgerlake.plans.warehouse import Warehouse

# Parameters of the questions.
LOW_MARGIN_SHARE = 0.10           # of the price, or of the revenue
TOP_K = 10
STOCKOUT_WINDOW_ROWS = 6          # current snapshot and the five before it
OVERSTOCK_DAYS_OF_COVER = 90
ABNORMAL_Z = 2
LOW_TURNOVER_PCT_RANK = 0.25
RETURN_TO_SALES_CHANNEL = {"ONLINE": "ECOM", "IN_STORE": "POS"}


def _month_cols(date_sk: str = "date_sk"):
    d = F.col(date_sk)
    year = (d / 10000).cast("int")
    month = ((d / 100).cast("int") % 100).cast("int")
    return year.alias("year_num"), month.alias("month_num")


def _month_index() -> F.Column:
    return F.col("year_num") * 12 + F.col("month_num")


def _sales_month_product(w: Warehouse) -> DataFrame:
    f = w.fact_sales_items().select("product_sk", "quantity", "line_revenue", *_month_cols())
    return f.groupBy("product_sk", "year_num", "month_num").agg(
        F.sum("quantity").alias("units"), F.sum("line_revenue").alias("revenue")
    )


# ----------------------------------------------------------------- revenue
def b01_net_revenue_rollup(w: Warehouse) -> DataFrame:
    per_day = metrics._channel_headers(w).groupBy("date_sk").agg(F.sum("net_revenue").alias("_net"))
    d = F.broadcast(w.dim_date().select("date_sk", "full_date", "year_num", "month_num"))
    return (
        per_day.join(d, "date_sk")
        .rollup("year_num", "month_num", "full_date")
        .agg(F.grouping_id().cast("int").alias("grouping_level"), money_sum("_net").alias("net_revenue"))
        .select("year_num", "month_num", "full_date", "grouping_level", "net_revenue")
    )


def b03_top_products_categories(w: Warehouse) -> DataFrame:
    per = w.fact_sales_items().groupBy("product_sk").agg(
        F.sum("line_revenue").alias("_rev"), F.sum("quantity").alias("_qty")
    )
    p = w.dim_product().select("product_sk", "product_id", "product_name", "category")
    prod = per.join(p, "product_sk")
    frames = []
    for metric, col in (("revenue", "_rev"), ("units", "_qty")):
        top = prod.orderBy(F.col(col).desc_nulls_last(), "product_id").limit(TOP_K)
        frames.append(top.select(
            F.lit("product").alias("level"), F.lit(metric).alias("metric"),
            F.col("product_id").cast("string").alias("member"), F.col(col).cast("decimal(38,2)").alias("value"),
        ))
        cat = prod.groupBy("category").agg(F.sum(col).alias("_v"))
        top_c = cat.orderBy(F.col("_v").desc_nulls_last(), "category").limit(TOP_K)
        frames.append(top_c.select(
            F.lit("category").alias("level"), F.lit(metric).alias("metric"),
            F.col("category").alias("member"), F.col("_v").cast("decimal(38,2)").alias("value"),
        ))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    rank = F.row_number().over(Window.partitionBy("level", "metric").orderBy(F.col("value").desc(), "member"))
    return out.withColumn("position", rank.cast("bigint"))


def b04_store_ranking(w: Warehouse) -> DataFrame:
    from ledgerlake.plans.views import view_store_performance

    s = view_store_performance(w)
    return global_rank(s, "total_revenue", "revenue_rank").select(
        "store_id", "store_name", "region", "total_transactions", "total_revenue", "revenue_rank"
    )


def b05_aov_trend(w: Warehouse) -> DataFrame:
    h = metrics._channel_headers(w).select("channel", "order_id", "net_revenue", *_month_cols())
    g = h.groupBy("year_num", "month_num", "channel").agg(
        F.count_distinct("order_id").alias("order_count"), F.sum("net_revenue").alias("_net")
    )
    return g.select(
        "year_num", "month_num", "channel", "order_count",
        F.col("_net").cast("decimal(38,2)").alias("net_revenue"), ratio("_net", "order_count", 2).alias("aov"),
    )


def b06_price_volume_mix(w: Warehouse) -> DataFrame:
    """Month-over-month revenue change split into price, volume and mix.

    price  = sum over products sold in both months of r1 - r0 * q1 / q0
    volume = (Q1 - Q0) * R0 / Q0        (total units change at old avg price)
    mix    = (R1 - R0) - price - volume (everything else, incl. new/lost items)
    Each product term and the volume term are rounded to cents.
    """
    pm = _sales_month_product(w).withColumn("_mi", _month_index())
    # Previous month of the same product (exact RANGE frame; bounded series).
    prev_frame = Window.partitionBy("product_sk").orderBy("_mi").rangeBetween(-1, -1)
    both = (
        pm.withColumn("q0", F.sum("units").over(prev_frame))
        .withColumn("r0", F.sum("revenue").over(prev_frame))
        .withColumn("_has_prev", F.count(F.lit(1)).over(prev_frame))
        .filter((F.col("_has_prev") > 0) & (F.col("q0") != 0) & (F.col("units") != 0))
    )
    price_term = F.col("revenue") - div_round(F.col("r0") * F.col("units"), F.col("q0"), 2)
    price = both.groupBy("_mi").agg(F.sum(price_term).alias("_price"))
    tot = pm.groupBy("_mi").agg(F.sum("units").alias("Q"), F.sum("revenue").alias("R"))
    # Month totals: one row per calendar month, so a window over them is
    # bounded by the calendar.
    months = Window.orderBy("_mi").rangeBetween(-1, -1)
    t = (
        tot.withColumn("Q0", F.sum("Q").over(months)).withColumn("R0", F.sum("R").over(months))
        .withColumn("_has_prev", F.count(F.lit(1)).over(months))
        .filter((F.col("_has_prev") > 0) & (F.col("Q0") != 0))
        .join(price, "_mi", "left")
    )
    volume = div_round((F.col("Q") - F.col("Q0")) * F.col("R0"), F.col("Q0"), 2)
    price_effect = F.coalesce(F.col("_price"), F.lit(0))
    return t.select(
        ((F.col("_mi") - 1) / 12).cast("int").alias("year_num"),
        ((F.col("_mi") - 1) % 12 + 1).cast("int").alias("month_num"),
        F.col("R").cast("decimal(38,2)").alias("revenue"),
        F.col("R0").cast("decimal(38,2)").alias("prev_revenue"),
        price_effect.cast("decimal(38,2)").alias("price_effect"),
        volume.cast("decimal(38,2)").alias("volume_effect"),
        (F.col("R") - F.col("R0") - price_effect - volume).cast("decimal(38,2)").alias("mix_effect"),
    )


def _growth(per: DataFrame, key: str, dim: str) -> DataFrame:
    """Previous month / same month last year by an exact RANGE frame on the
    month index: the frame [mi-1, mi-1] holds the previous month's row if it
    exists and nothing otherwise, so gaps never pair the wrong months. One
    exchange on the key; the series per key is bounded by calendar months."""
    per = per.withColumn("_mi", _month_index())
    series = Window.partitionBy(key).orderBy("_mi")
    prev_m = F.sum("value").over(series.rangeBetween(-1, -1))
    prev_y = F.sum("value").over(series.rangeBetween(-12, -12))
    j = per.withColumn("prev_month_value", prev_m).withColumn("prev_year_value", prev_y)
    return j.select(
        F.lit(dim).alias("dimension"), F.col(key).cast("string").alias("member"), "year_num", "month_num",
        F.col("value").cast("decimal(38,2)").alias("revenue"),
        F.col("prev_month_value").cast("decimal(38,2)").alias("prev_month_revenue"),
        F.col("prev_year_value").cast("decimal(38,2)").alias("prev_year_revenue"),
        ratio(F.col("value") - F.col("prev_month_value"), F.col("prev_month_value"), 4).alias("mom_growth"),
        ratio(F.col("value") - F.col("prev_year_value"), F.col("prev_year_value"), 4).alias("yoy_growth"),
    )


def b07_mom_yoy_contribution(w: Warehouse) -> DataFrame:
    pm = _sales_month_product(w).join(w.dim_product().select("product_sk", "product_id"), "product_sk")
    prod = pm.groupBy("product_id", "year_num", "month_num").agg(F.sum("revenue").alias("value"))
    pos = w.fact_pos_transactions().select("store_sk", "net_revenue", *_month_cols())
    sm = pos.groupBy("store_sk", "year_num", "month_num").agg(F.sum("net_revenue").alias("value"))
    sm = sm.join(w.dim_store().select("store_sk", "store_id"), "store_sk").drop("store_sk")
    return _growth(prod, "product_id", "product").unionByName(_growth(sm, "store_id", "store"))


# ----------------------------------------------------------------- margin
def b08_unit_margin_rank(w: Warehouse) -> DataFrame:
    p = w.dim_product().select("product_id", "product_name", "category", F.col("margin").alias("unit_margin"))
    cat = p.groupBy("category").agg(F.sum("unit_margin").alias("_s"), F.count("unit_margin").alias("_n"))
    cat = cat.select("category", ratio("_s", "_n", 2).alias("category_avg_margin"))
    ranked = global_rank(p, "unit_margin", "margin_rank")
    # Null-safe: products without a category are a category of their own.
    return ranked.join(cat, ranked["category"].eqNullSafe(cat["category"])).select(
        "product_id", "product_name", ranked["category"], "unit_margin", "margin_rank", "category_avg_margin"
    )


def b09_contribution_rank(w: Warehouse) -> DataFrame:
    from ledgerlake.plans.views import view_product_performance

    v = view_product_performance(w).select("product_id", "product_name", "total_margin", "total_revenue")
    return global_rank(v, "total_margin", "margin_rank")


def b10_low_margin_products(w: Warehouse, low: float = LOW_MARGIN_SHARE) -> DataFrame:
    """Products that earn nothing, or little: margin or total margin of zero
    or less, else a share of margin in the price, or of total margin in the
    revenue, of at most ``low``. The first reason that holds is given."""
    per = w.fact_sales_items().groupBy("product_sk").agg(F.sum("quantity").alias("_qty"), F.sum("line_revenue").alias("_rev"))
    p = w.dim_product().select("product_sk", "product_id", "product_name", "price", "margin")
    j = p.join(per, "product_sk", "left").withColumn("total_margin", (F.col("margin") * F.col("_qty")).cast("decimal(38,2)"))
    j = j.withColumn("price_share", ratio("margin", "price", 4)).withColumn("revenue_share", ratio("total_margin", "_rev", 4))
    reason = (
        F.when(F.col("margin") <= 0, F.lit("unit_margin"))
        .when(F.col("total_margin") <= 0, F.lit("total_margin"))
        .when(F.col("price_share") <= low, F.lit("low_unit_margin"))
        .when(F.col("revenue_share") <= low, F.lit("low_total_margin"))
    )
    return j.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(
        "product_id", "product_name", F.col("margin").alias("unit_margin"), "total_margin",
        "price_share", "revenue_share", "reason"
    )


def b11_category_margin_share(w: Warehouse) -> DataFrame:
    per = w.fact_sales_items().groupBy("product_sk").agg(F.sum("quantity").alias("_qty"))
    p = w.dim_product().select("product_sk", "category", "subcategory", "margin")
    g = per.join(p, "product_sk").groupBy("category", "subcategory").agg(
        F.sum(F.col("margin") * F.col("_qty")).alias("_m"))
    total = g.agg(F.sum("_m")).scalar()
    return g.select("category", "subcategory", F.col("_m").cast("decimal(38,2)").alias("total_margin"),
                    ratio(F.col("_m"), total, 4).alias("margin_share"))


def b12_seasonal_vs_core(w: Warehouse) -> DataFrame:
    per = w.fact_sales_items().groupBy("product_sk").agg(F.sum("quantity").alias("_qty"), F.sum("line_revenue").alias("_rev"))
    p = w.dim_product().select("product_sk", "season", "margin")
    g = per.join(p, "product_sk").groupBy("season").agg(
        long_sum("_qty").alias("units_sold"), money_sum("_rev").alias("revenue"),
        money_sum(F.col("margin") * F.col("_qty")).alias("total_margin"))
    seg = F.when(F.col("season") == "ALL YEAR", "CORE").otherwise("SEASONAL")
    return g.select("season", seg.alias("segment"), "units_sold", "revenue", "total_margin")


def b13_margin_trend(w: Warehouse) -> DataFrame:
    p = w.dim_product().select("product_sk", "margin")
    monthly = _sales_month_product(w).join(p, "product_sk").groupBy("year_num", "month_num").agg(
        F.sum("revenue").alias("_rev"), F.sum(F.col("margin") * F.col("units")).alias("_m"))
    j = monthly.withColumn("quarter_num", ((F.col("month_num") + 2) / 3).cast("int"))
    frames = []
    for ptype, col in (("month", "month_num"), ("quarter", "quarter_num")):
        g = j.groupBy("year_num", col).agg(F.sum("_rev").alias("_rev"), F.sum("_m").alias("_m"))
        frames.append(g.select(
            F.lit(ptype).alias("period_type"), "year_num", F.col(col).alias("period_num"),
            F.col("_rev").cast("decimal(38,2)").alias("revenue"), F.col("_m").cast("decimal(38,2)").alias("total_margin"),
            ratio("_m", "_rev", 4).alias("gross_margin_pct"),
        ))
    return frames[0].unionByName(frames[1])


# ----------------------------------------------------------------- inventory
def b14_stockout_trend(w: Warehouse) -> DataFrame:
    s = w.fact_inventory_snapshots().select("product_sk", "store_sk", "date_sk", "ending_inventory", "safety_stock")
    # Series per (product, store): one row per snapshot day by grain. Names
    # are attached to the few rows that the filter leaves.
    frame = Window.partitionBy("product_sk", "store_sk").orderBy("date_sk").rowsBetween(-(STOCKOUT_WINDOW_ROWS - 1), 0)
    gap = F.col("ending_inventory") - F.col("safety_stock")
    r = s.withColumn("_gs", F.sum(gap).over(frame)).withColumn("_gn", F.count(gap).over(frame))
    r = r.withColumn("rolling_gap", ratio("_gs", "_gn", 2)).filter(F.col("rolling_gap") <= 0)
    return metrics._snapshots(w, r).select(
        "full_date", "store_id", "product_id", "ending_inventory", "safety_stock", "rolling_gap")


def b15_safety_stock_frequency(w: Warehouse) -> DataFrame:
    i = w.fact_inventory_snapshots().groupBy("product_sk").agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.count_if(F.col("ending_inventory") < F.col("safety_stock")).alias("below_safety_count"),
    )
    p = w.dim_product().select("product_sk", "product_id", "product_name")
    return i.join(p, "product_sk").select(
        "product_id", "product_name", "snapshots", "below_safety_count",
        ratio("below_safety_count", "snapshots", 4).alias("below_safety_share"))


def b16_inventory_value_trend(w: Warehouse) -> DataFrame:
    i = w.fact_inventory_snapshots().join(w.dim_product().select("product_sk", "category"), "product_sk")
    g = i.groupBy("date_sk", "store_sk", "category").agg(money_sum("inventory_value").alias("inventory_value"))
    g = g.join(w.dim_store().select("store_sk", "store_id"), "store_sk")
    g = g.join(F.broadcast(w.dim_date().select("date_sk", "full_date")), "date_sk")
    return g.select("full_date", "store_id", "category", "inventory_value")


def _store_turnover(w: Warehouse) -> DataFrame:
    sold = w.fact_sales_items().filter(F.col("source_system") == "POS").groupBy("store_sk").agg(
        F.sum("quantity").alias("units_sold"))
    inv = w.fact_inventory_snapshots().groupBy("store_sk").agg(
        F.sum("ending_inventory").alias("_is"), F.count("ending_inventory").alias("_in"))
    s = w.dim_store().select("store_sk", "store_id", "store_name")
    j = sold.join(inv, "store_sk").join(s, "store_sk")
    return j.select(
        "store_id", "store_name", F.col("units_sold").cast("bigint").alias("units_sold"),
        ratio("_is", "_in", 2).alias("avg_inventory"),
        ratio(product("units_sold", "_in"), F.col("_is"), 4).alias("turnover"),
    )


def b17_store_turnover(w: Warehouse) -> DataFrame:
    t = _store_turnover(w)
    return percent_rank(t, "turnover", "turnover_pct_rank").filter(
        F.col("turnover_pct_rank") <= LOW_TURNOVER_PCT_RANK)


def b18_turnover_trend(w: Warehouse) -> DataFrame:
    sold = w.fact_sales_items().filter(F.col("source_system") == "POS").select(
        "product_sk", "store_sk", "quantity", *_month_cols())
    sold = sold.groupBy("product_sk", "store_sk", "year_num", "month_num").agg(F.sum("quantity").alias("units_sold"))
    inv = w.fact_inventory_snapshots().select("product_sk", "store_sk", "ending_inventory", *_month_cols())
    inv = inv.groupBy("product_sk", "store_sk", "year_num", "month_num").agg(
        F.sum("ending_inventory").alias("_is"), F.count("ending_inventory").alias("_in"))
    keys = ["product_sk", "store_sk", "year_num", "month_num"]
    j = sold.join(inv, keys).join(w.dim_product().select("product_sk", "product_id"), "product_sk").join(
        w.dim_store().select("store_sk", "store_id"), "store_sk")
    return j.select(
        "year_num", "month_num", "product_id", "store_id", F.col("units_sold").cast("bigint").alias("units_sold"),
        ratio("_is", "_in", 2).alias("avg_inventory"),
        ratio(product("units_sold", "_in"), F.col("_is"), 4).alias("turnover"),
    )


def b19_demand_vs_stock(w: Warehouse) -> DataFrame:
    demand = _sales_month_product(w).select("product_sk", "year_num", "month_num", F.col("units").alias("_units"))
    inv = w.fact_inventory_snapshots().select("product_sk", "store_sk", "date_sk", "ending_inventory", *_month_cols())
    # Closing stock of the month per product and store = the latest snapshot.
    last = inv.groupBy("product_sk", "store_sk", "year_num", "month_num").agg(
        F.max_by("ending_inventory", "date_sk").alias("_close"))
    stock = last.groupBy("product_sk", "year_num", "month_num").agg(F.sum("_close").alias("_stock"))
    keys = ["product_sk", "year_num", "month_num"]
    j = demand.join(stock, keys, "full").join(w.dim_product().select("product_sk", "product_id"), "product_sk")
    units = F.coalesce(F.col("_units"), F.lit(0)).cast("bigint")
    stock_c = F.coalesce(F.col("_stock"), F.lit(0)).cast("bigint")
    return j.select(
        "product_id", "year_num", "month_num", units.alias("units_sold"), stock_c.alias("closing_stock"),
        ratio(stock_c, units, 2).alias("stock_to_demand"),
    )


def b20_overstock(w: Warehouse) -> DataFrame:
    inv = w.fact_inventory_snapshots().groupBy("product_sk", "store_sk").agg(
        F.sum("ending_inventory").alias("_is"), F.count("ending_inventory").alias("_in"),
        F.min("date_sk").alias("_d0"), F.max("date_sk").alias("_d1"))
    sold = w.fact_sales_items().filter(F.col("source_system") == "POS").groupBy("product_sk", "store_sk").agg(
        F.sum("quantity").alias("_units"))
    j = inv.join(sold, ["product_sk", "store_sk"], "left")
    d0 = F.to_date(F.col("_d0").cast("string"), "yyyyMMdd")
    d1 = F.to_date(F.col("_d1").cast("string"), "yyyyMMdd")
    days = (F.datediff(d1, d0) + 1).alias("days_observed")
    j = j.withColumn("days_observed", days).withColumn("units_sold", F.coalesce(F.col("_units"), F.lit(0)).cast("bigint"))
    # days of cover = avg stock / (units / days) = sum_stock * days / (n * units)
    cover = ratio(product("_is", "days_observed"), product("_in", "units_sold"), 1)
    j = j.withColumn("days_of_cover", cover)
    over = (F.col("days_of_cover") > OVERSTOCK_DAYS_OF_COVER) | ((F.col("units_sold") == 0) & (F.col("_is") > 0))
    j = j.filter(over).join(w.dim_product().select("product_sk", "product_id"), "product_sk").join(
        w.dim_store().select("store_sk", "store_id"), "store_sk")
    return j.select("product_id", "store_id", ratio("_is", "_in", 2).alias("avg_stock"), "units_sold",
                    "days_observed", "days_of_cover")


# ----------------------------------------------------------------- returns
def b21_return_rate_slices(w: Warehouse) -> DataFrame:
    p = w.dim_product().select("product_sk", "product_id", "category")
    # Return channel -> the sales channel it is compared with.
    channel = F.col("return_channel")
    for ret_channel, sales_channel in RETURN_TO_SALES_CHANNEL.items():
        channel = F.when(F.col("return_channel") == ret_channel, sales_channel).otherwise(channel)
    # Aggregate each fact to (product, month, channel) first; only that small
    # frame meets the dimension and is exploded into its four slices.
    grain = ["product_sk", "year_num", "month_num", "channel"]
    r = w.fact_returns().select("product_sk", "quantity_returned", *_month_cols(), channel.alias("channel"))
    r = r.groupBy(*grain).agg(F.sum("quantity_returned").alias("quantity_returned")).join(p, "product_sk")
    s = w.fact_sales_items().select("product_sk", "quantity", F.col("source_system").alias("channel"), *_month_cols())
    s = s.groupBy(*grain).agg(F.sum("quantity").alias("quantity")).join(p, "product_sk")
    slices = F.array(
        F.struct(F.lit("product").alias("slice"), F.col("product_id").cast("string").alias("member")),
        F.struct(F.lit("category").alias("slice"), F.col("category").alias("member")),
        F.struct(F.lit("channel").alias("slice"), F.col("channel").alias("member")),
        F.struct(F.lit("period").alias("slice"),
                 F.format_string("%04d-%02d", F.col("year_num"), F.col("month_num")).alias("member")),
    )
    rr = r.select(F.explode(slices).alias("_s"), "quantity_returned").select("_s.*", "quantity_returned") \
        .groupBy("slice", "member").agg(F.sum("quantity_returned").alias("_ret"))
    ss = s.select(F.explode(slices).alias("_s"), "quantity").select("_s.*", "quantity") \
        .groupBy("slice", "member").agg(F.sum("quantity").alias("_sold"))
    # Full outer per slice; a NULL member (e.g. no category) is one member.
    j = rr.join(ss, (rr["slice"] == ss["slice"]) & rr["member"].eqNullSafe(ss["member"]), "full").select(
        F.coalesce(rr["slice"], ss["slice"]).alias("slice"),
        F.coalesce(rr["member"], ss["member"]).alias("member"),
        F.coalesce(F.col("_ret"), F.lit(0)).cast("bigint").alias("returned_units"),
        F.coalesce(F.col("_sold"), F.lit(0)).cast("bigint").alias("sold_units"),
    )
    return j.withColumn("return_rate", ratio("returned_units", "sold_units", 4))


def b22_return_reasons(w: Warehouse) -> DataFrame:
    per = w.fact_returns().groupBy("return_reason", "product_sk").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("quantity_returned").alias("_units"), F.sum("refund_amount").alias("_refund"))
    r = per.join(w.dim_product().select("product_sk", "category"), "product_sk")
    g = r.groupBy("return_reason", "category").agg(
        long_sum("_n").alias("return_count"), long_sum("_units").alias("units_returned"),
        money_sum("_refund").alias("refund_amount"))
    # Share of each category within its reason, over the grouped frame.
    per_reason = Window.partitionBy("return_reason")
    return g.withColumn("share_of_reason", ratio(F.col("units_returned"), F.sum("units_returned").over(per_reason), 4))


def b23_refund_trend(w: Warehouse) -> DataFrame:
    r = w.fact_returns().select("refund_amount", "quantity_returned", *_month_cols())
    return r.groupBy("year_num", "month_num").agg(
        F.count(F.lit(1)).alias("return_count"), long_sum("quantity_returned").alias("units_returned"),
        money_sum("refund_amount").alias("refund_amount"))


def b25_return_channel_patterns(w: Warehouse) -> DataFrame:
    r = w.fact_returns()
    g = r.groupBy("return_channel").agg(
        F.count(F.lit(1)).alias("return_count"), long_sum("quantity_returned").alias("units_returned"),
        F.sum("refund_amount").alias("_refund"),
        F.count_if(F.col("return_reason") == "DEFECTIVE").alias("defective_count"),
        F.count_if(F.col("return_reason") == "DAMAGED").alias("damaged_count"),
        F.count_if(F.col("return_reason") == "SIZE_FIT").alias("size_fit_count"),
    )
    return g.select(
        "return_channel", "return_count", "units_returned", F.col("_refund").cast("decimal(38,2)").alias("refund_amount"),
        ratio("_refund", "return_count", 2).alias("avg_refund"), "defective_count", "damaged_count", "size_fit_count",
    )


def b26_abnormal_returns(w: Warehouse) -> DataFrame:
    """Months whose returned units are more than ABNORMAL_Z sample standard
    deviations above the product's mean. Tested exactly in integers:
    (n*x - S)^2 * (n-1) > z^2 * n * (n*S2 - S^2) with x above the mean."""
    r = w.fact_returns().select("product_sk", "quantity_returned", *_month_cols())
    pm = r.groupBy("product_sk", "year_num", "month_num").agg(F.sum("quantity_returned").cast("bigint").alias("units_returned"))
    stats = pm.groupBy("product_sk").agg(
        F.count("units_returned").alias("_n"), F.sum("units_returned").cast("decimal(38,0)").alias("_s"),
        F.sum(F.col("units_returned") * F.col("units_returned")).cast("decimal(38,0)").alias("_s2"))
    j = pm.join(stats, "product_sk")
    n, s, s2, x = F.col("_n").cast("decimal(38,0)"), F.col("_s"), F.col("_s2"), F.col("units_returned").cast("decimal(38,0)")
    dev = n * x - s
    abnormal = (F.col("_n") > 1) & (dev > 0) & (dev * dev * (n - 1) > ABNORMAL_Z * ABNORMAL_Z * n * (n * s2 - s * s))
    j = j.filter(abnormal).join(w.dim_product().select("product_sk", "product_id"), "product_sk")
    return j.select("product_id", "year_num", "month_num", "units_returned",
                    F.col("_n").alias("months_observed"), ratio("_s", "_n", 2).alias("mean_units"))


# ----------------------------------------------------------------- channels
def _ecom_orders(w: Warehouse) -> DataFrame:
    return w.fact_ecom_orders()


def b28_device_performance(w: Warehouse) -> DataFrame:
    g = _ecom_orders(w).groupBy("device_type").agg(
        F.count_distinct("order_id").alias("order_count"), F.sum("net_revenue").alias("_net"))
    return g.select("device_type", "order_count", F.col("_net").cast("decimal(38,2)").alias("net_revenue"),
                    ratio("_net", "order_count", 2).alias("aov"))


def b29_traffic_source_revenue(w: Warehouse) -> DataFrame:
    g = _ecom_orders(w).groupBy("traffic_source").agg(
        F.count_distinct("order_id").alias("order_count"), money_sum("total_amount").alias("gross_revenue"),
        money_sum("net_revenue").alias("net_revenue"))
    return g


def b30_traffic_net_after_returns(w: Warehouse) -> DataFrame:
    """Net revenue per traffic source after discounts and refunds. Gold
    returns carry no order id, so refunds come from clean returns, summed
    per order before the join (one row per order on each side)."""
    r = w.silver("returns").filter((F.col("is_duplicate") == 0) & (F.col("is_bad_refund") == 0))
    refunds = r.groupBy(F.col("transaction_id").alias("order_id")).agg(F.sum("refund_amount").alias("_refund"))
    o = _ecom_orders(w).join(refunds, "order_id", "left")
    g = o.groupBy("traffic_source").agg(
        F.count_distinct("order_id").alias("order_count"), F.sum("total_amount").alias("_gross"),
        F.sum("discount_amount").alias("_disc"), F.sum("net_revenue").alias("_net"),
        F.sum(F.coalesce(F.col("_refund"), F.lit(0))).alias("_ref"))
    return g.select(
        "traffic_source", "order_count",
        F.col("_gross").cast("decimal(38,2)").alias("gross_revenue"),
        F.col("_disc").cast("decimal(38,2)").alias("discounts"),
        F.col("_ref").cast("decimal(38,2)").alias("refunds"),
        (F.col("_net") - F.col("_ref")).cast("decimal(38,2)").alias("net_after_returns"),
    )


def b31_acquisition_behaviour(w: Warehouse) -> DataFrame:
    lines = w.fact_sales_items().filter(F.col("source_system") == "ECOM").groupBy(
        F.col("transaction_id").alias("order_id")).agg(F.sum("quantity").alias("_units"))
    o = _ecom_orders(w).join(lines, "order_id", "left")
    g = o.groupBy("channel", "traffic_source").agg(
        F.count_distinct("order_id").alias("order_count"), F.sum("net_revenue").alias("_net"),
        long_sum("_units").alias("units_sold"))
    return g.select("channel", "traffic_source", "order_count", "units_sold",
                    F.col("_net").cast("decimal(38,2)").alias("net_revenue"), ratio("_net", "order_count", 2).alias("aov"))


QUESTIONS = {
    "b01_net_revenue_rollup": b01_net_revenue_rollup,
    "b03_top_products_categories": b03_top_products_categories,
    "b04_store_ranking": b04_store_ranking,
    "b05_aov_trend": b05_aov_trend,
    "b06_price_volume_mix": b06_price_volume_mix,
    "b07_mom_yoy_contribution": b07_mom_yoy_contribution,
    "b08_unit_margin_rank": b08_unit_margin_rank,
    "b09_contribution_rank": b09_contribution_rank,
    "b10_low_margin_products": b10_low_margin_products,
    "b11_category_margin_share": b11_category_margin_share,
    "b12_seasonal_vs_core": b12_seasonal_vs_core,
    "b13_margin_trend": b13_margin_trend,
    "b14_stockout_trend": b14_stockout_trend,
    "b15_safety_stock_frequency": b15_safety_stock_frequency,
    "b16_inventory_value_trend": b16_inventory_value_trend,
    "b17_store_turnover": b17_store_turnover,
    "b18_turnover_trend": b18_turnover_trend,
    "b19_demand_vs_stock": b19_demand_vs_stock,
    "b20_overstock": b20_overstock,
    "b21_return_rate_slices": b21_return_rate_slices,
    "b22_return_reasons": b22_return_reasons,
    "b23_refund_trend": b23_refund_trend,
    "b25_return_channel_patterns": b25_return_channel_patterns,
    "b26_abnormal_returns": b26_abnormal_returns,
    "b28_device_performance": b28_device_performance,
    "b29_traffic_source_revenue": b29_traffic_source_revenue,
    "b30_traffic_net_after_returns": b30_traffic_net_after_returns,
    "b31_acquisition_behaviour": b31_acquisition_behaviour,
}

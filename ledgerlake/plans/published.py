"""The nine KPI views, kept in the session catalog as SQL over named tables.

``publish`` names the written Gold tables of a materialised warehouse in a
database and creates the views over them. The views are text, not plans: any
session of the application reads them (of every later application too, where
the catalog is a metastore; elsewhere ``publish`` on the same folder brings
them back), and they answer from whatever the named tables hold when they are
asked. Each gives the rows of the function of the same name in ``views``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.plans.warehouse import FACT_PARTITION, GOLD_TABLES


def _nonzero(d: str) -> str:
    return f"nullif({d}, 0)"


def _quotient(n: str, d: str, scale: int) -> str:
    """``ratios.div_round`` as SQL text: half-up from exact decimals."""
    near = f"round(try_cast({n} AS DECIMAL(24,6)) / {_nonzero(f'try_cast({d} AS DECIMAL(24,6))')}, {scale})"
    wide, den = f"CAST({n} AS DECIMAL(38,6))", _nonzero(f"CAST({d} AS DECIMAL(38,6))")
    whole = f"CAST((({wide} - {wide} % {den}) / {den}) AS DECIMAL(36,6))"
    rest = f"round(CAST(({wide} % {den}) / {den} AS DECIMAL(12,6)), {scale})"
    return f"coalesce({near}, CAST({whole} + {rest} AS DECIMAL(38,{scale})))"


def _ratio(n: str, d: str, scale: int) -> str:
    """``ratios.ratio`` as SQL text: the quotient as DOUBLE."""
    return f"CAST({_quotient(n, d, scale)} AS DOUBLE)"


def _truncated(n: str, d: str) -> str:
    """INT / INT, toward zero."""
    return f"CAST((({n}) - ({n}) % {_nonzero(d)}) / CAST({_nonzero(d)} AS DECIMAL(38,0)) AS BIGINT)"


def _money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(38,2))"


_AVG_STOCK = _truncated("sum(ending_inventory)", "count(ending_inventory)")
_PER_PRODUCT = """SELECT product_sk, sum(quantity) AS qty, sum(line_revenue) AS rev, count(*) AS n, sum(unit_price) AS price_sum, count(unit_price) AS price_n
  FROM {db}.fact_sales_items GROUP BY product_sk"""

DEFINITIONS: dict[str, str] = {
    "view_revenue_summary": f"""
SELECT source_system, total_transactions, total_units_sold, {_money('rev')} AS total_revenue, total_margin,
  {_ratio('rev', 'sum(rev) OVER ()', 4)} AS revenue_share_pct
FROM (
  SELECT s.source_system, CAST(sum(s.qty) AS BIGINT) AS total_units_sold, sum(s.rev) AS rev, {_money('sum(p.margin * s.qty)')} AS total_margin
  FROM (SELECT source_system, product_sk, sum(quantity) AS qty, sum(line_revenue) AS rev
        FROM {{db}}.fact_sales_items GROUP BY source_system, product_sk) s
  JOIN {{db}}.dim_product p ON p.product_sk = s.product_sk GROUP BY s.source_system
) g JOIN (SELECT source_system, count(DISTINCT transaction_id) AS total_transactions
          FROM {{db}}.fact_sales_items GROUP BY source_system) o USING (source_system)""",
    "view_kpi_overview": f"""
SELECT {_money('total_revenue')} AS total_revenue, {_ratio('total_revenue', 'total_transactions', 2)} AS avg_order_value, units_sold,
  {_ratio('returned', 'units_sold', 4)} AS return_rate, {_truncated('units_sold', 'avg_stock')} AS inventory_turnover
FROM (
  SELECT count(DISTINCT source_system, transaction_id) AS total_transactions, sum(line_revenue) AS total_revenue,
    CAST(sum(quantity) AS BIGINT) AS units_sold,
    (SELECT CAST(sum(quantity_returned) AS BIGINT) FROM {{db}}.fact_returns) AS returned,
    (SELECT {_AVG_STOCK} FROM {{db}}.fact_inventory_snapshots) AS avg_stock
  FROM {{db}}.fact_sales_items)""",
    "view_daily_revenue": f"""
SELECT d.full_date, d.year_num, d.month_num, d.month_name, g.source_system, g.total_transactions, g.units_sold, g.daily_revenue
FROM (SELECT date_sk, source_system, count(DISTINCT transaction_id) AS total_transactions,
        CAST(sum(quantity) AS BIGINT) AS units_sold, {_money('sum(line_revenue)')} AS daily_revenue
      FROM {{db}}.fact_sales_items GROUP BY date_sk, source_system) g
JOIN {{db}}.dim_date d ON d.date_sk = g.date_sk""",
    "view_product_performance": f"""
SELECT product_id, product_name, category, subcategory, brand, units_sold, {_money('rev')} AS total_revenue,
  {_ratio('price_sum', 'price_n', 2)} AS avg_selling_price, {_money('margin_sum')} AS total_margin,
  {_ratio('margin_sum', 'rev', 4)} AS gross_margin_pct
FROM (SELECT p.product_id, p.product_name, p.category, p.subcategory, p.brand, CAST(sum(s.qty) AS BIGINT) AS units_sold,
        sum(s.rev) AS rev, sum(s.price_sum) AS price_sum, sum(s.price_n) AS price_n, sum(p.margin * s.qty) AS margin_sum
      FROM ({_PER_PRODUCT}) s JOIN {{db}}.dim_product p ON p.product_sk = s.product_sk
      GROUP BY p.product_id, p.product_name, p.category, p.subcategory, p.brand)""",
    "view_category_performance": f"""
SELECT category, subcategory, units_sold, {_money('rev')} AS category_revenue,
  {_ratio('margin_sum', 'rev', 4)} AS category_gross_margin_pct, {_ratio('rev', 'sum(rev) OVER ()', 4)} AS category_revenue_share
FROM (SELECT p.category, p.subcategory, CAST(sum(s.qty) AS BIGINT) AS units_sold, sum(s.rev) AS rev, sum(p.margin * s.qty) AS margin_sum
      FROM ({_PER_PRODUCT}) s JOIN {{db}}.dim_product p ON p.product_sk = s.product_sk GROUP BY p.category, p.subcategory)""",
    "view_store_performance": f"""
SELECT store_id, store_name, region, total_transactions, {_money('rev')} AS total_revenue,
  {_ratio('rev', 'total_transactions', 2)} AS avg_transaction_value
FROM (SELECT s.store_id, s.store_name, s.region, CAST(sum(g.n) AS BIGINT) AS total_transactions, sum(g.rev) AS rev
      FROM (SELECT store_sk, count(DISTINCT transaction_id) AS n, sum(net_revenue) AS rev
            FROM {{db}}.fact_pos_transactions GROUP BY store_sk) g
      JOIN {{db}}.dim_store s ON s.store_sk = g.store_sk GROUP BY s.store_id, s.store_name, s.region)""",
    "view_inventory_snapshot": """
SELECT d.full_date, s.store_id, p.product_id, i.beginning_inventory, i.ending_inventory, i.safety_stock, i.stock_status, i.inventory_value,
  CASE WHEN i.ending_inventory = 0 THEN 1 ELSE 0 END AS is_stock_out,
  CASE WHEN i.ending_inventory < i.safety_stock THEN 1 ELSE 0 END AS is_below_safety_stock
FROM {db}.fact_inventory_snapshots i JOIN {db}.dim_product p ON p.product_sk = i.product_sk
JOIN {db}.dim_store s ON s.store_sk = i.store_sk JOIN {db}.dim_date d ON d.date_sk = i.date_sk""",
    "view_inventory_turnover": f"""
SELECT p.product_id, p.product_name, s.total_units_sold, i.avg_inventory_units,
  {_ratio('s.total_units_sold', 'i.avg_inventory_units', 2)} AS inventory_turnover_ratio
FROM (SELECT product_sk, CAST(sum(quantity) AS BIGINT) AS total_units_sold FROM {{db}}.fact_sales_items GROUP BY product_sk) s
JOIN (SELECT product_sk, {_AVG_STOCK} AS avg_inventory_units FROM {{db}}.fact_inventory_snapshots GROUP BY product_sk) i
  ON i.product_sk = s.product_sk
JOIN {{db}}.dim_product p ON p.product_sk = s.product_sk""",
    # Returns x sales lines of a product, as products of sums per product (see views.view_returns_summary).
    "view_returns_summary": f"""
SELECT product_id, product_name, try_cast(total AS BIGINT) AS total_returns, try_cast(returned AS BIGINT) AS units_returned, total_refund_amount,
  try_cast((returned - returned % {_nonzero('sold')}) / {_nonzero('sold')} AS BIGINT) AS return_rate
FROM (SELECT p.product_id, p.product_name,
        sum(CAST(r.n_returns AS DECIMAL(19,0)) * CAST(greatest(coalesce(s.n, 0), 1) AS DECIMAL(18,0))) AS total,
        sum(CAST(r.units AS DECIMAL(19,0)) * CAST(greatest(coalesce(s.n, 0), 1) AS DECIMAL(18,0))) AS returned,
        {_money("sum(" + _money("r.refund * greatest(coalesce(s.n, 0), 1)") + ")")} AS total_refund_amount,
        sum(CAST(s.qty AS DECIMAL(19,0)) * CAST(r.n_rows AS DECIMAL(18,0))) AS sold
      FROM (SELECT product_sk, count(return_id) AS n_returns, count(*) AS n_rows, sum(quantity_returned) AS units, sum(refund_amount) AS refund
            FROM {{db}}.fact_returns GROUP BY product_sk) r
      JOIN {{db}}.dim_product p ON p.product_sk = r.product_sk
      LEFT JOIN ({_PER_PRODUCT}) s ON s.product_sk = r.product_sk GROUP BY p.product_id, p.product_name)""",
}

#: The repaired variants and the sample queries of ``views``, published on request.
VARIANTS: dict[str, str] = {
    "kpi_overview_exact": f"""
SELECT {_money('total_revenue')} AS total_revenue, {_ratio('total_revenue', 'total_transactions', 2)} AS avg_order_value, units_sold,
  {_ratio('returned', 'units_sold', 4)} AS return_rate, {_ratio('stock', 'stock_rows', 4)} AS avg_inventory_units,
  {_ratio('CAST(units_sold AS DECIMAL(19,0)) * CAST(stock_rows AS DECIMAL(18,0))', 'stock', 2)} AS inventory_turnover
FROM (
  SELECT count(DISTINCT source_system, transaction_id) AS total_transactions, sum(line_revenue) AS total_revenue,
    CAST(sum(quantity) AS BIGINT) AS units_sold,
    (SELECT CAST(sum(quantity_returned) AS BIGINT) FROM {{db}}.fact_returns) AS returned,
    (SELECT sum(ending_inventory) FROM {{db}}.fact_inventory_snapshots) AS stock,
    (SELECT count(ending_inventory) FROM {{db}}.fact_inventory_snapshots) AS stock_rows
  FROM {{db}}.fact_sales_items)""",
    "returns_summary_safe": f"""
SELECT product_id, product_name, total_returns, units_returned, total_refund_amount, units_sold,
  {_ratio('units_returned', 'units_sold', 4)} AS return_rate
FROM (SELECT p.product_id, p.product_name, CAST(sum(r.n_returns) AS BIGINT) AS total_returns, CAST(sum(r.units) AS BIGINT) AS units_returned,
        {_money('sum(r.refund)')} AS total_refund_amount, CAST(sum(s.qty) AS BIGINT) AS units_sold
      FROM (SELECT product_sk, count(return_id) AS n_returns, sum(quantity_returned) AS units, sum(refund_amount) AS refund
            FROM {{db}}.fact_returns GROUP BY product_sk) r
      JOIN {{db}}.dim_product p ON p.product_sk = r.product_sk
      LEFT JOIN ({_PER_PRODUCT}) s ON s.product_sk = r.product_sk GROUP BY p.product_id, p.product_name)""",
    "sq1_monthly_net_revenue": f"""
SELECT d.year_num, d.month_num, d.month_name, {_money('sum(g.net)')} AS monthly_net_revenue
FROM (SELECT date_sk, sum(net_revenue) AS net
      FROM (SELECT date_sk, net_revenue FROM {{db}}.fact_pos_transactions
            UNION ALL SELECT date_sk, net_revenue FROM {{db}}.fact_ecom_orders) GROUP BY date_sk) g
JOIN {{db}}.dim_date d ON d.date_sk = g.date_sk
GROUP BY d.year_num, d.month_num, d.month_name ORDER BY d.year_num, d.month_num""",
    "sq2_revenue_by_channel": f"""
SELECT source_system, {_money('sum(line_revenue)')} AS total_revenue FROM {{db}}.fact_sales_items GROUP BY source_system""",
    "sq3_top10_products": f"""
SELECT p.product_name, {_money('sum(s.rev)')} AS total_revenue
FROM ({_PER_PRODUCT}) s JOIN {{db}}.dim_product p ON p.product_sk = s.product_sk
GROUP BY p.product_name ORDER BY total_revenue DESC, product_name LIMIT 10""",
    "sq4_below_safety_stock": """
SELECT p.product_name, s.store_name, i.ending_inventory, i.safety_stock
FROM {db}.fact_inventory_snapshots i JOIN {db}.dim_product p ON p.product_sk = i.product_sk
JOIN {db}.dim_store s ON s.store_sk = i.store_sk WHERE i.ending_inventory < i.safety_stock""",
    "sq5_return_rate_by_channel": f"""
SELECT p.product_name, s.source_system, r.returned_units, s.sold_units,
  try_cast({_quotient('r.returned_units', 's.sold_units', 2)} AS DECIMAL(5,2)) AS return_rate
FROM (SELECT product_sk, source_system, CAST(sum(quantity) AS BIGINT) AS sold_units
      FROM {{db}}.fact_sales_items GROUP BY product_sk, source_system) s
JOIN (SELECT product_sk, CAST(sum(quantity_returned) AS BIGINT) AS returned_units FROM {{db}}.fact_returns GROUP BY product_sk) r
  ON r.product_sk = s.product_sk
JOIN {{db}}.dim_product p ON p.product_sk = s.product_sk ORDER BY return_rate DESC NULLS LAST""",
}


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def publish(spark: SparkSession, path: str, database: str, schemas: dict[str, DataFrame], variants: bool = False) -> list[str]:
    """Name the Gold tables written below ``path`` and create the nine views
    over them in ``database``, with ``variants`` the repaired variants and the
    sample queries too; returns the views' names.

    ``schemas`` has a frame of each Gold table (its columns; tables without
    rows have no files to take them from). Tables and views that are there are
    replaced, so a refreshed warehouse is published by the same call.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in GOLD_TABLES:
        table = f"`{database}`.`{name}`"
        month = name.startswith("fact_")
        columns = _columns(schemas[name].drop(FACT_PARTITION)) + (f", `{FACT_PARTITION}` int" if month else "")
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet " + (f"PARTITIONED BY (`{FACT_PARTITION}`) " if month else "")
                  + f"LOCATION '{os.path.join(path, 'gold', name)}'")
        if month:
            spark.sql(f"MSCK REPAIR TABLE {table}")
    definitions = {**DEFINITIONS, **(VARIANTS if variants else {})}
    for name, text in definitions.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {text.format(db=f'`{database}`')}")
    return list(definitions)

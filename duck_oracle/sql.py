"""Oracle SQL per registered key (DuckDB dialect), written independently of
the DataFrame code. Views are written literally (e.g. the returns summary
really joins returns x sales lines), so algebraic shortcuts taken on the
Spark side are cross-checked against the plain formulation."""

from __future__ import annotations

from duck_oracle.ctes import cte, iavg, idiv, ratio, ratio_dec, with_ctes

ORACLE: dict[str, str] = {}


def q(key: str, needs: list[str], body: str) -> None:
    ORACLE[key] = with_ctes(body.strip(), needs)


def oracle_query(key: str) -> str:
    return ORACLE[key]


# ------------------------------------------------------------------ views
q("view_revenue_summary", ["fact_sales_items", "dim_product"], f"""
SELECT source_system, total_transactions, total_units_sold, total_revenue, total_margin,
  {ratio('rev', 'sum(rev) OVER ()', 4)} AS revenue_share_pct
FROM (
  SELECT f.source_system,
    count(DISTINCT concat(f.source_system, '-', f.transaction_id)) AS total_transactions,
    CAST(sum(f.quantity) AS BIGINT) AS total_units_sold,
    CAST(sum(f.line_revenue) AS DECIMAL(38,2)) AS total_revenue,
    CAST(sum(p.margin * f.quantity) AS DECIMAL(38,2)) AS total_margin,
    sum(f.line_revenue) AS rev
  FROM fact_sales_items f JOIN dim_product p ON f.product_id = p.product_id
  GROUP BY f.source_system
) g""")

_KPI_CTES = ["fact_sales_items", "fact_returns", "fact_inventory_snapshots"]
q("view_kpi_overview", _KPI_CTES, f"""
SELECT CAST(s.total_revenue AS DECIMAL(38,2)) AS total_revenue,
  {ratio('s.total_revenue', 's.total_transactions', 2)} AS avg_order_value,
  s.units_sold,
  {ratio('r.units_returned', 's.units_sold', 4)} AS return_rate,
  {idiv('s.units_sold', 'i.avg_inventory_units')} AS inventory_turnover
FROM (SELECT count(DISTINCT concat(source_system, '-', transaction_id)) AS total_transactions,
             sum(line_revenue) AS total_revenue, CAST(sum(quantity) AS BIGINT) AS units_sold
      FROM fact_sales_items) s
CROSS JOIN (SELECT CAST(sum(quantity_returned) AS BIGINT) AS units_returned FROM fact_returns) r
CROSS JOIN (SELECT {iavg('ending_inventory')} AS avg_inventory_units FROM fact_inventory_snapshots) i""")

q("kpi_overview_exact", _KPI_CTES, f"""
SELECT CAST(s.total_revenue AS DECIMAL(38,2)) AS total_revenue,
  {ratio('s.total_revenue', 's.total_transactions', 2)} AS avg_order_value,
  s.units_sold,
  {ratio('r.units_returned', 's.units_sold', 4)} AS return_rate,
  {ratio('i.inv_sum', 'i.inv_n', 4)} AS avg_inventory_units,
  {ratio('s.units_sold * i.inv_n', 'i.inv_sum', 2)} AS inventory_turnover
FROM (SELECT count(DISTINCT concat(source_system, '-', transaction_id)) AS total_transactions,
             sum(line_revenue) AS total_revenue, CAST(sum(quantity) AS BIGINT) AS units_sold
      FROM fact_sales_items) s
CROSS JOIN (SELECT CAST(sum(quantity_returned) AS BIGINT) AS units_returned FROM fact_returns) r
CROSS JOIN (SELECT sum(ending_inventory) AS inv_sum, count(ending_inventory) AS inv_n
            FROM fact_inventory_snapshots) i""")

q("view_daily_revenue", ["fact_sales_items", "dim_date"], """
SELECT d.full_date, d.year_num, d.month_num, d.month_name, f.source_system,
  count(DISTINCT concat(f.source_system, '-', f.transaction_id)) AS total_transactions,
  CAST(sum(f.quantity) AS BIGINT) AS units_sold,
  CAST(sum(f.line_revenue) AS DECIMAL(38,2)) AS daily_revenue
FROM fact_sales_items f JOIN dim_date d ON f.date_sk = d.date_sk
GROUP BY d.full_date, d.year_num, d.month_num, d.month_name, f.source_system""")

q("view_product_performance", ["fact_sales_items", "dim_product"], f"""
SELECT product_id, product_name, category, subcategory, brand, units_sold, total_revenue,
  {ratio('price_sum', 'price_n', 2)} AS avg_selling_price,
  CAST(margin AS DECIMAL(38,2)) AS total_margin,
  {ratio('margin', 'rev', 4)} AS gross_margin_pct
FROM (
  SELECT p.product_id, p.product_name, p.category, p.subcategory, p.brand,
    CAST(sum(f.quantity) AS BIGINT) AS units_sold,
    CAST(sum(f.line_revenue) AS DECIMAL(38,2)) AS total_revenue,
    sum(f.line_revenue) AS rev,
    sum(f.unit_price) AS price_sum, count(f.unit_price) AS price_n,
    sum(p.margin * f.quantity) AS margin
  FROM fact_sales_items f JOIN dim_product p ON f.product_id = p.product_id
  GROUP BY p.product_id, p.product_name, p.category, p.subcategory, p.brand
) g""")

q("view_category_performance", ["fact_sales_items", "dim_product"], f"""
SELECT category, subcategory, units_sold, category_revenue,
  {ratio('margin', 'rev', 4)} AS category_gross_margin_pct,
  {ratio('rev', 'sum(rev) OVER ()', 4)} AS category_revenue_share
FROM (
  SELECT p.category, p.subcategory,
    CAST(sum(f.quantity) AS BIGINT) AS units_sold,
    CAST(sum(f.line_revenue) AS DECIMAL(38,2)) AS category_revenue,
    sum(f.line_revenue) AS rev,
    sum(p.margin * f.quantity) AS margin
  FROM fact_sales_items f JOIN dim_product p ON f.product_id = p.product_id
  GROUP BY p.category, p.subcategory
) g""")

q("view_store_performance", ["fact_pos_transactions", "dim_store"], f"""
SELECT store_id, store_name, region, total_transactions,
  CAST(rev AS DECIMAL(38,2)) AS total_revenue,
  {ratio('rev', 'total_transactions', 2)} AS avg_transaction_value
FROM (
  SELECT s.store_id, s.store_name, s.region,
    count(DISTINCT p.transaction_id) AS total_transactions,
    sum(p.net_revenue) AS rev
  FROM fact_pos_transactions p JOIN dim_store s ON p.store_id = s.store_id
  GROUP BY s.store_id, s.store_name, s.region
) g""")

q("view_inventory_snapshot", ["fact_inventory_snapshots", "dim_date"], """
SELECT d.full_date, i.store_id, i.product_id, i.beginning_inventory, i.ending_inventory,
  i.safety_stock, i.stock_status, i.inventory_value,
  CASE WHEN i.ending_inventory = 0 THEN 1 ELSE 0 END AS is_stock_out,
  CASE WHEN i.ending_inventory < i.safety_stock THEN 1 ELSE 0 END AS is_below_safety_stock
FROM fact_inventory_snapshots i JOIN dim_date d ON i.date_sk = d.date_sk""")

q("view_inventory_turnover", ["fact_sales_items", "fact_inventory_snapshots", "dim_product"], f"""
SELECT p.product_id, p.product_name, s.total_units_sold, i.avg_inventory_units,
  {ratio('s.total_units_sold', 'i.avg_inventory_units', 2)} AS inventory_turnover_ratio
FROM (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_units_sold
      FROM fact_sales_items GROUP BY product_id) s
JOIN (SELECT product_id, {iavg('ending_inventory')} AS avg_inventory_units
      FROM fact_inventory_snapshots GROUP BY product_id) i ON s.product_id = i.product_id
JOIN dim_product p ON p.product_id = s.product_id""")

q("view_returns_summary", ["fact_returns", "fact_sales_items", "dim_product"], f"""
SELECT product_id, product_name, total_returns, units_returned, total_refund_amount,
  {idiv('units_returned', 'sold')} AS return_rate
FROM (
  SELECT p.product_id, p.product_name,
    count(r.return_id) AS total_returns,
    CAST(sum(r.quantity_returned) AS BIGINT) AS units_returned,
    CAST(sum(r.refund_amount) AS DECIMAL(38,2)) AS total_refund_amount,
    sum(f.quantity) AS sold
  FROM fact_returns r
  JOIN dim_product p ON r.product_id = p.product_id
  LEFT JOIN fact_sales_items f ON f.product_id = p.product_id
  GROUP BY p.product_id, p.product_name
) g""")

q("returns_summary_safe", ["fact_returns", "fact_sales_items", "dim_product"], f"""
SELECT p.product_id, p.product_name, r.total_returns, r.units_returned, r.total_refund_amount,
  s.units_sold, {ratio('r.units_returned', 's.units_sold', 4)} AS return_rate
FROM (SELECT product_id, count(return_id) AS total_returns,
             CAST(sum(quantity_returned) AS BIGINT) AS units_returned,
             CAST(sum(refund_amount) AS DECIMAL(38,2)) AS total_refund_amount
      FROM fact_returns GROUP BY product_id) r
JOIN dim_product p ON r.product_id = p.product_id
LEFT JOIN (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units_sold
           FROM fact_sales_items GROUP BY product_id) s ON s.product_id = r.product_id""")

# ------------------------------------------------------------------ sample queries
q("sq1_monthly_net_revenue", ["fact_pos_transactions", "fact_ecom_orders", "dim_date"], """
SELECT d.year_num, d.month_num, d.month_name, CAST(sum(f.net_revenue) AS DECIMAL(38,2)) AS monthly_net_revenue
FROM (SELECT date_sk, net_revenue FROM fact_pos_transactions
      UNION ALL SELECT date_sk, net_revenue FROM fact_ecom_orders) f
JOIN dim_date d ON f.date_sk = d.date_sk
GROUP BY d.year_num, d.month_num, d.month_name
ORDER BY d.year_num, d.month_num""")

q("sq2_revenue_by_channel", ["fact_sales_items"], """
SELECT source_system, CAST(sum(line_revenue) AS DECIMAL(38,2)) AS total_revenue
FROM fact_sales_items GROUP BY source_system""")

q("sq3_top10_products", ["fact_sales_items", "dim_product"], """
SELECT p.product_name, CAST(sum(f.line_revenue) AS DECIMAL(38,2)) AS total_revenue
FROM fact_sales_items f JOIN dim_product p ON f.product_id = p.product_id
GROUP BY p.product_name
ORDER BY total_revenue DESC, p.product_name
LIMIT 10""")

q("sq4_below_safety_stock", ["fact_inventory_snapshots", "dim_product", "dim_store"], """
SELECT p.product_name, s.store_name, i.ending_inventory, i.safety_stock
FROM fact_inventory_snapshots i
JOIN dim_product p ON i.product_id = p.product_id
JOIN dim_store s ON i.store_id = s.store_id
WHERE i.ending_inventory < i.safety_stock""")

q("sq5_return_rate_by_channel", ["fact_sales_items", "fact_returns", "dim_product"], f"""
SELECT p.product_name, s.source_system, r.returned_units, s.sold_units,
  {ratio_dec('r.returned_units', 's.sold_units', 5, 2)} AS return_rate
FROM (SELECT product_id, source_system, CAST(sum(quantity) AS BIGINT) AS sold_units
      FROM fact_sales_items GROUP BY product_id, source_system) s
JOIN (SELECT product_id, CAST(sum(quantity_returned) AS BIGINT) AS returned_units
      FROM fact_returns GROUP BY product_id) r ON s.product_id = r.product_id
JOIN dim_product p ON p.product_id = s.product_id
ORDER BY return_rate DESC NULLS LAST""")

# ------------------------------------------------------------------ layers
for _t in ["pos_transactions", "pos_items", "ecom_orders", "ecom_items",
           "inventory_snapshots", "returns", "products", "stores"]:
    q(f"silver_{_t}", [f"silver_{_t}"], f"SELECT * FROM silver_{_t}")

for _t in ["dim_date", "dim_product", "dim_store", "fact_pos_transactions", "fact_ecom_orders",
           "fact_sales_items", "fact_returns", "fact_inventory_snapshots"]:
    q(_t, [_t], f"SELECT * FROM {_t}")

# ------------------------------------------------------------------ ingestion / validation
from ledgerlake.sources.schemas import RAW_COLUMNS, RECORD_COUNT_LABELS, SOURCE_FILES  # noqa: E402
from duck_oracle.ctes import malformed_count, td, tdate, ti, tid, tts  # noqa: E402

_RAW = list(RAW_COLUMNS)
_SILVER = ["pos_transactions", "pos_items", "ecom_orders", "ecom_items",
           "inventory_snapshots", "returns", "products", "stores"]
_GOLD = ["dim_date", "dim_product", "dim_store", "fact_pos_transactions", "fact_ecom_orders",
         "fact_sales_items", "fact_returns", "fact_inventory_snapshots"]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


q("load_raw_csv", ["pos_items_raw"],
  "SELECT " + ", ".join(f"NULLIF({c}, '') AS {c}" for c in RAW_COLUMNS["pos_items_raw"]) + " FROM pos_items_raw")

q("load_all_raw", _RAW, _union([
    f"SELECT '{ds}' AS table_name, count(*) AS record_count, CAST(sum("
    + " + ".join(f"CAST(NULLIF({c}, '') IS NULL AS BIGINT)" for c in cols)
    + f") AS BIGINT) AS null_cells, {malformed_count(ds)} AS rejected_count FROM {ds}"
    for ds, cols in RAW_COLUMNS.items()
]))

q("lineage_enrich", _RAW, _union([
    f"SELECT '{ds}' AS table_name, '{SOURCE_FILES[ds]}' AS source_file, count(*) AS row_count, "
    f"count(*) AS stamped_rows FROM {ds}"
    for ds in _RAW
]))

q("full_refresh_write", [f"silver_{t}" for t in _SILVER] + _GOLD, _union(
    [f"SELECT 'silver' AS layer, '{t}' AS table_name, count(*) AS row_count FROM silver_{t}" for t in _SILVER]
    + [f"SELECT 'gold' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _GOLD]
))

_FACT_MONEY = {"fact_pos_transactions": "net_revenue", "fact_ecom_orders": "net_revenue",
               "fact_sales_items": "line_revenue", "fact_returns": "refund_amount"}
q("co_partitioned_facts", list(_FACT_MONEY), _union([
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(sum({c}) AS DECIMAL(38,2)) AS money, "
    f"count(DISTINCT date_sk) AS days FROM {t}" for t, c in _FACT_MONEY.items()
]))

_VIEW_KEYS = ["view_revenue_summary", "view_kpi_overview", "kpi_overview_exact", "view_daily_revenue",
              "view_product_performance", "view_category_performance", "view_store_performance",
              "view_inventory_snapshot", "view_inventory_turnover", "view_returns_summary",
              "returns_summary_safe", "sq1_monthly_net_revenue", "sq2_revenue_by_channel",
              "sq3_top10_products", "sq4_below_safety_stock", "sq5_return_rate_by_channel"]
ORACLE["publish_views"] = _union([
    f"SELECT '{k}' AS view_name, (SELECT count(*) FROM (\n{ORACLE[k]}\n) v) AS row_count" for k in _VIEW_KEYS
])

q("sample_rows", _RAW, _union([
    f"(SELECT '{ds}' AS table_name, concat_ws('|', "
    + ", ".join(f"coalesce({c}, '<NULL>')" for c in cols)
    + f") AS row_text FROM {ds} ORDER BY row_text LIMIT 10)"
    for ds, cols in RAW_COLUMNS.items()
]))

q("record_counts", _RAW, _union([
    f"SELECT '{RECORD_COUNT_LABELS[ds]}' AS table_name, count(*) AS record_count FROM {ds}" for ds in _RAW
]))

_TARGET = {
    "pos_transactions_raw": {"store_id": "id", "transaction_timestamp": "ts", "total_amount": "dec",
                             "discount_amount": "dec", "tax_amount": "dec"},
    "pos_items_raw": {"product_id": "id", "quantity": "int", "unit_price": "dec", "line_total": "dec"},
    "ecom_orders_raw": {"order_timestamp": "ts", "shipping_cost": "dec", "total_amount": "dec",
                        "discount_amount": "dec"},
    "ecom_items_raw": {"order_item_id": "id", "product_id": "id", "quantity": "int", "unit_price": "dec",
                       "line_total": "dec"},
    "inventory_snapshots_raw": {"snapshot_date": "date", "store_id": "id", "product_id": "id",
                                "beginning_inventory": "int", "ending_inventory": "int",
                                "inventory_value": "dec14", "safety_stock": "int"},
    "returns_raw": {"product_id": "id", "return_date": "date", "refund_amount": "dec",
                    "quantity_returned": "int"},
    "products_raw": {"product_id": "id", "cost": "dec", "price": "dec", "launch_date": "date"},
    "stores_raw": {"store_id": "id", "opening_date": "date"},
}
_CONV = {"id": tid, "int": ti, "dec": td, "dec14": lambda c: td(c, 14, 2), "date": tdate, "ts": tts}


def _profile_part(ds: str, c: str) -> str:
    kind = _TARGET[ds].get(c)
    invalid = (f"count(*) FILTER (WHERE {c} IS NOT NULL AND trim({c}) <> '' AND {_CONV[kind](c)} IS NULL)"
               if kind else "CAST(0 AS BIGINT)")
    return (f"SELECT '{ds}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
            f"count(*) FILTER (WHERE {c} IS NOT NULL AND trim({c}) = '') AS blank_count, "
            f"{invalid} AS invalid_count, CAST(NULL AS BIGINT) AS duplicate_count FROM {ds}")


_KEY_SETS = {
    "pos_transactions_raw": [["transaction_id"]],
    "pos_items_raw": [["transaction_id", "product_id"]],
    "ecom_orders_raw": [["order_id"]],
    "ecom_items_raw": [["order_item_id"], ["order_id", "product_id"]],
    "inventory_snapshots_raw": [["snapshot_date", "store_id", "product_id"]],
    "returns_raw": [["return_id"], ["transaction_id", "product_id", "return_date"]],
    "products_raw": [["product_id"], ["sku"]],
    "stores_raw": [["store_id"], ["store_name"]],
}


def _key_part(ds: str, key: list[str]) -> str:
    cols = ", ".join(f"NULLIF(trim({c}), '') AS {c}" for c in key)
    null, blank = " OR ".join(f"{c} IS NULL" for c in key), " OR ".join(f"trim({c}) = ''" for c in key)
    known = " AND ".join(f"{c} IS NOT NULL" for c in key)
    return (f"SELECT '{ds}' AS table_name, '{', '.join(key)}' AS column_name, (SELECT count(*) FROM {ds}) AS total_rows, "
            f"(SELECT count(*) FROM {ds} WHERE {null}) AS null_count, (SELECT count(*) FROM {ds} WHERE NOT ({null}) AND ({blank})) AS blank_count, "
            f"CAST(0 AS BIGINT) AS invalid_count, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_count "
            f"FROM (SELECT count(*) AS n FROM (SELECT {cols} FROM {ds}) k WHERE {known} GROUP BY {', '.join(key)} HAVING count(*) > 1) g")


# A key's row stands beside its columns' rows; a key of one column is told by its duplicate_count.
q("dq_profile", _RAW, _union(
    [_profile_part(ds, c) for ds, cols in RAW_COLUMNS.items() for c in cols]
    + [_key_part(ds, key) for ds, keys in _KEY_SETS.items() for key in keys]))

_FLAGS = {
    "pos_transactions": ["is_bad_date", "is_bad_store", "is_bad_total", "is_duplicate"],
    "pos_items": ["is_bad_qty", "is_bad_price", "is_bad_line_total", "is_line_total_mismatch", "is_duplicate"],
    "ecom_orders": ["is_bad_date", "is_bad_total", "is_duplicate"],
    "ecom_items": ["is_bad_qty", "is_bad_price", "is_bad_line_total", "is_line_total_mismatch", "is_duplicate"],
    "inventory_snapshots": ["is_bad_date", "is_bad_store", "is_below_safety_stock", "is_duplicate"],
    "returns": ["is_bad_return_date", "is_bad_qty", "is_bad_refund", "is_duplicate"],
    "products": ["is_negative_margin", "is_duplicate"],
    "stores": ["is_duplicate"],
}
q("dq_flag_summary", [f"silver_{t}" for t in _SILVER], _union([
    f"SELECT '{t}' AS table_name, '{f}' AS flag_name, CAST(sum({f}) AS BIGINT) AS flagged_rows, "
    f"count(*) AS total_rows FROM silver_{t}"
    for t, flags in _FLAGS.items() for f in flags
]))

_NOT_NULL = {
    "pos_transactions": ["transaction_id"], "pos_items": ["transaction_id", "product_id"],
    "ecom_orders": ["order_id"], "ecom_items": ["order_item_id"],
    "inventory_snapshots": ["store_id", "product_id"], "returns": ["return_id"],
    "products": ["product_id"], "stores": ["store_id"],
}
_TYPED = {"pos_transactions": "s_pos_tx_typed", "pos_items": "s_pos_items_typed",
          "ecom_orders": "s_ecom_orders_typed", "ecom_items": "s_ecom_items_typed",
          "inventory_snapshots": "s_inventory_typed", "returns": "s_returns_typed",
          "products": "s_products_typed", "stores": "s_stores_typed"}
q("quarantine_not_null", list(_TYPED.values()), _union([
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS rejected_rows, "
    f"count(*) AS total_rows FROM {_TYPED[t]}"
    for t, cols in _NOT_NULL.items() for c in cols
]))

_FK = [
    ("fact_pos_transactions", "date_sk", "dim_date", False),
    ("fact_pos_transactions", "store_sk", "dim_store", False),
    ("fact_ecom_orders", "date_sk", "dim_date", False),
    ("fact_sales_items", "product_sk", "dim_product", False),
    ("fact_sales_items", "store_sk", "dim_store", True),
    ("fact_sales_items", "date_sk", "dim_date", False),
    ("fact_returns", "product_sk", "dim_product", False),
    ("fact_returns", "store_sk", "dim_store", True),
    ("fact_returns", "date_sk", "dim_date", False),
    ("fact_inventory_snapshots", "product_sk", "dim_product", False),
    ("fact_inventory_snapshots", "store_sk", "dim_store", False),
    ("fact_inventory_snapshots", "date_sk", "dim_date", False),
]
_NATURAL = {"product_sk": "product_id", "store_sk": "store_id", "date_sk": "date_sk"}


def _fk_part(fact, key, dim, nullable):
    k = _NATURAL[key]
    nulls = "CAST(0 AS BIGINT)" if nullable else f"count(*) FILTER (WHERE f.{k} IS NULL)"
    return (f"SELECT '{fact}.{key} -> {dim}' AS relation, count(*) AS checked_rows, {nulls} AS null_violations, "
            f"count(*) FILTER (WHERE f.{k} IS NOT NULL AND d.{k} IS NULL) AS orphan_rows "
            f"FROM {fact} f LEFT JOIN (SELECT DISTINCT {k} FROM {dim}) d ON f.{k} = d.{k}")


_SILVER_KEYS = [
    ("pos_transactions", "store_id", "store_id", "dim_store", "store_id"),
    ("pos_transactions", "day", "CAST(transaction_timestamp AS DATE)", "dim_date", "full_date"),
    ("pos_items", "product_id", "product_id", "dim_product", "product_id"),
    ("ecom_orders", "day", "CAST(order_timestamp AS DATE)", "dim_date", "full_date"),
    ("ecom_items", "product_id", "product_id", "dim_product", "product_id"),
    ("inventory_snapshots", "product_id", "product_id", "dim_product", "product_id"),
    ("inventory_snapshots", "store_id", "store_id", "dim_store", "store_id"),
    ("inventory_snapshots", "day", "snapshot_date", "dim_date", "full_date"),
    ("returns", "product_id", "product_id", "dim_product", "product_id"),
    ("returns", "day", "return_date", "dim_date", "full_date"),
]


def _silver_part(table, what, expr, dim, key):
    return (f"SELECT 'silver_{table}.{what} -> {dim}' AS relation, count(*) AS checked_rows, "
            f"count(*) FILTER (WHERE k IS NULL) AS null_violations, "
            f"count(*) FILTER (WHERE k IS NOT NULL AND NOT known) AS orphan_rows "
            f"FROM (SELECT k, k IN (SELECT {key} FROM {dim}) AS known FROM (SELECT {expr} AS k FROM silver_{table}))")


_SILVER = [f"silver_{t}" for t in dict.fromkeys(r[0] for r in _SILVER_KEYS)]
q("fk_audit", [*_GOLD, *_SILVER], _union([_fk_part(*r) for r in _FK] + [_silver_part(*r) for r in _SILVER_KEYS]))

# table: its typed rows before the NOT NULL filter, what it feeds, when a row is taken, when it finds its keys.
_DAY_OK = "CAST({} AS DATE) IN (SELECT full_date FROM dim_date)"
_STORE_OK, _PRODUCT_OK = "store_id IN (SELECT store_id FROM dim_store)", "product_id IN (SELECT product_id FROM dim_product)"
_LINE_OK = "is_bad_qty = 0 AND is_bad_price = 0 AND is_line_total_mismatch = 0"
_HEAD_OK = "is_duplicate = 0 AND is_bad_date = 0 AND is_bad_total = 0"
_POS_HEAD = f"transaction_id IN (SELECT transaction_id FROM silver_pos_transactions WHERE {_HEAD_OK} AND {_DAY_OK.format('transaction_timestamp')} AND {_STORE_OK})"
_ECOM_HEAD = f"order_id IN (SELECT order_id FROM silver_ecom_orders WHERE {_HEAD_OK} AND {_DAY_OK.format('order_timestamp')})"
_FEEDS = {
    "pos_transactions": ("s_pos_tx_typed", "SELECT count(*) FROM fact_pos_transactions", "is_bad_date = 0 AND is_bad_total = 0 AND is_bad_store = 0",
                         f"{_DAY_OK.format('transaction_timestamp')} AND {_STORE_OK}"),
    "pos_items": ("s_pos_items_typed", "SELECT count(*) FROM fact_sales_items WHERE source_system = 'POS'", _LINE_OK, f"{_PRODUCT_OK} AND {_POS_HEAD}"),
    "ecom_orders": ("s_ecom_orders_typed", "SELECT count(*) FROM fact_ecom_orders", "is_bad_date = 0 AND is_bad_total = 0", _DAY_OK.format("order_timestamp")),
    "ecom_items": ("s_ecom_items_typed", "SELECT count(*) FROM fact_sales_items WHERE source_system = 'ECOM'", _LINE_OK, f"{_PRODUCT_OK} AND {_ECOM_HEAD}"),
    "inventory_snapshots": ("s_inventory_typed", "SELECT count(*) FROM fact_inventory_snapshots", "is_bad_date = 0 AND is_bad_store = 0",
                            f"{_DAY_OK.format('snapshot_date')} AND {_STORE_OK} AND {_PRODUCT_OK}"),
    "returns": ("s_returns_typed", "SELECT count(DISTINCT return_id) FROM fact_returns", "is_bad_return_date = 0 AND is_bad_qty = 0 AND is_bad_refund = 0",
                f"{_DAY_OK.format('return_date')} AND {_PRODUCT_OK}"),
    "products": ("s_products_typed", "SELECT count(*) FROM dim_product", "true", "true"),
    "stores": ("s_stores_typed", "SELECT count(*) FROM dim_store", "true", "true"),
}
q("load_reconcile", [*_GOLD, *[f"silver_{t}" for t in _FEEDS]], _union([
    f"""SELECT '{t}' AS table_name, raw_lines, rejected_rows, refused_rows, duplicate_rows, flagged_rows, unmatched_rows, loaded_rows,
  raw_lines - rejected_rows - refused_rows - duplicate_rows - flagged_rows - unmatched_rows - loaded_rows AS difference
FROM (SELECT (SELECT count(*) FROM {typed}) + {malformed_count(t + '_raw')} AS raw_lines, {malformed_count(t + '_raw')} AS rejected_rows,
  (SELECT count(*) FROM {typed}) - (SELECT count(*) FROM silver_{t}) AS refused_rows,
  (SELECT count(*) FROM silver_{t} WHERE is_duplicate = 1) AS duplicate_rows,
  (SELECT count(*) FROM silver_{t} WHERE is_duplicate = 0 AND NOT ({taken})) AS flagged_rows,
  (SELECT count(*) FROM silver_{t} WHERE is_duplicate = 0 AND ({taken}) AND NOT coalesce({found}, false)) AS unmatched_rows,
  ({loaded}) AS loaded_rows)"""
    for t, (typed, loaded, taken, found) in _FEEDS.items()
]))

q("dim_identities", ["dim_product", "dim_store"], """
SELECT 'dim_product' AS table_name, count(*) AS row_count, count(*) FILTER (product_id % 10 <> 3) AS kept_keys,
  count(*) FILTER (product_id % 10 = 3) AS new_keys, CAST(1 AS BIGINT) AS least_key, count(*) AS greatest_key, count(*) AS distinct_keys FROM dim_product
UNION ALL
SELECT 'dim_store', count(*), count(*), CAST(0 AS BIGINT), CAST(1 AS BIGINT), count(*), count(*) FROM dim_store""")

_FACT_GRAINS = {
    "fact_pos_transactions": ["transaction_id"],
    "fact_ecom_orders": ["order_id"],
    "fact_sales_items": ["source_system", "transaction_id", "product_sk", "date_sk"],
    "fact_returns": ["return_id"],
    "fact_inventory_snapshots": ["product_sk", "store_sk", "date_sk"],
}
_DIM_GRAINS = {"dim_product": ["product_id"], "dim_store": ["store_id"], "dim_date": ["full_date"]}


def _grain_part(t, keys):
    cols = ", ".join(_NATURAL.get(k, k) for k in keys)
    return (f"SELECT '{t}' AS table_name, '{', '.join(keys)}' AS grain, count(*) AS duplicate_keys, "
            f"CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows "
            f"FROM (SELECT {cols}, count(*) AS n FROM {t} GROUP BY {cols} HAVING count(*) > 1) g")


q("grain_audit_facts", list(_FACT_GRAINS), _union([_grain_part(t, k) for t, k in _FACT_GRAINS.items()]))
q("grain_audit_dims", list(_DIM_GRAINS), _union(
    [_grain_part(t, k) for t, k in _DIM_GRAINS.items()]
    + [_grain_part(t, [k]) for t, k in (("dim_product", "product_sk"), ("dim_store", "store_sk"), ("dim_date", "date_sk"))]))

q("dedup_keep_latest", ["s_stores_typed"], """
SELECT store_id, store_name, store_type, region, address, opening_date, manager_id, source_file
FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY store_name, store_type, region, address,
             opening_date, manager_id, source_file) AS rn
      FROM s_stores_typed WHERE store_id IS NOT NULL) t
WHERE rn = 1""")

# table: typed rows, key, columns by which rows of one load time are ordered, newer, older, changed column.
_MERGE = {
    "pos_transactions": ("s_pos_tx_typed", ["transaction_id"], "store_id % 3 = 1", "store_id % 3 = 2", "total_amount", "total_amount + 1", "total_amount"),
    "pos_items": ("s_pos_items_typed", ["transaction_id", "product_id"], "product_id % 5 = 2", "product_id % 5 = 4", "unit_price", "unit_price + 1", "unit_price"),
    "ecom_orders": ("s_ecom_orders_typed", ["order_id"], "length(order_id) % 2 = 0", "length(order_id) % 2 = 1", "total_amount", "total_amount + 1", "total_amount"),
    "ecom_items": ("s_ecom_items_typed", ["order_item_id"], "product_id % 5 = 2", "product_id % 5 = 4", "unit_price", "unit_price + 1", "unit_price"),
    "inventory_snapshots": ("s_inventory_typed", ["snapshot_date", "store_id", "product_id"], "product_id % 5 = 2", "product_id % 5 = 4",
                            "ending_inventory", "ending_inventory + 1", "ending_inventory"),
    "returns": ("s_returns_typed", ["return_id"], "product_id % 5 = 2", "product_id % 5 = 4", "refund_amount", "refund_amount + 1", "refund_amount"),
    "stores": ("s_stores_typed", ["store_id"], "store_id % 4 = 1", "store_id % 4 = 2", "region", "region || '!'", "length(region)"),
}
# Columns in the order of the rows; of equal load times the row that is largest in them, as text, stays.
_MERGE_ORDER = {
    "pos_transactions": "store_id transaction_timestamp cashier_id customer_id payment_method total_amount discount_amount tax_amount",
    "pos_items": "quantity unit_price line_total calculated_line_total is_bad_qty is_bad_price is_bad_line_total is_line_total_mismatch",
    "ecom_orders": "customer_id order_timestamp order_status channel device_type traffic_source shipping_cost total_amount discount_amount net_revenue",
    "ecom_items": "order_id product_id quantity unit_price line_total calculated_line_total is_bad_qty is_bad_price is_bad_line_total is_line_total_mismatch",
    "inventory_snapshots": "beginning_inventory ending_inventory inventory_value safety_stock stock_status calculated_inventory_delta",
    "returns": "transaction_id product_id return_date return_reason refund_amount quantity_returned return_channel",
    "stores": "store_name store_type region address opening_date manager_id",
}


def _merge_part(t: str) -> str:
    typed, keys, newer, older, column, changed, number = _MERGE[t]
    kept = " AND ".join(f"{c} IS NOT NULL" for c in _NOT_NULL[t])
    order = ", ".join(f"CAST({c} AS VARCHAR) DESC NULLS LAST" for c in _MERGE_ORDER[t].split())
    known = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    kind = "VARCHAR" if t == "stores" else ("INTEGER" if t == "inventory_snapshots" else "DECIMAL(12,2)")
    first = f"SELECT * FROM {typed} WHERE {kept}"
    again = f"SELECT * REPLACE (CAST({changed} AS {kind}) AS {column})"
    once = f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY loaded DESC, {order}) AS rn FROM {{}}) w WHERE rn = 1 OR NOT ({known})"
    return f"""SELECT '{t}' AS table_name, count(*) AS row_count, count(*) FILTER (loaded = 1 AND {known}) AS replaced_keys,
  CAST(sum({number}) AS DECIMAL(38,2)) AS content
FROM ({once.format(f"(SELECT *, 0 AS loaded FROM ({first}) a UNION ALL {again}, 1 AS loaded FROM ({first}) b WHERE {newer} UNION ALL {again}, -1 AS loaded FROM ({first}) c WHERE {older}) v")}) x"""


q("merge_latest", [v[0] for v in _MERGE.values()], _union([_merge_part(t) for t in _MERGE]))

# ------------------------------------------------------------------ Tier 2 metrics
cte("headers", ["fact_pos_transactions", "fact_ecom_orders"], """
SELECT 'POS' AS channel, transaction_id AS order_id, date_sk, net_revenue FROM fact_pos_transactions
UNION ALL
SELECT 'ECOM' AS channel, order_id, date_sk, net_revenue FROM fact_ecom_orders""")
cte("snapshots", ["fact_inventory_snapshots", "dim_date"], """
SELECT i.*, d.full_date FROM fact_inventory_snapshots i JOIN dim_date d ON i.date_sk = d.date_sk""")

q("m_total_revenue", ["fact_sales_items"],
  "SELECT CAST(sum(line_revenue) AS DECIMAL(38,2)) AS total_revenue FROM fact_sales_items")
q("m_net_revenue", ["headers"],
  "SELECT channel, CAST(sum(net_revenue) AS DECIMAL(38,2)) AS net_revenue FROM headers GROUP BY channel")
q("m_aov", ["headers"], f"""
SELECT channel, CAST(net AS DECIMAL(38,2)) AS net_revenue, order_count, {ratio('net', 'order_count', 2)} AS aov
FROM (SELECT channel, sum(net_revenue) AS net, count(DISTINCT order_id) AS order_count FROM headers GROUP BY channel) g""")
q("m_units_sold", ["fact_sales_items"], "SELECT CAST(sum(quantity) AS BIGINT) AS units_sold FROM fact_sales_items")
q("m_order_count", ["headers"], """
SELECT channel, count(DISTINCT order_id) AS order_count FROM headers GROUP BY channel
UNION ALL
SELECT 'ALL', CAST(sum(n) AS BIGINT) FROM (SELECT count(DISTINCT order_id) AS n FROM headers GROUP BY channel) t""")
q("m_unit_margin", ["dim_product"],
  "SELECT product_id, product_name, price, cost, margin AS unit_margin FROM dim_product")
q("m_contribution_margin", ["fact_sales_items", "dim_product"], """
SELECT p.product_id, p.product_name, CAST(sum(f.quantity) AS BIGINT) AS units_sold,
  CAST(sum(p.margin * f.quantity) AS DECIMAL(38,2)) AS contribution_margin
FROM fact_sales_items f JOIN dim_product p ON f.product_id = p.product_id
GROUP BY p.product_id, p.product_name""")
q("m_inventory_value", ["snapshots"],
  "SELECT full_date, CAST(sum(inventory_value) AS DECIMAL(38,2)) AS inventory_value FROM snapshots GROUP BY full_date")
q("m_inventory_delta", ["snapshots"], """
SELECT full_date, store_id, product_id, beginning_inventory, ending_inventory,
  ending_inventory - beginning_inventory AS inventory_delta FROM snapshots""")
q("m_inventory_change", ["snapshots"], """
SELECT full_date, store_id, product_id, ending_inventory, previous_ending,
  ending_inventory - previous_ending AS inventory_change
FROM (SELECT *, lag(ending_inventory) OVER (PARTITION BY product_id, store_id ORDER BY date_sk) AS previous_ending
      FROM snapshots) t""")
q("m_return_count", ["fact_returns"], "SELECT count(DISTINCT return_id) AS return_count FROM fact_returns")
q("m_unit_return_rate", ["fact_returns", "fact_sales_items"], f"""
SELECT r.units_returned, s.units_sold, {ratio('r.units_returned', 's.units_sold', 4)} AS unit_return_rate
FROM (SELECT CAST(sum(quantity_returned) AS BIGINT) AS units_returned FROM fact_returns) r,
     (SELECT CAST(sum(quantity) AS BIGINT) AS units_sold FROM fact_sales_items) s""")
q("m_revenue_return_rate", ["fact_returns", "fact_sales_items"], f"""
SELECT CAST(r.refund AS DECIMAL(38,2)) AS refund_amount, CAST(s.rev AS DECIMAL(38,2)) AS gross_revenue,
  {ratio('r.refund', 's.rev', 4)} AS revenue_return_rate
FROM (SELECT sum(refund_amount) AS refund FROM fact_returns) r,
     (SELECT sum(line_revenue) AS rev FROM fact_sales_items) s""")

# ------------------------------------------------------------------ Tier 3 questions
_YM = "CAST(date_sk // 10000 AS INTEGER) AS year_num, CAST((date_sk // 100) % 100 AS INTEGER) AS month_num"


def hdiv(n: str, d: str) -> str:
    """Signed integer division rounded half away from zero (HUGEINT)."""
    return (f"((CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END) * "
            f"((2 * abs({n}) + abs({d})) // (2 * abs({d}))))")


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def from_cents(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(38,0)) * 0.01 AS DECIMAL(38,2))"


cte("sales_m", ["fact_sales_items"], f"SELECT *, {_YM} FROM fact_sales_items")

q("b01_net_revenue_rollup", ["headers", "dim_date"], """
SELECT year_num, month_num, full_date, CAST(GROUPING(year_num, month_num, full_date) AS INTEGER) AS grouping_level,
  CAST(sum(net_revenue) AS DECIMAL(38,2)) AS net_revenue
FROM (SELECT d.year_num, d.month_num, d.full_date, h.net_revenue FROM headers h JOIN dim_date d ON h.date_sk = d.date_sk) t
GROUP BY ROLLUP (year_num, month_num, full_date)""")

_B03 = []
for _m, _c in (("revenue", "rev"), ("units", "qty")):
    _B03.append(f"(SELECT 'product' AS level, '{_m}' AS metric, CAST(product_id AS VARCHAR) AS member, "
                f"CAST({_c} AS DECIMAL(38,2)) AS value FROM prod ORDER BY {_c} DESC NULLS LAST, product_id LIMIT 10)")
    _B03.append(f"(SELECT 'category' AS level, '{_m}' AS metric, category AS member, CAST(sum({_c}) AS DECIMAL(38,2)) AS value "
                f"FROM prod GROUP BY category ORDER BY sum({_c}) DESC NULLS LAST, category LIMIT 10)")
cte("prod", ["fact_sales_items", "dim_product"], """
SELECT p.product_id, p.category, sum(f.line_revenue) AS rev, sum(f.quantity) AS qty
FROM fact_sales_items f JOIN dim_product p ON f.product_id = p.product_id GROUP BY p.product_id, p.category""")
q("b03_top_products_categories", ["prod"], f"""
SELECT *, row_number() OVER (PARTITION BY level, metric ORDER BY value DESC, member) AS position
FROM ({_union(_B03)}) t""")

ORACLE["b04_store_ranking"] = f"""
SELECT store_id, store_name, region, total_transactions, total_revenue,
  rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS revenue_rank
FROM ({ORACLE['view_store_performance']}) v"""

q("b05_aov_trend", ["headers"], f"""
SELECT year_num, month_num, channel, order_count, CAST(net AS DECIMAL(38,2)) AS net_revenue,
  {ratio('net', 'order_count', 2)} AS aov
FROM (SELECT {_YM}, channel, count(DISTINCT order_id) AS order_count, sum(net_revenue) AS net
      FROM headers GROUP BY ALL) g""")

q("b06_price_volume_mix", ["sales_m"], f"""
WITH pm AS (SELECT product_id, year_num * 12 + month_num AS mi, sum(quantity) AS units, sum(line_revenue) AS revenue
            FROM sales_m GROUP BY product_id, year_num * 12 + month_num),
both_m AS (SELECT a.mi, {cents('a.revenue')} - {hdiv(cents('b.revenue') + ' * a.units', 'CAST(b.units AS HUGEINT)')} AS pc
         FROM pm a JOIN pm b ON a.product_id = b.product_id AND a.mi = b.mi + 1 WHERE b.units <> 0 AND a.units <> 0),
price AS (SELECT mi, sum(pc) AS pc FROM both_m GROUP BY mi),
tot AS (SELECT mi, sum(units) AS Q, sum(revenue) AS R FROM pm GROUP BY mi),
calc AS (SELECT t.mi, t.R, t0.R AS R0, coalesce(p.pc, 0) AS pc,
           {hdiv('CAST(t.Q - t0.Q AS HUGEINT) * ' + cents('t0.R'), 'CAST(t0.Q AS HUGEINT)')} AS vc
         FROM tot t JOIN tot t0 ON t.mi = t0.mi + 1 LEFT JOIN price p ON p.mi = t.mi WHERE t0.Q <> 0)
SELECT CAST((mi - 1) // 12 AS INTEGER) AS year_num, CAST((mi - 1) % 12 + 1 AS INTEGER) AS month_num,
  CAST(R AS DECIMAL(38,2)) AS revenue, CAST(R0 AS DECIMAL(38,2)) AS prev_revenue,
  {from_cents('pc')} AS price_effect, {from_cents('vc')} AS volume_effect,
  {from_cents(cents('R') + ' - ' + cents('R0') + ' - pc - vc')} AS mix_effect
FROM calc""")


def _growth_sql(dim: str, key: str, src: str) -> str:
    return f"""
SELECT '{dim}' AS dimension, CAST(c.k AS VARCHAR) AS member, c.year_num, c.month_num,
  CAST(c.v AS DECIMAL(38,2)) AS revenue, CAST(m.v AS DECIMAL(38,2)) AS prev_month_revenue,
  CAST(y.v AS DECIMAL(38,2)) AS prev_year_revenue,
  {ratio('c.v - m.v', 'm.v', 4)} AS mom_growth, {ratio('c.v - y.v', 'y.v', 4)} AS yoy_growth
FROM {src} c
LEFT JOIN {src} m ON m.k = c.k AND m.mi + 1 = c.mi
LEFT JOIN {src} y ON y.k = c.k AND y.mi + 12 = c.mi"""


cte("g_prod", ["sales_m"], """
SELECT product_id AS k, year_num, month_num, year_num * 12 + month_num AS mi, sum(line_revenue) AS v
FROM sales_m GROUP BY product_id, year_num, month_num""")
cte("g_store", ["fact_pos_transactions"], f"""
SELECT store_id AS k, year_num, month_num, year_num * 12 + month_num AS mi, sum(net_revenue) AS v
FROM (SELECT *, {_YM} FROM fact_pos_transactions) t GROUP BY store_id, year_num, month_num""")
q("b07_mom_yoy_contribution", ["g_prod", "g_store"],
  _growth_sql("product", "product_id", "g_prod") + "\nUNION ALL\n" + _growth_sql("store", "store_id", "g_store"))

q("b08_unit_margin_rank", ["dim_product"], f"""
SELECT p.product_id, p.product_name, p.category, p.margin AS unit_margin,
  rank() OVER (ORDER BY p.margin DESC NULLS LAST) AS margin_rank, c.category_avg_margin
FROM dim_product p JOIN (SELECT category, {ratio('sum(margin)', 'count(margin)', 2)} AS category_avg_margin
                         FROM dim_product GROUP BY category) c ON p.category IS NOT DISTINCT FROM c.category""")

ORACLE["b09_contribution_rank"] = f"""
SELECT product_id, product_name, total_margin, total_revenue,
  rank() OVER (ORDER BY total_margin DESC NULLS LAST) AS margin_rank
FROM ({ORACLE['view_product_performance']}) v"""

q("b10_low_margin_products", ["fact_sales_items", "dim_product"], f"""
SELECT * FROM (
  SELECT product_id, product_name, unit_margin, total_margin, price_share, revenue_share,
    CASE WHEN unit_margin <= 0 THEN 'unit_margin' WHEN total_margin <= 0 THEN 'total_margin'
         WHEN price_share <= 0.1 THEN 'low_unit_margin' WHEN revenue_share <= 0.1 THEN 'low_total_margin' END AS reason
  FROM (SELECT *, {ratio('unit_margin', 'price', 4)} AS price_share, {ratio('total_margin', 'rev', 4)} AS revenue_share
    FROM (SELECT p.product_id, p.product_name, p.price, p.margin AS unit_margin, s.rev, CAST(p.margin * s.qty AS DECIMAL(38,2)) AS total_margin
          FROM dim_product p LEFT JOIN (SELECT product_id, sum(quantity) AS qty, sum(line_revenue) AS rev FROM fact_sales_items GROUP BY product_id) s
            ON p.product_id = s.product_id) t) u) v
WHERE reason IS NOT NULL""")

q("b11_category_margin_share", ["fact_sales_items", "dim_product"], f"""
SELECT category, subcategory, CAST(m AS DECIMAL(38,2)) AS total_margin, {ratio('m', 'tot', 4)} AS margin_share
FROM (SELECT category, subcategory, m, sum(m) OVER () AS tot FROM (
  SELECT p.category, p.subcategory, sum(p.margin * f.quantity) AS m
  FROM fact_sales_items f JOIN dim_product p ON f.product_id = p.product_id GROUP BY p.category, p.subcategory) g) t""")

q("b12_seasonal_vs_core", ["fact_sales_items", "dim_product"], """
SELECT p.season, CASE WHEN p.season = 'ALL YEAR' THEN 'CORE' ELSE 'SEASONAL' END AS segment,
  CAST(sum(f.quantity) AS BIGINT) AS units_sold, CAST(sum(f.line_revenue) AS DECIMAL(38,2)) AS revenue,
  CAST(sum(p.margin * f.quantity) AS DECIMAL(38,2)) AS total_margin
FROM fact_sales_items f JOIN dim_product p ON f.product_id = p.product_id GROUP BY p.season""")

_B13 = []
for _pt, _col in (("month", "month_num"), ("quarter", "quarter_num")):
    _B13.append(f"""SELECT '{_pt}' AS period_type, d.year_num, d.{_col} AS period_num,
  CAST(sum(f.line_revenue) AS DECIMAL(38,2)) AS revenue, CAST(sum(p.margin * f.quantity) AS DECIMAL(38,2)) AS total_margin,
  {ratio('sum(p.margin * f.quantity)', 'sum(f.line_revenue)', 4)} AS gross_margin_pct
FROM fact_sales_items f JOIN dim_product p ON f.product_id = p.product_id JOIN dim_date d ON f.date_sk = d.date_sk
GROUP BY d.year_num, d.{_col}""")
q("b13_margin_trend", ["fact_sales_items", "dim_product", "dim_date"], _union(_B13))

q("b14_stockout_trend", ["snapshots"], f"""
SELECT full_date, store_id, product_id, ending_inventory, safety_stock, rolling_gap FROM (
  SELECT *, {ratio('gs', 'gn', 2)} AS rolling_gap FROM (
    SELECT *, sum(ending_inventory - safety_stock) OVER w AS gs, count(ending_inventory - safety_stock) OVER w AS gn
    FROM snapshots WINDOW w AS (PARTITION BY product_id, store_id ORDER BY date_sk ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
  ) a) b
WHERE rolling_gap <= 0""")

q("b15_safety_stock_frequency", ["fact_inventory_snapshots", "dim_product"], f"""
SELECT p.product_id, p.product_name, i.snapshots, i.below_safety_count,
  {ratio('i.below_safety_count', 'i.snapshots', 4)} AS below_safety_share
FROM (SELECT product_id, count(*) AS snapshots,
             count(*) FILTER (WHERE ending_inventory < safety_stock) AS below_safety_count
      FROM fact_inventory_snapshots GROUP BY product_id) i JOIN dim_product p ON i.product_id = p.product_id""")

q("b16_inventory_value_trend", ["snapshots", "dim_product"], """
SELECT s.full_date, s.store_id, p.category, CAST(sum(s.inventory_value) AS DECIMAL(38,2)) AS inventory_value
FROM snapshots s JOIN dim_product p ON s.product_id = p.product_id GROUP BY s.full_date, s.store_id, p.category""")

cte("store_turnover", ["fact_sales_items", "fact_inventory_snapshots", "dim_store"], f"""
SELECT s.store_id, s.store_name, CAST(u.units_sold AS BIGINT) AS units_sold,
  {ratio('i.inv_s', 'i.inv_n', 2)} AS avg_inventory,
  {ratio('u.units_sold * i.inv_n', 'i.inv_s', 4)} AS turnover
FROM (SELECT store_id, sum(quantity) AS units_sold FROM fact_sales_items WHERE source_system = 'POS' GROUP BY store_id) u
JOIN (SELECT store_id, sum(ending_inventory) AS inv_s, count(ending_inventory) AS inv_n
      FROM fact_inventory_snapshots GROUP BY store_id) i ON u.store_id = i.store_id
JOIN dim_store s ON s.store_id = u.store_id""")
q("b17_store_turnover", ["store_turnover"], f"""
SELECT store_id, store_name, units_sold, avg_inventory, turnover, turnover_pct_rank FROM (
  SELECT *, CASE WHEN n > 1 THEN {ratio('rk - 1', 'n - 1', 4)} ELSE 0.0 END AS turnover_pct_rank FROM (
    SELECT *, rank() OVER (ORDER BY turnover ASC NULLS LAST) AS rk, count(*) OVER () AS n FROM store_turnover) a) b
WHERE turnover_pct_rank <= 0.25""")

q("b18_turnover_trend", ["sales_m", "fact_inventory_snapshots"], f"""
SELECT u.year_num, u.month_num, u.product_id, u.store_id, CAST(u.units_sold AS BIGINT) AS units_sold,
  {ratio('i.inv_s', 'i.inv_n', 2)} AS avg_inventory, {ratio('u.units_sold * i.inv_n', 'i.inv_s', 4)} AS turnover
FROM (SELECT product_id, store_id, year_num, month_num, sum(quantity) AS units_sold FROM sales_m
      WHERE source_system = 'POS' GROUP BY ALL) u
JOIN (SELECT product_id, store_id, {_YM}, sum(ending_inventory) AS inv_s, count(ending_inventory) AS inv_n
      FROM fact_inventory_snapshots GROUP BY ALL) i
  ON u.product_id = i.product_id AND u.store_id = i.store_id AND u.year_num = i.year_num AND u.month_num = i.month_num""")

q("b19_demand_vs_stock", ["sales_m", "fact_inventory_snapshots"], f"""
WITH d AS (SELECT product_id, year_num, month_num, sum(quantity) AS units FROM sales_m GROUP BY ALL),
last AS (SELECT product_id, store_id, year_num, month_num, ending_inventory FROM (
           SELECT *, {_YM}, row_number() OVER (PARTITION BY product_id, store_id, CAST(date_sk // 100 AS INTEGER)
                                               ORDER BY date_sk DESC) AS rn
           FROM fact_inventory_snapshots) t WHERE rn = 1),
st AS (SELECT product_id, year_num, month_num, sum(ending_inventory) AS stock FROM last GROUP BY ALL)
SELECT coalesce(d.product_id, st.product_id) AS product_id, coalesce(d.year_num, st.year_num) AS year_num,
  coalesce(d.month_num, st.month_num) AS month_num, CAST(coalesce(d.units, 0) AS BIGINT) AS units_sold,
  CAST(coalesce(st.stock, 0) AS BIGINT) AS closing_stock,
  {ratio('coalesce(st.stock, 0)', 'coalesce(d.units, 0)', 2)} AS stock_to_demand
FROM d FULL OUTER JOIN st ON d.product_id = st.product_id AND d.year_num = st.year_num AND d.month_num = st.month_num""")

q("b20_overstock", ["fact_inventory_snapshots", "fact_sales_items"], f"""
SELECT product_id, store_id, {ratio('inv_s', 'inv_n', 2)} AS avg_stock, units_sold, days_observed, days_of_cover FROM (
  SELECT *, {ratio('inv_s * days_observed', 'inv_n * units_sold', 1)} AS days_of_cover FROM (
    SELECT i.product_id, i.store_id, i.inv_s, i.inv_n,
      CAST(date_diff('day', strptime(CAST(i.d0 AS VARCHAR), '%Y%m%d')::DATE,
                     strptime(CAST(i.d1 AS VARCHAR), '%Y%m%d')::DATE) + 1 AS INTEGER) AS days_observed,
      CAST(coalesce(s.units, 0) AS BIGINT) AS units_sold
    FROM (SELECT product_id, store_id, sum(ending_inventory) AS inv_s, count(ending_inventory) AS inv_n,
                 min(date_sk) AS d0, max(date_sk) AS d1 FROM fact_inventory_snapshots GROUP BY ALL) i
    LEFT JOIN (SELECT product_id, store_id, sum(quantity) AS units FROM fact_sales_items
               WHERE source_system = 'POS' GROUP BY ALL) s ON i.product_id = s.product_id AND i.store_id = s.store_id
  ) a) b
WHERE days_of_cover > 90 OR (units_sold = 0 AND inv_s > 0)""")

cte("ret_slices", ["fact_returns", "dim_product"], f"""
SELECT CAST(r.product_id AS VARCHAR) AS product, p.category, r.quantity_returned AS q,
  CASE WHEN r.return_channel = 'ONLINE' THEN 'ECOM' WHEN r.return_channel = 'IN_STORE' THEN 'POS' ELSE r.return_channel END AS channel,
  printf('%04d-%02d', CAST(r.date_sk // 10000 AS INTEGER), CAST((r.date_sk // 100) % 100 AS INTEGER)) AS period
FROM fact_returns r JOIN dim_product p ON r.product_id = p.product_id""")
cte("sale_slices", ["fact_sales_items", "dim_product"], f"""
SELECT CAST(f.product_id AS VARCHAR) AS product, p.category, f.quantity AS q, f.source_system AS channel,
  printf('%04d-%02d', CAST(f.date_sk // 10000 AS INTEGER), CAST((f.date_sk // 100) % 100 AS INTEGER)) AS period
FROM fact_sales_items f JOIN dim_product p ON f.product_id = p.product_id""")
q("b21_return_rate_slices", ["ret_slices", "sale_slices"], _union([
    f"""SELECT '{sl}' AS slice, coalesce(r.m, s.m) AS member, CAST(coalesce(r.v, 0) AS BIGINT) AS returned_units,
  CAST(coalesce(s.v, 0) AS BIGINT) AS sold_units, {ratio('coalesce(r.v, 0)', 'coalesce(s.v, 0)', 4)} AS return_rate
FROM (SELECT {sl} AS m, sum(q) AS v FROM ret_slices GROUP BY {sl}) r
FULL OUTER JOIN (SELECT {sl} AS m, sum(q) AS v FROM sale_slices GROUP BY {sl}) s ON r.m IS NOT DISTINCT FROM s.m"""
    for sl in ("product", "category", "channel", "period")
]))

q("b22_return_reasons", ["fact_returns", "dim_product"], f"""
SELECT return_reason, category, return_count, units_returned, refund_amount,
  {ratio('units_returned', 'sum(units_returned) OVER (PARTITION BY return_reason)', 4)} AS share_of_reason
FROM (SELECT r.return_reason, p.category, count(*) AS return_count, CAST(sum(r.quantity_returned) AS BIGINT) AS units_returned,
             CAST(sum(r.refund_amount) AS DECIMAL(38,2)) AS refund_amount
      FROM fact_returns r JOIN dim_product p ON r.product_id = p.product_id GROUP BY r.return_reason, p.category) g""")

q("b23_refund_trend", ["fact_returns"], f"""
SELECT year_num, month_num, count(*) AS return_count, CAST(sum(quantity_returned) AS BIGINT) AS units_returned,
  CAST(sum(refund_amount) AS DECIMAL(38,2)) AS refund_amount
FROM (SELECT *, {_YM} FROM fact_returns) t GROUP BY year_num, month_num""")

q("b25_return_channel_patterns", ["fact_returns"], f"""
SELECT return_channel, count(*) AS return_count, CAST(sum(quantity_returned) AS BIGINT) AS units_returned,
  CAST(sum(refund_amount) AS DECIMAL(38,2)) AS refund_amount, {ratio('sum(refund_amount)', 'count(*)', 2)} AS avg_refund,
  count(*) FILTER (WHERE return_reason = 'DEFECTIVE') AS defective_count,
  count(*) FILTER (WHERE return_reason = 'DAMAGED') AS damaged_count,
  count(*) FILTER (WHERE return_reason = 'SIZE_FIT') AS size_fit_count
FROM fact_returns GROUP BY return_channel""")

q("b26_abnormal_returns", ["fact_returns"], f"""
WITH pm AS (SELECT product_id, {_YM}, CAST(sum(quantity_returned) AS BIGINT) AS units_returned
            FROM fact_returns GROUP BY ALL),
st AS (SELECT product_id, count(units_returned) AS n, CAST(sum(units_returned) AS HUGEINT) AS s,
              CAST(sum(units_returned * units_returned) AS HUGEINT) AS s2 FROM pm GROUP BY product_id)
SELECT pm.product_id, pm.year_num, pm.month_num, pm.units_returned, st.n AS months_observed,
  {ratio('st.s', 'st.n', 2)} AS mean_units
FROM pm JOIN st ON pm.product_id = st.product_id
WHERE st.n > 1 AND (st.n * pm.units_returned - st.s) > 0
  AND (st.n * pm.units_returned - st.s) * (st.n * pm.units_returned - st.s) * (st.n - 1) > 4 * st.n * (st.n * st.s2 - st.s * st.s)""")

q("b28_device_performance", ["fact_ecom_orders"], f"""
SELECT device_type, count(DISTINCT order_id) AS order_count, CAST(sum(net_revenue) AS DECIMAL(38,2)) AS net_revenue,
  {ratio('sum(net_revenue)', 'count(DISTINCT order_id)', 2)} AS aov
FROM fact_ecom_orders GROUP BY device_type""")

q("b29_traffic_source_revenue", ["fact_ecom_orders"], """
SELECT traffic_source, count(DISTINCT order_id) AS order_count, CAST(sum(total_amount) AS DECIMAL(38,2)) AS gross_revenue,
  CAST(sum(net_revenue) AS DECIMAL(38,2)) AS net_revenue
FROM fact_ecom_orders GROUP BY traffic_source""")

q("b30_traffic_net_after_returns", ["fact_ecom_orders", "silver_returns"], """
SELECT o.traffic_source, count(DISTINCT o.order_id) AS order_count, CAST(sum(o.total_amount) AS DECIMAL(38,2)) AS gross_revenue,
  CAST(sum(o.discount_amount) AS DECIMAL(38,2)) AS discounts, CAST(sum(coalesce(r.refund, 0)) AS DECIMAL(38,2)) AS refunds,
  CAST(sum(o.net_revenue) - sum(coalesce(r.refund, 0)) AS DECIMAL(38,2)) AS net_after_returns
FROM fact_ecom_orders o
LEFT JOIN (SELECT transaction_id AS order_id, sum(refund_amount) AS refund FROM silver_returns
           WHERE is_duplicate = 0 AND is_bad_refund = 0 GROUP BY transaction_id) r ON o.order_id = r.order_id
GROUP BY o.traffic_source""")

q("b31_acquisition_behaviour", ["fact_ecom_orders", "fact_sales_items"], f"""
SELECT o.channel, o.traffic_source, count(DISTINCT o.order_id) AS order_count, CAST(sum(l.units) AS BIGINT) AS units_sold,
  CAST(sum(o.net_revenue) AS DECIMAL(38,2)) AS net_revenue,
  {ratio('sum(o.net_revenue)', 'count(DISTINCT o.order_id)', 2)} AS aov
FROM fact_ecom_orders o
LEFT JOIN (SELECT transaction_id AS order_id, sum(quantity) AS units FROM fact_sales_items
           WHERE source_system = 'ECOM' GROUP BY transaction_id) l ON o.order_id = l.order_id
GROUP BY o.channel, o.traffic_source""")

q("stream_land_raw", _RAW, _union([
    f"SELECT '{ds}' AS table_name, '{SOURCE_FILES[ds]}' AS source_file, count(*) AS row_count, {malformed_count(ds)} AS rejected_count FROM {ds}"
    for ds in _RAW
]))

_DEDUP = {"pos_transactions": ["transaction_id"], "pos_items": ["transaction_id", "product_id"],
          "ecom_orders": ["order_id"], "ecom_items": ["order_item_id"],
          "inventory_snapshots": ["snapshot_date", "store_id", "product_id"], "returns": ["return_id"],
          "stores": ["store_id"]}
q("dedup_flag", [f"silver_{t}" for t in _DEDUP], _union([
    f"SELECT '{t}' AS table_name, '{', '.join(k)}' AS dedup_key, count(*) AS flagged_rows, "
    f"count(DISTINCT ({', '.join(k)})) AS duplicate_keys FROM silver_{t} WHERE is_duplicate = 1"
    for t, k in _DEDUP.items()
]))

"""Silver -> Gold: conformed dimensions and fact tables.

Join strategy
-------------
* ``dim_date`` is generated from a calendar range, so its size is bounded
  by construction (days in the range) and it is broadcast explicitly.
* ``dim_store`` / ``dim_product`` grow with the business; they are joined
  without hints so the planner (static stats) and AQE (measured shuffle
  sizes) decide between broadcast and sort-merge. AQE's skew-join split
  handles a hot product or store.
* Header-level dimensions (store, date) are attached to the *headers*
  before the line-header join, so the large line side is joined once on
  the header key and once on product.

Surrogate keys are deterministic 64-bit hashes of the row's business
content (no global sort, no single-partition window): the same input in
any order yields the same keys. A materialised warehouse gives dimensions
lasting numbers instead (``identity``). The grain audits check that both
are unique.

``unmatched`` has the valid rows that the inner joins of a fact drop, with
the reason; ``valid`` says which rows a load takes at all.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's calendar range; testdata uses its own.
DEFAULT_DATE_RANGE = ("2018-01-01", "2030-12-31")
TESTDATA_DATE_RANGE = ("1995-01-01", "2001-12-31")

_PRODUCT_ATTRS = [
    "product_id", "sku", "product_name", "category", "subcategory", "brand",
    "cost", "price", "margin", "season", "launch_date", "status",
]
_STORE_ATTRS = ["store_id", "store_name", "store_type", "region", "address", "opening_date", "manager_id"]
LINEAGE = ["load_timestamp", "source_file"]


def surrogate_key(*cols) -> F.Column:
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])


def dim_date(spark: SparkSession, start: str = DEFAULT_DATE_RANGE[0], end: str = DEFAULT_DATE_RANGE[1]) -> DataFrame:
    """Calendar dimension, one row per day in [start, end]."""
    n_days = (_dt.date.fromisoformat(end) - _dt.date.fromisoformat(start)).days + 1
    d = F.col("full_date")
    return (
        spark.range(0, max(n_days, 0), numPartitions=1)
        .select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("full_date"))
        .select(
            F.date_format(d, "yyyyMMdd").cast("int").alias("date_sk"),
            d,
            F.year(d).alias("year_num"),
            F.quarter(d).alias("quarter_num"),
            F.month(d).alias("month_num"),
            F.date_format(d, "MMMM").alias("month_name"),
            F.dayofmonth(d).alias("day_num"),
            F.date_format(d, "EEEE").alias("day_name"),
            F.when(F.date_format(d, "EEEE").isin("Saturday", "Sunday"), 1).otherwise(0).alias("is_weekend"),
            F.current_timestamp().cast("timestamp_ntz").alias("load_timestamp"),
        )
    )


def dim_product(products_clean: DataFrame) -> DataFrame:
    p = products_clean.filter((F.col("is_duplicate") == 0) & F.col("product_id").isNotNull())
    return p.select(
        surrogate_key(*_PRODUCT_ATTRS).alias("product_sk"), *_PRODUCT_ATTRS, *LINEAGE
    )


def dim_store(stores_clean: DataFrame) -> DataFrame:
    s = stores_clean.filter((F.col("is_duplicate") == 0) & F.col("store_id").isNotNull())
    return s.select(surrogate_key(*_STORE_ATTRS).alias("store_sk"), *_STORE_ATTRS, *LINEAGE)


def _date_keys(dd: DataFrame) -> DataFrame:
    """The broadcastable (bounded) calendar lookup: full_date -> date_sk."""
    return F.broadcast(dd.select("full_date", "date_sk"))


def _money(expr) -> F.Column:
    return F.round(expr, 2).try_cast("decimal(12,2)")


# Surrogate key of each fact, and the columns that it is the hash of.
FACT_KEYS = {
    "fact_pos_transactions": ("pos_transaction_sk", ["transaction_id", "store_sk", "date_sk"]),
    "fact_ecom_orders": ("ecom_order_sk", ["order_id", "date_sk"]),
    "fact_sales_items": ("sales_item_sk", ["source_system", "transaction_id", "product_sk", "date_sk", "quantity", "unit_price",
                                           "line_revenue"]),
    "fact_returns": ("return_sk", ["return_id", "product_sk", "date_sk", "store_sk"]),
    "fact_inventory_snapshots": ("inventory_sk", ["product_sk", "store_sk", "date_sk"]),
}


def _fact_key(fact: str) -> F.Column:
    key, parts = FACT_KEYS[fact]
    return surrogate_key(*parts).alias(key)


# The flags that keep a Silver row out of what it feeds.
BLOCKING_FLAGS = {
    "pos_transactions": ["is_bad_date", "is_bad_total", "is_bad_store"],
    "pos_items": ["is_bad_qty", "is_bad_price", "is_line_total_mismatch"],
    "ecom_orders": ["is_bad_date", "is_bad_total"],
    "ecom_items": ["is_bad_qty", "is_bad_price", "is_line_total_mismatch"],
    "inventory_snapshots": ["is_bad_date", "is_bad_store"],
    "returns": ["is_bad_return_date", "is_bad_qty", "is_bad_refund"],
    "products": [],
    "stores": [],
}


def valid(table: str) -> F.Column:
    """Whether a Silver row is taken: not a duplicate, and none of the flags that keep it out."""
    cond = F.col("is_duplicate") == 0
    for flag in BLOCKING_FLAGS[table]:
        cond = cond & (F.col(flag) == 0)
    return cond


def unmatched(table: str, silver: dict[str, DataFrame], dp: DataFrame, ds: DataFrame, dd: DataFrame) -> DataFrame:
    """Valid Silver rows that do not reach their fact, with ``reject_reason``:
    the key that a dimension, or the loaded headers, lack."""
    rows = silver[table].filter(valid(table))
    days = {"pos_transactions": "transaction_timestamp", "ecom_orders": "order_timestamp",
            "inventory_snapshots": "snapshot_date", "returns": "return_date"}
    known = []  # (what, value in the row, frame with the known values in _key)
    if table in days:
        known.append(("date", F.to_date(days[table]), F.broadcast(dd.select(F.col("full_date").alias("_key")))))
    if table in ("pos_transactions", "inventory_snapshots"):
        known.append(("store_id", F.col("store_id"), ds.select(F.col("store_id").alias("_key"))))
    if table in ("pos_items", "ecom_items", "inventory_snapshots", "returns"):
        known.append(("product_id", F.col("product_id"), dp.select(F.col("product_id").alias("_key")).distinct()))
    if table == "pos_items":
        known.append(("transaction_id", F.col("transaction_id"), pos_headers(silver["pos_transactions"], ds, dd).select(F.col("transaction_id").alias("_key"))))
    if table == "ecom_items":
        known.append(("order_id", F.col("order_id"), ecom_headers(silver["ecom_orders"], dd).select(F.col("order_id").alias("_key"))))
    reasons = []
    for i, (what, value, frame) in enumerate(known):
        frame = frame.withColumnRenamed("_key", f"_key{i}")
        rows = rows.join(frame, value == F.col(f"_key{i}"), "left")
        reasons.append(F.when(F.col(f"_key{i}").isNull(), F.lit(f"{what} NOT FOUND")))
    reason = F.concat_ws("; ", *reasons) if reasons else F.lit("")
    return rows.withColumn("reject_reason", reason).drop(*[f"_key{i}" for i in range(len(known))]).filter("reject_reason != ''")


def pos_headers(pt: DataFrame, ds: DataFrame, dd: DataFrame) -> DataFrame:
    """Valid POS headers with store and date keys attached."""
    return _with_store_and_date(_valid_pos_headers(pt), ds, dd)


def _valid_pos_headers(pt: DataFrame) -> DataFrame:
    return pt.filter(
        (F.col("is_duplicate") == 0) & (F.col("is_bad_date") == 0) & (F.col("is_bad_total") == 0)
    ).withColumn("_d", F.to_date("transaction_timestamp"))


def _with_store_and_date(h: DataFrame, ds: DataFrame, dd: DataFrame) -> DataFrame:
    return (
        h.join(ds.select("store_id", "store_sk"), "store_id")
        .join(_date_keys(dd), F.col("_d") == F.col("full_date"))
        .drop("_d", "full_date")
    )


def fact_pos_transactions(pt: DataFrame, ds: DataFrame, dd: DataFrame) -> DataFrame:
    h = pos_headers(pt.filter(F.col("is_bad_store") == 0), ds, dd)
    zero = F.lit(0)
    net = F.coalesce(F.col("total_amount"), zero) - F.coalesce(F.col("discount_amount"), zero) + F.coalesce(
        F.col("tax_amount"), zero
    )
    return h.select(
        _fact_key("fact_pos_transactions"),
        "transaction_id", "store_sk", "date_sk", "cashier_id", "payment_method",
        "total_amount", "discount_amount", "tax_amount",
        _money(net).alias("net_revenue"),
        *LINEAGE,
    )


def ecom_headers(eo: DataFrame, dd: DataFrame) -> DataFrame:
    h = eo.filter(
        (F.col("is_duplicate") == 0) & (F.col("is_bad_date") == 0) & (F.col("is_bad_total") == 0)
    ).withColumn("_d", F.to_date("order_timestamp"))
    return h.join(_date_keys(dd), F.col("_d") == F.col("full_date")).drop("_d", "full_date")


def fact_ecom_orders(eo: DataFrame, dd: DataFrame) -> DataFrame:
    h = ecom_headers(eo, dd)
    zero = F.lit(0)
    # Core's net revenue SUBTRACTS shipping (silver's adds it).
    net = F.coalesce(F.col("total_amount"), zero) - F.coalesce(F.col("discount_amount"), zero) - F.coalesce(
        F.col("shipping_cost"), zero
    )
    return h.select(
        _fact_key("fact_ecom_orders"),
        "order_id", "date_sk", "order_status", "channel", "device_type", "traffic_source",
        "total_amount", "discount_amount", "shipping_cost",
        _money(net).alias("net_revenue"),
        *LINEAGE,
    )


def _valid_lines(items: DataFrame) -> DataFrame:
    return items.filter(
        (F.col("is_duplicate") == 0)
        & (F.col("is_bad_qty") == 0)
        & (F.col("is_bad_price") == 0)
        & (F.col("is_line_total_mismatch") == 0)
    )


def fact_sales_items(
    pi: DataFrame, pt: DataFrame, ei: DataFrame, eo: DataFrame, dp: DataFrame, ds: DataFrame, dd: DataFrame,
    lines_first: bool = False,
) -> DataFrame:
    """POS lines UNION ALL e-commerce lines, at line grain.

    ``lines_first`` joins lines and headers before anything else, for tables
    that lie together by the header key: a join of the headers with the stores
    would deal them out anew. Same rows either way.
    """
    products = dp.select("product_id", "product_sk")
    if lines_first:
        pos_h = _valid_pos_headers(pt).select("transaction_id", "store_id", "_d")
        pos = _with_store_and_date(_valid_lines(pi).join(pos_h, "transaction_id"), ds, dd)
    else:
        pos_h = pos_headers(pt, ds, dd).select("transaction_id", "store_sk", "date_sk")
        pos = _valid_lines(pi).join(pos_h, "transaction_id")
    pos = (
        pos
        .join(products, "product_id")
        .select(
            F.lit("POS").alias("source_system"),
            "transaction_id", "product_sk", "store_sk", "date_sk",
            "quantity", "unit_price",
            F.col("calculated_line_total").alias("line_revenue"),
            *LINEAGE,
        )
    )
    ecom_h = ecom_headers(eo, dd).select("order_id", "date_sk")
    ecom = (
        _valid_lines(ei)
        .join(ecom_h, "order_id")
        .join(products, "product_id")
        .select(
            F.lit("ECOM").alias("source_system"),
            F.col("order_id").alias("transaction_id"),
            "product_sk",
            F.lit(None).cast("bigint").alias("store_sk"),
            "date_sk", "quantity", "unit_price",
            F.col("calculated_line_total").alias("line_revenue"),
            *LINEAGE,
        )
    )
    both = pos.unionByName(ecom)
    return both.select(_fact_key("fact_sales_items"), *both.columns)


def fact_returns(
    r: DataFrame, pt: DataFrame, dp: DataFrame, ds: DataFrame, dd: DataFrame, header_first: bool = False
) -> DataFrame:
    """Return events; store from the POS header when there is one.

    As written, the header side is *not* deduplicated, so a duplicated
    header repeats its returns (the grain audit reports it). ``header_first``
    joins returns and headers before anything else, for tables that lie
    together by the header key. Same rows either way.
    """
    valid = r.filter(
        (F.col("is_duplicate") == 0)
        & (F.col("is_bad_return_date") == 0)
        & (F.col("is_bad_qty") == 0)
        & (F.col("is_bad_refund") == 0)
    ).withColumn("_d", F.col("return_date"))
    stores = ds.select(F.col("store_id").alias("_hstore"), "store_sk")
    headers = pt.select(F.col("transaction_id"), F.col("store_id").alias("_hstore"))
    if header_first:
        out = valid.join(headers, "transaction_id", "left").join(stores, "_hstore", "left")
    else:
        out = valid
    out = out.join(dp.select("product_id", "product_sk"), "product_id").join(
        _date_keys(dd), F.col("_d") == F.col("full_date")
    )
    if not header_first:
        out = out.join(headers.join(stores, "_hstore", "left").drop("_hstore"), "transaction_id", "left")
    return out.select(
        _fact_key("fact_returns"),
        "return_id", "product_sk", "store_sk", "date_sk",
        "quantity_returned", "refund_amount", "return_reason", "return_channel",
        *LINEAGE,
    )


def fact_inventory_snapshots(i: DataFrame, dp: DataFrame, ds: DataFrame, dd: DataFrame) -> DataFrame:
    valid = i.filter(
        (F.col("is_duplicate") == 0) & (F.col("is_bad_date") == 0) & (F.col("is_bad_store") == 0)
    )
    out = (
        valid.join(_date_keys(dd), F.col("snapshot_date") == F.col("full_date"))
        .join(ds.select("store_id", "store_sk"), "store_id")
        .join(dp.select("product_id", "product_sk"), "product_id")
    )
    return out.select(
        _fact_key("fact_inventory_snapshots"),
        "product_sk", "store_sk", "date_sk",
        "beginning_inventory", "ending_inventory", "inventory_value", "safety_stock", "stock_status",
        *LINEAGE,
    )

"""Bronze -> Silver: type, normalise, derive, flag, mark duplicates.

Each cleaner is a pure function ``raw DataFrame -> clean DataFrame`` that
keeps every input row; bad values become NULL and are flagged, duplicates
are flagged (see ``dedup``). Conversions are evaluated once into typed
helper columns (``with_once``) and then reused, by filters as well, so every
raw value is parsed a single time.

All work is narrow (map-only) except the duplicate marking, which costs one
pre-aggregated shuffle of the key columns plus one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import convert as cv
from ledgerlake.operators.dedup import dedup_flag, dedup_once

LINEAGE = ["load_timestamp", "source_file"]

# Duplicate keys and NOT NULL columns per clean table.
DEDUP_KEYS: dict[str, list[str] | None] = {
    "pos_transactions": ["transaction_id"],
    "pos_items": ["transaction_id", "product_id"],
    "ecom_orders": ["order_id"],
    "ecom_items": ["order_item_id"],
    "inventory_snapshots": ["snapshot_date", "store_id", "product_id"],
    "returns": ["return_id"],
    "products": None,
    "stores": ["store_id"],
}
NOT_NULL: dict[str, list[str]] = {
    "pos_transactions": ["transaction_id"],
    "pos_items": ["transaction_id", "product_id"],
    "ecom_orders": ["order_id"],
    "ecom_items": ["order_item_id"],
    "inventory_snapshots": ["store_id", "product_id"],
    "returns": ["return_id"],
    "products": ["product_id"],
    "stores": ["store_id"],
}
RAW_OF = {
    "pos_transactions": "pos_transactions_raw",
    "pos_items": "pos_items_raw",
    "ecom_orders": "ecom_orders_raw",
    "ecom_items": "ecom_items_raw",
    "inventory_snapshots": "inventory_snapshots_raw",
    "returns": "returns_raw",
    "products": "products_raw",
    "stores": "stores_raw",
}


def _lineage(raw: DataFrame) -> list:
    return [F.col(c) if c in raw.columns else F.lit(None).cast("timestamp" if c == "load_timestamp" else "string").alias(c) for c in LINEAGE]


def _lineage_ntz(raw: DataFrame) -> list:
    cols = _lineage(raw)
    cols[0] = cols[0].cast("timestamp_ntz").alias("load_timestamp")
    return cols


# The typed values that duplicate marking needs, for the key and
# for what is accepted.
KEY_INPUTS: dict[str, list[str]] = {
    "pos_transactions": ["_total", "_disc", "_tax"],
    "pos_items": ["_product", "_qty", "_price"],
    "ecom_orders": ["_ship", "_total", "_disc"],
    "ecom_items": ["_item", "_qty", "_price"],
    "inventory_snapshots": ["_date", "_store", "_product"],
    "returns": [],
    "stores": ["_store"],
}


def _typed(raw: DataFrame, keys_of: str | bool, **columns) -> DataFrame:
    """``raw`` with the typed values. With ``keys_of`` a table only those of its
    ``KEY_INPUTS`` are converted, the others are NULL: what passes through a
    generator is evaluated even where nobody asks for it."""
    needed = KEY_INPUTS[keys_of] if keys_of else list(columns)
    typed = cv.with_once(raw, **{n: columns[n] for n in needed}) if needed else raw
    absent = {n: F.when(F.lit(False), c) for n, c in columns.items() if n not in needed}
    return typed.withColumns(absent) if absent else typed


def clean_pos_transactions(raw: DataFrame, finish: bool = True, keys_only: bool = False) -> DataFrame:
    typed = _typed(
        raw, keys_only and "pos_transactions",
        _store=cv.try_id("store_id"),
        _ts=cv.try_timestamp("transaction_timestamp"),
        _total=cv.try_dec("total_amount"),
        _disc=cv.try_dec("discount_amount"),
        _tax=cv.try_dec("tax_amount"),
    )
    out = typed.select(
        cv.trim("transaction_id").alias("transaction_id"),
        F.col("_store").alias("store_id"),
        F.col("_ts").alias("transaction_timestamp"),
        cv.trim("cashier_id").alias("cashier_id"),
        cv.blank_to_null("customer_id").alias("customer_id"),
        cv.vocab("payment_method", cv.PAYMENT_RULES).alias("payment_method"),
        cv.non_negative(F.col("_total")).alias("total_amount"),
        cv.non_negative(F.col("_disc")).alias("discount_amount"),
        cv.non_negative(F.col("_tax")).alias("tax_amount"),
        cv.is_null_flag(F.col("_ts")).alias("is_bad_date"),
        cv.is_null_flag(F.col("_store")).alias("is_bad_store"),
        cv.is_null_flag(F.col("_total")).alias("is_bad_total"),
        *_lineage_ntz(raw),
    )
    return _finish(out, "pos_transactions", raw) if finish else out


def _line_items(typed: DataFrame) -> list:
    """Shared derivations of POS and e-commerce line items."""
    qty, price, total = F.col("_qty"), F.col("_price"), F.col("_line")
    calculated = F.round(F.coalesce(qty, F.lit(0)) * F.coalesce(price, F.lit(0)), 2)
    return [
        cv.non_negative(qty).alias("quantity"),
        cv.non_negative(price).alias("unit_price"),
        cv.non_negative(total).alias("line_total"),
        calculated.try_cast("decimal(12,2)").alias("calculated_line_total"),
        cv.is_null_flag(qty).alias("is_bad_qty"),
        cv.is_null_flag(price).alias("is_bad_price"),
        cv.is_null_flag(total).alias("is_bad_line_total"),
        cv.flag(F.abs(total - qty * price) > F.lit(0.05).cast("decimal(3,2)")).alias("is_line_total_mismatch"),
    ]


def _typed_items(raw: DataFrame, keys_of: str | bool = False, **more) -> DataFrame:
    return _typed(
        raw, keys_of,
        **more,
        _product=cv.try_id("product_id"),
        _qty=cv.try_int("quantity"),
        _price=cv.try_dec("unit_price"),
        _line=cv.try_dec("line_total"),
    )


def clean_pos_items(raw: DataFrame, finish: bool = True, keys_only: bool = False) -> DataFrame:
    typed = _typed_items(raw, keys_only and "pos_items")
    out = typed.select(
        cv.trim("transaction_id").alias("transaction_id"),
        F.col("_product").alias("product_id"),
        *_line_items(typed),
        *_lineage_ntz(raw),
    )
    return _finish(out, "pos_items", raw) if finish else out


def clean_ecom_orders(raw: DataFrame, finish: bool = True, keys_only: bool = False) -> DataFrame:
    typed = _typed(
        raw, keys_only and "ecom_orders",
        _ts=cv.try_timestamp("order_timestamp"),
        _ship=cv.try_dec("shipping_cost"),
        _total=cv.try_dec("total_amount"),
        _disc=cv.try_dec("discount_amount"),
    )
    zero = F.lit(0)
    # Silver's net revenue ADDS shipping (core's subtracts it); both kept.
    net = F.round(
        F.coalesce(F.col("_total"), zero) - F.coalesce(F.col("_disc"), zero) + F.coalesce(F.col("_ship"), zero), 2
    )
    out = typed.select(
        cv.trim("order_id").alias("order_id"),
        cv.blank_to_null("customer_id").alias("customer_id"),
        F.col("_ts").alias("order_timestamp"),
        cv.upper_trim("order_status").alias("order_status"),
        cv.upper_trim("channel").alias("channel"),
        cv.upper_trim("device_type").alias("device_type"),
        cv.blank_to_null("traffic_source").alias("traffic_source"),
        cv.non_negative(F.col("_ship")).alias("shipping_cost"),
        F.col("_total").alias("total_amount"),
        cv.non_negative(F.col("_disc")).alias("discount_amount"),
        net.try_cast("decimal(12,2)").alias("net_revenue"),
        cv.is_null_flag(F.col("_ts")).alias("is_bad_date"),
        cv.is_null_flag(F.col("_total")).alias("is_bad_total"),
        *_lineage_ntz(raw),
    )
    return _finish(out, "ecom_orders", raw) if finish else out


def clean_ecom_items(raw: DataFrame, finish: bool = True, keys_only: bool = False) -> DataFrame:
    typed = _typed_items(raw, keys_only and "ecom_items", _item=cv.try_id("order_item_id"))
    out = typed.select(
        F.col("_item").alias("order_item_id"),
        cv.trim("order_id").alias("order_id"),
        F.col("_product").alias("product_id"),
        *_line_items(typed),
        *_lineage_ntz(raw),
    )
    return _finish(out, "ecom_items", raw) if finish else out


def clean_inventory_snapshots(raw: DataFrame, finish: bool = True, keys_only: bool = False) -> DataFrame:
    typed = _typed(
        raw, keys_only and "inventory_snapshots",
        _date=cv.try_date("snapshot_date"),
        _store=cv.try_id("store_id"),
        _product=cv.try_id("product_id"),
        _begin=cv.try_int("beginning_inventory"),
        _end=cv.try_int("ending_inventory"),
        _value=cv.try_dec("inventory_value", 14, 2),
        _safety=cv.try_int("safety_stock"),
    )
    out = typed.select(
        F.col("_date").alias("snapshot_date"),
        F.col("_store").alias("store_id"),
        F.col("_product").alias("product_id"),
        cv.non_negative(F.col("_begin")).alias("beginning_inventory"),
        cv.non_negative(F.col("_end")).alias("ending_inventory"),
        cv.non_negative(F.col("_value")).alias("inventory_value"),
        cv.non_negative(F.col("_safety")).alias("safety_stock"),
        cv.vocab("stock_status", cv.STOCK_STATUS_RULES).alias("stock_status"),
        (F.col("_end") - F.col("_begin")).alias("calculated_inventory_delta"),
        cv.is_null_flag(F.col("_date")).alias("is_bad_date"),
        cv.is_null_flag(F.col("_store")).alias("is_bad_store"),
        cv.flag(F.col("_end") < F.col("_safety")).alias("is_below_safety_stock"),
        *_lineage_ntz(raw),
    )
    return _finish(out, "inventory_snapshots", raw) if finish else out


def clean_returns(raw: DataFrame, finish: bool = True, keys_only: bool = False) -> DataFrame:
    typed = _typed(
        raw, keys_only and "returns",
        _product=cv.try_id("product_id"),
        _date=cv.try_date("return_date"),
        _refund=cv.try_dec("refund_amount"),
        _qty=cv.try_int("quantity_returned"),
    )
    out = typed.select(
        cv.trim("return_id").alias("return_id"),
        cv.trim("transaction_id").alias("transaction_id"),
        F.col("_product").alias("product_id"),
        F.col("_date").alias("return_date"),
        cv.vocab("return_reason", cv.RETURN_REASON_RULES).alias("return_reason"),
        cv.non_negative(F.col("_refund")).alias("refund_amount"),
        cv.positive(F.col("_qty")).alias("quantity_returned"),
        cv.vocab("return_channel", cv.RETURN_CHANNEL_RULES).alias("return_channel"),
        cv.is_null_flag(F.col("_date")).alias("is_bad_return_date"),
        # As written: a NULL quantity is not "bad" (only <= 0 is).
        cv.flag(F.col("_qty") <= 0).alias("is_bad_qty"),
        cv.is_null_flag(F.col("_refund")).alias("is_bad_refund"),
        *_lineage_ntz(raw),
    )
    return _finish(out, "returns", raw) if finish else out


def clean_products(raw: DataFrame, finish: bool = True, keys_only: bool = False) -> DataFrame:
    typed = _typed(raw, keys_only and "products", _product=cv.try_id("product_id"), _cost=cv.try_dec("cost"), _price=cv.try_dec("price"))
    cost, price = F.col("_cost"), F.col("_price")
    out = typed.select(
        F.col("_product").alias("product_id"),
        cv.trim("sku").alias("sku"),
        cv.trim("product_name").alias("product_name"),
        cv.upper_trim("category").alias("category"),
        cv.upper_trim("subcategory").alias("subcategory"),
        cv.upper_trim("brand").alias("brand"),
        cv.non_negative(cost).alias("cost"),
        cv.non_negative(price).alias("price"),
        F.when(price.isNotNull() & cost.isNotNull(), price - cost).try_cast("decimal(12,2)").alias("margin"),
        cv.upper_trim("season").alias("season"),
        cv.try_date("launch_date").alias("launch_date"),
        cv.upper_trim("status").alias("status"),
        cv.flag(price < cost).alias("is_negative_margin"),
        *_lineage_ntz(raw),
    )
    return _finish(out, "products", raw) if finish else out


def clean_stores(raw: DataFrame, finish: bool = True, keys_only: bool = False) -> DataFrame:
    typed = _typed(raw, keys_only and "stores", _store=cv.try_id("store_id"))
    out = typed.select(
        F.col("_store").alias("store_id"),
        cv.trim("store_name").alias("store_name"),
        cv.upper_trim("store_type").alias("store_type"),
        cv.upper_trim("region").alias("region"),
        cv.trim("address").alias("address"),
        cv.try_date("opening_date").alias("opening_date"),
        cv.blank_to_null("manager_id").alias("manager_id"),
        *_lineage_ntz(raw),
    )
    return _finish(out, "stores", raw) if finish else out


def _finish(out: DataFrame, table: str, raw: DataFrame) -> DataFrame:
    """Drop NOT-NULL violators (quarantined separately), mark duplicates,
    and put lineage last."""
    out = accepted(out, table)
    keys = DEDUP_KEYS[table]
    if keys is None:
        out = out.withColumn("is_duplicate", F.lit(0))
    else:
        seen = accepted(CLEANERS[table](raw, finish=False, keys_only=True), table)
        out = dedup_flag(out, keys, seen=seen)
    return lineage_last(out)


def unique_rows(raw: DataFrame, table: str) -> DataFrame:
    """The rows of the cleaned table that are no duplicates, for a fact that
    takes no others; a table whose key is NOT NULL. Converts each row once."""
    keys = DEDUP_KEYS[table]
    if not keys or not set(keys) <= set(NOT_NULL[table]):
        raise ValueError(f"{table}: its key may be NULL, or it has none")
    return lineage_last(dedup_once(accepted(CLEANERS[table](raw, finish=False), table), keys))


def lineage_last(out: DataFrame) -> DataFrame:
    body = [c for c in out.columns if c not in LINEAGE]
    return out.select(*body, *LINEAGE)


MONEY = "decimal(12,2)"


def _fits(*amounts) -> F.Column:
    """Whether the sum of the amounts (NULL as 0) is money of the target type."""
    total = F.lit(0)
    for a in amounts:
        total = total + F.coalesce(a, F.lit(0))
    return F.round(total, 2).try_cast(MONEY).isNotNull()


def money_fits(table: str):
    """On typed rows: whether each amount derived from them, here and in the
    facts, fits its column. (The reference fails the load where one does not.)"""
    if table == "pos_transactions":
        return _fits(F.col("total_amount"), -F.col("discount_amount"), F.col("tax_amount"))
    if table == "ecom_orders":
        core = _fits(F.col("total_amount"), -F.col("discount_amount"), -F.col("shipping_cost"))
        return F.col("net_revenue").isNotNull() & core
    if table in ("pos_items", "ecom_items"):
        return F.col("calculated_line_total").isNotNull()
    return F.lit(True)


def raw_money_fits(table: str):
    """The same on raw rows."""
    dec = cv.try_dec
    part = lambda c: cv.non_negative(dec(c))
    if table == "pos_transactions":
        return _fits(part("total_amount"), -part("discount_amount"), part("tax_amount"))
    if table == "ecom_orders":
        return _fits(dec("total_amount"), -dec("discount_amount"), dec("shipping_cost")) & _fits(
            dec("total_amount"), -part("discount_amount"), -part("shipping_cost"))
    if table in ("pos_items", "ecom_items"):
        return _fits(cv.try_int("quantity") * dec("unit_price"))
    return F.lit(True)


def not_null_predicate(table: str):
    pred = None
    for c in NOT_NULL[table]:
        p = F.col(c).isNotNull()
        pred = p if pred is None else (pred & p)
    return pred


def accepted(df: DataFrame, table: str) -> DataFrame:
    return df.filter(not_null_predicate(table) & money_fits(table))


CLEANERS = {
    "pos_transactions": clean_pos_transactions,
    "pos_items": clean_pos_items,
    "ecom_orders": clean_ecom_orders,
    "ecom_items": clean_ecom_items,
    "inventory_snapshots": clean_inventory_snapshots,
    "returns": clean_returns,
    "products": clean_products,
    "stores": clean_stores,
}

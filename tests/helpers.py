"""Builders for hand-written raw rows (rule tables)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.plans.warehouse import Warehouse
from ledgerlake.sources.schemas import RAW_COLUMNS, SOURCE_FILES, raw_schema

CAL = ("2024-01-01", "2024-12-31")
LOAD_TS = dt.datetime(2024, 6, 1, 0, 0, 0)


def raw(spark, dataset: str, rows: list[dict]):
    """All-string raw frame with lineage; ``_ts`` in a row sets its load time."""
    cols = RAW_COLUMNS[dataset]
    schema = raw_schema(dataset).add("load_timestamp", "timestamp")
    data = [tuple(r.get(c) for c in cols) + (r.get("_ts", LOAD_TS),) for r in rows]
    return spark.createDataFrame(data, schema).withColumn("source_file", F.lit(SOURCE_FILES[dataset]))


def warehouse(spark, **tables) -> Warehouse:
    frames = {}
    for ds in RAW_COLUMNS:
        frames[ds] = raw(spark, ds, tables.get(ds.replace("_raw", ""), []))
    return Warehouse.from_raw(spark, frames, CAL)


def rows(df, *cols):
    sel = df.select(*cols) if cols else df
    return sorted([tuple(r) for r in sel.collect()], key=lambda t: tuple(str(x) for x in t))


PRODUCT = {"product_id": "5", "sku": "S5", "product_name": "X", "category": "c", "subcategory": "s",
           "brand": "b", "cost": "2.00", "price": "3.00", "season": "spring", "launch_date": "2024-01-01",
           "status": "active"}
STORE = {"store_id": "1", "store_name": "S", "store_type": "Mall", "region": "east", "address": "a",
         "opening_date": "2020-01-01", "manager_id": "M1"}


def pos_header(tid: str, total="100.00", disc="0", tax="0", store="1", ts="2024-03-01 10:00:00", pay="Cash"):
    return {"transaction_id": tid, "store_id": store, "transaction_timestamp": ts, "cashier_id": "C1",
            "customer_id": "9", "payment_method": pay, "total_amount": total, "discount_amount": disc,
            "tax_amount": tax}


def pos_item(tid: str, pid="5", qty="1", price="1.00", total=None):
    if total is None:
        total = f"{int(qty) * float(price):.2f}" if qty.lstrip("-").isdigit() else "0"
    return {"transaction_id": tid, "product_id": pid, "quantity": qty, "unit_price": price, "line_total": total}


def ecom_order(oid: str, total="100.00", disc="0", ship="0", ts="2024-03-01 20:00:00"):
    return {"order_id": oid, "customer_id": "1", "order_timestamp": ts, "order_status": "completed",
            "channel": "web", "shipping_cost": ship, "total_amount": total, "discount_amount": disc,
            "device_type": "mobile", "traffic_source": "Search"}


def ecom_item(iid: str, oid: str, pid="5", qty="1", price="1.00", total=None):
    if total is None:
        total = f"{int(qty) * float(price):.2f}"
    return {"order_item_id": iid, "order_id": oid, "product_id": pid, "quantity": qty, "unit_price": price,
            "line_total": total}


def ret(rid: str, tid: str, pid="5", qty="1", refund="1.00", date="2024-03-05", reason="damaged", channel="online"):
    return {"return_id": rid, "transaction_id": tid, "product_id": pid, "return_date": date,
            "return_reason": reason, "refund_amount": refund, "quantity_returned": qty, "return_channel": channel}


def inv(date: str, store="1", pid="5", begin="10", end="3", value="30.00", status="In stock", safety="5"):
    return {"snapshot_date": date, "store_id": store, "product_id": pid, "beginning_inventory": begin,
            "ending_inventory": end, "inventory_value": value, "stock_status": status, "safety_stock": safety}

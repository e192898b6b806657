"""Source contracts: eight all-string raw extracts.

Bronze is schema-on-read: every business column is text, nothing is
inferred. Lineage columns (load_timestamp, source_file) are appended after
the load.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Raw column lists per dataset, in source order.
RAW_COLUMNS: dict[str, list[str]] = {
    "pos_transactions_raw": [
        "transaction_id", "store_id", "transaction_timestamp", "cashier_id",
        "customer_id", "payment_method", "total_amount", "discount_amount",
        "tax_amount",
    ],
    "pos_items_raw": [
        "transaction_id", "product_id", "quantity", "unit_price", "line_total",
    ],
    "ecom_orders_raw": [
        "order_id", "customer_id", "order_timestamp", "order_status", "channel",
        "shipping_cost", "total_amount", "discount_amount", "device_type",
        "traffic_source",
    ],
    "ecom_items_raw": [
        "order_item_id", "order_id", "product_id", "quantity", "unit_price",
        "line_total",
    ],
    "inventory_snapshots_raw": [
        "snapshot_date", "store_id", "product_id", "beginning_inventory",
        "ending_inventory", "inventory_value", "stock_status", "safety_stock",
    ],
    "returns_raw": [
        "return_id", "transaction_id", "product_id", "return_date",
        "return_reason", "refund_amount", "quantity_returned", "return_channel",
    ],
    "products_raw": [
        "product_id", "sku", "product_name", "category", "subcategory", "brand",
        "cost", "price", "season", "launch_date", "status",
    ],
    "stores_raw": [
        "store_id", "store_name", "store_type", "region", "address",
        "opening_date", "manager_id",
    ],
}

# Dataset -> CSV file name of the scheduled extract.
SOURCE_FILES: dict[str, str] = {
    "pos_transactions_raw": "pos_transactions_raw.csv",
    "pos_items_raw": "pos_order_items_raw.csv",
    "ecom_orders_raw": "ecom_orders_raw.csv",
    "ecom_items_raw": "ecom_order_items_raw.csv",
    "inventory_snapshots_raw": "inventory_raw.csv",
    "returns_raw": "returns_raw.csv",
    "products_raw": "products_raw.csv",
    "stores_raw": "stores_raw.csv",
}

# Human labels used by the record-count validation.
RECORD_COUNT_LABELS: dict[str, str] = {
    "pos_transactions_raw": "POS Transactions",
    "pos_items_raw": "POS Items",
    "ecom_orders_raw": "E-Commerce Orders",
    "ecom_items_raw": "E-Commerce Items",
    "inventory_snapshots_raw": "Inventory Snapshots",
    "returns_raw": "Returns",
    "products_raw": "Products",
    "stores_raw": "Stores",
}

RAW_DATASETS = list(RAW_COLUMNS)


def raw_schema(dataset: str) -> StructType:
    """All-string StructType of one raw dataset."""
    return StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS[dataset]])

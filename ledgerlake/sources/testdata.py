"""Testdata adapter: TPC-H-like parquet tables -> eight dirty raw extracts.

The projection rules are fixture definitions (FIXTURES.md section 3). They
are written as SQL expression text that Spark and DuckDB evaluate
identically, so the engine and the SQL oracle start from the same raw rows.
Everything downstream of these frames (cleaning, modelling, KPIs) is
implemented independently on each side.

Each raw frame is: source table (optionally filtered) UNION ALL the rows
matching a "repeat" predicate, projected to all-string columns, UNION ALL the
rows matching the "refused" predicate with an identifier that cleaning
refuses, plus the lineage columns (``raw_frame`` gives the copies in one scan). The rows matching "malformed" come once
more as a broken line of the CSV extract.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.schemas import RAW_COLUMNS, SOURCE_FILES

# Integer money helpers shared by several rules (whole cents, portable).
_UNIT_CENTS = (
    "CAST(FLOOR(CAST(ROUND(l_extendedprice * 100) AS BIGINT) / CAST(l_quantity AS BIGINT)) AS BIGINT)"
)
_QTY_TEXT = (
    "CASE WHEN l_partkey % 83 = 2 THEN '1.5' "
    "WHEN l_partkey % 79 = 2 THEN '-' || CAST(CAST(l_quantity AS INT) AS STRING) "
    "ELSE CAST(CAST(l_quantity AS INT) AS STRING) END"
)
_UNIT_PRICE_TEXT = f"CAST(CAST(CAST({_UNIT_CENTS} AS DECIMAL(18,0)) / 100 AS DECIMAL(12,2)) AS STRING)"
_LINE_TOTAL_TEXT = (
    f"CAST(CAST(CAST({_UNIT_CENTS} * CAST(l_quantity AS BIGINT) + "
    "CASE WHEN (l_orderkey + l_linenumber) % 13 = 0 THEN 100 ELSE 0 END "
    "AS DECIMAL(18,0)) / 100 AS DECIMAL(12,2)) AS STRING)"
)
_BEGIN_INV = "(20 + (l_partkey * 7 + l_suppkey) % 60)"


@dataclass(frozen=True)
class RawRule:
    """How one raw extract is derived from testdata."""

    source_sql: str          # FROM clause body (tables / subquery), aliased as needed
    where: str | None        # row filter on the source
    repeat: str | None       # rows matching this predicate appear twice
    columns: dict            # raw column -> SQL expression over the source
    refused: tuple[str, str, str]  # rows matching come once more with this column as this expression
    malformed: str           # rows matching come once more in the extract, as a broken line


# FIXTURES.md section 3 projection rules.
RULES: dict[str, RawRule] = {
    "stores_raw": RawRule(
        source_sql="supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
        where=None,
        repeat="s_suppkey % 25 = 7",
        columns={
            "store_id": "CAST(s_suppkey AS STRING)",
            "store_name": "'  ' || s_name",
            "store_type": "CASE s_suppkey % 3 WHEN 0 THEN 'Mall' WHEN 1 THEN 'Outlet ' ELSE 'High Street' END",
            "region": "lower(r_name)",
            "address": "'1 Main St, ' || n_name",
            "opening_date": "CASE WHEN s_suppkey % 17 = 3 THEN 'n/a' ELSE '1994-0' || CAST(1 + s_suppkey % 9 AS STRING) || '-15' END",
            "manager_id": "CASE WHEN s_suppkey % 11 = 5 THEN '  ' ELSE 'M' || CAST(s_suppkey AS STRING) END",
        },
        refused=('s_suppkey % 9 = 4', 'store_id', "'HQ'"),
        malformed='s_suppkey % 8 = 5',
    ),
    "products_raw": RawRule(
        source_sql="part",
        where=None,
        repeat=None,
        columns={
            "product_id": "CAST(p_partkey AS STRING)",
            "sku": "' SKU-' || CAST(p_partkey AS STRING)",
            "product_name": "p_name",
            "category": "lower(p_type)",
            "subcategory": "'size ' || CAST(p_size % 5 AS STRING)",
            "brand": "p_brand",
            "cost": "CAST(CAST(CAST(CAST(FLOOR(CAST(ROUND(p_retailprice * 100) AS BIGINT) * (60 + p_partkey % 50) / 100) AS BIGINT) AS DECIMAL(18,0)) / 100 AS DECIMAL(12,2)) AS STRING)",
            "price": "CASE WHEN p_partkey % 101 = 9 THEN 'N/A' ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) END",
            "season": "CASE p_partkey % 4 WHEN 0 THEN 'spring' WHEN 1 THEN 'summer' WHEN 2 THEN 'winter' ELSE 'all year' END",
            "launch_date": "CASE WHEN p_partkey % 89 = 4 THEN '1994-13-01' ELSE '1994-06-01' END",
            "status": "CASE WHEN p_partkey % 7 = 0 THEN 'Discontinued' ELSE 'active' END",
        },
        refused=('p_partkey % 71 = 5', 'product_id', "'P-' || CAST(p_partkey AS STRING)"),
        malformed='p_partkey % 53 = 8',
    ),
    "pos_transactions_raw": RawRule(
        source_sql="orders",
        where="o_orderkey % 2 = 0",
        repeat="o_orderkey % 194 = 0",
        columns={
            "transaction_id": "' T' || CAST(o_orderkey AS STRING)",
            "store_id": "CASE WHEN o_orderkey % 106 = 0 THEN 'unknown' ELSE CAST(o_custkey % n_sup AS STRING) END",
            "transaction_timestamp": "CASE WHEN o_orderkey % 122 = 0 THEN 'not-a-date' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:15:00' END",
            "cashier_id": "'C' || CAST(o_custkey % 13 AS STRING)",
            "customer_id": "CASE WHEN o_orderkey % 10 = 4 THEN ' ' ELSE CAST(o_custkey AS STRING) END",
            "payment_method": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Cash' WHEN '2-HIGH' THEN ' debit card' WHEN '3-MEDIUM' THEN 'CREDIT card' WHEN '5-LOW' THEN ' gift ' ELSE CAST(NULL AS STRING) END",
            "total_amount": "CASE WHEN o_orderkey % 142 = 0 THEN '-1.00' WHEN o_orderkey % 94 = 0 THEN 'abc' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END",
            "discount_amount": "CASE WHEN o_custkey % 6 = 1 THEN CAST(NULL AS STRING) WHEN o_custkey % 6 = 2 THEN '-5' ELSE CAST(o_custkey % 6 AS STRING) || '.25' END",
            "tax_amount": "CAST(o_custkey % 9 AS STRING) || '.10'",
        },
        refused=('o_orderkey % 134 = 0', 'transaction_id', 'CAST(NULL AS STRING)'),
        malformed='o_orderkey % 158 = 0',
    ),
    "ecom_orders_raw": RawRule(
        source_sql="orders",
        where="o_orderkey % 2 = 1",
        repeat="o_orderkey % 97 = 5",
        columns={
            "order_id": "'E' || CAST(o_orderkey AS STRING)",
            "customer_id": "CASE WHEN o_orderkey % 10 = 3 THEN '' ELSE CAST(o_custkey AS STRING) END",
            "order_timestamp": "CASE WHEN o_orderkey % 59 = 1 THEN '1998-02-30' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 20:30:00' END",
            "order_status": "CASE o_orderstatus WHEN 'F' THEN 'completed ' WHEN 'O' THEN 'Open' ELSE 'pending' END",
            "channel": "CASE WHEN o_custkey % 3 = 0 THEN 'app' ELSE ' Web' END",
            "shipping_cost": "CASE WHEN o_custkey % 8 = 0 THEN CAST(NULL AS STRING) ELSE CAST(o_custkey % 8 AS STRING) || '.99' END",
            "total_amount": "CASE WHEN o_orderkey % 73 = 1 THEN '-20.00' WHEN o_orderkey % 47 = 1 THEN '' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END",
            "discount_amount": "CASE WHEN o_custkey % 6 = 2 THEN '-5' ELSE CAST(o_custkey % 6 AS STRING) || '.25' END",
            "device_type": "CASE o_custkey % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'Desktop' ELSE 'tablet ' END",
            "traffic_source": "CASE o_custkey % 5 WHEN 0 THEN 'Search' WHEN 1 THEN 'social' WHEN 2 THEN 'Email' WHEN 3 THEN 'direct' ELSE ' ' END",
        },
        refused=('o_orderkey % 83 = 2', 'order_id', 'CAST(NULL AS STRING)'),
        malformed='o_orderkey % 89 = 4',
    ),
    "pos_items_raw": RawRule(
        source_sql="lineitem",
        where="l_orderkey % 2 = 0",
        repeat=None,
        columns={
            "transaction_id": "'T' || CAST(l_orderkey AS STRING) || ' '",
            "product_id": "CAST(l_partkey AS STRING)",
            "quantity": _QTY_TEXT,
            "unit_price": _UNIT_PRICE_TEXT,
            "line_total": _LINE_TOTAL_TEXT,
        },
        refused=('l_orderkey % 146 = 0 AND l_linenumber = 1', 'product_id', "'12x'"),
        malformed='l_orderkey % 202 = 0 AND l_linenumber = 2',
    ),
    "ecom_items_raw": RawRule(
        source_sql="lineitem",
        where="l_orderkey % 2 = 1",
        repeat=None,
        columns={
            "order_item_id": "CAST(l_orderkey * 10 + l_linenumber AS STRING)",
            "order_id": "'E' || CAST(l_orderkey AS STRING)",
            "product_id": "CAST(l_partkey AS STRING)",
            "quantity": _QTY_TEXT,
            "unit_price": _UNIT_PRICE_TEXT,
            "line_total": _LINE_TOTAL_TEXT,
        },
        refused=('l_orderkey % 103 = 6 AND l_linenumber = 1', 'order_item_id', "'?'"),
        malformed='l_orderkey % 107 = 2 AND l_linenumber = 1',
    ),
    "inventory_snapshots_raw": RawRule(
        source_sql=(
            "(SELECT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS d, "
            "CAST(SUM(CAST(l_quantity AS INT)) AS BIGINT) AS q FROM lineitem "
            "GROUP BY l_partkey, l_suppkey, CAST(l_shipdate AS DATE)) g"
        ),
        where=None,
        repeat="l_partkey % 61 = 6",
        columns={
            "snapshot_date": "CASE WHEN l_partkey % 97 = 3 THEN '1997-00-10' ELSE CAST(d AS STRING) END",
            "store_id": "CAST(l_suppkey AS STRING)",
            "product_id": "CAST(l_partkey AS STRING)",
            "beginning_inventory": f"CAST({_BEGIN_INV} AS STRING)",
            "ending_inventory": f"CAST({_BEGIN_INV} - q AS STRING)",
            "inventory_value": f"CAST(CAST(({_BEGIN_INV} - q) * 9.5 AS DECIMAL(14,2)) AS STRING)",
            "stock_status": (
                f"CASE WHEN l_partkey % 29 = 0 THEN 'backorder' WHEN {_BEGIN_INV} - q <= 0 THEN 'Out of Stock' "
                f"WHEN {_BEGIN_INV} - q < 5 + l_partkey % 20 THEN 'low stock' ELSE 'In stock' END"
            ),
            "safety_stock": "CAST(5 + l_partkey % 20 AS STRING)",
        },
        refused=('l_partkey % 73 = 11', 'store_id', "'closed'"),
        malformed='l_partkey % 67 = 13',
    ),
    "returns_raw": RawRule(
        source_sql="lineitem",
        where="l_returnflag = 'R' AND (l_orderkey + l_partkey) % 3 = 0",
        repeat="l_orderkey % 40 = 8",
        columns={
            "return_id": "'R' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)",
            "transaction_id": "CASE WHEN l_orderkey % 2 = 0 THEN 'T' ELSE 'E' END || CAST(l_orderkey AS STRING)",
            "product_id": "CAST(l_partkey AS STRING)",
            "return_date": "CASE WHEN l_partkey % 53 = 1 THEN 'soon' ELSE CAST(CAST(CAST(l_shipdate AS DATE) + INTERVAL 10 DAY AS DATE) AS STRING) END",
            "return_reason": "CASE l_linenumber % 5 WHEN 0 THEN 'Defective unit' WHEN 1 THEN 'damaged box' WHEN 2 THEN 'wrong size' WHEN 3 THEN ' changed mind ' ELSE CAST(NULL AS STRING) END",
            "refund_amount": "CASE WHEN l_partkey % 67 = 1 THEN 'tbd' ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END",
            "quantity_returned": "CASE WHEN l_partkey % 31 = 1 THEN '0' WHEN l_partkey % 37 = 1 THEN CAST(NULL AS STRING) ELSE CAST(CAST(l_quantity AS INT) AS STRING) END",
            "return_channel": "CASE l_orderkey % 3 WHEN 0 THEN 'In Store' WHEN 1 THEN 'online' ELSE 'Online Store' END",
        },
        refused=('l_orderkey % 44 = 9', 'return_id', 'CAST(NULL AS STRING)'),
        malformed='l_orderkey % 50 = 7',
    ),
}

# Testdata tables each rule reads (only these are scanned).
_SOURCE_TABLES = {
    "stores_raw": ["supplier", "nation", "region"],
    "products_raw": ["part"],
    "pos_transactions_raw": ["orders"],
    "ecom_orders_raw": ["orders"],
    "pos_items_raw": ["lineitem"],
    "ecom_items_raw": ["lineitem"],
    "inventory_snapshots_raw": ["lineitem"],
    "returns_raw": ["lineitem"],
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _source_frame(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    t = lambda n: _table(spark, sf_dir, n)
    if dataset == "stores_raw":
        return (
            t("supplier")
            .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
    if dataset == "pos_transactions_raw":
        # The store id of a transaction cycles over the supplier count; a
        # scalar subquery (evaluated once) rather than a cross join.
        n_sup = t("supplier").agg(F.count(F.lit(1))).scalar()
        return t("orders").withColumn("n_sup", n_sup)
    if dataset == "inventory_snapshots_raw":
        d = F.col("l_shipdate").cast("date")
        return (
            t("lineitem")
            .groupBy("l_partkey", "l_suppkey", d.alias("d"))
            .agg(F.sum(F.col("l_quantity").cast("int")).cast("bigint").alias("q"))
        )
    return t(_SOURCE_TABLES[dataset][0])


def _spark_sql(rule: str) -> str:
    """The rule as Spark evaluates it. Whole cents become money by an exact
    product: a decimal division, two a line, took most of an extract's time."""
    return rule.replace("AS DECIMAL(18,0)) / 100 AS DECIMAL(12,2))", "AS DECIMAL(18,0)) * 0.01BD AS DECIMAL(12,2))")


def _columns(dataset: str) -> list:
    rule = RULES[dataset].columns
    return [F.expr(_spark_sql(rule[c])).cast("string").alias(c) for c in RAW_COLUMNS[dataset]]


def _copies(rule: RawRule) -> F.Column:
    """The copies of a source row: 0 itself, 1 its repeat, 2 the refused one."""
    repeat, refused = F.expr(rule.repeat or "false"), F.expr(rule.refused[0])
    numbers = lambda *n: F.array(*[F.lit(i) for i in n])
    return F.when(repeat & refused, numbers(0, 1, 2)).when(repeat, numbers(0, 1)).when(refused, numbers(0, 2)).otherwise(numbers(0))


def _with_header(batches, header: str):
    yield pa.RecordBatch.from_pydict({"value": [header]})
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0)], ["value"])


def write_malformed(spark: SparkSession, sf_dir: str, base_path: str, compression: str = "none") -> None:
    """Append the broken lines to extracts that are already written: every
    other one has a field too many, the others end after two fields."""
    for ds, rule in RULES.items():
        src = _source_frame(spark, sf_dir, ds)
        src = src.filter(F.expr(rule.where)) if rule.where else src
        rows = src.filter(F.expr(rule.malformed)).select(*_columns(ds))
        cells = [F.coalesce(F.col(c), F.lit("")) for c in RAW_COLUMNS[ds]]
        longer, shorter = F.concat_ws(",", *cells, F.lit("extra")), F.concat_ws(",", *cells[:2])
        lines = rows.select(F.when(F.crc32(F.concat_ws(",", *cells)) % 2 == 0, longer).otherwise(shorter).alias("value"))
        lines = lines.mapInArrow(partial(_with_header, header=",".join(RAW_COLUMNS[ds])), "value string")
        lines.write.mode("append").option("compression", compression).text(f"{base_path.rstrip('/')}/{SOURCE_FILES[ds]}")


def raw_frame(spark: SparkSession, sf_dir: str, dataset: str, with_lineage: bool = True) -> DataFrame:
    """One dirty raw extract derived from the testdata tables, which are read
    once: a row gives its copies there."""
    rule = RULES[dataset]
    src = _source_frame(spark, sf_dir, dataset)
    if rule.where:
        src = src.filter(F.expr(rule.where))
    src = src.withColumn("_copy", F.explode(_copies(rule)))
    _, column, value = rule.refused
    out = src.select(*[
        F.when(F.col("_copy") == 2, F.expr(value)).otherwise(c).alias(n) if n == column else c
        for n, c in zip(RAW_COLUMNS[dataset], _columns(dataset))
    ])
    if with_lineage:
        out = out.withColumn("load_timestamp", F.current_timestamp()).withColumn(
            "source_file", F.lit(SOURCE_FILES[dataset])
        )
    return out


def raw_frames(spark: SparkSession, sf_dir: str, with_lineage: bool = True) -> dict[str, DataFrame]:
    return {ds: raw_frame(spark, sf_dir, ds, with_lineage) for ds in RULES}

"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query derives its input from the testdata tables through the full
raw -> silver -> gold chain, so its work grows with the data. Outputs
expose natural keys only (surrogate-key values are an implementation
detail) and leave out load timestamps.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.plans import views
from ledgerlake.plans.warehouse import SILVER_TABLES, Warehouse
from ledgerlake.sources.schemas import RAW_COLUMNS

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


_WAREHOUSES: dict[tuple[int, str], Warehouse] = {}


def warehouse_for(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One lazily built warehouse per (session, input folder).

    Only the driver-side plan objects are shared between queries (no data is
    cached): each query still scans the testdata tables when it runs.
    """
    key = (id(spark._jsparkSession), sf_dir.rstrip("/"))
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse.from_testdata(spark, sf_dir)
    return _WAREHOUSES[key]


def register(key: str, fn: Callable[[Warehouse], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(warehouse_for(spark, sf_dir))

    run.__name__ = key
    REGISTRY[key] = run


def without_load_time(df: DataFrame) -> DataFrame:
    return df.drop("load_timestamp")


# ----------------------------------------------------------------- silver
for _t in SILVER_TABLES:
    register(f"silver_{_t}", lambda w, t=_t: without_load_time(w.silver(t)))


# ----------------------------------------------------------------- gold
def gold_natural(w: Warehouse, table: str) -> DataFrame:
    """Gold table with surrogate keys replaced by natural keys."""
    df = w.gold(table)
    if table == "dim_date":
        return without_load_time(df)
    if table in ("dim_product", "dim_store"):
        return without_load_time(df.drop(f"{table[4:]}_sk"))
    if "product_sk" in df.columns:
        df = df.join(w.dim_product().select("product_sk", "product_id"), "product_sk")
    if "store_sk" in df.columns:
        df = df.join(w.dim_store().select("store_sk", "store_id"), "store_sk", "left")
    drop = [c for c in df.columns if c.endswith("_sk") and c != "date_sk"]
    return without_load_time(df.drop(*drop))


for _t in [
    "dim_date", "dim_product", "dim_store", "fact_pos_transactions", "fact_ecom_orders",
    "fact_sales_items", "fact_returns", "fact_inventory_snapshots",
]:
    register(_t, lambda w, t=_t: gold_natural(w, t))

# ----------------------------------------------------------------- views
for _k, _fn in views.VIEWS.items():
    register(_k, _fn)


def queries() -> dict[str, QueryFn]:
    return dict(REGISTRY)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One KPI through every layer: revenue by channel with share of total."""
    return REGISTRY["view_revenue_summary"](spark, sf_dir).orderBy(F.col("source_system"))


# ----------------------------------------------------------------- ingestion
def _drop_of(spark: SparkSession, sf_dir: str, compression: str = "none") -> str:
    """A folder with the eight CSV extracts, malformed lines and all (what a
    scheduled drop brings)."""
    from ledgerlake.session import loading, scratch_path
    from ledgerlake.sources import csv_loader, testdata

    base = scratch_path(spark, f"extracts-{uuid.uuid4().hex[:12]}")
    with loading(spark):
        csv_loader.write_extracts(testdata.raw_frames(spark, sf_dir, with_lineage=False), base, compression)
        testdata.write_malformed(spark, sf_dir, base, compression)
    return base


def _stored(spark: SparkSession, sf_dir: str, compression: str = "none"):
    """(store, counts) of the extracts loaded into stored raw tables."""
    from ledgerlake.sources import csv_loader
    from ledgerlake.sources.stored import TableStore

    base = _drop_of(spark, sf_dir, compression)
    store = TableStore(spark, f"{base}-store")
    return store, csv_loader.replace_raw(store, base)


def _load_raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest extract, loaded twice: the second load replaces the first."""
    from ledgerlake.sources import csv_loader
    from ledgerlake.sources.stored import TableStore

    base = _drop_of(spark, sf_dir)
    store = TableStore(spark, f"{base}-store")
    for _ in range(2):
        csv_loader.replace_raw(store, base, ["pos_items_raw"])
    return csv_loader.stored_raw(store, "pos_items_raw").select(*RAW_COLUMNS["pos_items_raw"])


def _load_all_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per stored raw table: its rows, empty cells, and the lines that were rejected."""
    from ledgerlake.sources import csv_loader

    store, _ = _stored(spark, sf_dir)
    out = None
    for ds, cols in RAW_COLUMNS.items():
        nulls = sum((F.col(c).isNull().cast("bigint") for c in cols), F.lit(0).cast("bigint"))
        g = csv_loader.stored_raw(store, ds).agg(F.count(F.lit(1)).alias("record_count"), F.sum(nulls).cast("bigint").alias("null_cells"))
        lost = csv_loader.stored_rejects(store, ds).agg(F.count("record")).scalar()
        g = g.select(F.lit(ds).alias("table_name"), "record_count", "null_cells", lost.alias("rejected_count"))
        out = g if out is None else out.unionByName(g)
    return out


def _lineage_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.sources import csv_loader

    store, _ = _stored(spark, sf_dir)
    out = None
    for ds in RAW_COLUMNS:
        g = csv_loader.stored_raw(store, ds).groupBy(F.lit(ds).alias("table_name"), "source_file").agg(
            F.count(F.lit(1)).alias("row_count"), F.count("load_timestamp").alias("stamped_rows")
        )
        out = g if out is None else out.unionByName(g)
    return out


REGISTRY["load_raw_csv"] = _load_raw_csv
REGISTRY["load_all_raw"] = _load_all_raw
REGISTRY["lineage_enrich"] = _lineage_enrich


def _full_refresh_write(w: Warehouse) -> DataFrame:
    """Materialise Silver and Gold twice into the same folder (overwrite):
    the second run must leave the same tables and row counts."""
    from ledgerlake.plans.warehouse import GOLD_TABLES
    from ledgerlake.session import scratch_path

    path = scratch_path(w.spark, f"warehouse-{uuid.uuid4().hex[:12]}")
    w.materialize(path)
    written = w.materialize(path)
    frames = [
        written.silver(t).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit("silver").alias("layer"), F.lit(t).alias("table_name"), "row_count")
        for t in SILVER_TABLES
    ] + [
        written.gold(t).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit("gold").alias("layer"), F.lit(t).alias("table_name"), "row_count")
        for t in GOLD_TABLES
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _publish_views(w: Warehouse) -> DataFrame:
    """Publish all views, repaired variants and sample queries over the written
    Gold tables and count their rows in another session."""
    from ledgerlake.plans import published
    from ledgerlake.plans.warehouse import GOLD_TABLES
    from ledgerlake.session import loading, scratch_path

    name = f"warehouse_{uuid.uuid4().hex[:12]}"
    path = scratch_path(w.spark, name)
    written = w.materialize(path)
    names = published.publish(w.spark, path, name, {t: written.gold(t) for t in GOLD_TABLES}, variants=True)
    other = w.spark.newSession()
    # One view after another: in a single query the driver would hold the plans,
    # the stages and the broadcasts of all of them at a time.
    with loading(other):
        counts = [(n, other.table(f"{name}.{n}").count()) for n in names]
    return w.spark.createDataFrame(counts, "view_name string NOT NULL, row_count long NOT NULL")


def _co_partitioned_facts(w: Warehouse) -> DataFrame:
    """The facts built from headers, lines and returns that lie in buckets of
    the header key: rows and money of each."""
    from ledgerlake.plans.layout import lay_out
    from ledgerlake.plans.warehouse import run_all
    from ledgerlake.session import scratch_path

    name = f"layout_{uuid.uuid4().hex[:12]}"
    buckets = int(w.spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(w.spark, name)
    bronze = {ds: os.path.join(path, "bronze", ds) for ds in w.raw_datasets}
    run_all([lambda ds=ds, at=at: w.raw(ds).write.parquet(at) for ds, at in bronze.items()])
    raw = {ds: w.spark.read.schema(w.raw(ds).schema).parquet(at) for ds, at in bronze.items()}
    laid = lay_out(Warehouse.from_raw(w.spark, raw, w.date_range), path, name, buckets)
    out = None
    for fact, money in CO_PARTITIONED_MONEY.items():
        g = laid.gold(fact).agg(
            F.count(F.lit(1)).alias("row_count"), F.sum(money).cast("decimal(38,2)").alias("money"),
            F.count_distinct("date_sk").alias("days"),
        ).select(F.lit(fact).alias("table_name"), "row_count", "money", "days")
        out = g if out is None else out.unionByName(g)
    return out


# The amount of each fact that is added up.
CO_PARTITIONED_MONEY = {
    "fact_pos_transactions": "net_revenue",
    "fact_ecom_orders": "net_revenue",
    "fact_sales_items": "line_revenue",
    "fact_returns": "refund_amount",
}

register("full_refresh_write", _full_refresh_write)
register("co_partitioned_facts", _co_partitioned_facts)
register("publish_views", _publish_views)

# ----------------------------------------------------------------- quality
from ledgerlake.operators import quality  # noqa: E402
from ledgerlake.operators.dedup import dedup_keep_latest  # noqa: E402
from ledgerlake.operators import gold as _gold  # noqa: E402


def _gold_tables(w: Warehouse) -> dict[str, DataFrame]:
    from ledgerlake.plans.warehouse import GOLD_TABLES

    return {t: w.gold(t) for t in GOLD_TABLES}


register("sample_rows", lambda w: quality.sample_rows(w.raw_datasets, ordered=True))
register("record_counts", lambda w: quality.record_counts(w.raw_datasets))
register("dq_profile", lambda w: quality.dq_profile(w.raw_datasets))
register("dq_flag_summary", lambda w: quality.dq_flag_summary({t: w.silver(t) for t in SILVER_TABLES}))
register("quarantine_not_null", lambda w: quality.quarantine_not_null({t: w.silver_typed(t) for t in SILVER_TABLES}))
def _fk_audit(w: Warehouse) -> DataFrame:
    """The facts' keys, and the Silver keys before the joins that drop orphans."""
    gold = _gold_tables(w)
    silver = {t: w.silver(t) for t in SILVER_TABLES}
    return quality.fk_audit(gold).unionByName(quality.silver_key_audit(silver, gold))


def _load_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts -> stored raw tables -> Silver -> Gold, each write counting."""
    from ledgerlake.operators.silver import RAW_OF
    from ledgerlake.plans.warehouse import GOLD_TABLES
    from ledgerlake.sources import csv_loader

    store, lines = _stored(spark, sf_dir, "gzip")
    raw = {ds: csv_loader.stored_raw(store, ds) for ds in RAW_OF.values()}
    totals: dict = {}
    written = Warehouse.from_raw(spark, raw, _gold.TESTDATA_DATE_RANGE).materialize(totals=totals)
    return quality.load_reconcile(spark, lines, totals, {t: written.gold(t) for t in GOLD_TABLES})


def _dim_identities(w: Warehouse) -> DataFrame:
    """Two loads of the dimensions: the second brings every tenth product for
    the first time and other costs for the rest. Keys of the first are kept."""
    from ledgerlake.operators import identity
    from ledgerlake.operators.silver import clean_products, clean_stores
    from ledgerlake.session import scratch_path
    from ledgerlake.sources.stored import TableStore

    store = TableStore(w.spark, scratch_path(w.spark, f"keys-{uuid.uuid4().hex[:12]}"))
    products = w.raw("products_raw")
    later = F.col("product_id").try_cast("bigint") % 10 == 3
    raised = products.withColumn("cost", F.coalesce(F.col("cost").try_cast("decimal(12,2)") + 1, F.lit(0)).cast("string"))
    loads = {
        "dim_product": ("product_id", _gold.dim_product, [clean_products(products.filter(~later)), clean_products(raised)]),
        "dim_store": ("store_id", _gold.dim_store, [clean_stores(w.raw("stores_raw"))] * 2),
    }
    out = None
    for name, (natural, build, frames) in loads.items():
        sk = f"{name[4:]}_sk"
        first, second = (identity.with_identities(store, name, build(f), natural, sk).select(natural, sk) for f in frames)
        before = first.select(F.col(natural).alias("_id"), F.col(sk).alias("_old"))
        both = second.join(before, F.col(natural) == F.col("_id"), "left")
        g = both.agg(
            F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("_old") == F.col(sk)).alias("kept_keys"),
            F.count_if(F.col("_old").isNull()).alias("new_keys"), F.min(sk).alias("least_key"),
            F.max(sk).alias("greatest_key"), F.count_distinct(sk).alias("distinct_keys"),
        ).select(F.lit(name).alias("table_name"), "*")
        out = g if out is None else out.unionByName(g)
    return out


register("dim_identities", _dim_identities)
register("fk_audit", _fk_audit)
REGISTRY["load_reconcile"] = _load_reconcile
register("grain_audit_facts", lambda w: quality.grain_audit(_gold_tables(w), quality.FACT_GRAINS))
register("grain_audit_dims", lambda w: quality.grain_audit(_gold_tables(w), quality.DIM_GRAINS).unionByName(
    quality.grain_audit(_gold_tables(w), quality.DIM_KEYS)))


def _dedup_keep_latest(w: Warehouse) -> DataFrame:
    """Documented intent: the store dimension keeping the newest version of
    a duplicated store instead of dropping every copy."""
    typed = w.silver_typed("stores")
    latest = dedup_keep_latest(quality.quarantine_split(typed, "stores")[0], ["store_id"])
    dim = _gold.dim_store(latest.withColumn("is_duplicate", F.lit(0)))
    return without_load_time(dim.drop("store_sk"))


register("dedup_keep_latest", _dedup_keep_latest)

# Per table the key, the rows that the next extract brings again
# (a newer version of the first, an older one of the second), the column that
# changes in them and how, and a number of a row's content.
VERSIONS = {
    "pos_transactions": (["transaction_id"], "store_id % 3 = 1", "store_id % 3 = 2", "total_amount", "total_amount + 1", "total_amount"),
    "pos_items": (["transaction_id", "product_id"], "product_id % 5 = 2", "product_id % 5 = 4", "unit_price", "unit_price + 1", "unit_price"),
    "ecom_orders": (["order_id"], "length(order_id) % 2 = 0", "length(order_id) % 2 = 1", "total_amount", "total_amount + 1", "total_amount"),
    "ecom_items": (["order_item_id"], "product_id % 5 = 2", "product_id % 5 = 4", "unit_price", "unit_price + 1", "unit_price"),
    "inventory_snapshots": (["snapshot_date", "store_id", "product_id"], "product_id % 5 = 2", "product_id % 5 = 4",
                            "ending_inventory", "ending_inventory + 1", "ending_inventory"),
    "returns": (["return_id"], "product_id % 5 = 2", "product_id % 5 = 4", "refund_amount", "refund_amount + 1", "refund_amount"),
    "stores": (["store_id"], "store_id % 4 = 1", "store_id % 4 = 2", "region", "region || '!'", "length(region)"),
}


def _merge_latest(w: Warehouse) -> DataFrame:
    """Two extracts merged into each of the seven stored tables: the second
    holds a newer version of some rows and an older one of others."""
    from ledgerlake.operators import merge
    from ledgerlake.session import scratch_path
    from ledgerlake.sources.stored import TableStore

    store = TableStore(w.spark, scratch_path(w.spark, f"merged-{uuid.uuid4().hex[:12]}"))
    out = None
    for table, (keys, newer, older, column, changed, number) in VERSIONS.items():
        first = quality.quarantine_split(w.silver_typed(table), table)[0]
        at = lambda days: F.lit(f"2024-06-{10 + days:02d}").cast("timestamp_ntz")
        again = [first.filter(cond).withColumn(column, F.expr(changed).cast(first.schema[column].dataType)).withColumn("load_timestamp", at(d))
                 for cond, d in ((newer, 1), (older, -1))]
        first = first.withColumn("load_timestamp", at(0))
        stored = merge.merge_into(store, table, first)
        merged = merge.merge_into(store, table, again[0].unionByName(again[1]))
        replaced = merge.replaced_keys(stored, merged, keys).agg(F.count(F.lit(1))).scalar()
        g = merged.agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.expr(number)).cast("decimal(38,2)").alias("content"))
        g = g.select(F.lit(table).alias("table_name"), "row_count", replaced.alias("replaced_keys"), "content")
        out = g if out is None else out.unionByName(g)
    return out


register("merge_latest", _merge_latest)

# ----------------------------------------------------------------- metrics
from ledgerlake.plans import metrics  # noqa: E402

for _k, _fn in metrics.METRICS.items():
    register(_k, _fn)

# ----------------------------------------------------------------- questions
from ledgerlake.plans import questions  # noqa: E402

for _k, _fn in questions.QUESTIONS.items():
    register(_k, _fn)


# ----------------------------------------------------------------- streaming
def _stream_land_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the extracts through the streaming bronze loader (twice: the
    second availableNow run must land nothing new), then count the accepted
    and the rejected lines per table."""
    from ledgerlake.streaming import landing

    base = _drop_of(spark, sf_dir)
    for _ in range(2):
        landing.land_all(spark, base, f"{base}-bronze", f"{base}-ckpt")
    out = None
    for ds in RAW_COLUMNS:
        g = landing.read_bronze(spark, f"{base}-bronze", ds).groupBy(
            F.lit(ds).alias("table_name"), "source_file").agg(F.count(F.lit(1)).alias("row_count"))
        lost = landing.read_rejects(spark, f"{base}-bronze", ds).agg(F.count("record")).scalar()
        g = g.select("*", lost.alias("rejected_count"))
        out = g if out is None else out.unionByName(g)
    return out


REGISTRY["stream_land_raw"] = _stream_land_raw


# ----------------------------------------------------------------- dedup marker
def _dedup_flag(w: Warehouse) -> DataFrame:
    """The shared duplicate marker, summarised per clean table: rows flagged
    and distinct keys they belong to."""
    from ledgerlake.operators.silver import DEDUP_KEYS

    out = None
    for t, keys in DEDUP_KEYS.items():
        if keys is None:
            continue
        flagged = w.silver(t).filter(F.col("is_duplicate") == 1)
        g = flagged.agg(
            F.count(F.lit(1)).alias("flagged_rows"),
            F.count_distinct(*keys).alias("duplicate_keys"),
        ).select(F.lit(t).alias("table_name"), F.lit(", ".join(keys)).alias("dedup_key"),
                 "flagged_rows", "duplicate_keys")
        out = g if out is None else out.unionByName(g)
    return out


register("dedup_flag", _dedup_flag)

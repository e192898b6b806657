"""The warehouse: lazily built layers over one raw source.

A ``Warehouse`` holds the eight raw frames and builds Silver and Gold on
demand as lazy DataFrame plans (memoised, so one plan reuses the same
sub-plans and Spark can reuse their exchanges). ``materialize`` writes the
Silver and Gold tables to Parquet under the shared checkpoint folder and
returns a warehouse that reads them back: the lineage is cut there, and a
lost executor only recomputes from the written layer.
"""

from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import gold, identity, quality, silver
from ledgerlake.session import checkpoint_dir, loading
from ledgerlake.sources import testdata
from ledgerlake.sources.stored import TableStore

SILVER_TABLES = list(silver.CLEANERS)
GOLD_TABLES = [
    "dim_date", "dim_product", "dim_store",
    "fact_pos_transactions", "fact_ecom_orders", "fact_sales_items",
    "fact_returns", "fact_inventory_snapshots",
]
# Natural keys of the dimensions that get lasting numbers.
DIM_NATURAL = {"dim_product": "product_id", "dim_store": "store_id"}
# Fact tables are written partitioned by calendar month (yyyyMM, derived
# from the yyyyMMdd date key) when materialised: month filters prune
# folders, and a month is a large enough unit at any scale.
FACT_PARTITION = "date_month"
# Tables with a row for each line, or for each product, store and day: their
# writes follow one another, so that the shuffles of one at most lie on disk.
LARGE = {"pos_items", "ecom_items", "inventory_snapshots", "fact_sales_items", "fact_inventory_snapshots"}
WRITTEN = {"compression": "zstd"}


def run_all(jobs: list, parallel: int = 8) -> None:
    """Submit independent Spark jobs at the same time, so that their stages overlap."""
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        for f in [pool.submit(j) for j in jobs]:
            f.result()


def run_tables(jobs: list, parallel: int = 8) -> None:
    """``run_all`` for (table, job): those of large tables in turn, beside the others."""
    def in_turn() -> None:
        for table, job in jobs:
            if table in LARGE:
                job()

    run_all([in_turn, *[job for table, job in jobs if table not in LARGE]], parallel)


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        raw: dict[str, DataFrame] | None = None,
        date_range: tuple[str, str] = gold.DEFAULT_DATE_RANGE,
        tables: dict[str, DataFrame] | None = None,
    ):
        self.spark = spark
        self._raw = dict(raw or {})
        self.date_range = date_range
        self._memo: dict[str, DataFrame] = dict(tables or {})
        self._written = set(self._memo)

    # ------------------------------------------------------------------ sources
    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, date_range=gold.TESTDATA_DATE_RANGE) -> "Warehouse":
        return cls(spark, testdata.raw_frames(spark, sf_dir), date_range)

    @classmethod
    def from_raw(cls, spark: SparkSession, raw: dict[str, DataFrame], date_range=gold.DEFAULT_DATE_RANGE) -> "Warehouse":
        return cls(spark, raw, date_range)

    @classmethod
    def from_parquet(cls, spark: SparkSession, path: str, date_range=gold.DEFAULT_DATE_RANGE,
                     schemas: dict | None = None, bronze: list[str] = ()) -> "Warehouse":
        """Read a materialised warehouse. ``schemas`` (table -> StructType)
        lets empty tables - written without data files - be read back.
        ``bronze`` names the raw extracts that were written too; asking for
        them by name works on any file system."""
        schemas = schemas or {}

        def read(layer: str, name: str) -> DataFrame:
            reader = spark.read
            if name in schemas:
                reader = reader.schema(schemas[name])
            return reader.parquet(os.path.join(path, layer, name))

        tables = {}
        for name in SILVER_TABLES:
            tables[f"silver_{name}"] = read("silver", f"{name}")
        for name in GOLD_TABLES:
            df = read("gold", name)
            tables[name] = df.drop(FACT_PARTITION) if FACT_PARTITION in df.columns else df
        raw = {ds: read("bronze", ds) for ds in bronze}
        return cls(spark, raw, date_range, tables)

    # ------------------------------------------------------------------ layers
    def _get(self, key: str, build) -> DataFrame:
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def raw(self, dataset: str) -> DataFrame:
        return self._raw[dataset]

    @property
    def raw_datasets(self) -> dict[str, DataFrame]:
        return dict(self._raw)

    def silver(self, table: str) -> DataFrame:
        return self._get(f"silver_{table}", lambda: silver.CLEANERS[table](self.raw(silver.RAW_OF[table])))

    def silver_typed(self, table: str) -> DataFrame:
        """Typed rows before the NOT NULL split and duplicate marking."""
        return self._get(
            f"typed_{table}", lambda: silver.CLEANERS[table](self.raw(silver.RAW_OF[table]), finish=False)
        )

    def unique(self, table: str) -> DataFrame:
        """Silver rows for a fact that takes no duplicates: the written table,
        or (not written) its rows that are none, found in one aggregation."""
        if f"silver_{table}" in self._written:
            return self.silver(table)
        return self._get(f"unique_{table}", lambda: silver.unique_rows(self.raw(silver.RAW_OF[table]), table))

    def quarantine(self, table: str) -> DataFrame:
        """The raw rows that Silver refuses: raw columns, lineage and
        ``reject_reason``."""
        return self._get(f"quarantine_{table}", lambda: quality.quarantined(self.raw(silver.RAW_OF[table]), table))

    def unmatched(self, table: str) -> DataFrame:
        """The valid Silver rows that no fact takes, with ``reject_reason``."""
        return gold.unmatched(table, {t: self.silver(t) for t in (table, "pos_transactions", "ecom_orders")},
                              self.dim_product(), self.dim_store(), self.dim_date())

    def dim_date(self) -> DataFrame:
        return self._get("dim_date", lambda: gold.dim_date(self.spark, *self.date_range))

    def dim_product(self) -> DataFrame:
        return self._get("dim_product", lambda: gold.dim_product(self.silver("products")))

    def dim_store(self) -> DataFrame:
        return self._get("dim_store", lambda: gold.dim_store(self.silver("stores")))

    def fact_pos_transactions(self) -> DataFrame:
        return self._get(
            "fact_pos_transactions",
            lambda: gold.fact_pos_transactions(self.silver("pos_transactions"), self.dim_store(), self.dim_date()),
        )

    def fact_ecom_orders(self) -> DataFrame:
        return self._get(
            "fact_ecom_orders", lambda: gold.fact_ecom_orders(self.silver("ecom_orders"), self.dim_date())
        )

    def fact_sales_items(self) -> DataFrame:
        return self._get(
            "fact_sales_items",
            lambda: gold.fact_sales_items(
                self.unique("pos_items"), self.unique("pos_transactions"),
                self.unique("ecom_items"), self.unique("ecom_orders"),
                self.dim_product(), self.dim_store(), self.dim_date(),
            ),
        )

    def fact_returns(self) -> DataFrame:
        return self._get(
            "fact_returns",
            lambda: gold.fact_returns(
                self.silver("returns"), self.silver("pos_transactions"),
                self.dim_product(), self.dim_store(), self.dim_date(),
            ),
        )

    def fact_inventory_snapshots(self) -> DataFrame:
        return self._get(
            "fact_inventory_snapshots",
            lambda: gold.fact_inventory_snapshots(
                self.silver("inventory_snapshots"), self.dim_product(), self.dim_store(), self.dim_date()
            ),
        )

    def gold(self, table: str) -> DataFrame:
        return getattr(self, table)()

    # ------------------------------------------------------------ materialise
    def materialize(self, path: str | None = None, include_bronze: bool = False, parallel: int = 8,
                    totals: dict | None = None) -> "Warehouse":
        """Write Silver and Gold (and optionally Bronze) as Parquet; return a
        warehouse that reads the written tables. Overwrite mode: re-running
        gives the same content (idempotent full refresh). Product and store
        keys are numbers that a later run into the same folder keeps.

        ``totals``, if given, gets the rows that each write counted (layer and
        table -> counts), and the valid rows that no fact takes are written as
        well. The counts are observed in the last stage of each write, where a
        repeated task counts once.

        Independent tables of a layer are submitted as concurrent Spark jobs
        (silver tables; then dimensions; then facts), so the scheduler
        overlaps their stages instead of running them one after another; only
        the ``LARGE`` ones, which fill a cluster each, are written in turn.
        Shuffle files go with the write that made them (``session.loading``).
        """
        with loading(self.spark):
            return self._materialize(path, include_bronze, parallel, totals)

    def _materialize(self, path: str | None, include_bronze: bool, parallel: int, totals: dict | None) -> "Warehouse":
        if path is None:
            path = os.path.join(checkpoint_dir(self.spark), f"warehouse-{uuid.uuid4().hex[:12]}")

        seen: dict = {}

        def watched(df: DataFrame, what: tuple[str, str], *more) -> DataFrame:
            if totals is None:
                return df
            seen[what] = Observation()
            return df.observe(seen[what], F.count(F.lit(1)).alias("rows"), *more)

        def silver_counts(n: str) -> list:
            return [F.count_if(F.col("is_duplicate") == 1).alias("duplicates"), F.count_if(gold.valid(n)).alias("valid")]

        source = self
        if include_bronze:
            run_all([
                (lambda ds=ds, df=df: df.write.mode("overwrite").options(**WRITTEN).parquet(os.path.join(path, "bronze", ds)))
                for ds, df in self._raw.items()
            ], parallel)
            # Silver builds from the written bronze layer: each raw extract is
            # derived once, and the lineage is cut at bronze.
            bronze = {ds: self.spark.read.schema(df.schema).parquet(os.path.join(path, "bronze", ds))
                      for ds, df in self._raw.items()}
            source = Warehouse(self.spark, bronze, self.date_range)
        schemas: dict = {}
        for n in SILVER_TABLES:
            schemas[n] = source.silver(n).schema
        for ds in source._raw if include_bronze else ():
            schemas[ds] = source.raw(ds).schema
        run_tables([
            (n, lambda n=n: watched(source.silver(n), ("silver", n), *silver_counts(n)).write.mode("overwrite").options(
                **WRITTEN).parquet(os.path.join(path, "silver", n)))
            for n in SILVER_TABLES
        ] + [
            # Rows that a NOT NULL column keeps out of Silver, with the reason:
            # Silver and quarantine together are every raw row.
            (n, lambda n=n: watched(source.quarantine(n), ("quarantine", n)).write.mode("overwrite").options(
                **WRITTEN).parquet(os.path.join(path, "quarantine", n)))
            for n in SILVER_TABLES if silver.RAW_OF[n] in source._raw
        ], parallel)
        # Gold builds from the written Silver layer (lineage cut there).
        written = Warehouse(self.spark, self._raw, self.date_range, {
            f"silver_{n}": self.spark.read.schema(schemas[n]).parquet(os.path.join(path, "silver", n))
            for n in SILVER_TABLES
        })
        dims = [n for n in GOLD_TABLES if n.startswith("dim_")]
        facts = [n for n in GOLD_TABLES if n.startswith("fact_")]
        keys = TableStore(self.spark, os.path.join(path, "keys"))

        def write_dim(n: str) -> None:
            df = written.gold(n)
            if n in DIM_NATURAL:
                df = identity.with_identities(keys, n, df, DIM_NATURAL[n], f"{n[4:]}_sk")
            watched(df, ("gold", n)).write.mode("overwrite").options(**WRITTEN).parquet(os.path.join(path, "gold", n))

        run_all([(lambda n=n: write_dim(n)) for n in dims], parallel)
        for n in dims:
            schemas[n] = written.gold(n).schema
            written._memo[n] = self.spark.read.schema(schemas[n]).parquet(os.path.join(path, "gold", n))

        def write_fact(n: str) -> None:
            # Month folders for pruning. Rebalancing by month brings a month's
            # rows together (few files per folder); AQE then splits a large
            # month, or one hot day, into tasks of even size and joins small
            # ones. No sampling pass, so the joins run once. The row's hash, which
            # does not compress, is taken behind the shuffle.
            df = written.gold(n).withColumn(FACT_PARTITION, (F.col("date_sk") / 100).cast("int"))
            schemas[n] = df.schema
            key, parts = gold.FACT_KEYS[n]
            df = df.drop(key).hint("rebalance", FACT_PARTITION).withColumn(key, gold.surrogate_key(*parts)).select(*df.columns)
            watched(df, ("gold", n)).write.mode("overwrite").options(**WRITTEN).partitionBy(FACT_PARTITION).parquet(
                os.path.join(path, "gold", n))

        run_tables([(n, lambda n=n: write_fact(n)) for n in facts] + [
            (n, lambda n=n: watched(written.unmatched(n), ("unmatched", n)).write.mode("overwrite").options(
                **WRITTEN).parquet(os.path.join(path, "unmatched", n)))
            for n in (SILVER_TABLES if totals is not None else [])
        ], parallel)
        if totals is not None:
            totals.update({what: dict(s.get) for what, s in seen.items()})
        return Warehouse.from_parquet(self.spark, path, self.date_range, schemas, list(self._raw) if include_bronze else [])

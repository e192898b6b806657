"""Validation, data-quality profiling, quarantine and model audits.

Every audit is a single aggregation pass per table (map-side partial
aggregation, one small shuffle) that returns a handful of summary rows;
nothing is collected to the driver. Constraint checks of the reference
(NOT NULL, FOREIGN KEY, UNIQUE grain) become reports here instead of
failing the load.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import convert as cv
from ledgerlake.operators.silver import NOT_NULL, money_fits, raw_money_fits
from ledgerlake.sources.schemas import RAW_COLUMNS, RECORD_COUNT_LABELS

# Target type of every raw column that the cleaning layer
# converts ("id", "int", "dec", "dec14", "date", "ts"); all others stay text.
TARGET_TYPES: dict[str, dict[str, str]] = {
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

_CONVERTERS = {
    "id": cv.try_id,
    "int": cv.try_int,
    "dec": cv.try_dec,
    "dec14": lambda c: cv.try_dec(c, 14, 2),
    "date": cv.try_date,
    "ts": cv.try_timestamp,
}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _long(one_row: DataFrame, entries: list[tuple], names: list[str]) -> DataFrame:
    """Turn a one-row aggregate into one row per entry (structs exploded)."""
    structs = [F.struct(*[(F.lit(v) if not hasattr(v, "alias") else v).alias(n) for v, n in zip(e, names)])
               for e in entries]
    return one_row.select(F.inline(F.array(*structs)))


# ---------------------------------------------------------------- validation
def sample_rows(raw: dict[str, DataFrame], n: int = 10, ordered: bool = False) -> DataFrame:
    """``n`` rows of each raw table, rendered as text: any ``n``, as the
    reference's TOP without ORDER BY, so a scan stops once it has them.

    ``ordered`` gives the first by their text instead, the same in every run,
    for which each table is read whole (a top-k: k rows per task, merged).
    """
    frames = []
    for ds in RAW_COLUMNS:
        text = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("<NULL>")) for c in RAW_COLUMNS[ds]]).alias("row_text")
        rows = raw[ds] if ordered else raw[ds].limit(n)
        rows = rows.select(F.lit(ds).alias("table_name"), text)
        frames.append(rows.orderBy("row_text").limit(n) if ordered else rows)
    return _union(frames)


def record_counts(raw: dict[str, DataFrame]) -> DataFrame:
    """(table_name, record_count) for the eight raw tables."""
    return _union([
        raw[ds].agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(RECORD_COUNT_LABELS[ds]).alias("table_name"), "record_count"
        )
        for ds in RAW_COLUMNS
    ])


# The keys of each raw table whose repeats the profile counts.
KEY_SETS: dict[str, list[list[str]]] = {
    "pos_transactions_raw": [["transaction_id"]],
    "pos_items_raw": [["transaction_id", "product_id"]],
    "ecom_orders_raw": [["order_id"]],
    "ecom_items_raw": [["order_item_id"], ["order_id", "product_id"]],
    "inventory_snapshots_raw": [["snapshot_date", "store_id", "product_id"]],
    "returns_raw": [["return_id"], ["transaction_id", "product_id", "return_date"]],
    "products_raw": [["product_id"], ["sku"]],
    "stores_raw": [["store_id"], ["store_name"]],
}


def duplicate_counts(df: DataFrame, key_sets: list[list[str]]) -> DataFrame:
    """(key_set, duplicate_count): rows whose key another row has, for several
    keys in one pass. Parts are trimmed; a key with an empty part is none.

    Each row gives one short row (key, hash of its value) a key. Counts of
    those are added up before the shuffle, which a hot value does not skew;
    hashes that occur once are done with. Only the rows behind the others are
    then counted by their values, so that a chance repeat of a hash counts
    for nothing.
    """
    part = lambda c: F.when(F.trim(c) != "", F.trim(c))
    entries = [F.struct(F.lit(i).alias("key_set"), F.array(*[part(c) for c in key]).alias("parts")) for i, key in enumerate(key_sets)]
    rows = df.select(F.inline(F.array(*[
        F.struct(e["key_set"].alias("key_set"), F.to_json(e["parts"]).alias("value"),
                 F.when(~F.exists(e["parts"], lambda x: x.isNull()), F.xxhash64(e["parts"])).alias("hash")) for e in entries])))
    rows = rows.filter(F.col("hash").isNotNull())
    again = rows.groupBy("key_set", "hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("key_set", "hash")
    values = rows.join(again, ["key_set", "hash"], "left_semi").groupBy("key_set", "value").agg(F.count(F.lit(1)).alias("_n"))
    return values.filter("_n > 1").groupBy("key_set").agg(F.sum("_n").alias("duplicate_count"))


def dq_profile(raw: dict[str, DataFrame]) -> DataFrame:
    """Per raw column: NULLs, blanks, and non-blank values that fail the
    conversion to the column's target type, in one scan per table. Per key of
    a table: rows with a NULL or else blank part, and rows whose key repeats
    (``duplicate_count``, which is NULL in the rows of columns)."""
    frames = []
    names = ["table_name", "column_name", "total_rows", "null_count", "blank_count", "invalid_count"]
    for ds, cols in RAW_COLUMNS.items():
        df = raw[ds]
        aggs = [F.count(F.lit(1)).alias("_rows")]
        for c in cols:
            x = F.col(c)
            blank = x.isNotNull() & (F.trim(x) == "")
            aggs.append(F.count_if(x.isNull()).alias(f"{c}__null"))
            aggs.append(F.count_if(blank).alias(f"{c}__blank"))
            kind = TARGET_TYPES[ds].get(c)
            if kind:
                bad = x.isNotNull() & ~blank & _CONVERTERS[kind](x).isNull()
                aggs.append(F.count_if(bad).alias(f"{c}__invalid"))
        for i, key in enumerate(KEY_SETS[ds]):
            null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
            blank = reduce(lambda a, b: a | b, [F.trim(c) == "" for c in key])
            aggs += [F.count_if(null).alias(f"_key{i}__null"), F.count_if(~null & blank).alias(f"_key{i}__blank")]
        one = df.agg(*aggs)
        none = F.lit(0).cast("bigint")
        entries = [
            (ds, c, F.col("_rows"), F.col(f"{c}__null"), F.col(f"{c}__blank"),
             F.col(f"{c}__invalid") if TARGET_TYPES[ds].get(c) else none, F.lit(None).cast("int"))
            for c in cols
        ] + [
            (ds, ", ".join(key), F.col("_rows"), F.col(f"_key{i}__null"), F.col(f"_key{i}__blank"), none, F.lit(i))
            for i, key in enumerate(KEY_SETS[ds])
        ]
        rows = _long(one, entries, [*names, "key_set"]).join(duplicate_counts(df, KEY_SETS[ds]), "key_set", "left")
        count = F.when(F.col("key_set").isNotNull(), F.coalesce("duplicate_count", none))
        frames.append(rows.select(*names, count.alias("duplicate_count")))
    return _union(frames)


def dq_flag_summary(silver_tables: dict[str, DataFrame]) -> DataFrame:
    """Per clean table and ``is_*`` flag: flagged rows and total rows."""
    frames = []
    for name, df in silver_tables.items():
        flags = [c for c in df.columns if c.startswith("is_")]
        one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(c).cast("bigint").alias(c) for c in flags])
        entries = [(name, f, F.col(f), F.col("_rows")) for f in flags]
        frames.append(_long(one, entries, ["table_name", "flag_name", "flagged_rows", "total_rows"]))
    return _union(frames)


# ---------------------------------------------------------------- quarantine
def quarantine_split(typed: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined): rows with a NULL in a NOT NULL target column,
    or an amount too large for its column, go to the side table with the
    reasons in ``reject_reason`` instead of failing the whole load."""
    reasons = [F.when(F.col(c).isNull(), F.lit(f"{c} IS NULL")) for c in NOT_NULL[table]]
    reasons.append(F.when(~money_fits(table), F.lit("AMOUNT TOO LARGE")))
    reason = F.concat_ws("; ", *reasons)
    bad = ~money_fits(table)
    for c in NOT_NULL[table]:
        bad = bad | F.col(c).isNull()
    accepted = typed.filter(~bad)
    rejected = typed.filter(bad).withColumn("reject_reason", reason)
    return accepted, rejected


# Identifiers that are whole numbers; the other keys are text.
NUMBER_IDS = ("product_id", "store_id", "order_item_id")


def quarantined(raw: DataFrame, table: str) -> DataFrame:
    """Raw rows that cleaning refuses, as they came, with the reason. Keys are
    converted as cleaning converts them."""
    value = lambda c: cv.try_id(c) if c in NUMBER_IDS else cv.trim(c)
    reasons = [F.when(value(c).isNull(), F.lit(f"{c} IS NULL")) for c in NOT_NULL[table]]
    reasons.append(F.when(~raw_money_fits(table), F.lit("AMOUNT TOO LARGE")))
    reason = F.concat_ws("; ", *reasons)
    return cv.with_once(raw, reject_reason=reason).filter(F.col("reject_reason") != "")


def quarantine_not_null(typed_tables: dict[str, DataFrame]) -> DataFrame:
    """Rows each NOT NULL column would reject, per clean table."""
    frames = []
    for name, df in typed_tables.items():
        cols = NOT_NULL[name]
        one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        entries = [(name, c, F.col(c), F.col("_rows")) for c in cols]
        frames.append(_long(one, entries, ["table_name", "column_name", "rejected_rows", "total_rows"]))
    return _union(frames)


# ---------------------------------------------------------------- audits
# Fact -> dimension relations (fact, key, dimension, NULL allowed).
FK_RELATIONS = [
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


# Silver key -> dimension relations (table, what, dimension, its key, NULL allowed).
SILVER_RELATIONS = [
    ("pos_transactions", "store_id", "dim_store", "store_id", False),
    ("pos_transactions", "day", "dim_date", "full_date", False),
    ("pos_items", "product_id", "dim_product", "product_id", False),
    ("ecom_orders", "day", "dim_date", "full_date", False),
    ("ecom_items", "product_id", "dim_product", "product_id", False),
    ("inventory_snapshots", "product_id", "dim_product", "product_id", False),
    ("inventory_snapshots", "store_id", "dim_store", "store_id", False),
    ("inventory_snapshots", "day", "dim_date", "full_date", False),
    ("returns", "product_id", "dim_product", "product_id", False),
    ("returns", "day", "dim_date", "full_date", False),
]
_DAY = {"pos_transactions": "transaction_timestamp", "ecom_orders": "order_timestamp",
        "inventory_snapshots": "snapshot_date", "returns": "return_date"}


def silver_key_audit(silver: dict[str, DataFrame], dims: dict[str, DataFrame]) -> DataFrame:
    """Per relation: Silver rows, rows without a key, and rows whose key the
    dimension lacks, which the inner joins of the facts will drop (a store
    that occurs twice is in no dimension). Keys are counted before they meet
    the dimension, so a hot key is one row."""
    frames = []
    for table in dict.fromkeys(r[0] for r in SILVER_RELATIONS):
        # One pass per table: a row gives each of its keys, as a number, and
        # the keys of all its relations meet those of the dimensions at once.
        rels = [r[1:] for r in SILVER_RELATIONS if r[0] == table]
        days = F.to_date(_DAY[table]) if table in _DAY else F.lit(None).cast("date")
        number = lambda c, what: (F.unix_date(c) if what == "day" else F.col(c)).cast("bigint")
        values = [F.struct(F.lit(i).alias("_rel"), number("_day" if what == "day" else what, what).alias("_key"))
                  for i, (what, *_) in enumerate(rels)]
        rows = silver[table].select(days.alias("_day"), *[what for what, *_ in rels if what != "day"])
        keys = rows.select(F.inline(F.array(*values))).groupBy("_rel", "_key").agg(F.count(F.lit(1)).alias("_n"))
        known = None
        for i, (what, dim, key, _) in enumerate(rels):
            k = dims[dim].select(F.lit(i).alias("_of"), number(key, what).alias("_dim"))
            known = k if known is None else known.unionByName(k)
        known = known.dropDuplicates().withColumn("_hit", F.lit(1))
        keys = keys.join(known, (F.col("_rel") == F.col("_of")) & (F.col("_key") == F.col("_dim")), "left")
        aggs, entries = [], []
        for i, (what, dim, key, nullable) in enumerate(rels):
            some = lambda cond, i=i: F.coalesce(F.sum(F.when((F.col("_rel") == i) & cond, F.col("_n"))), F.lit(0)).cast("bigint")
            aggs += [some(F.lit(True)).alias(f"_rows{i}"), some(F.col("_key").isNull()).alias(f"_null{i}"),
                     some(F.col("_key").isNotNull() & F.col("_hit").isNull()).alias(f"_orphan{i}")]
            entries.append((f"silver_{table}.{what} -> {dim}", F.col(f"_rows{i}"),
                            F.lit(0).cast("bigint") if nullable else F.col(f"_null{i}"), F.col(f"_orphan{i}")))
        frames.append(_long(keys.agg(*aggs), entries, ["relation", "checked_rows", "null_violations", "orphan_rows"]))
    return _union(frames)


# What each Silver table feeds, and which rows of it.
FEEDS = {
    "pos_transactions": ("fact_pos_transactions", None), "ecom_orders": ("fact_ecom_orders", None),
    "pos_items": ("fact_sales_items", "source_system = 'POS'"), "ecom_items": ("fact_sales_items", "source_system = 'ECOM'"),
    "inventory_snapshots": ("fact_inventory_snapshots", None), "returns": ("fact_returns", None),
    "products": ("dim_product", None), "stores": ("dim_store", None),
}


def load_reconcile(spark, lines: dict[str, dict], totals: dict, gold: dict[str, DataFrame]) -> DataFrame:
    """Control totals, a row per source: where every line of its extract went.

    ``lines`` are the counts of the raw load (``replace_raw``), ``totals`` those
    of ``Warehouse.materialize``, ``gold`` the written tables. A line is
    rejected (malformed), refused (a NOT NULL column is empty), duplicate,
    flagged (valid in form, but a flag keeps it out), unmatched (no dimension
    row, or no loaded header) or loaded; ``difference`` is what these six leave
    unexplained. A return whose header repeats is loaded once and counted once.
    """
    out = []
    for table, (target, rows) in FEEDS.items():
        raw, clean = lines[f"{table}_raw"], totals["silver", table]
        flagged = clean["rows"] - clean["duplicates"] - clean["valid"]
        if rows is not None:
            loaded = gold[target].filter(rows).count()
        elif table == "returns":
            loaded = gold[target].agg(F.count_distinct("return_id")).first()[0]
        else:
            loaded = totals["gold", target]["rows"]
        parts = [raw["rejected_rows"], totals["quarantine", table]["rows"], clean["duplicates"], flagged,
                 totals["unmatched", table]["rows"], loaded]
        out.append((table, raw["lines"], *parts, raw["lines"] - sum(parts)))
    names = ["raw_lines", "rejected_rows", "refused_rows", "duplicate_rows", "flagged_rows", "unmatched_rows", "loaded_rows", "difference"]
    return spark.createDataFrame(out, "table_name string, " + ", ".join(f"{n} long" for n in names))


def fk_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Per relation: fact rows checked, NULL keys (violations unless NULL is
    allowed) and orphan keys absent from the dimension.

    One pass per fact: its key columns are scanned once, each dimension's key
    set is left-joined (planner / AQE choose broadcast or sort-merge from the
    dimension's size) and all relations of the fact are counted in a single
    aggregation."""
    frames = []
    facts = []
    for fact, *_ in FK_RELATIONS:
        if fact not in facts:
            facts.append(fact)
    for fact in facts:
        rels = [(key, dim, nullable) for f, key, dim, nullable in FK_RELATIONS if f == fact]
        df = tables[fact].select(*[k for k, _, _ in rels])
        aggs = [F.count(F.lit(1)).alias("_rows")]
        for i, (key, dim, nullable) in enumerate(rels):
            hit = f"_hit{i}"
            d = tables[dim].select(F.col(key).alias(f"_k{i}")).dropDuplicates().withColumn(hit, F.lit(1))
            df = df.join(d, F.col(key) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
            aggs.append(F.count_if(F.col(key).isNull()).alias(f"_null{i}"))
            aggs.append(F.count_if(F.col(key).isNotNull() & F.col(hit).isNull()).alias(f"_orphan{i}"))
        one = df.agg(*aggs)
        entries = [
            (f"{fact}.{key} -> {dim}", F.col("_rows"),
             F.lit(0).cast("bigint") if nullable else F.col(f"_null{i}"), F.col(f"_orphan{i}"))
            for i, (key, dim, nullable) in enumerate(rels)
        ]
        frames.append(_long(one, entries, ["relation", "checked_rows", "null_violations", "orphan_rows"]))
    return _union(frames)


# Declared grains of facts and dimensions.
FACT_GRAINS = {
    "fact_pos_transactions": ["transaction_id"],
    "fact_ecom_orders": ["order_id"],
    "fact_sales_items": ["source_system", "transaction_id", "product_sk", "date_sk"],
    "fact_returns": ["return_id"],
    "fact_inventory_snapshots": ["product_sk", "store_sk", "date_sk"],
}
DIM_GRAINS = {
    "dim_product": ["product_id"],
    "dim_store": ["store_id"],
    "dim_date": ["full_date"],
}
# The keys that facts refer to, to be unique as well.
DIM_KEYS = {"dim_product": ["product_sk"], "dim_store": ["store_sk"], "dim_date": ["date_sk"]}


def grain_audit(tables: dict[str, DataFrame], grains: dict[str, list[str]]) -> DataFrame:
    """Per table: keys occurring more than once and the rows they cover.
    Counts are pre-aggregated per key (a hot key collapses map-side)."""
    frames = []
    for name, keys in grains.items():
        per_key = tables[name].groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        one = per_key.agg(
            F.count(F.lit(1)).alias("duplicate_keys"),
            F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        )
        frames.append(one.select(F.lit(name).alias("table_name"), F.lit(", ".join(keys)).alias("grain"),
                                 "duplicate_keys", "duplicate_rows"))
    return _union(frames)

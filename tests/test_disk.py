"""What loads leave on disk, and how much at a time."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from helpers import PRODUCT, STORE, ecom_item, ecom_order, inv, pos_header, pos_item, raw, ret, rows, warehouse
from ledgerlake.operators import gold
from ledgerlake.plans import warehouse as plans
from ledgerlake.sources import csv_loader


def _small(spark):
    return warehouse(
        spark, stores=[STORE], products=[PRODUCT], pos_transactions=[pos_header("T1"), pos_header("T2")],
        pos_items=[pos_item("T1"), pos_item("T1"), pos_item("T2")], ecom_orders=[ecom_order("E1")], ecom_items=[ecom_item("7", "E1")],
        inventory_snapshots=[inv("2024-03-01"), inv("2024-03-02")], returns=[ret("R1", "T1")])


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f}


def test_a_load_leaves_no_shuffle_files(spark, tmp_path):
    there = _shuffle_files(spark)
    _small(spark).materialize(str(tmp_path / "wh"), totals={})
    end = time.time() + 20
    while (left := _shuffle_files(spark) - there) and time.time() < end:  # they are removed behind the query's back
        time.sleep(0.5)
    assert not left


def test_large_tables_are_written_in_turn_beside_the_others():
    running, most, lock, small = set(), [], threading.Lock(), threading.Event()

    def job(table):
        with lock:
            running.add(table)
            most.append(len(running & plans.LARGE))
        if table in plans.LARGE:
            assert small.wait(10)
        else:
            small.set()
        time.sleep(0.02)
        with lock:
            running.discard(table)

    names = plans.SILVER_TABLES + plans.GOLD_TABLES
    plans.run_tables([(n, lambda n=n: job(n)) for n in names])
    assert len(most) == len(names) and max(most) == 1
    with pytest.raises(KeyError):
        plans.run_tables([("pos_items", lambda: {}["no"])])


def test_written_facts_keep_keys_and_columns(spark, tmp_path):
    w = _small(spark)
    written = w.materialize(str(tmp_path / "wh"))
    for fact, (key, parts) in gold.FACT_KEYS.items():
        got = written.gold(fact)
        assert got.columns == w.gold(fact).columns and key == got.columns[0]
        assert got.count() == got.filter(F.col(key) == gold.surrogate_key(*parts)).count() > 0, fact
    assert all(".zstd." in f for f in written.gold("fact_sales_items").inputFiles() + written.silver("pos_items").inputFiles())


def test_compressed_extracts_give_the_same_rows(spark, tmp_path):
    items = raw(spark, "pos_items_raw", [pos_item("T1"), {"transaction_id": " x, 1", "product_id": "", "quantity": "1 "}])
    got = {}
    for how in ("none", "gzip"):
        path = csv_loader.write_extracts({"pos_items_raw": items}, str(tmp_path / how), how)["pos_items_raw"]
        df = csv_loader.lineage_enrich(csv_loader.load_raw_csv(spark, "pos_items_raw", path)).drop("load_timestamp")
        got[how] = rows(df)
        assert all(f.endswith(".csv.gz") == (how == "gzip") for f in df.inputFiles())
    assert got["none"] == got["gzip"] and len(got["gzip"]) == 2

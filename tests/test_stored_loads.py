"""Stored tables: replacement, rejects, control totals, lasting keys, merges, money that does not fit."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import PRODUCT, STORE, ecom_item, ecom_order, inv, pos_header, pos_item, raw, ret, rows, warehouse
from ledgerlake.operators import gold, identity, merge, quality
from ledgerlake.plans.registry import REGISTRY
from ledgerlake.sources import csv_loader, testdata
from ledgerlake.sources.schemas import RAW_COLUMNS, SOURCE_FILES
from ledgerlake.sources.stored import TableStore

HEAD = ",".join(RAW_COLUMNS["stores_raw"]) + "\n"


def _extract(base, name, *lines):
    folder = base / "drop" / SOURCE_FILES["stores_raw"]
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(HEAD + "".join(f"{x}\n" for x in lines))
    return str(base / "drop")


def test_a_load_replaces_the_one_before_and_keeps_its_rejects(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    assert store.version("stores_raw") is None and store.versions("stores_raw") == []
    with pytest.raises(ValueError, match="never loaded"):
        csv_loader.stored_raw(store, "stores_raw")
    drop = _extract(tmp_path, "a.csv", "1,S,Mall,east,a,2020-01-01,M", "2,S", '3,"S,Mall,east,a,2020-01-01,M', "4,S,Mall,east,a,2020-01-01,M,more")
    counts = csv_loader.replace_raw(store, drop, ["stores_raw"])["stores_raw"]
    assert (counts["lines"], counts["accepted_rows"], counts["rejected_rows"]) == (4, 1, 3)
    first = csv_loader.stored_raw(store, "stores_raw")
    assert rows(first, "store_id", "source_file") == [("1", "stores_raw.csv")] and first.filter("load_timestamp IS NULL").count() == 0
    lost = csv_loader.stored_rejects(store, "stores_raw")
    assert rows(lost, "table_name", "record") == sorted(("stores_raw", r) for r in ("2,S", '3,"S,Mall,east,a,2020-01-01,M', "4,S,Mall,east,a,2020-01-01,M,more"))

    _extract(tmp_path, "a.csv", "5,S,Mall,east,a,2020-01-01,M")
    counts = csv_loader.replace_raw(store, drop, ["stores_raw"])["stores_raw"]
    assert (counts["lines"], counts["rejected_rows"]) == (1, 0)
    assert rows(csv_loader.stored_raw(store, "stores_raw"), "store_id") == [("5",)]
    assert csv_loader.stored_rejects(store, "stores_raw").count() == 0
    assert rows(first, "store_id") == [("1",)]  # whoever began before stays on that version
    assert len(store.versions("stores_raw")) == 2
    assert len(store.drop_old_versions("stores_raw", keep=0)) == 1 and rows(csv_loader.stored_raw(store, "stores_raw"), "store_id") == [("5",)]


def test_a_load_that_fails_leaves_the_old_rows(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    drop = _extract(tmp_path, "a.csv", "1,S,Mall,east,a,2020-01-01,M")
    csv_loader.replace_raw(store, drop, ["stores_raw"])
    (tmp_path / "drop" / SOURCE_FILES["stores_raw"] / "b.csv").write_text("store_name,store_id,store_type,region,address,opening_date,manager_id\nS,9,Mall,east,a,2020-01-01,M\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv_loader.replace_raw(store, drop, ["stores_raw"])
    with pytest.raises(Exception, match="(?i)assert|raise|broken"):  # killed after it has written some rows
        store.replace("stores_raw", csv_loader.stored_raw(store, "stores_raw").withColumn("store_id", F.raise_error(F.lit("broken"))))
    assert rows(csv_loader.stored_raw(store, "stores_raw"), "store_id") == [("1",)]


def test_extracts_without_rows(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    counts = csv_loader.replace_raw(store, _extract(tmp_path, "a.csv"), ["stores_raw"])["stores_raw"]
    assert counts["lines"] == 0 and csv_loader.stored_raw(store, "stores_raw").count() == 0
    assert csv_loader.stored_rejects(store, "stores_raw").count() == 0


def test_every_line_of_the_extracts_is_accounted_for(spark):
    got = REGISTRY["load_reconcile"](spark, SF_SMALL).collect()
    assert len(got) == 8 and all(r["difference"] == 0 for r in got)
    for column in ("rejected_rows", "refused_rows", "duplicate_rows", "flagged_rows", "unmatched_rows"):
        assert sum(r[column] for r in got) > 0, column
    by = {r["table_name"]: r for r in got}
    frames = testdata.raw_frames(spark, SF_SMALL)
    assert all(by[t[:-4]]["raw_lines"] - by[t[:-4]]["rejected_rows"] == f.count() for t, f in frames.items())


def test_unmatched_rows_have_their_reason(spark):
    w = warehouse(spark, stores=[STORE], products=[PRODUCT],
                  pos_transactions=[pos_header("T1"), pos_header("T2", store="77"), pos_header("T3", ts="2031-01-01 00:00:00"), pos_header("T4", total="bad")],
                  pos_items=[pos_item("T1"), pos_item("T2"), pos_item("T9", pid="6"), pos_item("T4")],
                  ecom_orders=[ecom_order("E1")], ecom_items=[ecom_item("1", "E1"), ecom_item("2", "E2")],
                  returns=[ret("R1", "T1"), ret("R2", "T9", pid="6"), ret("R3", "T1", date="2031-01-01")],
                  inventory_snapshots=[inv("2024-03-01"), inv("2024-03-01", store="77", pid="6")])
    got = {t: rows(w.unmatched(t), "reject_reason") for t in ("pos_transactions", "pos_items", "ecom_items", "returns", "inventory_snapshots", "ecom_orders", "stores")}
    assert got == {
        "pos_transactions": [("date NOT FOUND",), ("store_id NOT FOUND",)],
        "pos_items": [("product_id NOT FOUND; transaction_id NOT FOUND",), ("transaction_id NOT FOUND",), ("transaction_id NOT FOUND",)],
        "ecom_items": [("order_id NOT FOUND",)],
        "returns": [("date NOT FOUND",), ("product_id NOT FOUND",)],
        "inventory_snapshots": [("store_id NOT FOUND; product_id NOT FOUND",)], "ecom_orders": [], "stores": []}


def test_a_price_change_keeps_the_key(spark, tmp_path):
    path = str(tmp_path / "wh")
    w = warehouse(spark, stores=[STORE], products=[PRODUCT, dict(PRODUCT, product_id="9"), dict(PRODUCT, product_id="9", sku="other")],
                  ecom_orders=[ecom_order("E1")], ecom_items=[ecom_item("7", "E1")])
    first = w.materialize(path)
    old = rows(first.dim_product(), "product_id", "product_sk")
    assert [p for p, _ in old] == [5, 9, 9] and sorted(k for _, k in old) == [1, 2, 3]  # a copy has a key of its own
    assert rows(first.fact_sales_items(), "product_sk") == [(old[0][1],)]
    more = warehouse(spark, stores=[dict(STORE, region="west"), dict(STORE, store_id="0")],
                     products=[dict(PRODUCT, product_id="1"), dict(PRODUCT, price="99.00"), dict(PRODUCT, product_id="9", price="1.00"), dict(PRODUCT, product_id="9", sku="other")],
                     ecom_orders=[ecom_order("E1")], ecom_items=[ecom_item("7", "E1")])
    again = more.materialize(path)
    assert set(old) < set(rows(again.dim_product(), "product_id", "product_sk"))
    assert dict(rows(again.dim_product(), "product_id", "product_sk"))[1] == 4
    assert dict(rows(again.dim_store(), "store_id", "store_sk")) == {1: 1, 0: 2}
    tables = {t: again.gold(t) for t in ("dim_product", "dim_store", "dim_date")}
    assert all(r["duplicate_keys"] == 0 for r in quality.grain_audit(tables, quality.DIM_KEYS).collect())


def test_dense_numbers_over_many_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"))
    got = rows(identity.dense_numbers(df, ["x"], "n").filter("n <> x + 1"))
    assert got == [] and identity.dense_numbers(df, ["x"], "n").count() == 5000
    assert identity.dense_numbers(df.limit(0), ["x"], "n").count() == 0


def test_money_that_does_not_fit_is_quarantined(spark):
    big = "9999999999.99"
    w = warehouse(spark, pos_items=[pos_item("T1", qty="2", price=big, total=big), pos_item("T2", qty="1", price=big, total=big)],
                  ecom_items=[dict(ecom_item("1", "E1"), quantity="3", unit_price=big)],
                  ecom_orders=[ecom_order("E1", total=big, ship="1.00"), ecom_order("E2", total=big, disc="1.00", ship="1.00")],
                  pos_transactions=[pos_header("T1", total=big, tax="1.00"), pos_header("T2", total=big, tax="1.00", disc="2.00"), pos_header("T3", total="x")])
    kept = {t: [r[0] for r in rows(w.silver(t), k)] for t, k in (("pos_items", "transaction_id"), ("ecom_items", "order_item_id"), ("ecom_orders", "order_id"), ("pos_transactions", "transaction_id"))}
    assert kept == {"pos_items": ["T2"], "ecom_items": [], "ecom_orders": ["E2"], "pos_transactions": ["T2", "T3"]}
    for t, n in (("pos_items", 1), ("ecom_items", 1), ("ecom_orders", 1), ("pos_transactions", 1)):
        refused = rows(w.quarantine(t), "reject_reason")
        assert refused == [("AMOUNT TOO LARGE",)] * n, t
        assert len(kept[t]) + n == w.raw(f"{t}_raw").count()
    assert gold.fact_pos_transactions(w.silver("pos_transactions"), w.dim_store(), w.dim_date()).filter("net_revenue IS NULL").count() == 0


def test_merge_keeps_the_latest_version(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))

    def extract(*versions):
        frame = warehouse(spark, stores=[dict(STORE, store_id=i, store_name=n, _ts=dt.datetime(2024, 1, day)) for i, n, day in versions])
        return quality.quarantine_split(frame.silver_typed("stores"), "stores")[0]

    steps = [extract(("1", "a", 5), ("2", "b", 5), ("2", "c", 5)), extract(("1", "new", 6), ("2", "late", 4), ("3", "d", 4))]
    first = merge.merge_into(store, "stores", steps[0])
    assert rows(first, "store_id", "store_name") == [(1, "a"), (2, "c")]
    second = merge.merge_into(store, "stores", steps[1])
    assert rows(second, "store_id", "store_name") == [(1, "new"), (2, "c"), (3, "d")]
    assert rows(merge.replaced_keys(first, second, ["store_id"])) == [(1,)]
    assert rows(merge.merge_into(store, "stores", steps[1]), "store_id", "store_name") == rows(second, "store_id", "store_name")
    assert rows(first, "store_id", "store_name") == [(1, "a"), (2, "c")]
    store2 = TableStore(spark, str(tmp_path / "other"))  # the extracts in the other order
    merge.merge_into(store2, "stores", steps[1])
    assert rows(merge.merge_into(store2, "stores", steps[0]), "store_id", "store_name") == rows(second, "store_id", "store_name")


def test_duplicates_of_several_keys_in_one_pass(spark, monkeypatch):
    frame = raw(spark, "ecom_items_raw", [ecom_item("1", "E1"), ecom_item(" 1", "E2"), ecom_item("2", "E1", pid="6"), ecom_item("3", "E2"), ecom_item("3", " E2 "),
                                          dict(ecom_item("", "E9")), dict(ecom_item("", "E9"), product_id=None)])
    keys = quality.KEY_SETS["ecom_items_raw"]
    assert dict(rows(quality.duplicate_counts(frame, keys))) == {0: 4, 1: 3}
    # A hash that different values share says nothing by itself.
    monkeypatch.setattr(quality.F, "xxhash64", lambda *_: F.lit(7).cast("long"))
    assert dict(rows(quality.duplicate_counts(frame, keys))) == {0: 4, 1: 3}

"""Streaming bronze landing: every line of new drops lands exactly once, accepted or rejected."""

import pytest

from helpers import STORE, raw
from ledgerlake.sources.csv_loader import write_extracts
from ledgerlake.sources.schemas import RAW_COLUMNS, SOURCE_FILES
from ledgerlake.streaming import landing


def _land(spark, base):
    landing.land_dataset(spark, "stores_raw", f"{base}/landing", f"{base}/bronze", f"{base}/ckpt").awaitTermination()


def _ids(spark, base):
    return sorted(r["store_id"] for r in landing.read_bronze(spark, f"{base}/bronze", "stores_raw").collect())


def test_landing_is_incremental_and_exactly_once(spark, tmp_path):
    base = str(tmp_path)
    assert landing.read_bronze(spark, f"{base}/bronze", "stores_raw").count() == 0
    first = raw(spark, "stores_raw", [dict(STORE, store_id="1"), dict(STORE, store_id="2", address="1 King St, Toronto")])
    write_extracts({"stores_raw": first}, f"{base}/landing")
    for _ in range(2):  # a second run over the same files lands nothing new
        _land(spark, base)
    bronze = landing.read_bronze(spark, f"{base}/bronze", "stores_raw")
    assert _ids(spark, base) == ["1", "2"]
    assert {r["source_file"] for r in bronze.collect()} == {"stores_raw.csv"}
    assert {r["address"] for r in bronze.collect()} == {"a", "1 King St, Toronto"}

    # A new drop (another part file in the same extract folder) is picked up.
    second = raw(spark, "stores_raw", [dict(STORE, store_id="3")])
    second.select(*[c for c in second.columns if c not in ("load_timestamp", "source_file")]) \
        .write.mode("append").option("header", "true").csv(f"{base}/landing/stores_raw.csv")
    _land(spark, base)
    assert _ids(spark, base) == ["1", "2", "3"]


def test_malformed_lines_are_kept_and_reordered_headers_stop_the_stream(spark, tmp_path):
    folder = tmp_path / "landing" / SOURCE_FILES["stores_raw"]
    folder.mkdir(parents=True)
    head = ",".join(RAW_COLUMNS["stores_raw"])
    good, bad = ["1,S,Mall,east,a,2020-01-01,M", "2,S,Mall,east,a,2020-01-01,M"], ["3,S,Mall,east,a,2020-01-01,M,more", "4,S"]
    for k in range(2):
        (folder / f"{k}.csv").write_text("\n".join([head, good[k], bad[k]]) + "\n")
        _land(spark, tmp_path)
        lost = landing.read_rejects(spark, f"{tmp_path}/bronze", "stores_raw")
        assert sorted(r["record"] for r in lost.collect()) == bad[: k + 1] and len(_ids(spark, tmp_path)) == k + 1
        assert {(r["table_name"], r["source_file"]) for r in lost.collect()} == {("stores_raw", "stores_raw.csv")}
    (folder / "9.csv").write_text("store_name,store_id,store_type,region,address,opening_date,manager_id\nS,9,Mall,east,a,2020-01-01,M\n")
    with pytest.raises(Exception, match="(?i)header"):
        _land(spark, tmp_path)
    assert _ids(spark, tmp_path) == ["1", "2"] and landing.committed_batches(spark, f"{tmp_path}/bronze", "stores_raw") == [0, 1]


def test_a_batch_that_was_cut_off_is_written_again(spark, tmp_path):
    """The rows of a batch whose commit is missing are unseen, and the batch replaces them when it is repeated."""
    import shutil

    write_extracts({"stores_raw": raw(spark, "stores_raw", [dict(STORE, store_id="1")])}, f"{tmp_path}/landing")
    _land(spark, tmp_path)
    # As a driver leaves it that dies between the rows and the commits.
    shutil.move(tmp_path / "bronze/stores_raw/committed/0", tmp_path / "lost-marker")
    shutil.move(tmp_path / "ckpt/commits", tmp_path / "lost-commits")
    assert _ids(spark, tmp_path) == []
    _land(spark, tmp_path)
    assert _ids(spark, tmp_path) == ["1"]

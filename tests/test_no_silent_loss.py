"""Nothing is lost without a trace: malformed records, refused rows, large ids, restarts, ties."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from helpers import PRODUCT, STORE, ecom_item, ecom_order, raw, ret, rows, warehouse
from ledgerlake.operators.ranking import global_rank
from ledgerlake.plans import questions
from ledgerlake.sources import csv_loader


def test_malformed_records_are_rejected_not_shifted(spark, tmp_path):
    good = '1,S,Mall,east,"1 King St, Toronto",2020-01-01,M1'
    bad = ["2,S,Mall,east,1 King St, Toronto,2020-01-01,M2", "3,S,Mall"]
    (tmp_path / "stores.csv").write_text("\n".join(["store_id,store_name,store_type,region,address,opening_date,manager_id", good, *bad]) + "\n")
    path = str(tmp_path / "stores.csv")
    kept = csv_loader.load_raw_csv(spark, "stores_raw", path)
    assert rows(kept, "store_id", "address", "manager_id") == [("1", "1 King St, Toronto", "M1")]
    lost = csv_loader.rejected_records(spark, "stores_raw", path)
    assert rows(lost, "record") == sorted((b,) for b in bad)
    assert {r["table_name"] for r in lost.collect()} == {"stores_raw"} and all(r["source_path"].endswith("stores.csv") for r in lost.collect())


def test_columns_in_another_order_are_an_error(spark, tmp_path):
    (tmp_path / "stores.csv").write_text("store_name,store_id,store_type,region,address,opening_date,manager_id\nS,1,Mall,east,a,2020-01-01,M1\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv_loader.load_raw_csv(spark, "stores_raw", str(tmp_path / "stores.csv")).collect()


def test_ids_beyond_int_stay_and_refused_rows_are_written(spark, tmp_path):
    w = warehouse(spark, stores=[STORE], products=[PRODUCT], ecom_orders=[ecom_order("E1")],
                  ecom_items=[ecom_item("7", "E1"), ecom_item("x", "E1"), ecom_item("3000000000", "E1")])
    built = w.materialize(str(tmp_path / "wh"))
    assert rows(built.silver("ecom_items"), "order_item_id") == [(3000000000,), (7,)]
    refused = spark.read.parquet(str(tmp_path / "wh" / "quarantine" / "ecom_items"))
    assert rows(refused, "order_item_id", "reject_reason") == [("x", "order_item_id IS NULL")]
    assert built.silver("ecom_items").count() + refused.count() == w.raw("ecom_items_raw").count()


def test_hot_day_is_written_by_several_tasks(spark, tmp_path):
    w = warehouse(spark, stores=[STORE], products=[PRODUCT], ecom_orders=[ecom_order("E1")], ecom_items=[ecom_item("7", "E1")])
    w.materialize(str(tmp_path / "wh"))
    days = spark.range(3_000_000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, 20240301).otherwise(20240401).alias("date_sk"), F.xxhash64("id").alias("v"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "2m")
    try:
        out = days.withColumn("date_month", (F.col("date_sk") / 100).cast("int")).hint("rebalance", "date_month")
        assert "rangepartitioning" not in out._jdf.queryExecution().toString().lower()
        out.write.partitionBy("date_month").parquet(str(tmp_path / "fact"))
    finally:
        spark.conf.set(key, old)
    assert len([f for f in os.listdir(tmp_path / "fact" / "date_month=202403") if f.endswith(".parquet")]) > 1


def test_rank_with_a_third_of_the_rows_on_one_value(spark):
    data = [(i, None if i % 10 == 0 else 5.0 if i % 3 == 0 else float(i % 97)) for i in range(3000)]
    df = spark.createDataFrame(data, "id int, v double")
    for descending in (True, False):
        got = dict(rows(global_rank(df, "v", descending=descending), "id", "rank"))
        worse = (lambda a, b: a > b) if descending else (lambda a, b: a < b)
        values = [v for _, v in data if v is not None]
        want = {i: 1 + (len(values) if v is None else sum(worse(x, v) for x in values)) for i, v in data}
        assert got == want
    empty = global_rank(df.limit(0), "v")
    assert empty.count() == 0 and "checkpoint" not in open(sys.modules[global_rank.__module__].__file__).read().split('"""', 2)[2]
    assert rows(global_rank(df.withColumn("v", F.lit(None).cast("double")), "v"), "rank") == [(1,)] * 3000


def test_products_without_a_category_are_ranked(spark):
    w = warehouse(spark, products=[PRODUCT, dict(PRODUCT, product_id="6", category=None)])
    got = rows(questions.b08_unit_margin_rank(w), "product_id", "category", "category_avg_margin")
    assert got == [(5, "C", 1.0), (6, None, 1.0)]


def test_return_rate_of_no_category_is_one_row(spark):
    w = warehouse(spark, stores=[STORE], products=[dict(PRODUCT, category=None)], ecom_orders=[ecom_order("E1")],
                  ecom_items=[ecom_item("7", "E1", qty="4")], returns=[ret("R1", "E1", qty="1")])
    got = rows(questions.b21_return_rate_slices(w).filter("slice = 'category'"), "member", "returned_units", "sold_units")
    assert got == [(None, 1, 4)]


LAND = """
import sys
sys.path.insert(0, sys.argv[1])
from ledgerlake.session import get_session
from ledgerlake.streaming import landing
s = get_session("local[2]", 2, extra={"spark.checkpoint.dir": sys.argv[2] + "/ckpt"})
landing.land_dataset(s, "stores_raw", sys.argv[2] + "/landing", sys.argv[2] + "/bronze").awaitTermination()
print("ids", sorted(r[0] for r in landing.read_bronze(s, sys.argv[2] + "/bronze", "stores_raw").select("store_id").collect()))
"""


def test_a_second_application_goes_on_where_the_first_stopped(spark, tmp_path):
    from ledgerlake.sources.schemas import SOURCE_FILES

    folder = tmp_path / "landing" / SOURCE_FILES["stores_raw"]
    folder.mkdir(parents=True)
    head = "store_id,store_name,store_type,region,address,opening_date,manager_id\n"
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for k in (1, 2):
        (folder / f"part-{k}.csv").write_text(f"{head}{k},S,Mall,east,a,2020-01-01,M\n")
        out = subprocess.run([sys.executable, "-c", LAND, repo, str(tmp_path)], capture_output=True, text=True, timeout=300)
        assert f"ids {[str(i) for i in range(1, k + 1)]}" in out.stdout, out.stdout + out.stderr[-2000:]


def test_a_cluster_must_name_its_shared_folder(spark):
    from ledgerlake import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_raw_helper_is_all_text(spark):
    assert {t for _, t in raw(spark, "stores_raw", [STORE]).drop("load_timestamp").dtypes} == {"string"}


def test_ratios_of_large_operands(spark):
    """Sizes that 100 TB brings: products beyond BIGINT, sums beyond 1e18."""
    from decimal import ROUND_HALF_UP, Decimal, getcontext

    from ledgerlake.functions.ratios import div_round, product, ratio

    getcontext().prec = 80
    pairs = [(10**11, 56 * 10**8, 3 * 10**12), (9 * 10**13, 10**13, 7), (12345678901, 9876543210123, 1111), (-(10**14), 10**13, 3), (5, 7, 2), (5, 7, 0)]
    df = spark.createDataFrame(pairs, "a long, b long, c long")
    got = df.select("a", "b", "c", div_round(product("a", "b"), "c", 2).alias("d"), ratio(product("a", "b"), "c", 2).alias("r")).collect()
    for r in got:
        if r["c"] == 0:
            assert r["d"] is None and r["r"] is None
            continue
        want = (Decimal(r["a"]) * r["b"] / r["c"]).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert r["d"] == want and r["r"] == float(want)
    money = spark.createDataFrame([(Decimal("123456789012345678901.25"), 400)], "m decimal(38,2), n long")
    assert money.select(div_round("m", "n", 2)).first()[0] == Decimal("308641972530864197.25")

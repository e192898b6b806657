"""Tables laid out by header key: same facts, no shuffle by the key, hot keys apart."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import PRODUCT, STORE, ecom_item, ecom_order, pos_header, pos_item, ret, warehouse
from ledgerlake.plans.layout import FACTS, hot_keys, lay_out
from ledgerlake.plans.registry import warehouse_for

HEADER_SHUFFLE = re.compile(r"hashpartitioning\((transaction_id|order_id)#")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcasts(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    w = warehouse_for(spark, SF_SMALL)
    return w, lay_out(w, str(tmp_path_factory.mktemp("layout")), "layout_small", 8)


def _same(a, b):
    drop = [c for c in a.columns if c == "load_timestamp"]
    a, b = a.drop(*drop), b.drop(*drop).select(a.drop(*drop).columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("fact", FACTS)
def test_facts_are_the_same(both, fact):
    w, laid = both
    assert laid.gold(fact).count() > 0
    _same(w.gold(fact), laid.gold(fact))


@pytest.mark.parametrize("table", ["pos_transactions", "pos_items", "returns", "ecom_orders", "ecom_items"])
def test_silver_is_the_same(both, table):
    w, laid = both
    _same(w.silver(table), laid.silver(table))


@pytest.mark.parametrize("fact", ["fact_sales_items", "fact_returns"])
def test_no_shuffle_by_the_header_key(both, no_broadcasts, fact):
    w, laid = both
    assert HEADER_SHUFFLE.search(_plan(w.gold(fact)))
    plan = _plan(laid.bucketed_fact(fact))
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert not HEADER_SHUFFLE.search(plan), plan


def test_hot_keys_and_rows_without_a_key_stay_apart(spark, tmp_path):
    heads = [pos_header(f"T{i}") for i in range(20)] + [pos_header("T3")]
    lines = [pos_item("T1", pid="5", qty=str(q)) for q in range(1, 31)]  # all copies by (transaction, product)
    lines += [pos_item("T1", pid=str(p)) for p in range(100, 130)] + [pos_item(f"T{i}") for i in range(2, 20)]
    products = [PRODUCT] + [dict(PRODUCT, product_id=str(p)) for p in range(100, 130)]
    returns = [ret(f"R{i}", "T1") for i in range(20)] + [ret("R90", None), ret("R91", "T2"), ret("R92", "T3"), ret("R92", "T4")]
    orders = [ecom_order(f"O{i}") for i in range(10)]
    items = [ecom_item(str(i), "O1") for i in range(1, 40)] + [ecom_item("40", "O2"), ecom_item("40", "O3"), ecom_item("41", None)]
    w = warehouse(spark, stores=[STORE], products=products, pos_transactions=heads, pos_items=lines, returns=returns,
                  ecom_orders=orders, ecom_items=items)
    laid = lay_out(w, str(tmp_path), "layout_hot", 4, least_hot=10)
    apart = {r[0] for r in laid.spread.silver("pos_items").select("transaction_id").collect()}
    assert apart == {"T1"}
    assert laid.bucketed.silver("pos_items").filter("transaction_id = 'T1'").count() == 0
    assert laid.spread.silver("pos_transactions").count() == 1  # the header of the hot key goes with it
    assert {r[0] for r in laid.spread.silver("ecom_items").select("order_id").collect()} == {"O1", None}
    for t in ("pos_transactions", "pos_items", "returns", "ecom_orders", "ecom_items"):
        _same(w.silver(t), laid.silver(t))
    for fact in FACTS:
        _same(w.gold(fact), laid.gold(fact))


def test_hot_keys_are_at_most_as_many_as_buckets(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 400, F.lit("a")).otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("k"))
    assert [r[0] for r in hot_keys([rows], "k", 4, least=1).collect()] == ["a"]
    assert hot_keys([rows.limit(0)], "k", 4, least=1).count() == 0


def test_laid_out_again_replaces(spark, tmp_path):
    for n in (3, 2):
        w = warehouse(spark, stores=[STORE], products=[PRODUCT], pos_transactions=[pos_header(f"T{i}") for i in range(n)])
        laid = lay_out(w, str(tmp_path), "layout_again", 2)
    assert laid.silver("pos_transactions").count() == 2
    assert laid.gold("fact_sales_items").count() == 0

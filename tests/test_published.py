"""The published views are text over named tables: another session reads them, with the rows of the functions."""

import pytest

from conftest import SF_SMALL
from helpers import PRODUCT, STORE, ecom_item, ecom_order, ret, warehouse
from ledgerlake.plans import published, views
from ledgerlake.plans.registry import warehouse_for
from ledgerlake.plans.warehouse import GOLD_TABLES


def _rows(df):
    return sorted([tuple(r) for r in df.select(*sorted(df.columns)).collect()], key=str)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wh"))
    w = warehouse_for(spark, SF_SMALL).materialize(path)
    published.publish(spark, path, "kpi_test", {t: w.gold(t) for t in GOLD_TABLES})
    return w


@pytest.mark.parametrize("name", list(published.DEFINITIONS))
def test_view_answers_in_another_session(spark, written, name):
    got, want = spark.newSession().table(f"kpi_test.{name}"), views.VIEWS[name](written)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert _rows(got) == _rows(want) and want.count()


def test_the_nine_views_and_no_others(spark, written):
    there = {t.name for t in spark.newSession().catalog.listTables("kpi_test")}
    assert there == {*published.DEFINITIONS, *GOLD_TABLES} and sorted(published.DEFINITIONS) == sorted(views.PUBLISHED)
    assert len(published.DEFINITIONS) == 9


def test_a_refresh_is_published_by_the_same_call(spark, tmp_path):
    path = str(tmp_path / "wh")
    for qty, returned in (("4", []), ("6", [ret("R1", "E1", qty="1")])):
        w = warehouse(spark, stores=[STORE], products=[PRODUCT], ecom_orders=[ecom_order("E1")], ecom_items=[ecom_item("7", "E1", qty=qty)], returns=returned)
        written = w.materialize(path)
        published.publish(spark, path, "kpi_refresh", {t: written.gold(t) for t in GOLD_TABLES})
        row = spark.newSession().table("kpi_refresh.view_kpi_overview").first()
        assert row["units_sold"] == int(qty)
        assert spark.newSession().table("kpi_refresh.view_returns_summary").count() == len(returned)


def test_returns_of_a_hot_product_do_not_overflow(spark):
    """Sales lines x returned units beyond BIGINT: sums that 100 TB brings."""
    w = warehouse(spark, products=[PRODUCT])
    sk = w.dim_product().first()["product_sk"]
    sales = spark.createDataFrame([(sk, 4 * 10**18)], "product_sk long, quantity long").selectExpr(
        "product_sk", "quantity", "CAST(1.00 AS DECIMAL(12,2)) AS line_revenue")
    back = spark.createDataFrame([(sk, f"R{k}", 2 * 10**18) for k in range(4)], "product_sk long, return_id string, quantity_returned long").selectExpr(
        "*", "CAST(1.00 AS DECIMAL(12,2)) AS refund_amount")
    w._memo.update(fact_sales_items=sales, fact_returns=back)
    row = views.view_returns_summary(w).first()
    assert (row["total_returns"], row["units_returned"], row["return_rate"]) == (4, 8 * 10**18, 0)
    w._memo["fact_sales_items"] = sales.union(sales.limit(0)).unionByName(sales.selectExpr("product_sk", "CAST(7 AS BIGINT) AS quantity", "line_revenue"))
    row = views.view_returns_summary(w).first()  # two lines a return: 1.6e19 units
    assert (row["total_returns"], row["units_returned"], row["return_rate"]) == (8, None, 0)


@pytest.fixture(scope="module")
def all_names(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("all"))
    w = warehouse_for(spark, SF_SMALL).materialize(path)
    return w, published.publish(spark, path, "kpi_all", {t: w.gold(t) for t in GOLD_TABLES}, variants=True)


@pytest.mark.parametrize("name", list(published.VARIANTS))
def test_variant_answers_in_another_session(spark, all_names, name):
    got, want = spark.newSession().table(f"kpi_all.{name}"), views.VIEWS[name](all_names[0])
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert _rows(got) == _rows(want) and want.count()


def test_the_query_publishes_every_view_variant_and_sample(spark, all_names):
    import __spark_entry__ as e

    assert sorted(all_names[1]) == sorted(views.VIEWS) and len(views.VIEWS) == 16
    names = [r["view_name"] for r in e.queries()["publish_views"](spark, SF_SMALL).collect()]
    assert sorted(names) == sorted(views.VIEWS)
    assert all(f"'{name}' AS view_name" in e.oracle_sql()["publish_views"] for name in views.VIEWS)

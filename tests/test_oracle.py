"""Spark result == independent DuckDB SQL on the same testdata (sf0.001),
for a representative subset of keys (tools/compare.py runs them all)."""

import decimal

import duckdb
import pytest

from conftest import SF_SMALL

KEYS = [
    "silver_pos_items", "silver_inventory_snapshots", "fact_sales_items", "fact_returns",
    "view_revenue_summary", "view_kpi_overview", "view_returns_summary", "view_inventory_turnover",
    "sq5_return_rate_by_channel", "dq_profile", "fk_audit", "load_reconcile", "grain_audit_facts", "b08_unit_margin_rank",
    "m_inventory_change", "b06_price_volume_mix", "b17_store_turnover", "b19_demand_vs_stock",
    "b26_abnormal_returns", "load_raw_csv", "lineage_enrich", "dedup_flag", "b07_mom_yoy_contribution",
    "b21_return_rate_slices", "b04_store_ranking",
]
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _norm(rows):
    def cell(v):
        if v is None:
            return "NULL"
        if isinstance(v, float):
            return repr(v)
        if isinstance(v, decimal.Decimal):
            return str(v)
        if hasattr(v, "isoformat"):
            return v.isoformat()
        return str(v)
    return sorted("|".join(cell(x) for x in r) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    import __spark_entry__ as e

    df = e.queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    s_rows = [tuple(r[c] for c in cols) for r in df.collect()]
    cur = con.execute(e.oracle_sql()[key])
    o_cols = [d[0] for d in cur.description]
    assert sorted(o_cols) == cols
    idx = [o_cols.index(c) for c in cols]
    o_rows = [tuple(r[i] for i in idx) for r in cur.fetchall()]
    assert len(s_rows) == len(o_rows)
    assert _norm(s_rows) == _norm(o_rows)


def test_entry_smoke(spark):
    import __spark_entry__ as e

    rows = e.entry(spark).collect()
    assert {r["source_system"] for r in rows} == {"POS", "ECOM"}

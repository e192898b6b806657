"""Every registered query and its oracle SQL agree on column names and types
(Spark schema vs DuckDB DESCRIBE). Planning only: nothing is executed, except
for the keys that land files while being built, which are skipped here."""

import duckdb
import pytest

from conftest import SF_SMALL
from ledgerlake.plans import registry

EAGER = {"full_refresh_write", "stream_land_raw", "load_all_raw", "lineage_enrich", "load_raw_csv"}
SPARK_TO_DUCK = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "StringType()": "VARCHAR",
                 "DoubleType()": "DOUBLE", "DateType()": "DATE", "TimestampNTZType()": "TIMESTAMP"}


def _duck_type(t) -> str:
    s = repr(t)
    if s.startswith("DecimalType"):
        return "DECIMAL" + s[len("DecimalType"):]
    return SPARK_TO_DUCK.get(s, s)


def test_every_key_has_an_oracle():
    import __spark_entry__ as e

    # The optional training-data queries are tested in their own folder.
    assert set(registry.queries()) <= set(e.oracle_sql()) and set(e.oracle_sql()) <= set(e.queries())


def test_schemas_match_oracle(spark):
    import __spark_entry__ as e

    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    mismatches = {}
    for key, fn in registry.queries().items():
        if key in EAGER:
            continue
        spark_types = {f.name: _duck_type(f.dataType) for f in fn(spark, SF_SMALL).schema.fields}
        duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {e.oracle_sql()[key]}").fetchall()}
        if spark_types != duck_types:
            mismatches[key] = (spark_types, duck_types)
    assert not mismatches, mismatches

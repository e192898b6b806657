"""Keep-latest shuffles one copy of a row, and gives it back exactly."""

import datetime as dt
from decimal import Decimal

from ledgerlake.operators.dedup import dedup_keep_latest

SCHEMA = "k long, load_timestamp timestamp_ntz, m decimal(12,2), d date, s string, n int, b boolean, t timestamp_ntz"
AT = dt.datetime(2024, 6, 1)


def _row(k, at, m="1.50", d=dt.date(2024, 2, 29), s="a", n=-3, b=True, t=dt.datetime(2024, 1, 1, 0, 0, 0, 120000)):
    return (k, at, m if m is None else Decimal(m), d, s, n, b, t)


def test_values_come_back_from_the_ordering_key(spark):
    later = AT + dt.timedelta(days=1)
    old, new = _row(1, AT, m="99.00"), _row(1, later, m="0.00", s=" x, y ", n=None, b=None)
    tie = [_row(2, AT, m="9.00"), _row(2, AT, m="10.00")]  # as text, 9.00 is the larger
    alone, keyless = _row(3, None, m=None, d=None, s="", t=None), [_row(None, AT), _row(None, AT)]
    out = dedup_keep_latest(spark.createDataFrame([old, new, *tie, alone, *keyless], SCHEMA), ["k"])
    assert out.schema.simpleString() == spark.createDataFrame([], SCHEMA).schema.simpleString()
    assert sorted(map(tuple, out.collect()), key=str) == sorted([new, tie[0], alone, *keyless], key=str)
    assert "max_by" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_other_types_travel_beside_the_ordering_key(spark):
    df = spark.createDataFrame([(1, AT, 0.1), (1, AT, 0.3), (2, AT, None)], "k long, load_timestamp timestamp_ntz, x double")
    assert sorted(map(tuple, dedup_keep_latest(df, ["k"]).collect())) == [(1, AT, 0.3), (2, AT, None)]

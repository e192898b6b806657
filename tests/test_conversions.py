"""Conversion edge cases (FIXTURES rule table 'conversion')."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.functions import convert as cv


def _one(spark, fn, value):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(fn(F.col("v")).alias("x")).collect()[0]["x"]


def test_try_int(spark):
    assert _one(spark, cv.try_int, "12.5") is None
    assert _one(spark, cv.try_int, " 7 ") == 7
    assert _one(spark, cv.try_int, "") is None
    assert _one(spark, cv.try_int, "99999999999") is None


def test_try_dec(spark):
    assert _one(spark, cv.try_dec, "12.345") == Decimal("12.35")
    assert _one(spark, cv.try_dec, "99999999999.99") is None
    assert _one(spark, cv.try_dec, "$5") is None
    assert _one(spark, cv.try_dec, "1e3") is None
    assert _one(spark, cv.try_dec, "-5") == Decimal("-5.00")


def test_try_date(spark):
    assert _one(spark, cv.try_date, "2024-02-30") is None
    assert _one(spark, cv.try_date, "2024") == dt.date(2024, 1, 1)
    assert _one(spark, cv.try_date, "20240105") == dt.date(2024, 1, 5)
    assert _one(spark, cv.try_date, "01/05/2024") == dt.date(2024, 1, 5)
    assert _one(spark, cv.try_date, "") is None
    assert _one(spark, cv.try_date, "n/a") is None


def test_vocab_first_match_wins(spark):
    pay = lambda c: cv.vocab(c, cv.PAYMENT_RULES)
    assert _one(spark, pay, "CASHBACK DEBIT") == "CASH"
    assert _one(spark, pay, " gift ") == "GIFT"
    stock = lambda c: cv.vocab(c, cv.STOCK_STATUS_RULES)
    assert _one(spark, stock, "Discontinued") == "IN_STOCK"
    chan = lambda c: cv.vocab(c, cv.RETURN_CHANNEL_RULES)
    assert _one(spark, chan, "Online Store") == "IN_STORE"
    reason = lambda c: cv.vocab(c, cv.RETURN_REASON_RULES)
    assert _one(spark, reason, "Damaged, defective") == "DEFECTIVE"

"""Fail-safe conversions and normalisation expressions (all JVM-side).

Semantics follow the reference's cleaning layer:

* ``try_int`` / ``try_dec`` return NULL instead of failing. Text is
  guarded by a plain-number pattern first, so ``'12.5'`` is not an INT and
  ``'1e3'`` / ``'$5'`` are not decimals.
* ``try_date`` accepts ISO dates and, like the reference's server, the
  compact ``yyyyMMdd`` and US ``MM/dd/yyyy`` forms.
* ``vocab`` is an ordered ``LIKE '%x%'`` rule list on the upper-cased,
  *untrimmed* value; first match wins, otherwise upper(trim(value)).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted number shapes (leading/trailing blanks allowed).
INT_PATTERN = r"^ *[+-]?[0-9]+ *$"
DEC_PATTERN = r"^ *[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+) *$"
COMPACT_DATE_PATTERN = r"^ *[0-9]{8} *$"
US_DATE_PATTERN = r"^ *[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} *$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns``, each evaluated once a row.

    Spark moves a filter below the projection that computes what it tests and
    repeats the expression there for each mention. It does not move one below
    a generator, so the values pass through one that gives a row for a row.
    """
    packed = df.select("*", F.struct(*[c.alias(n) for n, c in columns.items()]).alias("_once"))
    return packed.select("*", F.inline(F.array("_once"))).drop("_once")


def trim(c) -> Column:
    """LTRIM(RTRIM(x)): blanks only."""
    return F.trim(col(c))


def blank_to_null(c) -> Column:
    """NULLIF(LTRIM(RTRIM(x)), '')."""
    t = trim(c)
    return F.when(t != F.lit(""), t)


def upper_trim(c) -> Column:
    return F.upper(trim(c))


def try_int(c) -> Column:
    """TRY_CONVERT(INT, x)."""
    c = col(c)
    return F.when(c.rlike(INT_PATTERN), F.trim(c).try_cast("int"))


def try_id(c) -> Column:
    """A whole-number identifier. BIGINT: ids grow with the data, and one
    beyond INT would become NULL and lose its row."""
    c = col(c)
    return F.when(c.rlike(INT_PATTERN), F.trim(c).try_cast("bigint"))


def try_dec(c, precision: int = 12, scale: int = 2) -> Column:
    """TRY_CONVERT(DECIMAL(p,s), x): rounds half-up to scale, NULL on overflow."""
    c = col(c)
    return F.when(c.rlike(DEC_PATTERN), F.trim(c).try_cast(f"decimal({precision},{scale})"))


def try_date(c) -> Column:
    """TRY_CONVERT(DATE, x)."""
    c = col(c)
    t = F.trim(c)
    return F.coalesce(
        t.try_cast("date"),
        F.when(t.rlike(COMPACT_DATE_PATTERN), F.to_date(F.try_to_timestamp(t, F.lit("yyyyMMdd")))),
        F.when(t.rlike(US_DATE_PATTERN), F.to_date(F.try_to_timestamp(t, F.lit("M/d/yyyy")))),
    )


def try_timestamp(c) -> Column:
    """TRY_CONVERT(DATETIME2, x): zone-less timestamp."""
    c = col(c)
    t = F.trim(c)
    return F.coalesce(
        t.try_cast("timestamp_ntz"),
        F.when(t.rlike(COMPACT_DATE_PATTERN), F.try_to_timestamp(t, F.lit("yyyyMMdd")).cast("timestamp_ntz")),
        F.when(t.rlike(US_DATE_PATTERN), F.try_to_timestamp(t, F.lit("M/d/yyyy")).cast("timestamp_ntz")),
    )


def non_negative(v: Column) -> Column:
    """CASE WHEN v >= 0 THEN v END."""
    return F.when(v >= 0, v)


def positive(v: Column) -> Column:
    """CASE WHEN v > 0 THEN v END."""
    return F.when(v > 0, v)


def flag(predicate: Column) -> Column:
    """CASE WHEN p THEN 1 ELSE 0 END (NULL predicate -> 0)."""
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))


def is_null_flag(v: Column) -> Column:
    return flag(v.isNull())


def vocab(c, rules: list[tuple[str, str]]) -> Column:
    """Ordered substring vocabulary on UPPER(raw value); else upper(trim)."""
    c = col(c)
    up = F.upper(c)
    out = None
    for needle, label in rules:
        cond = up.contains(needle)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(upper_trim(c))


# Vocabulary rules, in matching order (first match wins).
PAYMENT_RULES = [("CASH", "CASH"), ("DEBIT", "DEBIT"), ("CREDIT", "CREDIT_CARD")]
STOCK_STATUS_RULES = [
    ("OUT", "OUT_OF_STOCK"),
    ("LOW", "LOW_STOCK"),
    ("IN", "IN_STOCK"),
    ("BACK", "BACKORDER"),
]
RETURN_REASON_RULES = [("DEFECT", "DEFECTIVE"), ("DAMAG", "DAMAGED"), ("SIZE", "SIZE_FIT")]
RETURN_CHANNEL_RULES = [("STORE", "IN_STORE"), ("ONLINE", "ONLINE")]


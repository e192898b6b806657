"""Division helpers with the reference's rounding and truncation rules.

* ``ratio``  - ROUND(num / NULLIF(den, 0), scale): exact decimal division,
  half-up, returned as DOUBLE. Operands are widened to DECIMAL(24,6) so the
  quotient carries 14 fractional digits before the final rounding (Spark's
  default result scale of 6 would round twice); see ``_quotient`` for larger ones.
* ``int_div`` - INT / INT of the reference: truncation toward zero.
* ``int_avg`` - AVG over an INT column, which the reference truncates.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(24,6)"
_WIDEST = "decimal(38,6)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_den(den) -> Column:
    """NULLIF(den, 0)."""
    den = _c(den)
    return F.when(den != 0, den)


def _quotient(num, den, scale: int) -> Column:
    """ROUND(num / NULLIF(den, 0), scale), half-up.

    Operands below 1e18 divide with 14 fractional digits. Larger ones would
    not fit that type: their whole part is divided exactly, and only the
    remainder, which is smaller than the divisor, to 6 digits.
    """
    num, den = _c(num), _c(den)
    near = F.round(num.try_cast(_WIDE) / safe_den(den.try_cast(_WIDE)), scale)
    n, d = num.cast(_WIDEST), safe_den(den.cast(_WIDEST))
    rest = n % d
    far = ((n - rest) / d).cast("decimal(36,6)") + F.round((rest / d).cast("decimal(12,6)"), scale)
    return F.coalesce(near, far.cast(f"decimal(38,{scale})"))


def product(a, b) -> Column:
    """a * b of two whole numbers, in a type that holds any two BIGINT of
    practical size (BIGINT * BIGINT fails from 9.2e18 on)."""
    return _c(a).cast("decimal(19,0)") * _c(b).cast("decimal(18,0)")


def div_round(num, den, scale: int = 2) -> Column:
    """ROUND(num / NULLIF(den, 0), scale) as an exact DECIMAL(38, scale)."""
    return _quotient(num, den, scale).cast(f"decimal(38,{scale})")


def ratio(num, den, scale: int = 4) -> Column:
    return _quotient(num, den, scale).cast("double")


def ratio_decimal(num, den, precision: int, scale: int) -> Column:
    """CAST(num * 1.0 / NULLIF(den, 0) AS DECIMAL(p,s)); NULL on overflow."""
    return _quotient(num, den, scale).try_cast(f"decimal({precision},{scale})")


def int_div(num, den) -> Column:
    """Truncating integer division (toward zero); NULL when den is 0 or NULL.

    ``n - n % d`` is an exact multiple of ``d`` (``%`` keeps the dividend's
    sign, as in the reference), so the decimal quotient is exact.
    """
    n, d = _c(num).cast("bigint"), safe_den(_c(den).cast("bigint"))
    exact = (n - n % d).cast("decimal(38,0)") / d.cast("decimal(38,0)")
    return exact.cast("bigint")


def int_avg(col) -> Column:
    """AVG(int_col) truncated toward zero (sum div count of non-NULL)."""
    c = _c(col)
    return int_div(F.sum(c), F.count(c))


def money_sum(col) -> Column:
    """SUM of a money column, widened to DECIMAL(38,2)."""
    return F.sum(_c(col)).cast("decimal(38,2)")


def long_sum(col) -> Column:
    return F.sum(_c(col)).cast("bigint")

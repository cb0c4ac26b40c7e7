"""Engine-stable numeric output.

Money stays DECIMAL through every sum (exact, order independent) and becomes
DOUBLE only at the output edge.  Ratios divide doubles with a NULL for a zero
divisor (instead of an error or infinity).  A double that must be rounded to
cents is rounded as ``round(x * 100) / 100`` — a half-away-from-zero round of
one double, which gives the same bits in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x) -> Column:
    """Exact decimal → double, unrounded."""
    return _c(x).cast("double")


def rounded_money(x) -> Column:
    """ROUND(decimal, 2) then DOUBLE (the reference's ROUND(SUM(...), 2))."""
    return F.round(_c(x), 2).cast("double")


def safe_div(num, den) -> Column:
    """num / den in double; NULL when den is 0 or NULL."""
    d = _c(den).cast("double")
    return _c(num).cast("double") / F.when(d != 0, d)


def ratio(num, den) -> Column:
    return safe_div(num, den)


def round2(x) -> Column:
    """Round a double to cents, half away from zero, engine-stable."""
    return F.round(_c(x) * 100) / 100


def count_when(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as BIGINT."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def strip(x) -> Column:
    """pandas ``str.strip``: all leading/trailing whitespace, not only spaces."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")

"""Calendar helpers that stay in timestamp-without-time-zone.

``date_trunc`` on a TIMESTAMP_NTZ returns a zoned timestamp in Spark; the
month start is built from the DATE instead, so results do not depend on the
session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_start(ts) -> Column:
    """DATE_TRUNC('month', ts) as TIMESTAMP_NTZ."""
    return F.trunc(_c(ts).cast("date"), "month").cast("timestamp_ntz")


def iso_weekday(ts) -> Column:
    """ISO day of week, Monday = 1 … Sunday = 7, BIGINT."""
    return F.extract(F.lit("DAYOFWEEK_ISO"), _c(ts)).cast("bigint")


def day_name(ts) -> Column:
    """Full English day name ('Saturday')."""
    return F.date_format(_c(ts), "EEEE")


def year_of(ts) -> Column:
    return F.year(_c(ts)).cast("int")


def month_of(ts) -> Column:
    return F.month(_c(ts)).cast("int")

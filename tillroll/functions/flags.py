"""Quality flags, line category and sale / cancellation measures.

Every flag is a never-null boolean (``CASE … THEN TRUE ELSE FALSE``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll import schemas as S

PRODUCT = "product"


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def is_cancellation() -> Column:
    # Invoice LIKE 'C%', case-sensitive
    return _flag(F.col(S.INVOICE).startswith("C"))


def is_negative_quantity() -> Column:
    return _flag(F.col(S.QUANTITY) < 0)


def is_zero_price() -> Column:
    return _flag(F.col(S.PRICE) == 0)


def is_negative_price() -> Column:
    return _flag(F.col(S.PRICE) < 0)


def is_missing_customer() -> Column:
    return F.col(S.CUSTOMER).isNull()


def is_missing_description() -> Column:
    return F.col(S.DESCRIPTION).isNull()


def raw_line_value() -> Column:
    """Quantity × Price, exact decimal."""
    return F.col(S.QUANTITY).cast("decimal(20,0)") * F.col(S.PRICE)


def is_product_sale() -> Column:
    return _flag((F.col("line_category") == PRODUCT) & ~F.col("is_cancellation")
                 & (F.col(S.QUANTITY) > 0) & (F.col(S.PRICE) > 0))


def is_product_cancellation() -> Column:
    return _flag((F.col("line_category") == PRODUCT) & F.col("is_cancellation")
                 & (F.col(S.QUANTITY) < 0) & (F.col(S.PRICE) > 0))


def value_if(cond: Column) -> Column:
    """raw_line_value where cond, else an exact decimal zero."""
    zero = F.lit(0).cast("decimal(38,4)")
    return F.when(cond, F.col("raw_line_value")).otherwise(zero).cast("decimal(38,4)")

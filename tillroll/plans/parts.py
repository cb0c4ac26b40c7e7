"""Parts of the line tables that lie together or apart, for any warehouse.

A ``Warehouse`` stores them; any other object with a ``table(name)`` has its lines read
as they are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tillroll.plans import layers


def by_invoice(wh, per_invoice: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``per_invoice`` (a grouping by invoice) of all lines."""
    stored = getattr(wh, "by_invoice", None)
    return stored(per_invoice) if stored else per_invoice(wh.table("bronze"))


def repeat_suspects(wh) -> DataFrame:
    """Bronze lines that may have an equal in the business columns."""
    stored = getattr(wh, "repeat_suspects", None)
    return stored() if stored else layers.repeat_suspects(wh.table("bronze"))[1]

"""Reports from state that grows batch by batch (see ``streaming.monthly``)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.plans.sales import _performance
from tillroll.sources import fixture_map
from tillroll.streaming.monthly import MonthlyTotals


def monthly_performance_incremental(wh) -> DataFrame:
    """The monthly totals after two batches, the lines of the earlier and
    of the later period; the second rewrites only the months that its invoices touch.  Batches
    that the stored state has already are not read again."""
    state = MonthlyTotals(wh.spark, os.path.join(wh.root, "monthly-state"), wh.categories())
    for batch, period in enumerate((fixture_map.PERIOD_EARLY, fixture_map.PERIOD_LATE)):
        if state.manifest()["batch"] < batch:
            state.apply(wh.table("bronze").where(F.col(S.PERIOD) == period), batch)
    return _performance(state.totals())

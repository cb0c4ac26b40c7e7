"""Customer scoring expressions (E2–E4, A27): ``when`` chains, first match wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Segment names and frequency-band labels of the reference.
SEGMENTS = ["Champions", "Loyal", "Potential", "At Risk", "Low Value", "Regular"]
SEGMENT_DISPLAY_ORDER = ["Champions", "Loyal", "Potential", "Regular", "At Risk", "Low Value"]
FREQUENCY_BANDS = ["1 commande", "2 commandes", "3 à 5 commandes", "6 à 10 commandes",
                   "Plus de 10 commandes"]
MISSING_DESCRIPTION_LABEL = "Description manquante"


def frequency_score(freq) -> Column:
    f = F.col(freq) if isinstance(freq, str) else freq
    return (F.when(f == 1, 1).when(f == 2, 2).when(f <= 5, 3).when(f <= 10, 4)
            .otherwise(5).cast("int"))


def frequency_band(freq) -> Column:
    f = F.col(freq) if isinstance(freq, str) else freq
    b = FREQUENCY_BANDS
    return (F.when(f == 1, b[0]).when(f == 2, b[1]).when(f <= 5, b[2]).when(f <= 10, b[3])
            .otherwise(b[4]))


def frequency_band_order(freq) -> Column:
    f = F.col(freq) if isinstance(freq, str) else freq
    return (F.when(f == 1, 1).when(f == 2, 2).when(f <= 5, 3).when(f <= 10, 4)
            .otherwise(5).cast("int"))


def segment(r="r_score", f="f_score", m="m_score") -> Column:
    r, f, m = (F.col(x) if isinstance(x, str) else x for x in (r, f, m))
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
            .when((f >= 4) & (m >= 3), "Loyal")
            .when((r >= 4) & (f <= 3), "Potential")
            .when((r <= 2) & ((f >= 3) | (m >= 3)), "At Risk")
            .when((r <= 2) & (f <= 2) & (m <= 2), "Low Value")
            .otherwise("Regular"))


def quintile_from_bounds(lo: Column, hi: Column, n: Column) -> Column:
    """pandas ``rank(method='average', pct=True)`` cut at 0.2, 0.4, … 1.0.

    The average rank of a tie group is (lo + hi) / 2, its percentile
    (lo + hi) / 2N; the right-closed bin index is ceil(5·(lo + hi) / 2N),
    computed in integers: (5·(lo + hi) + 2N − 1) div 2N.
    """
    num = F.lit(5) * (lo + hi) + F.lit(2) * n - 1
    # exact: the true quotient is ≥ 1/(2N) away from the next integer
    return F.floor(num / (F.lit(2) * n)).cast("int")

"""Column expressions (JVM-side, code-generated; no Python UDFs)."""

from tillroll.functions.numeric import money, ratio, round2, rounded_money, safe_div  # noqa: F401

"""tillroll — retail invoice-line analytics as Spark DataFrame jobs.

Layers (each a function from DataFrames to a DataFrame):

* ``sources``   – period scans, typing/consolidation, the special-code table,
                  the test-table mapping, Parquet/CSV sinks;
* ``functions`` – column expressions (quality flags, sale measures, scores,
                  calendar helpers, engine-stable rounding);
* ``operators`` – distributed building blocks Spark has no single call for
                  (tie-aware global ranks and running totals without a
                  single-task window, exact quantiles, skew-safe repeat count);
* ``plans``     – the warehouse (bronze → silver → marts → RFM) and every
                  report, audit and reconciliation query on top of it;
* ``streaming`` – incremental ingest of new period files into bronze.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"

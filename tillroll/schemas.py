"""Explicit schemas: no inference anywhere in the pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of a consolidated invoice line.  ``Customer ID`` carries a
# space in the source; it is renamed at the source boundary.
INVOICE = "Invoice"
STOCK_CODE = "StockCode"
DESCRIPTION = "Description"
QUANTITY = "Quantity"
INVOICE_DATE = "InvoiceDate"
PRICE = "Price"
CUSTOMER = "customer_id_raw"
COUNTRY = "Country"
PERIOD = "SourcePeriod"

RAW_COLUMNS = [INVOICE, STOCK_CODE, DESCRIPTION, QUANTITY, INVOICE_DATE, PRICE, CUSTOMER, COUNTRY]
BRONZE_COLUMNS = RAW_COLUMNS + [PERIOD]

# Money is exact: DECIMAL inside, DOUBLE only at the output edge.
PRICE_TYPE = T.DecimalType(18, 4)

# A period file as it arrives: every column text, typed by ``sources.periods``.
RAW_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

BRONZE_SCHEMA = T.StructType([
    T.StructField(INVOICE, T.StringType(), True),
    T.StructField(STOCK_CODE, T.StringType(), True),
    T.StructField(DESCRIPTION, T.StringType(), True),
    T.StructField(QUANTITY, T.LongType(), False),
    T.StructField(INVOICE_DATE, T.TimestampNTZType(), False),
    T.StructField(PRICE, PRICE_TYPE, False),
    T.StructField(CUSTOMER, T.LongType(), True),
    T.StructField(COUNTRY, T.StringType(), True),
    T.StructField(PERIOD, T.StringType(), False),
])

CATEGORY_SCHEMA = T.StructType([
    T.StructField("stock_code", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
])

QUALITY_FLAGS = [
    "is_cancellation",
    "is_negative_quantity",
    "is_zero_price",
    "is_negative_price",
    "is_missing_customer",
    "is_missing_description",
    "is_special_stockcode",
    "is_repeated_row",
]

"""The special stock-code table: code → line category.

Special = "listed here"; a listed code may still be a ``product``.  Codes are
compared with binary collation (``M`` and ``m`` are two codes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import CATEGORY_SCHEMA

# Fixed values that must equal the reference classification (62 codes,
# 10 categories), in the order of its published table.
STOCKCODE_CATEGORIES = [
    ("ADJUST", "adjustment"),
    ("ADJUST2", "adjustment"),
    ("AMAZONFEE", "fee"),
    ("B", "adjustment"),
    ("BANK CHARGES", "fee"),
    ("C2", "shipping"),
    ("C3", "stock_movement"),
    ("CRUK", "fee"),
    ("D", "discount"),
    ("DCGS0003", "product"),
    ("DCGS0004", "product"),
    ("DCGS0006", "stock_movement"),
    ("DCGS0016", "stock_movement"),
    ("DCGS0027", "stock_movement"),
    ("DCGS0036", "stock_movement"),
    ("DCGS0037", "product"),
    ("DCGS0039", "stock_movement"),
    ("DCGS0041", "product"),
    ("DCGS0044", "product"),
    ("DCGS0053", "stock_movement"),
    ("DCGS0055", "stock_movement"),
    ("DCGS0056", "stock_movement"),
    ("DCGS0057", "stock_movement"),
    ("DCGS0058", "product"),
    ("DCGS0059", "stock_movement"),
    ("DCGS0060", "stock_movement"),
    ("DCGS0062", "product"),
    ("DCGS0066N", "product"),
    ("DCGS0066P", "stock_movement"),
    ("DCGS0067", "stock_movement"),
    ("DCGS0068", "product"),
    ("DCGS0069", "product"),
    ("DCGS0070", "product"),
    ("DCGS0071", "stock_movement"),
    ("DCGS0072", "product"),
    ("DCGS0073", "stock_movement"),
    ("DCGS0074", "stock_movement"),
    ("DCGS0075", "product"),
    ("DCGS0076", "product"),
    ("DCGSLBOY", "stock_movement"),
    ("DCGSLGIRL", "stock_movement"),
    ("DCGSSBOY", "product"),
    ("DCGSSGIRL", "product"),
    ("DOT", "shipping"),
    ("GIFT", "stock_movement"),
    ("M", "manual"),
    ("PADS", "product"),
    ("POST", "shipping"),
    ("S", "sample"),
    ("SP1002", "product"),
    ("TEST001", "test"),
    ("TEST002", "test"),
    ("gift_0001_10", "gift_voucher"),
    ("gift_0001_20", "gift_voucher"),
    ("gift_0001_30", "gift_voucher"),
    ("gift_0001_40", "gift_voucher"),
    ("gift_0001_50", "gift_voucher"),
    ("gift_0001_60", "gift_voucher"),
    ("gift_0001_70", "gift_voucher"),
    ("gift_0001_80", "gift_voucher"),
    ("gift_0001_90", "gift_voucher"),
    ("m", "manual"),
]

# The audit's rule lists, applied in this order (later lists
# overwrite earlier ones); codes in none of them start as "unknown" and are
# then classed "stock_movement".
AUDIT_RULE_LISTS = [
    ("shipping", ["POST", "DOT", "C2"]),
    ("discount", ["D"]),
    ("sample", ["S"]),
    ("fee", ["BANK CHARGES", "AMAZONFEE", "CRUK"]),
    ("adjustment", ["ADJUST", "ADJUST2", "B"]),
    ("manual", ["M", "m"]),
    ("test", ["TEST001", "TEST002"]),
    ("gift_voucher", ["gift_0001_10", "gift_0001_20", "gift_0001_30", "gift_0001_40",
                      "gift_0001_50", "gift_0001_60", "gift_0001_70", "gift_0001_80",
                      "gift_0001_90"]),
    ("product", ["DCGS0058", "DCGSSGIRL", "DCGSSBOY", "PADS", "DCGS0003", "DCGS0076",
                 "DCGS0069", "DCGS0004", "DCGS0072", "DCGS0066N", "DCGS0068", "DCGS0070",
                 "SP1002", "DCGS0037", "DCGS0062", "DCGS0041", "DCGS0044", "DCGS0075"]),
]
AUDIT_FALLBACK_CATEGORY = "stock_movement"


def audit_rule_map() -> list[tuple[str, str]]:
    """(code, category) after applying the rule lists in order, last wins."""
    mapping: dict[str, str] = {}
    for category, codes in AUDIT_RULE_LISTS:
        for code in codes:
            mapping[code] = category
    return sorted(mapping.items())


def stockcode_categories(spark: SparkSession) -> DataFrame:
    """The 62-row table as a DataFrame (fixed size: safe to broadcast)."""
    return spark.createDataFrame(STOCKCODE_CATEGORIES, CATEGORY_SCHEMA)


def read_stockcode_categories(spark: SparkSession, path: str) -> DataFrame:
    """The same table from a CSV file with a header, schema given, not inferred."""
    return (spark.read.schema(CATEGORY_SCHEMA).option("header", True)
            .option("mode", "FAILFAST").csv(path)
            .select(F.col("stock_code"), F.col("category")))


def write_stockcode_categories(df: DataFrame, path: str) -> None:
    df.coalesce(1).orderBy("stock_code").write.mode("overwrite").option("header", True).csv(path)

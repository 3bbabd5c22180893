"""Schemas and the fixed values the operators share."""

from __future__ import annotations

from pyspark.sql import types as T

# Header of the raw invoice file -> column name in the fact table.
SOURCE_COLUMNS = {
    "Invoice": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}

# Stock codes that are not products.
NON_PRODUCT_CODES = ("POST", "M", "DOT", "C2", "BANK CHARGES", "AMAZONFEE")

# Fixed value: cancelled invoices start with this letter, in either case.
CANCELLATION_PREFIX = "C"

# Fixed value: stands for a missing reference key where a key must not be NULL.
NO_REFERENCE_KEY = "__none__"

BUSINESS_COLUMNS = tuple(SOURCE_COLUMNS.values())

# A row lacking one of these cannot be used and is dropped at load.
REQUIRED_COLUMNS = ("invoice_no", "stock_code", "invoice_date", "quantity", "unit_price")

FLAG_COLUMNS = (
    "is_cancellation",
    "is_missing_customer",
    "is_return",
    "is_invalid_price",
    "is_non_product",
    "is_stock_adjustment",
)

RAW_INVOICES = T.StructType([T.StructField(name, T.StringType()) for name in SOURCE_COLUMNS])

TRANSACTIONS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("invoice_no", T.StringType(), False),
        T.StructField("stock_code", T.StringType(), False),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType(), False),
        T.StructField("invoice_date", T.TimestampNTZType(), False),
        T.StructField("unit_price", T.DecimalType(10, 2), False),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("country", T.StringType()),
    ]
)

CUSTOMER_SEGMENTS = T.StructType(
    [
        T.StructField("customer_id", T.IntegerType(), False),
        T.StructField("recency_days", T.IntegerType(), False),
        T.StructField("frequency", T.LongType(), False),
        T.StructField("monetary", T.DecimalType(31, 2), False),
        T.StructField("cluster", T.IntegerType(), False),
        T.StructField("segment_name", T.StringType(), False),
    ]
)

TRANSACTION_ANOMALIES = T.StructType(
    [
        T.StructField("transaction_id", T.LongType(), False),
        T.StructField("anomaly_score", T.DecimalType(10, 6), False),
        T.StructField("is_anomaly", T.BooleanType(), False),
    ]
)

NARRATIVES = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("narrative_type", T.StringType(), False),
        T.StructField("reference_key", T.StringType()),
        T.StructField("input_stats", T.StringType(), False),
        T.StructField("narrative_text", T.StringType(), False),
        T.StructField("generated_at", T.TimestampNTZType()),
    ]
)

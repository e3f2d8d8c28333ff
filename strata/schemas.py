"""Declared schemas.

``user_purchase`` is the one table whose layout is fixed: eight nullable columns, no key.
The other layouts (raw reviews, raw review logs, the silver and gold outputs) are this
library's own contracts.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The purchase table's columns, in order, with their declared types.
USER_PURCHASE_DDL = (
    "invoice_number VARCHAR(10), "
    "stock_code VARCHAR(20), "
    "detail VARCHAR(1000), "
    "quantity INT, "
    "invoice_date TIMESTAMP_NTZ, "
    "unit_price DECIMAL(8,3), "
    "customer_id INT, "
    "country VARCHAR(20)"
)

# VARCHAR(n) limits; readers cannot carry them in a StructType, so they are checked apart.
USER_PURCHASE_VARCHAR = {
    "invoice_number": 10,
    "stock_code": 20,
    "detail": 1000,
    "country": 20,
}

USER_PURCHASE = T.StructType([
    T.StructField("invoice_number", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("invoice_date", T.TimestampNTZType()),
    T.StructField("unit_price", T.DecimalType(8, 3)),
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("country", T.StringType()),
])

# Raw review file: one review per row, free text that may hold commas, quotes, newlines.
MOVIE_REVIEW = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("review_id", T.LongType()),
    T.StructField("review_text", T.StringType()),
])

# Raw review-log file: one XML <log> element per row in the ``log`` column.
LOG_REVIEW = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("log", T.StringType()),
])

# Fields inside each <log> element; ``ts`` is text and is cast after parsing.
LOG_XML_FIELDS = T.StructType([
    T.StructField("ts", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

REVIEW_LOGS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

CLASSIFIED_REVIEW = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("review_id", T.LongType()),
    T.StructField("positive_review", T.IntegerType()),
])

MOVIE_ANALYTICS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("amount_spent", T.DecimalType(38, 3)),
    T.StructField("review_score", T.LongType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("log_count", T.LongType()),
    T.StructField("last_log", T.TimestampNTZType()),
])

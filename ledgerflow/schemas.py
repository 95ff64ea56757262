"""Typed schemas of the two feeds (transactions, payments) and derived tables.

Amounts are 64-bit doubles everywhere: the payment link compares amounts for
equality, so both sides must have the same width. Event times are
TIMESTAMP_NTZ (wall-clock time as sent by the processor).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the transaction payload, in order.
TRANSACTION_FIELDS: list[tuple[str, T.DataType]] = [
    ("transaction_id", T.StringType()),
    ("card_id", T.StringType()),
    ("member_id", T.StringType()),
    ("amount", T.DoubleType()),
    ("currency_code", T.StringType()),
    ("merchant_name", T.StringType()),
    ("merchant_category_code", T.StringType()),
    ("transaction_type", T.StringType()),
    ("transaction_status", T.StringType()),
    ("posted_at", T.TimestampNTZType()),
    ("authorized_at", T.TimestampNTZType()),
    ("network", T.StringType()),
    ("is_international", T.BooleanType()),
    ("decline_reason", T.StringType()),
]

# Field names and types of the payment payload, in order.
PAYMENT_FIELDS: list[tuple[str, T.DataType]] = [
    ("payment_id", T.StringType()),
    ("member_id", T.StringType()),
    ("payment_type", T.StringType()),
    ("amount", T.DoubleType()),
    ("payment_status", T.StringType()),
    ("scheduled_date", T.DateType()),
    ("settled_at", T.TimestampNTZType()),
    ("source_account", T.StringType()),
    ("destination_account", T.StringType()),
    ("failure_reason", T.StringType()),
]

TRANSACTION_COLUMNS = [n for n, _ in TRANSACTION_FIELDS]
PAYMENT_COLUMNS = [n for n, _ in PAYMENT_FIELDS]


def struct_of(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TRANSACTION_SCHEMA = struct_of(TRANSACTION_FIELDS)
PAYMENT_SCHEMA = struct_of(PAYMENT_FIELDS)

# Columns that the events table and the daily fact add, in order.
EVENT_SCHEMA = struct_of(TRANSACTION_FIELDS + [
    ("payment_id", T.StringType()), ("payment_type", T.StringType()),
    ("payment_status", T.StringType()), ("settled_at", T.TimestampNTZType()),
    ("event_date", T.DateType()), ("event_month", T.TimestampNTZType()),
    ("event_hour", T.IntegerType()), ("is_approved", T.BooleanType()),
    ("geo_type", T.StringType()), ("amount_tier", T.StringType()),
    ("event_key", T.StringType()), ("_dbt_updated_at", T.TimestampNTZType()),
])
FACT_SCHEMA = struct_of([
    ("daily_key", T.StringType()), ("event_date", T.DateType()), ("card_id", T.StringType()),
    ("member_id", T.StringType()), ("geo_type", T.StringType()),
    ("total_transactions", T.LongType()), ("approved_transactions", T.LongType()),
    ("declined_transactions", T.LongType()), ("approval_rate_pct", T.DoubleType()),
    ("total_spend", T.DoubleType()), ("avg_transaction_amount", T.DoubleType()),
    ("max_transaction_amount", T.DoubleType()), ("distinct_mcc_count", T.LongType()),
    ("distinct_merchant_count", T.LongType()), ("payments_linked", T.LongType()),
    ("settled_payment_amount", T.DoubleType()), ("intl_transactions", T.LongType()),
    ("intl_spend", T.DoubleType()), ("fraud_declines", T.LongType()),
    ("credit_limit_declines", T.LongType()), ("_dbt_updated_at", T.TimestampNTZType()),
])

# Routing keys per feed (JSON path of the record key and of the
# date the record is routed by).
TRANSACTION_ROUTING = ("$.transaction_id", "$.posted_at")
PAYMENT_ROUTING = ("$.payment_id", "$.scheduled_date")
ROUTING = {"transactions": TRANSACTION_ROUTING, "payments": PAYMENT_ROUTING}

# Raw (landed/loaded) table: one JSON payload per record + load metadata.
RAW_SCHEMA = T.StructType([
    T.StructField("raw_payload", T.StringType(), True),
    T.StructField("loaded_at", T.TimestampNTZType(), True),
    T.StructField("source_file", T.StringType(), True),
    T.StructField("source_row", T.LongType(), True),
])

PROCESSOR_VERSION = "1.0.0"

"""Fixture adapter: the driver's ``events`` table -> raw transaction / payment feeds.

The rules are the fixed mapping of FIXTURES.md §3 (k = integer at ``$.k`` of
``props``). Everything is a narrow projection of ``events`` (plus one filtered
re-send set per feed, unioned), so it scales with the events table and adds no
shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.expressions import to_json_payload
from ledgerflow.schemas import PAYMENT_COLUMNS, TRANSACTION_COLUMNS

# Card networks by k % 4, payment types by event_id % 3,
# decline reasons by k % 3 (in that index order).
NETWORKS = ["VISA", "MASTERCARD", "AMEX", "DISCOVER"]
FIXTURE_PAYMENT_TYPES = ["ACH", "WIRE", "BILLPAY"]
DECLINE_REASONS = ["FRAUD_SUSPECTED", "CREDIT_LIMIT", "OTHER"]
# The run timestamp used by tests and registered queries.
FIXTURE_AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)
# Every 97th event's payload is replaced by this text.
BAD_PAYLOAD = "{bad"
BAD_PAYLOAD_EVERY = 97


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def _pick(index: Column, values: list[str]) -> Column:
    expr = F.lit(None).cast("string")
    for i in reversed(range(len(values))):
        expr = F.when(index == i, values[i]).otherwise(expr)
    return expr


def _amount() -> Column:
    return F.round(F.col("value") * 5, 2)


def _ntz(c: Column) -> Column:
    return c.cast(T.TimestampNTZType())


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (load_table(spark, sf_dir, "events")
            .select("event_id", "ts", "user_id", "event_type", "value", _k().alias("k")))


def raw_transaction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed raw transaction records (set A: every event; set B: re-sends)."""
    ev = _events(spark, sf_dir)
    k = F.col("k")
    common = [
        F.concat(F.lit("T"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.concat(F.lit("M"), (F.col("user_id") % 50).cast("string")).alias("member_id"),
        F.lit("USD").alias("currency_code"),
        F.concat(F.lit("MERCHANT_"), k.cast("string")).alias("merchant_name"),
        (F.lit(5000) + k % 20).cast("string").alias("merchant_category_code"),
        F.upper("event_type").alias("transaction_type"),
        F.col("ts").alias("posted_at"),
    ]
    set_a = ev.select(
        *common,
        F.when(k == 99, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("C"), F.col("user_id").cast("string"))).alias("card_id"),
        F.when(k == 98, F.lit(None).cast("double")).otherwise(_amount()).alias("amount"),
        F.when(F.col("event_type") == "error", "DECLINED")
         .when(F.col("event_type") == "signup", "PENDING")
         .when(k % 7 == 0, " approved ")
         .otherwise("APPROVED").alias("transaction_status"),
        F.when(k % 25 == 0, F.lit(None).cast(T.TimestampNTZType()))
         .otherwise(_ntz(F.col("ts") - F.expr("INTERVAL 2 MINUTES"))).alias("authorized_at"),
        _pick(k % 4, NETWORKS).alias("network"),
        F.when(k % 11 == 0, F.lit(None).cast("boolean"))
         .when(k % 5 == 0, True).otherwise(False).alias("is_international"),
        F.when(F.col("event_type") == "error", _pick(k % 3, DECLINE_REASONS))
         .alias("decline_reason"),
        _ntz(F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("loaded_at"),
        F.col("event_id"),
        F.lit("A").alias("resend_set"),
    )
    set_b = ev.where(k % 10 == 0).select(
        *common,
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("card_id"),
        _amount().alias("amount"),
        F.lit("APPROVED").alias("transaction_status"),
        _ntz(F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("authorized_at"),
        F.lit("VISA").alias("network"),
        F.lit(False).alias("is_international"),
        F.lit(None).cast("string").alias("decline_reason"),
        _ntz(F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("loaded_at"),
        F.col("event_id"),
        F.lit("B").alias("resend_set"),
    )
    cols = TRANSACTION_COLUMNS + ["loaded_at", "event_id", "resend_set"]
    return set_a.select(*cols).unionByName(set_b.select(*cols))


def corrected_rows(rows: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """Corrections that arrive at ``loaded_at`` (set C): every transaction of the first day and
    each 29th one is posted a day later, each 31st one loses its posting time."""
    first = rows.agg(F.min(F.to_date("posted_at"))).first()[0]
    of_first_day = F.to_date("posted_at") == F.lit(first)
    moved = of_first_day | (F.col("event_id") % 29 == 0)
    out = rows.where((F.col("resend_set") == "A") & (moved | (F.col("event_id") % 31 == 0)))
    return out.withColumns({
        "posted_at": F.when(moved, _ntz(F.col("posted_at") + F.expr("INTERVAL 1 DAY"))),
        "authorized_at": F.lit(None).cast(T.TimestampNTZType()),
        "loaded_at": F.lit(loaded_at).cast(T.TimestampNTZType()),
        "resend_set": F.lit("C")})


def restated_rows(rows: DataFrame) -> DataFrame:
    """Versions that differ from the first in status alone (set C): each 17th transaction,
    equal authorization time, loaded four hours later."""
    return rows.where((F.col("resend_set") == "A") & (F.col("event_id") % 17 == 0)).withColumns({
        "transaction_status": F.lit("PENDING"),
        "loaded_at": _ntz(F.col("loaded_at") + F.expr("INTERVAL 4 HOURS")), "resend_set": F.lit("C")})


def raw_payment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed raw payment records (set A: clicks/purchases; set B: re-sends)."""
    ev = _events(spark, sf_dir)
    k = F.col("k")
    member = F.concat(F.lit("M"), (F.col("user_id") % 50).cast("string"))
    status_a = (F.when(F.col("event_id") % 5 == 0, "PENDING")
                .when(F.col("event_id") % 5 == 1, "FAILED")
                .otherwise("SETTLED"))
    set_a = ev.where(F.col("event_type").isin("click", "purchase") & (k != 98)).select(
        F.concat(F.lit("P"), F.col("event_id").cast("string")).alias("payment_id"),
        member.alias("member_id"),
        _pick(F.col("event_id") % 3, FIXTURE_PAYMENT_TYPES).alias("payment_type"),
        _amount().alias("amount"),
        status_a.alias("payment_status"),
        F.to_date("ts").alias("scheduled_date"),
        F.when(status_a == "SETTLED", _ntz(F.col("ts") + F.expr("INTERVAL 2 DAYS")))
         .alias("settled_at"),
        F.concat(F.lit("SRC_"), F.col("user_id").cast("string")).alias("source_account"),
        F.concat(F.lit("DST_"), k.cast("string")).alias("destination_account"),
        F.when(status_a == "FAILED", "NSF").alias("failure_reason"),
        _ntz(F.col("ts") + F.expr("INTERVAL 3 HOURS")).alias("loaded_at"),
        F.col("event_id"),
        F.lit("A").alias("resend_set"),
    )
    set_b = ev.where((F.col("event_type") == "purchase") & (k % 10 == 0)).select(
        F.concat(F.lit("P"), F.col("event_id").cast("string"),
                 F.when(F.col("event_id") % 2 == 1, "B").otherwise("")).alias("payment_id"),
        member.alias("member_id"),
        F.lit("ACH").alias("payment_type"),
        _amount().alias("amount"),
        F.lit("SETTLED").alias("payment_status"),
        F.to_date("ts").alias("scheduled_date"),
        _ntz(F.col("ts") + F.expr("INTERVAL 3 DAYS")).alias("settled_at"),
        F.concat(F.lit("SRC_"), F.col("user_id").cast("string")).alias("source_account"),
        F.concat(F.lit("DST_"), k.cast("string")).alias("destination_account"),
        F.lit(None).cast("string").alias("failure_reason"),
        _ntz(F.col("ts") + F.expr("INTERVAL 4 HOURS")).alias("loaded_at"),
        F.col("event_id"),
        F.lit("B").alias("resend_set"),
    )
    cols = PAYMENT_COLUMNS + ["loaded_at", "event_id", "resend_set"]
    return set_a.select(*cols).unionByName(set_b.select(*cols))


def _source_file(feed: str) -> Column:
    return F.concat(F.lit(f"{feed}/"), F.date_format("loaded_at", "yyyy/MM/dd/HH"),
                    F.lit("/batch_"), F.col("resend_set"), F.lit(".json"))


def _raw_table(rows: DataFrame, feed: str, fields: list[str],
               corrupt_every: int | None, key: str, route_date: Column) -> DataFrame:
    payload = to_json_payload(fields)
    key_col = F.col(key)
    if corrupt_every:
        bad = F.col("event_id") % corrupt_every == 0
        payload = F.when(bad, F.lit(BAD_PAYLOAD)).otherwise(payload)
        key_col = F.when(~bad, key_col)
        route_date = F.when(~bad, route_date)
    return rows.select(
        payload.alias("raw_payload"),
        F.col("loaded_at"),
        _source_file(feed).alias("source_file"),
        F.col("event_id").alias("source_row"),
        key_col.alias("record_key"),
        route_date.alias("route_date"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str,
                     corrupt_every: int | None = None) -> DataFrame:
    """raw.transactions: (raw_payload, loaded_at, source_file, source_row,
    record_key, route_date) — the last two are routing keys kept beside the
    payload (transaction_id, posting date), as a loader extracts them."""
    return raw_transactions_of(raw_transaction_rows(spark, sf_dir), corrupt_every)


def raw_transactions_of(rows: DataFrame, corrupt_every: int | None = None) -> DataFrame:
    return _raw_table(rows, "transactions", TRANSACTION_COLUMNS, corrupt_every, "transaction_id",
                      F.to_date("posted_at"))


def raw_payments(spark: SparkSession, sf_dir: str,
                 corrupt_every: int | None = None) -> DataFrame:
    """raw.payments: (raw_payload, loaded_at, source_file, source_row,
    record_key = payment_id, route_date = scheduled_date)."""
    return _raw_table(raw_payment_rows(spark, sf_dir), "payments",
                      PAYMENT_COLUMNS, corrupt_every, "payment_id", F.col("scheduled_date"))


def materialize_raw(df: DataFrame, path: str) -> DataFrame:
    """Store a raw feed as a table partitioned by load day, as a loader would.

    Arrival filters (``loaded_at >= bound``) then prune whole load days.
    """
    out = df.withColumn("load_date", F.to_date("loaded_at"))
    out.write.mode("overwrite").partitionBy("load_date").parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)

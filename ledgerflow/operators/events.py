"""Enriched card events: transactions LEFT JOIN settled payments.

Join keys are (member_id, amount, event_date = scheduled_date). The right side
is restricted to SETTLED before the join, so unmatched transactions survive.
Strategy is left to AQE: the settled-payments side is broadcast only when its
measured shuffle output is below the broadcast threshold, otherwise a
sort-merge join runs and skewed left partitions (a hot member/day, or the
NULL-amount rows that can never match) are split by the skew-join rule.

The join is many-to-many by definition: two settled payments of the same
member, amount and day both attach to a transaction (one event_key, two rows).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.expressions import (
    MODEL_HIGH_TIER, PAYMENT_SETTLED, amount_tier, as_of_literal, event_date,
    event_hour, event_month, geo_type, is_approved, surrogate_key,
)
from ledgerflow.schemas import TRANSACTION_COLUMNS

PAYMENT_LINK_COLUMNS = ["payment_id", "payment_type", "payment_status", "settled_at"]

EVENT_COLUMNS = (TRANSACTION_COLUMNS + PAYMENT_LINK_COLUMNS +
                 ["event_date", "event_month", "event_hour", "is_approved",
                  "geo_type", "amount_tier", "event_key", "_dbt_updated_at"])


def settled_payments(stg_pay: DataFrame) -> DataFrame:
    return (stg_pay.where(F.col("payment_status") == PAYMENT_SETTLED)
                   .select(F.col("member_id").alias("_p_member_id"),
                           F.col("amount").alias("_p_amount"),
                           F.col("scheduled_date").alias("_p_date"),
                           *PAYMENT_LINK_COLUMNS))


# Prefix of the salted member key given to rows that cannot
# match (no payment member_id starts with a NUL character).
UNMATCHABLE_PREFIX = "\u0000"


def link_payments(transactions: DataFrame, stg_pay: DataFrame) -> DataFrame:
    """Left join of transactions (with ``event_date``) to settled payments.

    A transaction with a NULL member, amount or date can never match, but a
    left join still shuffles it, and all such rows would hash to a single
    reducer. They get a per-row salted member key instead (a NUL-prefixed hash
    of the transaction id that no payment carries), which spreads them evenly
    and leaves the result unchanged.
    """
    p = settled_payments(stg_pay)
    can_match = (F.col("member_id").isNotNull() & F.col("amount").isNotNull()
                 & F.col("event_date").isNotNull())
    salt = F.concat(F.lit(UNMATCHABLE_PREFIX),
                    F.xxhash64("transaction_id", "posted_at").cast("string"))
    t = transactions.withColumn("_join_member", F.when(can_match, F.col("member_id"))
                                .otherwise(salt))
    cond = ((t["_join_member"] == p["_p_member_id"])
            & (t["amount"] == p["_p_amount"])
            & (t["event_date"] == p["_p_date"]))
    return (t.join(p, cond, "left")
             .drop("_p_member_id", "_p_amount", "_p_date", "_join_member"))


def derived_columns(linked: DataFrame, high_tier: float = MODEL_HIGH_TIER) -> DataFrame:
    """Linked transactions with the attributes derived from their own columns (a stream too)."""
    return (linked.withColumn("event_date", event_date("posted_at"))
            .withColumn("event_month", event_month("posted_at"))
            .withColumn("event_hour", event_hour("posted_at"))
            .withColumn("is_approved", is_approved("transaction_status"))
            .withColumn("geo_type", geo_type("is_international"))
            .withColumn("amount_tier", amount_tier("amount", high=high_tier)))


def credit_card_events(stg_tx: DataFrame, stg_pay: DataFrame, as_of: dt.datetime,
                       high_tier: float = MODEL_HIGH_TIER) -> DataFrame:
    """int_credit_card_events: one row per (transaction, linked settled payment)."""
    t = stg_tx.select(*TRANSACTION_COLUMNS).withColumn("event_date", event_date("posted_at"))
    out = derived_columns(link_payments(t, stg_pay), high_tier)
    out = out.withColumn("event_key", surrogate_key(out, ["transaction_id", "posted_at"]))
    out = out.withColumn("_dbt_updated_at", as_of_literal(as_of))
    return out.select(*EVENT_COLUMNS)

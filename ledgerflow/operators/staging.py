"""Staging views over the raw feeds (I1): window, parse, dedupe.

A "view" is simply a function returning a lazy DataFrame; Catalyst inlines it
into whatever consumes it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.expressions import as_of_literal, load_window, parsed_fields
from ledgerflow.operators.dedupe import latest_per_key
from ledgerflow.schemas import PAYMENT_FIELDS, TRANSACTION_FIELDS


# What decides between versions of equal event and load time: a later epoch of a
# stream, a file that landed later, and then file name and position.
ARRIVAL_COLUMNS = ["epoch", "file_mtime", "source_file", "source_row"]


def parse_raw(raw: DataFrame, fields, as_of: dt.datetime | None,
              window_days: int | None) -> DataFrame:
    if window_days is not None:
        if as_of is None:
            raise ValueError("a load window needs an explicit as_of")
        raw = raw.where(load_window("loaded_at", as_of, window_days))
    extra = [c for c in ARRIVAL_COLUMNS if c in raw.columns]
    parsed = parsed_fields(raw, "raw_payload", fields, extra + ["loaded_at"])
    return (parsed.withColumnRenamed("loaded_at", "_loaded_at")
                  .withColumn("_dbt_updated_at", as_of_literal(as_of or dt.datetime(1970, 1, 1))))


def stg_transactions(raw: DataFrame, as_of: dt.datetime | None = None,
                     window_days: int | None = 7) -> DataFrame:
    """Latest version of every transaction loaded in the window.

    Order: authorized_at DESC NULLS FIRST, _loaded_at DESC NULLS FIRST (the
    warehouse default for DESC, written out). The provenance columns break any
    remaining tie so the result is deterministic.
    """
    parsed = parse_raw(raw, TRANSACTION_FIELDS, as_of, window_days)
    order = [F.col("authorized_at").desc_nulls_first(),
             F.col("_loaded_at").desc_nulls_first()]
    order += [F.col(c).desc_nulls_last() for c in ARRIVAL_COLUMNS if c in parsed.columns]
    return latest_per_key(parsed, "transaction_id", order).drop("epoch", "file_mtime")


def stg_payments(raw: DataFrame, as_of: dt.datetime | None = None,
                 window_days: int | None = 7) -> DataFrame:
    """Latest version of every payment: settled_at DESC NULLS LAST, _loaded_at DESC."""
    parsed = parse_raw(raw, PAYMENT_FIELDS, as_of, window_days)
    order = [F.col("settled_at").desc_nulls_last(),
             F.col("_loaded_at").desc_nulls_first()]
    order += [F.col(c).desc_nulls_last() for c in ARRIVAL_COLUMNS if c in parsed.columns]
    return latest_per_key(parsed, "payment_id", order).drop(*ARRIVAL_COLUMNS)

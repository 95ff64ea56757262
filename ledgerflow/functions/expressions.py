"""Column builders: payload parsing, classification, keys and predicates.

Everything here returns a ``pyspark.sql.Column`` built from JVM-side
functions, so it stays inside whole-stage codegen; nothing needs a Python
worker.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.schemas import PAYMENT_FIELDS, TRANSACTION_FIELDS

# Text pattern for timestamps inside surrogate keys and JSON
# payloads (microsecond precision, engine independent).
KEY_TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"
JSON_TIMESTAMP_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Placeholder for NULL key parts, key separator, lower bound of an
# empty target's high-water mark.
NULL_KEY_TEXT = "__null__"
KEY_SEPARATOR = "|"
EMPTY_HIGH_WATER = dt.datetime(1900, 1, 1)

# Business domains.
STATUS_APPROVED = "APPROVED"
PAYMENT_SETTLED = "SETTLED"
GEO_INTERNATIONAL = "INTERNATIONAL"
GEO_DOMESTIC = "DOMESTIC"
TIER_HIGH, TIER_MEDIUM, TIER_LOW = "HIGH", "MEDIUM", "LOW"
DECLINE_FRAUD = "FRAUD_SUSPECTED"
DECLINE_CREDIT_LIMIT = "CREDIT_LIMIT"
PAYMENT_TYPES = ("ACH", "WIRE", "BILLPAY")
# HIGH-tier threshold of the batch lane and of the model lane,
# MEDIUM threshold, high-risk amount.
BATCH_HIGH_TIER = 1000
MODEL_HIGH_TIER = 500
MEDIUM_TIER = 100
HIGH_RISK_AMOUNT = 500


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --------------------------------------------------------------------------
# JSON payload parsing
# --------------------------------------------------------------------------

def safe_parse_json(col: Column | str) -> Column:
    """Invalid JSON text -> NULL variant instead of an error."""
    return F.try_parse_json(_c(col))


def _extract(variant: Column, fields: list[tuple[str, T.DataType]],
             strict: bool) -> list[Column]:
    get = F.variant_get if strict else F.try_variant_get
    return [get(variant, f"$.{name}", dtype.simpleString()).alias(name)
            for name, dtype in fields]


_CORRUPT = "_corrupt_record"


def fast_parsed(col: Column | str, fields: list[tuple[str, T.DataType]]) -> Column:
    """``from_json`` of the payload into a fixed struct plus a corrupt-record text.

    Rows whose JSON or any field does not fit the schema come back with
    ``_corrupt_record`` set; ``slow_document`` re-reads only those rows. What the
    reader would take but VARIANT rejects (single quotes, NaN) is switched off.
    Timestamps have no pattern: the reader then takes the texts that a cast takes
    (but for a time zone), at a fraction of a pattern's cost.
    """
    schema = T.StructType([T.StructField(n, t) for n, t in fields]
                          + [T.StructField(_CORRUPT, T.StringType())])
    return F.from_json(_c(col), schema, {"mode": "PERMISSIVE",
                                         "columnNameOfCorruptRecord": _CORRUPT,
                                         "allowSingleQuotes": "false",
                                         "allowNonNumericNumbers": "false"})


def fits_fast_path(struct_col: Column | str, text_col: Column | str, keys_col: Column | str) -> Column:
    """Whether the fast struct holds what reading with VARIANT would give.

    Not so for rows it rejected, nor for duplicate keys (malformed for VARIANT):
    the outer keys (``json_object_keys`` of the text) are compared, and a nested
    object takes the slow path.
    """
    st, text, keys = _c(struct_col), _c(text_col), _c(keys_col)
    repeated = F.size(F.array_distinct(keys)) != F.size(keys)
    nested = F.locate("{", text, 2) > 0
    return st.isNull() | (st[_CORRUPT].isNull() & ~F.coalesce(repeated | nested, F.lit(False)))


def slow_document(fits_col: Column | str, text_col: Column | str) -> Column:
    """VARIANT of the rows that the fast path does not cover, NULL for others: one parse a row."""
    return F.when(~_c(fits_col), F.try_parse_json(_c(text_col)))


def lenient_fields(struct_col: Column | str, fits_col: Column | str, variant_col: Column | str,
                   fields: list[tuple[str, T.DataType]]) -> list[Column]:
    """Fields from the fast struct, or per field from the VARIANT where it does not
    fit (a mistyped field is NULL, strings cast to the target type)."""
    st = _c(struct_col)
    return [F.when(_c(fits_col), st[name])
            .otherwise(F.try_variant_get(_c(variant_col), f"$.{name}", dtype.simpleString())).alias(name)
            for name, dtype in fields]


def parsed_fields(df: DataFrame, text_col: str, fields: list[tuple[str, T.DataType]],
                  extra: list[str]) -> DataFrame:
    """``fields`` of the JSON in ``text_col`` beside the ``extra`` columns. Each step is a
    projection of its own, so no parse is repeated, per field or per use of the keys."""
    v = df.select(fast_parsed(text_col, fields).alias("_s"), F.json_object_keys(text_col).alias("_keys"), text_col, *extra)
    v = v.select("_s", fits_fast_path("_s", text_col, "_keys").alias("_fits"), text_col, *extra)
    v = v.select("_s", "_fits", slow_document("_fits", text_col).alias("_v"), *extra)
    return v.select(*lenient_fields("_s", "_fits", "_v", fields), *extra)


def parse_transaction(col: Column | str, strict: bool = False) -> list[Column]:
    """14 typed transaction fields from a JSON payload (B1/L1).

    With ``strict=False`` a mistyped field becomes NULL; ``strict=True`` raises
    on a value that cannot be cast (the warehouse's ``::TYPE`` behaviour).
    Unparseable text yields all-NULL fields.
    """
    return _extract(safe_parse_json(col), TRANSACTION_FIELDS, strict)


def parse_payment(col: Column | str, strict: bool = False) -> list[Column]:
    """10 typed payment fields from a JSON payload (B2/L2)."""
    return _extract(safe_parse_json(col), PAYMENT_FIELDS, strict)


def to_json_payload(cols: list[Column | str]) -> Column:
    """Serialise columns to a JSON object; NTZ timestamps keep microseconds."""
    return F.to_json(F.struct(*[_c(c) for c in cols]),
                     {"timestampNTZFormat": JSON_TIMESTAMP_PATTERN,
                      "timestampFormat": JSON_TIMESTAMP_PATTERN})


# --------------------------------------------------------------------------
# Classification
# --------------------------------------------------------------------------

def normalize_status(col: Column | str = "transaction_status") -> Column:
    """upper(trim(status))."""
    return F.upper(F.trim(_c(col)))


def amount_tier(col: Column | str = "amount", high: float = MODEL_HIGH_TIER,
                medium: float = MEDIUM_TIER) -> Column:
    """HIGH / MEDIUM / LOW; NULL amounts fall to LOW."""
    a = _c(col)
    return (F.when(a >= F.lit(high), TIER_HIGH)
            .when(a >= F.lit(medium), TIER_MEDIUM)
            .otherwise(TIER_LOW))


def geo_type(col: Column | str = "is_international") -> Column:
    """TRUE -> INTERNATIONAL; FALSE or NULL -> DOMESTIC."""
    return F.when(_c(col) == F.lit(True), GEO_INTERNATIONAL).otherwise(GEO_DOMESTIC)


def is_high_risk(amount: Column | str = "amount",
                 international: Column | str = "is_international",
                 threshold: float = HIGH_RISK_AMOUNT) -> Column:
    """amount > threshold AND international, three-valued."""
    return (_c(amount) > F.lit(threshold)) & (_c(international) == F.lit(True))


def is_approved(col: Column | str = "transaction_status") -> Column:
    """Exact match on APPROVED; anything else, NULL included, is FALSE."""
    return F.when(_c(col) == F.lit(STATUS_APPROVED), True).otherwise(False)


def event_date(col: Column | str = "posted_at") -> Column:
    return F.to_date(_c(col))


def event_month(col: Column | str = "posted_at") -> Column:
    """First instant of the month as TIMESTAMP_NTZ."""
    return F.date_trunc("month", _c(col)).cast(T.TimestampNTZType())


def event_hour(col: Column | str = "posted_at") -> Column:
    return F.hour(_c(col))


# --------------------------------------------------------------------------
# Keys and predicates
# --------------------------------------------------------------------------

def key_text(col: Column | str, dtype: T.DataType) -> Column:
    """Engine-independent text of one key part; NULL -> '__null__'."""
    c = _c(col)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        txt = F.date_format(c, KEY_TIMESTAMP_PATTERN)
    elif isinstance(dtype, T.DateType):
        txt = F.date_format(c, "yyyy-MM-dd")
    else:
        txt = c.cast("string")
    return F.coalesce(txt, F.lit(NULL_KEY_TEXT))


def surrogate_key(df: DataFrame, fields: list[str]) -> Column:
    """md5 of the '|'-joined key texts of ``fields``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.md5(F.concat_ws(KEY_SEPARATOR,
                             *[key_text(F.col(f), types[f]) for f in fields]))


def lookback_bound(high_water: dt.datetime | None, lookback_hours: float) -> dt.datetime:
    """coalesce(high-water mark, 1900-01-01) - lookback."""
    base = high_water if high_water is not None else EMPTY_HIGH_WATER
    return base - dt.timedelta(hours=lookback_hours)


def incremental_predicate(ts_col: Column | str, high_water: dt.datetime | None,
                          lookback_hours: float = 6) -> Column:
    """``ts >= coalesce(max(ts in target), 1900-01-01) - lookback`` (L3).

    The bound is a literal, so the predicate reaches the file scan (and, on a
    date-partitioned input, prunes partitions). NULL timestamps never pass.
    """
    bound = lookback_bound(high_water, lookback_hours)
    return _c(ts_col) >= F.lit(bound).cast(T.TimestampNTZType())


def load_window(loaded_at: Column | str, as_of: dt.datetime, days: int = 7) -> Column:
    """Rolling load window ``loaded_at >= as_of - days``."""
    return _c(loaded_at) >= F.lit(as_of - dt.timedelta(days=days)).cast(T.TimestampNTZType())


def half_open_window(ts_col: Column | str, start: dt.datetime, end: dt.datetime) -> Column:
    """``start <= ts < end``."""
    c = _c(ts_col)
    return ((c >= F.lit(start).cast(T.TimestampNTZType()))
            & (c < F.lit(end).cast(T.TimestampNTZType())))


def hour_floor(ts: dt.datetime) -> dt.datetime:
    return ts.replace(minute=0, second=0, microsecond=0)


def as_of_literal(as_of: dt.datetime) -> Column:
    """Run timestamp as one literal per run (never the wall clock)."""
    return F.lit(as_of).cast(T.TimestampNTZType())

"""Edge cases of FIXTURES.md §4 on small hand-made payloads."""

import datetime as dt
import hashlib
import json

import re

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions import expressions as X
from ledgerflow.operators.daily import daily_fact
from ledgerflow.operators.events import credit_card_events
from ledgerflow.operators.staging import stg_payments, stg_transactions
from ledgerflow.operators.transform import transform_transactions
from ledgerflow.schemas import RAW_SCHEMA, TRANSACTION_SCHEMA

AS_OF = dt.datetime(2024, 1, 31)
T0 = dt.datetime(2024, 1, 5, 10, 0, 0)


def tx(**kw):
    base = {"transaction_id": "T1", "card_id": "C1", "member_id": "M1", "amount": 50.0,
            "transaction_status": "APPROVED", "posted_at": "2024-01-05T10:00:00",
            "authorized_at": "2024-01-05T09:58:00", "is_international": False,
            "merchant_name": "M", "merchant_category_code": "5000"}
    base.update(kw)
    return base


def pay(**kw):
    base = {"payment_id": "P1", "member_id": "M1", "payment_type": "ACH", "amount": 50.0,
            "payment_status": "SETTLED", "scheduled_date": "2024-01-05",
            "settled_at": "2024-01-07T10:00:00"}
    base.update(kw)
    return base


def raw(spark, records, loaded_at=T0):
    rows = []
    for i, r in enumerate(records):
        text = r if isinstance(r, str) else json.dumps(r)
        rows.append((text, loaded_at + dt.timedelta(minutes=i), "f.json", i))
    return spark.createDataFrame(rows, RAW_SCHEMA)


def typed(spark, records):
    """Typed rows for the batch lane (as the fixed-schema JSON reader yields)."""
    return spark.read.schema(TRANSACTION_SCHEMA).json(
        spark.sparkContext.parallelize([json.dumps(r) for r in records]))


def stg(spark, records):
    return stg_transactions(raw(spark, records), AS_OF, None)


def test_null_authorized_wins_in_staging_loses_in_batch_lane(spark):
    recs = [tx(authorized_at="2024-01-05T09:00:00", transaction_status="DATED"),
            tx(authorized_at=None, transaction_status="UNDATED")]
    assert [r.transaction_status for r in stg(spark, recs).collect()] == ["UNDATED"]
    out = transform_transactions(typed(spark, recs), AS_OF).collect()
    assert [r.transaction_status for r in out] == ["DATED"]


def test_newest_version_without_card_drops_in_batch_lane_only(spark):
    recs = [tx(authorized_at="2024-01-05T09:00:00"),
            tx(authorized_at="2024-01-05T09:30:00", card_id=None)]
    assert transform_transactions(typed(spark, recs), AS_OF).count() == 0
    assert stg(spark, recs).count() == 1


def test_unparseable_payload_is_all_null_and_filtered(spark):
    df = raw(spark, ["{bad", tx()])
    parsed = stg_transactions(df, AS_OF, None)
    assert parsed.count() == 1
    from ledgerflow.operators.staging import parse_raw
    from ledgerflow.schemas import TRANSACTION_FIELDS
    rows = parse_raw(df, TRANSACTION_FIELDS, None, None).collect()
    bad = [r for r in rows if r.transaction_id is None]
    assert len(bad) == 1 and all(bad[0][f] is None for f, _ in TRANSACTION_FIELDS)


def test_amount_text_lenient_and_strict(spark):
    df = raw(spark, [tx(amount="abc"), tx(transaction_id="T2", amount="12.5")])
    got = {r.transaction_id: r.amount
           for r in df.select(*X.parse_transaction("raw_payload")).collect()}
    assert got == {"T1": None, "T2": 12.5}
    with pytest.raises(Exception):
        df.select(*X.parse_transaction("raw_payload", strict=True)).collect()


def test_tiers_geo_risk(spark):
    df = spark.createDataFrame(
        [(None, None), (100.0, None), (500.0, True), (1000.0, False), (600.0, None),
         (99.99, True)], "amount double, intl boolean")
    rows = df.select(
        X.amount_tier("amount").alias("model"),
        X.amount_tier("amount", high=X.BATCH_HIGH_TIER).alias("batch"),
        X.geo_type("intl").alias("geo"),
        X.is_high_risk("amount", "intl").alias("risk")).collect()
    assert [r.model for r in rows] == ["LOW", "MEDIUM", "HIGH", "HIGH", "HIGH", "LOW"]
    assert [r.batch for r in rows] == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "MEDIUM", "LOW"]
    assert [r.geo for r in rows] == ["DOMESTIC", "DOMESTIC", "INTERNATIONAL", "DOMESTIC",
                                     "DOMESTIC", "INTERNATIONAL"]
    assert [r.risk for r in rows] == [None, False, False, False, None, False]


def test_status_normalise_and_exact_approval(spark):
    df = spark.createDataFrame([(" approved ",), ("APPROVED",), (None,)], "s string")
    rows = df.select(X.is_approved("s").alias("raw"),
                     X.is_approved(X.normalize_status("s")).alias("norm")).collect()
    assert [r.raw for r in rows] == [False, True, False]
    assert [r.norm for r in rows] == [True, True, False]


def test_two_payments_one_transaction_and_null_amount(spark):
    st = stg(spark, [tx(), tx(transaction_id="T2", amount=None)])
    sp = stg_payments(raw(spark, [pay(), pay(payment_id="P2"),
                                  pay(payment_id="P3", payment_status="PENDING"),
                                  pay(payment_id="P4", amount=None)]), AS_OF, None)
    ev = credit_card_events(st, sp, AS_OF).collect()
    t1 = [r for r in ev if r.transaction_id == "T1"]
    assert sorted(r.payment_id for r in t1) == ["P1", "P2"]
    assert len({r.event_key for r in t1}) == 1
    t2 = [r for r in ev if r.transaction_id == "T2"]
    assert len(t2) == 1 and t2[0].payment_id is None and t2[0].amount_tier == "LOW"


def test_null_card_two_members_same_day_share_daily_key(spark):
    st = stg(spark, [tx(card_id=None, member_id="M1"),
                     tx(transaction_id="T2", card_id=None, member_id="M2")])
    sp = stg_payments(raw(spark, [pay(payment_id="PX", member_id="M9")]), AS_OF, None)
    fact = daily_fact(credit_card_events(st, sp, AS_OF), AS_OF).collect()
    assert len(fact) == 2 and len({r.daily_key for r in fact}) == 1


def test_day_without_approvals(spark):
    st = stg(spark, [tx(transaction_status="DECLINED", decline_reason="FRAUD_SUSPECTED")])
    sp = stg_payments(raw(spark, [pay(member_id="M9")]), AS_OF, None)
    r = daily_fact(credit_card_events(st, sp, AS_OF), AS_OF).collect()[0]
    assert r.total_spend == 0 and r.avg_transaction_amount is None
    assert r.max_transaction_amount is None and r.approval_rate_pct == 0.0
    assert r.declined_transactions == 1 and r.fraud_declines == 1


def test_surrogate_key_text(spark):
    df = spark.createDataFrame([("T1", dt.datetime(2024, 1, 5, 10, 0, 0, 123456))],
                               "id string, ts timestamp_ntz")
    got = df.select(X.surrogate_key(df, ["id", "ts"]).alias("k")).first().k
    want = hashlib.md5(b"T1|2024-01-05 10:00:00.123456").hexdigest()
    assert got == want
    df2 = spark.createDataFrame([(None,)], "id string")
    assert df2.select(X.surrogate_key(df2, ["id"]).alias("k")).first().k == \
        hashlib.md5(b"__null__").hexdigest()


def test_window_edges_and_empty_target_bound(spark):
    from ledgerflow.sources.landing import extract_window
    start = dt.datetime(2024, 1, 5, 10, 0, 0)
    df = spark.createDataFrame([(start,), (start + dt.timedelta(hours=1),),
                                (start - dt.timedelta(microseconds=1),)], "ts timestamp_ntz")
    assert [r.ts for r in extract_window(df, "ts", start).collect()] == [start]
    assert X.lookback_bound(None, 6) == dt.datetime(1899, 12, 31, 18, 0)


def test_payment_subset_and_load_window(spark):
    from ledgerflow.sources.landing import payment_subset
    df = spark.createDataFrame([("ACH",), ("CARD",), ("WIRE",)], "payment_type string")
    assert payment_subset(df).count() == 2
    old = raw(spark, [tx()], loaded_at=AS_OF - dt.timedelta(days=8))
    assert stg_transactions(old, AS_OF, 7).count() == 0


def test_fast_parse_equals_variant_reading(spark):
    payloads = [
        json.dumps(tx()), json.dumps(tx(amount="12.5")), json.dumps(tx(amount="abc")),
        json.dumps(tx(is_international="true")), json.dumps(tx(posted_at="2024-01-05 10:00:00.123")),
        json.dumps(tx(posted_at="2024-01-05T10:00:00.5")), json.dumps(tx(card_id=123)),
        json.dumps({"transaction_id": "T9"}), "{bad", "[1, 2]", '"text"', "", "null",
        json.dumps(tx(amount=1e300)), json.dumps(tx(posted_at="not a time")), None,
        '{"transaction_id": "T1", "transaction_id": "T2"}', '{"transaction_id": "T1", "amount": NaN}',
        "{'transaction_id': 'T1'}", '{"transaction_id": "T1", "meta": {"a": 1, "a": 2}}',
        '{"transaction_id": "T1", "meta": {"a": 1}, "amount": "7"}',
    ]
    df = spark.createDataFrame([(p,) for p in payloads], "raw_payload string")
    fast = X.parsed_fields(df, "raw_payload", X.TRANSACTION_FIELDS, []).collect()
    slow = df.select(*X._extract(X.safe_parse_json("raw_payload"), X.TRANSACTION_FIELDS,
                                 False)).collect()
    assert fast == slow


def test_repeated_keys_in_any_spelling(spark):
    """Fast and VARIANT reading agree on repeated keys: escapes, spaces before colons, nulls, colons in text."""
    texts = ['{"amount":1,"amount":2}', '{"amount" :1,"amount":2}', '{"amount":1,"amount":null}', '{"amount":null,"member_id":"a","member_id":"b"}',
             '{"posted_at":"2024-01-01T10\\u003a00\\u003a00","amount":1,"amount":2,"amount":3}', '{"posted_at":"2024-01-01T10:00:00","amount":1,"amount":2}',
             '{"posted_at":"2024-01-01T10:00:00","amount":1}', '{"merchant_name":"a:b:c","amount":1}', '{"merchant_name":"::","x":1,"amount":1}',
             '{"x":1,"x":2,"amount":3}', '{"amount":1,"x":5}', '{}', '{"a":{"b":1,"b":2}}']
    df = spark.createDataFrame([(t,) for t in texts], "raw_payload string")
    fast = X.parsed_fields(df, "raw_payload", X.TRANSACTION_FIELDS, ["raw_payload"]).collect()
    slow = df.select(*X.parse_transaction("raw_payload"), "raw_payload").collect()
    assert sorted(map(repr, fast)) == sorted(map(repr, slow))


def test_payload_is_read_once_and_timestamps_as_a_cast_reads_them(spark):
    """The fast path takes the outer keys once and no timestamp pattern, and gives what VARIANT gives."""
    from ledgerflow.operators.staging import parse_raw
    from ledgerflow.schemas import TRANSACTION_FIELDS
    times = ["2024-01-05T09:00:00", "2024-01-05T09:00:00.1", "2024-01-05T09:00:00.123456", "2024-01-05T09:00:00.1234567", "2024-01-05 09:00:00",
             "2024-01-05T09:00:00Z", "2024-01-05T09:00:00+02:00", "2024-01-05", "2024-1-5", "2024", "09:00:00", " 2024-01-05T09:00:00 ", "", "x",
             "2024-02-30T09:00:00", "2024-01-05T24:00:00", "+12024-01-05", None, 5, True]
    df = raw(spark, [tx(transaction_id=f"T{i}", posted_at=t) for i, t in enumerate(times)])
    rows = parse_raw(df, TRANSACTION_FIELDS, None, None)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("json_object_keys|jsonObjectKeys", plan)) == 1 and "timestampNTZFormat" not in plan
    text = F.col("posted_at").cast("string")
    got = {r[0]: r[1] for r in rows.select("transaction_id", text).collect()}
    assert got == {r[0]: r[1] for r in df.select(*X.parse_transaction("raw_payload")).select("transaction_id", text).collect()}
    assert len({t for t in got.values() if t is not None}) > 4

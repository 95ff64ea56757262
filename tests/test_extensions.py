"""Reconciliation, currency conversion and member context against plain versions."""

import collections
import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import currency, members, reconciliation
from ledgerflow.operators.ranking import place_in_group

DAY = dt.date(2024, 1, 1)


def at(day, minute=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, minutes=minute)


# ---------------------------------------------------------------- places in a group

def test_places_in_groups(spark):
    r = random.Random(1)
    rows = [(r.choice(["hot"] * 30 + ["a", "b", None, "c"]), r.choice([1, 2, None]), r.choice([None, 1.5, 2.5]), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, h int, x double, id int").repartition(5)
    got = [tuple(x) for x in place_in_group(df, ["g", "h"], ["x", "id"], partitions=23).collect()]
    groups = collections.defaultdict(list)
    for x in rows:
        groups[x[:2]].append((x[2] is not None, x[2] or 0, x[3]))
    want = {(*g, t[2]): n for g, ts in groups.items() for n, t in enumerate(sorted(ts), 1)}
    assert {(x[0], x[1], x[3]): x[4] for x in got} == want and len(got) == len(rows)
    same = spark.createDataFrame([("a", 1)] * 500, "g string, x int").repartition(4)
    assert sorted(x["place"] for x in place_in_group(same, ["g"], ["x"], partitions=9).collect()) == list(range(1, 501))
    assert place_in_group(df.limit(0), ["g"], ["x"]).count() == 0


# ---------------------------------------------------------------- reconciliation

def plain_reconcile(txs, pays):
    keyed = collections.defaultdict(lambda: ([], []))
    out = []
    first = lambda t: (t[0] is not None, t[0] or dt.datetime.min, t[1])
    for i, m, a, w in txs:
        if None in (m, a, w):
            out.append((m, a, w and w.date(), None, i, w, None, None, "unpaid"))
        else:
            keyed[m, a, w.date()][0].append((w, i))
    for i, m, a, d, s, w in pays:
        if s != "SETTLED":
            continue
        if None in (m, a, d):
            out.append((m, a, d, None, None, None, i, w, "orphan"))
        else:
            keyed[m, a, d][1].append((w, i))
    for key, (t, p) in keyed.items():
        t, p = sorted(t, key=first), sorted(p, key=first)
        for n in range(max(len(t), len(p))):
            a, b = (t[n] if n < len(t) else None), (p[n] if n < len(p) else None)
            kind = "matched" if a and b else "unpaid" if a else "surplus" if t else "orphan"
            out.append((*key, n + 1, a and a[1], a and a[0], b and b[1], b and b[0], kind))
    return collections.Counter(out)


def make_sides(spark, seed=3, hot=0):
    r = random.Random(seed)
    member = lambda: r.choice(["M1", "M2", "M3", None])
    amount = lambda: r.choice([10.0, 20.0, 30.5, None])
    txs = [(f"T{i}", member(), amount(), r.choice([None, *(at(d, r.randrange(1000)) for d in range(4))])) for i in range(400)]
    pays = [(f"P{i}", member(), amount(), r.choice([None, *(DAY + dt.timedelta(days=d) for d in range(6))]), r.choice(["SETTLED", "SETTLED", "FAILED", None]),
             r.choice([None, at(5, i % 7)])) for i in range(400)]
    txs += [(f"HT{i}", "HOT", 5.0, at(1, i % 1400)) for i in range(hot)]
    pays += [(f"HP{i}", "HOT", 5.0, DAY + dt.timedelta(days=1), "SETTLED", at(3)) for i in range(hot + hot // 3)]
    t = spark.createDataFrame(txs, "transaction_id string, member_id string, amount double, posted_at timestamp_ntz").withColumn("place", F.lit("x"))
    p = spark.createDataFrame(pays, "payment_id string, member_id string, amount double, scheduled_date date, payment_status string, settled_at timestamp_ntz")
    return txs, pays, t, p.withColumn("owed", F.lit("x"))


@pytest.mark.parametrize("hot_rows", [10**6, 40, 0])
def test_reconcile(spark, hot_rows):
    """Equal with keys treated as hot or not; every row of both inputs is in one row of the result."""
    txs, pays, t, p = make_sides(spark, hot=300)
    rows = [tuple(r) for r in reconciliation.reconcile(t, p, hot_rows).collect()]
    assert collections.Counter(rows) == plain_reconcile(txs, pays)
    assert sorted(r[4] for r in rows if r[4]) == sorted(x[0] for x in txs)
    assert sorted(r[6] for r in rows if r[6]) == sorted(x[0] for x in pays if x[4] == "SETTLED")
    assert {r[8] for r in rows} == {"matched", "unpaid", "surplus", "orphan"}


def test_reconcile_empty(spark):
    _, _, t, p = make_sides(spark)
    assert reconciliation.reconcile(t.limit(0), p.limit(0)).count() == 0
    assert {r.match_class for r in reconciliation.reconcile(t, p.limit(0)).collect()} == {"unpaid"}
    assert {r.match_class for r in reconciliation.reconcile(t.limit(0), p).collect()} == {"orphan"}


def test_reconcile_shuffles_the_sides_once(spark):
    """One exchange by key for ranks, counts and pairs; none for rows that cannot match."""
    _, _, t, p = make_sides(spark)
    plan = reconciliation.reconcile(t, p)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_totals_add_up(spark):
    txs, pays, t, p = make_sides(spark, hot=50)
    rows = reconciliation.reconciliation_totals(reconciliation.reconcile(t, p)).collect()
    assert sum(r.transactions for r in rows) == len(txs) and sum(r.payments for r in rows) == sum(x[4] == "SETTLED" for x in pays)
    assert all(r.transactions == r.payments == r.pairs for r in rows if r.match_class == "matched")


# ---------------------------------------------------------------- currency

def plain_convert(txs, rates, max_age):
    best = {}
    for c, d, x, w in rates:
        if c and d and x is not None and 0 < x < math.inf:
            best[c, d] = max(best.get((c, d), ((False,),)), ((w is not None, w or dt.datetime.min, x),))
    out = {}
    for i, c, a, d in txs:
        known = [k for k in best if k[0] == c and d and k[1] <= d]
        day = max((k[1] for k in known), default=None)
        rate = best[c, day][0][2] if day else None
        status = ("no_currency" if c is None else "base" if c == "USD" else "no_date" if d is None else "missing" if rate is None
                  else "stale" if max_age is not None and (d - day).days > max_age else "exact" if day == d else "carried")
        used = 1.0 if status == "base" else rate if status in ("exact", "carried") else None
        out[i] = (used, day if status in ("exact", "carried", "stale") else None, status, a * used if a is not None and used is not None else None)
    return out


@pytest.mark.parametrize("max_age", [None, 0, 2])
def test_conversion(spark, max_age):
    r = random.Random(5)
    days = [DAY + dt.timedelta(days=i) for i in range(12)]
    rates = [(r.choice(["EUR", "JPY", "USD", None, "GBP"]), r.choice([None, *days[2::3]]), r.choice([None, -1.0, 0.0, 1.1, 1.2, 0.9, math.inf, math.nan]),
              r.choice([None, at(1), at(2)])) for _ in range(120)]
    txs = [(f"T{i}", r.choice(["EUR", "JPY", "USD", "GBP", "usd", "XXX", None]), r.choice([None, 10.0, -3.5]), r.choice([None, *days])) for i in range(600)]
    t = spark.createDataFrame(txs, "transaction_id string, currency_code string, amount double, event_date date").withColumns({"rate": F.lit("x"), "day": F.lit("x")})
    x = spark.createDataFrame(rates, "currency_code string, rate_date date, rate double, published_at timestamp_ntz")
    out = currency.to_base_currency(t, x, max_age_days=max_age)
    assert out.columns == t.columns + currency.CONVERTED_COLUMNS
    got = {q.transaction_id: (q.fx_rate, q.fx_rate_date, q.fx_rate_status, q.amount_base) for q in out.collect()}
    assert got == plain_convert(txs, rates, max_age)
    assert {q[2] for q in got.values()} >= {"no_currency", "base", "no_date", "missing", "exact"}
    assert currency.to_base_currency(t.limit(0), x).count() == 0
    assert {q.fx_rate_status for q in currency.to_base_currency(t, x.limit(0)).collect()} == {"no_currency", "base", "no_date", "missing"}


# ---------------------------------------------------------------- members

@pytest.mark.parametrize("bucket_days", [1, 4, 32])
def test_member_versions(spark, bucket_days):
    r = random.Random(7)
    days = [DAY + dt.timedelta(days=i) for i in range(-5, 25)]
    versions = [(r.choice(["M1", "M2", "M3", None]), r.randrange(20), r.choice([None, *days]), r.choice([None, *days]), r.choice(["a", "b"])) for _ in range(60)]
    versions += versions[:10] + [("M4", 1, days[3], days[6], "old"), ("M5", 1, days[9], days[9], "never")]
    events = [(f"T{i}", r.choice(["M1", "M2", "M4", "M5", "M9", None]), r.choice([None, *days])) for i in range(500)]
    e = spark.createDataFrame(events, "transaction_id string, member_id string, event_date date").withColumns({"day": F.lit("x"), "valid_from": F.lit("x")})
    v = spark.createDataFrame(versions, "member_id string, version_id int, valid_from date, valid_to date, tier string")
    out = members.with_member_context(e, v, ["tier"], bucket_days=bucket_days)
    assert out.columns == e.columns + ["member_version", "member_tier", "member_status"]

    def plain(m, d):
        if m is None or d is None:
            return None, None, "no_member" if m is None else "no_date"
        mine = [x for x in versions if x[0] == m]
        live = [((x[2] is not None, x[2] or dt.date.min), x[1], x[4]) for x in mine if (x[2] is None or x[2] <= d) and (x[3] is None or d < x[3])]
        return (*max(live)[1:], "known") if live else (None, None, "gap" if mine else "unknown")

    got = {q.transaction_id: (q.member_version, q.member_tier, q.member_status) for q in out.collect()}
    assert got == {i: plain(m, d) for i, m, d in events}
    assert {q[2] for q in got.values()} == {"known", "gap", "unknown", "no_member", "no_date"}
    assert members.with_member_context(e.limit(0), v, ["tier"]).count() == 0
    assert {q.member_status for q in members.with_member_context(e, v.limit(0), ["tier"]).collect()} == {"unknown", "no_member", "no_date"}


def test_no_python_and_no_cross_join(spark):
    _, _, t, p = make_sides(spark)
    x = spark.createDataFrame([("EUR", DAY, 1.0, at(0))], "currency_code string, rate_date date, rate double, published_at timestamp_ntz")
    v = spark.createDataFrame([("M1", 1, DAY, None, "a")], "member_id string, version_id int, valid_from date, valid_to date, tier string")
    e = t.withColumns({"event_date": F.to_date("posted_at"), "currency_code": F.lit("EUR")})
    for df in (reconciliation.reconcile(t, p, 0), currency.to_base_currency(e, x), members.with_member_context(e, v, ["tier"])):
        plan = df._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"))

"""Benchmark the headline stages on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line:
  {"metric": "chain_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each stage is executed to completion with the ``noop`` sink (full plan, no
driver collect); stages that write tables do so under a fresh folder of the
session's shared checkpoint directory. Timings are the median of
$BENCH_REPEAT runs (default 3) after one warm-up run of the cheapest stage.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))
# Stages that land, load and merge several times within one run are timed once.
WHOLE_RUNS = {"incremental_merge", "idempotent_reload", "stream_merge"}


def _sf(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def main() -> None:
    from ledgerflow.session import build_session
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    spark = build_session("ledgerflow-bench", master=f"local[{CPUS}]",
                          shuffle_partitions=int(CPUS) * 2, extra=extra)
    if not spark.conf.get("spark.checkpoint.dir", None):   # local bench
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerflow-bench-"))

    from ledgerflow.plans import registry as R
    from ledgerflow.plans import incremental as INC
    from ledgerflow.session import scratch_path

    def run_query(name):
        def go():
            R.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return go

    from pyspark.sql import functions as F
    from ledgerflow.operators import transform as TR

    # Raw feeds stored once as load-day partitioned tables (what the loader
    # maintains); full refresh and incremental runs both read them.
    raw_root = scratch_path(spark, "bench_raw")
    raw_tx = R.fx.materialize_raw(R.fx.raw_transactions(spark, SF_DIR), f"{raw_root}/tx")
    raw_pay = R.fx.materialize_raw(R.fx.raw_payments(spark, SF_DIR), f"{raw_root}/pay")

    def until(df, t):
        return df.where(F.col("loaded_at") <= F.lit(t).cast("timestamp_ntz"))

    def full_chain():
        root = scratch_path(spark, "bench_chain")
        INC.run_chain_from_raw(spark, raw_tx, raw_pay, f"{root}/events", f"{root}/daily",
                               R.AS_OF, mode="full")

    # Hourly incremental run vs full refresh: the target holds everything that
    # arrived up to one hour before the last arrival; the timed run adds the
    # last hour (arrival look-back, relink, key merge, whole-day fact rebuild).
    last = raw_tx.agg(F.max("loaded_at")).first()[0]
    hour_before = last - __import__("datetime").timedelta(hours=1)
    work = {}

    def incremental_hour():
        root = scratch_path(spark, "bench_incr")
        INC.run_chain_from_raw(spark, until(raw_tx, hour_before), until(raw_pay, hour_before),
                               f"{root}/events", f"{root}/daily", hour_before, mode="full")
        t0 = time.perf_counter()
        touched = INC.run_events_from_raw(spark, raw_tx, raw_pay, f"{root}/events", R.AS_OF)
        INC.run_daily(spark, f"{root}/events", f"{root}/daily", R.AS_OF, touched_days=touched)
        elapsed = time.perf_counter() - t0
        ev = spark.read.parquet(f"{root}/events")
        work["events_partitions_rewritten"] = len(touched) if touched != INC.ALL_DAYS else -1
        work["events_partitions_total"] = ev.select("event_date").distinct().count()
        work["events_rows_rewritten"] = ev.where(F.col("_dbt_updated_at") == F.lit(R.AS_OF)
                                                 .cast("timestamp_ntz")).count()
        work["events_rows_total"] = ev.count()
        return elapsed

    # One-day read on the clustered (date-partitioned, sorted) events table vs
    # the same rows written unpartitioned in hash order.
    ev_root = scratch_path(spark, "bench_read")
    events = R.int_events(spark, SF_DIR)
    TR.write_partitioned(events, f"{ev_root}/clustered", ["event_date"],
                         cluster_cols=["event_date", "transaction_type"])
    events.repartition(int(CPUS) * 2, "event_key").write.parquet(f"{ev_root}/unclustered")
    one_day = events.agg(F.max("event_date")).first()[0]

    def day_read(kind):
        def go():
            (spark.read.parquet(f"{ev_root}/{kind}").where(F.col("event_date") == one_day)
                  .groupBy("transaction_type").agg(F.sum("amount"), F.count(F.lit(1)))
                  .write.format("noop").mode("overwrite").save())
        return go

    # Skew: one member and one card carry a third of all transactions and
    # payments (derived from the same tables), through the link and the fact.
    from ledgerflow.operators.daily import daily_fact
    from ledgerflow.operators.events import credit_card_events

    def skewed_link_fact():
        st, sp = R.staged(spark, SF_DIR, None)
        hot = F.abs(F.xxhash64("transaction_id")) % 3 == 0
        st = (st.withColumn("member_id", F.when(hot, F.lit("M_HOT")).otherwise(F.col("member_id")))
                .withColumn("card_id", F.when(hot, F.lit("C_HOT")).otherwise(F.col("card_id"))))
        sp = sp.withColumn("member_id", F.when(F.abs(F.xxhash64("payment_id")) % 3 == 0,
                                               F.lit("M_HOT")).otherwise(F.col("member_id")))
        (daily_fact(credit_card_events(st, sp, R.AS_OF), R.AS_OF)
         .write.format("noop").mode("overwrite").save())

    stages = {
        "parse": run_query("raw_transactions_parse"),
        "staging_dedupe": run_query("stg_transactions"),
        "events_join": run_query("int_events"),
        "daily_fact": run_query("fct_daily"),
        "full_chain": full_chain,
        "incremental_merge": run_query("incremental_daily"),
        "idempotent_reload": run_query("load_idempotent"),
        "batch_lane": run_query("batch_transform"),
        "stream_merge": run_query("stream_merge"),
        "skewed_link_fact": skewed_link_fact,
        "one_day_read_clustered": day_read("clustered"),
        "one_day_read_unclustered": day_read("unclustered"),
    }
    run_query("raw_transactions_parse")()          # warm-up (JIT, file cache)
    results = {}
    for name, fn in stages.items():
        times = []
        for _ in range(1 if name in WHOLE_RUNS else REPEAT):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
    results["incremental_hour"] = round(statistics.median(
        [incremental_hour() for _ in range(REPEAT)]), 3)
    total = round(sum(v for k, v in results.items()
                      if not k.startswith("one_day_read")), 3)
    ratios = {
        "incremental_over_full_refresh": round(results["incremental_hour"]
                                               / results["full_chain"], 3),
        "clustered_over_unclustered_day_read": round(results["one_day_read_clustered"]
                                                     / results["one_day_read_unclustered"], 3),
        "incremental_rows_over_full_rows": round(work["events_rows_rewritten"]
                                                 / max(work["events_rows_total"], 1), 3),
        "incremental_partitions_over_all": round(work["events_partitions_rewritten"]
                                                 / max(work["events_partitions_total"], 1), 3),
    }
    print(json.dumps({"metric": "stage_seconds_total", "value": total, "unit": "sec",
                      "queries": results, "ratios": ratios, "sf": _sf(SF_DIR),
                      "cpus": int(CPUS), "repeat": REPEAT}))
    spark.stop()


if __name__ == "__main__":
    main()

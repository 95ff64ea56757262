"""What the streams' sinks and the landing do at size: files, tasks, memory."""

import datetime as dt
import glob
import json
import os

from pyspark.sql import functions as F

from ledgerflow.operators.merge import EVENTS_LAYOUT, merge_by_key, write_full
from ledgerflow.plans import incremental as INC
from ledgerflow.schemas import EVENT_SCHEMA, PAYMENT_ROUTING, TRANSACTION_ROUTING
from ledgerflow.session import local_path
from ledgerflow.sources import json_files as J
from ledgerflow.sources import landing as L
from ledgerflow.streaming import streams as ST

AS_OF = dt.datetime(2024, 1, 31)


def _files(spark, texts):
    rows = [(t, f"f{i}.json", dt.datetime(2024, 1, 9, 0, i)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "text string, source_file string, file_mtime timestamp").repartition(4)


def _hours(spark, n, hours=(10, 11)):
    ts = F.element_at(F.array(*[F.lit(dt.datetime(2024, 1, 5, h)) for h in hours], F.lit(None)), (F.col("id") % (len(hours) + 1)).cast("int") + 1)
    return spark.range(n, numPartitions=3).select(F.concat(F.lit("T"), F.col("id")).alias("transaction_id"), ts.cast("timestamp_ntz").alias("at"))


def test_landing_writes_plain_files(spark, tmp_root):
    got = [L.land(_hours(spark, 60), tmp_root, "t", ["transaction_id"], "at", batch_size=7) for _ in range(2)]
    out = local_path(spark, got[0].prefix)
    names = [n for d, _, files in os.walk(out) for n in (os.path.join(d, f) for f in files)]
    parts = [n for n in names if os.path.basename(n).startswith("part-")]
    assert set(names) - set(parts) == {f"{out}/_SUCCESS"}     # no checksums, nothing of the tasks' folders
    assert not [d for d in glob.glob(f"{out}/*") if os.path.basename(d).startswith("_staging")]
    assert len(parts) == sum(r.files_written for r in got)
    assert sum(r.records_extracted for r in got) == 120
    per_hour = {}
    for n in parts:
        records = json.load(open(n))
        assert len(records) <= 7
        per_hour.setdefault(os.path.dirname(n)[len(out) + 1:], []).extend(r["transaction_id"] for r in records)
    day = "year=2024/month=01/day=05"
    null = "/".join(f"{c}=__HIVE_DEFAULT_PARTITION__" for c in L.PARTITION_COLUMNS)
    want = {h: sorted(2 * [f"T{i}" for i in range(k, 60, 3)]) for k, h in enumerate((f"{day}/hour=10", f"{day}/hour=11", null))}
    assert {h: sorted(x) for h, x in per_hour.items()} == want


def test_landing_through_spark_writes_the_same(spark, tmp_root, monkeypatch):
    rows = _hours(spark, 30)
    one = L.land(rows, tmp_root, "a", ["transaction_id"], "at", batch_size=4)
    monkeypatch.setattr(L, "local_path", lambda spark, path: None)
    two = L.land(rows, tmp_root, "b", ["transaction_id"], "at", batch_size=4)
    read = lambda r: sorted((os.path.dirname(n)[len(r.prefix.removeprefix("file:")) + 1:], open(n).read())
                            for n in glob.glob(f"{local_path(spark, r.prefix)}/*/*/*/*/part-*"))
    assert [x[1] for x in read(one)] == [x[1] for x in read(two)]
    assert (one.records_extracted, one.files_written) == (two.records_extracted, two.files_written) == (30, len(read(one)))


def test_small_files_share_tasks(spark, tmp_root):
    prefix = L.land(_hours(spark, 200), tmp_root, "t", ["transaction_id"], "at", batch_size=1).prefix
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")      # a task a file, as the scan counts them
    try:
        rows = J.read_array_payloads(spark, prefix)
        assert rows.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
        assert rows.count() == 200
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_an_epoch_has_a_file_a_day(spark, tmp_root):
    texts = [json.dumps([{"transaction_id": f"T{f}{d}", "posted_at": f"2024-01-0{d}T10:00:00"} for d in range(1, 6)]) for f in range(8)]
    rows = ST.append_epoch(_files(spark, texts), 0, f"{tmp_root}/raw", TRANSACTION_ROUTING, lambda epoch: AS_OF)
    out = local_path(spark, f"{tmp_root}/raw/epoch=0")
    assert len(glob.glob(f"{out}/route_date=*/part-*")) == 5
    assert {(r.epoch, r.record_key) for r in rows.collect()} == {(0, f"T{f}{d}") for f in range(8) for d in range(1, 6)}
    assert rows.count() == 40


def test_payments_relink_what_they_link(spark, tmp_root):
    tx = [("T1", "M1", 10.0), ("T2", "M1", 20.0), ("T3", "M1", 30.0), ("T4", "M2", 10.0), ("T5", "M1", None)]
    day = dt.date(2024, 1, 5)
    rows = [{f.name: None for f in EVENT_SCHEMA} | {"transaction_id": t, "member_id": m, "amount": a, "event_date": day} for t, m, a in tx]
    write_full(spark.createDataFrame([tuple(r[f.name] for f in EVENT_SCHEMA) for r in rows], EVENT_SCHEMA), f"{tmp_root}/events", EVENTS_LAYOUT)
    pay = lambda amount, status: json.dumps({"payment_id": "P1", "member_id": "M1", "amount": amount, "payment_status": status, "scheduled_date": "2024-01-05"})
    for epoch, text in enumerate((pay(10.0, "SETTLED"), pay(20.0, "SETTLED"), pay(30.0, "FAILED"), pay(None, "SETTLED"))):
        ST.append_epoch(_files(spark, [text]), epoch, f"{tmp_root}/pay", PAYMENT_ROUTING, lambda epoch: AS_OF)
    changed = spark.createDataFrame([("P1",)], "record_key string")
    keys = lambda **kw: {r[0] for r in INC.relinked_transactions(spark, f"{tmp_root}/events", ST.read_epochs(spark, f"{tmp_root}/pay"), changed, AS_OF, **kw).collect()}
    assert keys(by_amount=True) == {"T1", "T2"}     # of an older settled version and of the newer one
    assert keys() == {"T1", "T2", "T3", "T5"}


def test_a_merge_reads_its_rows_once(spark, tmp_root):
    schema = "event_date date, transaction_id string"
    day = lambda n: dt.date(2024, 1, n)
    write_full(spark.createDataFrame([(day(1), "a"), (day(2), "b"), (None, "c"), (day(3), "d")], schema), f"{tmp_root}/t", EVENTS_LAYOUT.partition_col)
    seen = spark.sparkContext.accumulator(0)
    batch = spark.createDataFrame([(day(2), "a"), (None, "x")], schema)
    counted = batch.mapInArrow(lambda it: (seen.add(b.num_rows) or b for b in it), schema)
    gone = spark.createDataFrame([("a",), ("c",)], "transaction_id string")
    merge_by_key(spark, f"{tmp_root}/t", counted, ["transaction_id"], "event_date", checkpoint=False,
                 partitions=[day(1), day(2), None], delete_keys=gone)
    rows = {(r.event_date, r.transaction_id) for r in spark.read.parquet(f"{tmp_root}/t").collect()}
    assert rows == {(day(2), "a"), (day(2), "b"), (None, "x"), (day(3), "d")}
    assert not os.path.exists(local_path(spark, f"{tmp_root}/t/event_date=2024-01-01"))
    assert seen.value == 2


def test_stream_state_is_kept_on_disk(spark, tmp_root):
    rows = _hours(spark, 50).select(F.col("transaction_id").alias("k"), F.lit(dt.datetime(2024, 1, 5)).cast("timestamp_ntz").alias("posted_at"))
    for _ in range(2):      # what comes again is dropped by the state of the run before
        rows.write.mode("append").parquet(f"{tmp_root}/in")
        before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", *ST.STATE_STORE)}
        s = ST.dedupe_first_arrival(spark.readStream.schema(rows.schema).parquet(f"{tmp_root}/in"), "k")
        ST.run_available(s.select("k").writeStream.format("parquet").option("checkpointLocation", f"{tmp_root}/c").option("path", f"{tmp_root}/out"), spark)
        assert {k: spark.conf.get(k, None) for k in before} == before
        assert spark.read.parquet(f"{tmp_root}/out").count() == 50
    state = f"{local_path(spark, tmp_root)}/c/state/0"
    assert len(glob.glob(f"{state}/*/*.zip")) > 0 and not glob.glob(f"{state}/*/*.delta")


def test_daily_states_join_their_feeds_once(spark, monkeypatch):
    from ledgerflow.plans import extension_queries as EQ
    from ledgerflow.plans.registry import settle_streams
    seen = spark.sparkContext.accumulator(0)

    def counted(*args):
        joined = settle_streams(*args)
        return joined.mapInArrow(lambda it: (seen.add(b.num_rows) or b for b in it), joined.schema)
    monkeypatch.setattr(EQ, "settle_streams", counted)
    out = EQ.q_stream_daily_states(spark, "/root/testdata/sf0.001")
    n = out.agg(F.sum("total_transactions")).first()[0]
    assert seen.value == n > 0

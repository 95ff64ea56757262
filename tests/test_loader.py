"""Landing, idempotent loading, commit ledger and reject accounting."""

import datetime as dt
import json
import os
import re

from pyspark.sql import functions as F

from ledgerflow.sources import landing as L
from ledgerflow.sources import loader as LD
from ledgerflow.schemas import TRANSACTION_COLUMNS

AS_OF = dt.datetime(2024, 1, 31)


def _rows(spark, n=50):
    return (spark.range(n)
            .select(F.concat(F.lit("T"), F.col("id").cast("string")).alias("transaction_id"),
                    F.lit("C1").alias("card_id"), F.lit("M1").alias("member_id"),
                    (F.col("id") * 1.5).alias("amount"),
                    *[F.lit(None).cast("string").alias(c) for c in
                      ("currency_code", "merchant_name", "merchant_category_code",
                       "transaction_type", "transaction_status")],
                    (F.lit(dt.datetime(2024, 1, 5, 10)).cast("timestamp_ntz")
                     + F.expr("INTERVAL 10 MINUTES") * F.col("id")).alias("posted_at"),
                    F.lit(None).cast("timestamp_ntz").alias("authorized_at"),
                    F.lit(None).cast("string").alias("network"),
                    F.lit(None).cast("boolean").alias("is_international"),
                    F.lit(None).cast("string").alias("decline_reason")))


def test_landing_chunks_are_capped(spark, tmp_root):
    res = L.land(_rows(spark), tmp_root, "transactions", TRANSACTION_COLUMNS, "posted_at",
                 batch_size=7)
    assert res.records_extracted == 50 and res.status == "success"
    from ledgerflow.sources.json_files import read_array_payloads
    per_file = read_array_payloads(spark, res.prefix).groupBy("source_file").count().collect()
    assert sum(r["count"] for r in per_file) == 50
    assert max(r["count"] for r in per_file) <= 7
    assert len(per_file) == res.files_written


def test_landing_empty_status(spark, tmp_root):
    res = L.land(_rows(spark).limit(0), tmp_root, "transactions", TRANSACTION_COLUMNS,
                 "posted_at")
    assert res.status == "empty" and res.records_extracted == 0


def test_load_twice_adds_nothing(spark, tmp_root):
    res = L.land(_rows(spark), tmp_root, "transactions", TRANSACTION_COLUMNS, "posted_at")
    first = LD.load(spark, res.prefix, f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF)
    second = LD.load(spark, res.prefix, f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF)
    assert (first.rows_loaded, first.status) == (50, "success")
    assert (second.files_processed, second.rows_loaded, second.status) == (0, 0, "success")
    assert LD.read_raw_table(spark, f"{tmp_root}/raw", f"{tmp_root}/ledger").count() == 50


def test_no_files_for_date(spark, tmp_root):
    r = LD.load_date(spark, tmp_root, "transactions", f"{tmp_root}/raw", f"{tmp_root}/ledger",
                     AS_OF, date=dt.date(2023, 1, 1))
    assert (r.files_processed, r.rows_loaded, r.rows_errored, r.status) == (0, 0, 0, "no_files")


def test_uncommitted_load_is_invisible_and_reloaded(spark, tmp_root):
    res = L.land(_rows(spark, 10), tmp_root, "transactions", TRANSACTION_COLUMNS, "posted_at")
    # a crashed load: data written, ledger never written
    orphan = spark.createDataFrame([("{}", AS_OF, "x", 0, 1, dt.datetime(2024, 1, 1), False,
                                     None, None, AS_OF.date(), "crashed")], LD.RAW_TABLE_SCHEMA)
    orphan.write.partitionBy("load_date", "load_id").parquet(f"{tmp_root}/raw")
    assert LD.read_raw_table(spark, f"{tmp_root}/raw", f"{tmp_root}/ledger").count() == 0
    r = LD.load(spark, res.prefix, f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF)
    assert r.rows_loaded == 10
    assert LD.read_raw_table(spark, f"{tmp_root}/raw", f"{tmp_root}/ledger").count() == 10


def test_malformed_files_are_counted_not_fatal(spark, tmp_root):
    d = f"{tmp_root}/src/year=2024/month=01/day=05/hour=10"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/a.json", "w") as f:
        json.dump([{"transaction_id": "T1"}, "oops", {"transaction_id": "T2"}], f)
    with open(f"{d}/b.json", "w") as f:
        f.write("[{not json")
    with open(f"{d}/c.json", "w") as f:
        f.write("[]")
    with open(f"{d}/d.json", "wb") as f:
        f.write(b'[{"transaction_id": "T3", "merchant_name": "caf\xff"}]')
    r = LD.load(spark, f"{tmp_root}/src", f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF)
    assert (r.files_processed, r.rows_loaded, r.rows_errored, r.status) == (4, 3, 2, "partial")
    good = LD.read_raw_table(spark, f"{tmp_root}/raw", f"{tmp_root}/ledger")
    names = {json.loads(p)["transaction_id"]: json.loads(p).get("merchant_name")
             for (p,) in good.select("raw_payload").collect()}
    assert names == {"T1": None, "T2": None, "T3": "caf�"}
    report = LD.load_report(spark, f"{tmp_root}/ledger").collect()
    assert report[0].status == "partial" and report[0].files_processed == 4
    from ledgerflow.operators.quality import evaluate, load_rules
    everything = LD.read_raw_table(spark, f"{tmp_root}/raw", f"{tmp_root}/ledger",
                                   include_errors=True)
    assert evaluate(everything, "raw", load_rules()).first().failing_rows == 2


def test_plain_json_reader_loses_invalid_utf8_record(spark, tmp_root):
    from ledgerflow.sources.json_files import read_raw_transactions, read_repaired_payloads
    d = f"{tmp_root}/u"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/x.json", "wb") as f:
        f.write(b'[{"transaction_id": "T3", "merchant_name": "caf\xff"}]')
    rows = read_repaired_payloads(spark, d).collect()
    assert rows[0].repaired and "�" in rows[0].raw_payload
    plain = read_raw_transactions(spark, d).collect()
    assert len(plain) == 1


def test_columnar_formats_load(spark, tmp_root):
    _rows(spark, 5).write.parquet(f"{tmp_root}/pq")
    r = LD.load(spark, f"{tmp_root}/pq", f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF,
                file_format="parquet", glob="*.parquet")
    assert r.rows_loaded == 5
    got = LD.read_raw_table(spark, f"{tmp_root}/raw", f"{tmp_root}/ledger")
    assert got.where(F.col("source_row").isNotNull()).count() == 5


def test_routing_keys_and_csv_and_stage(spark, tmp_root):
    res = L.land(_rows(spark, 5), tmp_root, "transactions", TRANSACTION_COLUMNS, "posted_at")
    LD.load(spark, res.prefix, f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF,
            routing=LD.TRANSACTION_ROUTING)
    got = LD.read_raw_table(spark, f"{tmp_root}/raw", f"{tmp_root}/ledger")
    keys = {(r.record_key, str(r.route_date)) for r in got.collect()}
    assert keys == {(f"T{i}", "2024-01-05") for i in range(5)}
    _rows(spark, 4).select("transaction_id", "amount").write.option("header", True) \
        .csv(f"{tmp_root}/csv")
    r = LD.load(spark, f"{tmp_root}/csv", f"{tmp_root}/raw2", f"{tmp_root}/ledger2", AS_OF,
                file_format="csv", glob="*.csv")
    assert (r.rows_loaded, r.status) == (4, "success")
    from ledgerflow.sources.json_files import register_stage
    register_stage(spark, "landed_stage", res.prefix)
    assert spark.sql("SELECT count(*) AS n FROM landed_stage WHERE NOT is_error").first().n == 5


def test_corrupt_record_quarantine_and_lines_landing(spark, tmp_root):
    from ledgerflow.sources.json_files import read_raw_transactions
    d = f"{tmp_root}/q"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/a.json", "w") as f:
        f.write('{"transaction_id": "T1", "amount": 5.0}\n{"transaction_id": "T2", "amount": "x"}\n')
    rows = read_raw_transactions(spark, d, multi_line=False, with_corrupt=True).collect()
    good = [r for r in rows if r._corrupt_record is None]
    bad = [r for r in rows if r._corrupt_record is not None]
    assert [r.transaction_id for r in good] == ["T1"] and len(bad) == 1
    res = L.land(_rows(spark, 30), tmp_root, "lines", TRANSACTION_COLUMNS, "posted_at",
                 batch_size=4, fmt="lines")
    assert res.records_extracted == 30 and res.files_written >= 30 // 4
    back = read_raw_transactions(spark, res.prefix, multi_line=False)
    assert back.count() == 30


def test_run_batch_job(spark, tmp_root):
    from ledgerflow.operators.transform import read_processed, run_batch
    res = L.land(_rows(spark, 20), tmp_root, "transactions", TRANSACTION_COLUMNS, "posted_at")
    n = run_batch(spark, res.prefix, f"{tmp_root}/processed", AS_OF)
    out = read_processed(spark, f"{tmp_root}/processed")
    assert n == 20 and out.count() == 20
    assert {r.amount_tier for r in out.collect()} <= {"LOW", "MEDIUM"}


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_every_good_record_loads_and_every_broken_one_is_one_error(spark, tmp_root):
    good = [json.dumps({"transaction_id": f"T{i}", "items": [{"a": 1}, {"b": "},{"}]}) for i in range(100)]
    broken = '{"transaction_id": "X", "amount": }'
    texts = {
        "lines": "\n".join(good), "array": "[" + ",\n ".join(good) + "]",
        "broken_array": "[" + ",".join([*good[:50], broken, *good[50:]]) + "]",
        "broken_lines": "\n".join([*good[:50], broken, *good[50:], "oops"]),
        "concatenated": " ".join(good), "two_arrays": "[" + ",".join(good[:50]) + "]\n[" + ",".join(good[50:]) + "]",
        "open_array": "[" + ",".join(good), "single": good[0], "blank": " \n", "empty": "[]", "tail": "[" + good[0] + "] rest",
    }
    want = {"lines": (100, 0), "array": (100, 0), "broken_array": (100, 1), "broken_lines": (100, 2), "concatenated": (100, 0),
            "two_arrays": (100, 0), "open_array": (100, 0), "single": (1, 0), "blank": (0, 0), "empty": (0, 0), "tail": (1, 1)}
    for name, text in texts.items():
        _write(f"{tmp_root}/src/{name}.json", text.encode())
    r = LD.load(spark, f"{tmp_root}/src", f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF, feed="transactions")
    assert (r.files_processed, r.rows_loaded, r.rows_errored, r.status) == (
        len(texts), sum(a for a, _ in want.values()), sum(b for _, b in want.values()), "partial")
    per_file = {os.path.basename(x.source_file)[:-5]: (x.rows_loaded, x.rows_errored) for x in LD.read_ledger(spark, f"{tmp_root}/ledger").collect()}
    assert per_file == want
    assert LD.load(spark, f"{tmp_root}/src", f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF).files_processed == 0


def test_csv_and_parquet_rejects(spark, tmp_root):
    _write(f"{tmp_root}/csv/a b.csv", b"transaction_id,amount\nT1,5\nT2,6,7\nT3,8\n")
    r = LD.load(spark, f"{tmp_root}/csv", f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF, file_format="csv", feed="transactions")
    assert (r.rows_loaded, r.rows_errored, r.status) == (2, 1, "partial")
    _rows(spark, 5).coalesce(1).write.parquet(f"{tmp_root}/pq")
    _write(f"{tmp_root}/pq/part-bad.parquet", b"this is no parquet file")
    r = LD.load(spark, f"{tmp_root}/pq", f"{tmp_root}/raw2", f"{tmp_root}/ledger2", AS_OF, file_format="parquet", glob="*.parquet")
    assert (r.files_processed, r.rows_loaded, r.rows_errored, r.status) == (2, 5, 1, "partial")


def test_files_keep_their_own_columns_and_types(spark, tmp_root):
    """CSV columns in another order or number, Parquet files of other columns and types, names that look like patterns."""
    _write(f"{tmp_root}/csv/a [1].csv", b"transaction_id,amount\nT1,5\n")
    _write(f"{tmp_root}/csv/b.csv", b"\namount,transaction_id\n6,T2\n")
    _write(f"{tmp_root}/csv/c.csv", b"transaction_id,amount,network\nT3,7,VISA\n")
    _write(f"{tmp_root}/csv/d.csv", b" \n")
    r = LD.load(spark, f"{tmp_root}/csv", f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF, file_format="csv", feed="transactions")
    assert (r.files_processed, r.rows_loaded, r.rows_errored) == (4, 3, 0)
    got = [json.loads(x.raw_payload) for x in LD.read_raw_table(spark, f"{tmp_root}/raw", f"{tmp_root}/ledger").orderBy("record_key").collect()]
    assert got == [{"transaction_id": "T1", "amount": "5"}, {"transaction_id": "T2", "amount": "6"},
                   {"transaction_id": "T3", "amount": "7", "network": "VISA"}]
    for i, expr in enumerate(["5L AS amount", "'6' AS amount", "7L AS amount, 'VISA' AS network"]):
        spark.sql(f"SELECT 'T{i}' AS transaction_id, {expr}").coalesce(1).write.mode("append").parquet(f"{tmp_root}/pq")
    r = LD.load(spark, f"{tmp_root}/pq", f"{tmp_root}/raw2", f"{tmp_root}/ledger2", AS_OF, file_format="parquet", glob="*.parquet", feed="transactions")
    assert (r.files_processed, r.rows_loaded, r.rows_errored) == (3, 3, 0)
    got = [json.loads(x.raw_payload) for x in LD.read_raw_table(spark, f"{tmp_root}/raw2", f"{tmp_root}/ledger2").orderBy("record_key").collect()]
    assert got == [{"transaction_id": "T0", "amount": 5}, {"transaction_id": "T1", "amount": "6"}, {"transaction_id": "T2", "amount": 7, "network": "VISA"}]


def test_damaged_parquet_rows_fail_the_load(spark, tmp_root):
    """A file with a damaged later row group is not taken for loaded."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    import pytest
    os.makedirs(f"{tmp_root}/pq")
    path = f"{tmp_root}/pq/a.parquet"
    pq.write_table(pa.table({"transaction_id": [f"T{i}" for i in range(4000)]}), path, row_group_size=1000, use_dictionary=False)
    start = pq.ParquetFile(path).metadata.row_group(2).column(0).data_page_offset
    with open(path, "r+b") as f:
        f.seek(start)
        f.write(b"\xff" * 400)
    with pytest.raises(Exception):
        LD.load(spark, f"{tmp_root}/pq", f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF, file_format="parquet", on_error="abort")
    assert LD.read_raw_table(spark, f"{tmp_root}/raw", f"{tmp_root}/ledger", include_errors=True).count() == 0
    assert LD.read_ledger(spark, f"{tmp_root}/ledger").count() == 0


def _damaged_parquet(path, rows=4000):
    """A Parquet file with a sound footer and a damaged third row group."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table({"transaction_id": [f"D{i}" for i in range(rows)]}), path, row_group_size=rows // 4, use_dictionary=False)
    start = pq.ParquetFile(path).metadata.row_group(2).column(0).data_page_offset
    with open(path, "r+b") as f:
        f.seek(start)
        f.write(b"\xff" * 400)


def test_damaged_files_cost_only_themselves(spark, tmp_root):
    """Two landing days, damaged Parquet files in the first: every sound row of both days loads, a
    damaged file is one error, a second run finds nothing to do, and no orphan partition is left."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    first, second = (f"{tmp_root}/src/year=2024/month=01/day=0{d}/hour=10" for d in (5, 6))
    _damaged_parquet(f"{first}/bad1.parquet")
    _damaged_parquet(f"{first}/bad2.parquet")
    _write(f"{first}/none.parquet", b"this is no parquet file")
    for folder, n, name in ((first, 70, "a"), (first, 0, "empty"), (second, 50, "b")):
        os.makedirs(folder, exist_ok=True)
        pq.write_table(pa.table({"transaction_id": pa.array([f"{name}{i}" for i in range(n)], pa.string()), "amount": pa.array([1.5] * n, pa.float64())}), f"{folder}/{name}.parquet")
    args = (f"{tmp_root}/src", f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF)
    r = LD.load(spark, *args, file_format="parquet", feed="transactions", batch_days=1)
    assert (r.files_processed, r.rows_loaded, r.rows_errored, r.status) == (6, 120, 3, "partial")
    assert LD.load(spark, *args, file_format="parquet", feed="transactions", batch_days=1).files_processed == 0
    per_file = {os.path.basename(x.source_file): (x.rows_loaded, x.rows_errored) for x in LD.read_ledger(spark, args[2]).collect()}
    assert per_file == {"bad1.parquet": (0, 1), "bad2.parquet": (0, 1), "none.parquet": (0, 1), "a.parquet": (70, 0), "empty.parquet": (0, 0), "b.parquet": (50, 0)}
    raw = LD.read_raw_table(spark, args[1], args[2], include_errors=True)
    assert raw.where("is_error").count() == 3 and {x.record_key for x in raw.where("not is_error").collect()} == {f"a{i}" for i in range(70)} | {f"b{i}" for i in range(50)}
    ids = {x.load_id for x in spark.read.schema(LD.RAW_TABLE_SCHEMA).parquet(args[1]).select("load_id").distinct().collect()}
    assert ids == {x.load_id for x in LD.read_ledger(spark, args[2]).select("load_id").distinct().collect()}
    days = {x.landing_date.day: x.status for x in LD.load_report(spark, args[2]).collect()}
    assert days == {5: "partial", 6: "success"}


def test_damaged_compressed_csv(spark, tmp_root):
    """A cut-off gzip file is one error beside its sound neighbours."""
    import gzip
    for name, n in (("a", 5), ("b", 2000), ("c", 7)):
        data = gzip.compress(("transaction_id,amount\n" + "".join(f"{name}{i},{i * 7919 % 1000}\n" for i in range(n))).encode())
        _write(f"{tmp_root}/csv/{name}.csv.gz", data[:len(data) // 2] if name == "b" else data)
    r = LD.load(spark, f"{tmp_root}/csv", f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF, file_format="csv", feed="transactions")
    assert (r.files_processed, r.rows_loaded, r.rows_errored, r.status) == (3, 12, 1, "partial")


def test_flat_lines_need_no_python(spark, tmp_root):
    """Files of flat JSON lines are cut by built-ins and give what the document cutter gives."""
    import random
    from ledgerflow.sources import json_files as J
    r = random.Random(4)
    parts = ['{"a":1}', '{"b":"x y"}', '{"c":{"d":1}}', "\n", "\n", "\n", " ", "\r\n", "{bad", '{"a":1},', '[{"a":2}]', '{"a":"}{"}', '"s"', "5", "{}",
             '{"a":1} x}', '{"a":1}{"a":2}']
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(9))) for _ in range(800)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {}
    for x in J.explode_json_text(df).collect():
        got.setdefault(x.id, []).append((x.source_row, x.raw_payload, x.is_error))
    arrays = {i for i, t in enumerate(texts) if t.strip()[:1] == "[" and t.strip()[-1:] == "]"}
    for i, t in enumerate(texts):
        if i not in arrays:
            assert [p for _, p, _ in sorted(got.get(i, []))] == J.split_documents(t), t
    fed = J._plain_lines("text")[1]
    assert {x.id for x in df.where(fed).collect()} >= {i for i, t in enumerate(texts) if t and not set(t.split("\n")) - {'{"a":1}', '{"b":"x y"}', "{}"}}


def test_files_beside_the_day_folders_and_bad_folder_names(spark, tmp_root):
    rec = b'[{"transaction_id": "T"}]'
    for p in ("year=2024/month=01/day=05/hour=10/a.json", "year=2024/month=13/day=45/b.json", "loose.json", "year=2024/c.json",
              "year=2024/month=01/d.json", "other/e.json", "year=2024/month=01/day=06/deep/er/f.json"):
        _write(f"{tmp_root}/src/{p}", rec)
    r = LD.load(spark, f"{tmp_root}/src", f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF, batch_days=1)
    assert (r.files_processed, r.rows_loaded, r.status) == (7, 7, "success")
    assert LD.load(spark, f"{tmp_root}/src", f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF).files_processed == 0
    days = {x.landing_date for x in LD.read_ledger(spark, f"{tmp_root}/ledger").collect()}
    assert days == {dt.date(2024, 1, 5), dt.date(2024, 1, 6), None}


def test_part_of_a_folder_already_loaded(spark, tmp_root):
    _write(f"{tmp_root}/src/a.json", b'[{"transaction_id": "T1"}]')
    LD.load(spark, f"{tmp_root}/src", f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF)
    _write(f"{tmp_root}/src/b.json", b'{"transaction_id": "T2"}')
    r = LD.load(spark, f"{tmp_root}/src", f"{tmp_root}/raw", f"{tmp_root}/ledger", AS_OF)
    assert (r.files_processed, r.rows_loaded) == (1, 1)
    assert LD.read_raw_table(spark, f"{tmp_root}/raw", f"{tmp_root}/ledger").count() == 2


def test_shared_folder_is_required_on_a_cluster():
    import types

    import pytest
    from ledgerflow.session import shared_dir
    context = types.SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda k, d=None: d), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session)


def test_records_are_cut_without_a_copy_of_their_file(spark):
    """Beside each record stand only file columns and flags, no column of the file's size."""
    from ledgerflow.sources.json_files import explode_json_text
    files = spark.createDataFrame([("f", '[{"a": 1}, {"a": 2}]'), ("g", '{"a": 3}\n{"a": }')], "source_file string, text string")
    rows = explode_json_text(files)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    carried = re.search(r"Generate posexplode\(.*\), \[([^\[\]]*)\], \w+, \[", plan).group(1)
    assert re.sub(r"#\d+", "", carried) == "source_file, _cut"
    assert sorted((r["source_file"], r["source_row"], r["is_error"]) for r in rows.collect()) == [
        ("f", 0, False), ("f", 1, False), ("g", 0, False), ("g", 1, True)]


def test_landed_arrays_take_one_shuffle(spark):
    """The task that sorts a run of hours also joins its arrays: no second shuffle of the
    records, and no file cut short but the last of an hour and task (F2, F5)."""
    rows = _rows(spark, 200).withColumn("hour_of_day", F.hour("posted_at"))
    chunks = L._array_chunks(rows, TRANSACTION_COLUMNS, "posted_at", 4)
    plan = chunks._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange \w+partitioning", plan)) == 1
    tasks = chunks.select(F.spark_partition_id().alias("t"), "day", "hour", "value", "_n").collect()
    assert [(r["day"], r["hour"]) for r in tasks] == sorted((r["day"], r["hour"]) for r in tasks)
    assert sum(r["_n"] for r in tasks) == 200 and max(r["_n"] for r in tasks) <= 4
    short = [(r["t"], r["day"], r["hour"]) for r in tasks if r["_n"] < 4]
    assert len(short) == len(set(short))
    ids = [x["transaction_id"] for r in tasks for x in json.loads(r["value"])]
    assert sorted(ids) == sorted(f"T{i}" for i in range(200))


def test_landed_arrays_keep_every_byte(spark, tmp_root):
    """Records without a time, and bytes that are no UTF-8, land as they are."""
    rows = _rows(spark, 6).withColumn("posted_at", F.when(F.col("transaction_id") != "T3", F.col("posted_at")))
    bad = F.concat(F.lit('{"a": "'), F.unhex(F.lit("FF")).cast("string"), F.lit('"}'))
    res = L.land(rows, tmp_root, "transactions", TRANSACTION_COLUMNS, "posted_at", payload=bad)
    assert (res.records_extracted, res.files_written) == (6, 2)
    found = [bytes(r[0]) for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(res.prefix).select("content").collect()]
    assert sorted(f.count(b'{"a": "\xff"}') for f in found) == [1, 5]


def _cut_whole(text):
    """``split_documents`` over a text held whole."""
    from ledgerflow.sources import json_files as J
    decode, at, pieces = json.JSONDecoder(strict=False).raw_decode, 0, []
    while (at := J._BETWEEN.match(text, at).end()) < len(text):
        try:
            stop = decode(text, at)[1]
        except (ValueError, RecursionError):
            found = (J._RESUME if text[at] == "{" else J._RESUME_AT_OBJECT).search(text, at + 1)
            stop = found.start() if found else len(text)
        pieces.append(text[at:stop].strip())
        at = stop
    return pieces


def test_chunks_of_a_text_give_its_pieces():
    """Wherever chunks end, a text gives the same pieces, and what is held does not grow with it."""
    import random
    from ledgerflow.sources import json_files as J
    r = random.Random(7)
    parts = ['{"a":1}', '{"b":"x \\n y"}', '{"c":{"d":[1,2.5e+10]}}', "\n", " ", "\r\n", "{bad", "{bad}", ",", "[", "]", '{"a":"}{"}', '"s"', "15.25e3", "-7",
             "true", "nul", "-Infinity", '{"a": }', '{"a":"open', '{"a":1,   }', '{"\\u00e9":"\\ud83d\\ude00"}', "é", "},\n{", '{"a": "\\q"}']
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(30)))
        cuts = sorted(r.randrange(len(text) + 1) for _ in range(r.randrange(12)))
        chunks = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        cutter = J.Cutter()
        got = [p for i, c in enumerate(chunks) for p in cutter.feed(c, i == len(chunks) - 1)]
        assert got == _cut_whole(text) == J.split_documents(text), (text, cuts)
    cutter, n, most = J.Cutter(), 0, 0
    for _ in range(300):
        n += len(cutter.feed('{"a": "some text"} {"a": } ' * 100, False))
        most = max(most, cutter.size)
    assert n + len(cutter.feed("", True)) == 60_000 and most < 5_400


def test_python_gets_loose_text_by_chunks(spark):
    """A text of several chunks, beside files that need no Python: every record at its place,
    and no row that goes to Python is longer than a chunk (F9)."""
    from ledgerflow.sources import json_files as J
    good, broken = '{"a": "%s"}' % ("é" * 90), '{"a": }'
    n = 30 * J.CHUNK // len(good)
    loose = " ".join(broken if i % 97 == 0 else good for i in range(n))
    files = spark.createDataFrame([("f", loose), ("g", '[{"a": 1}]'), ("h", None), ("i", loose), ("j", '{"a": 1}\n{"a": 2}'), ("k", "")],
                                  "source_file string, text string").coalesce(1)
    rows = J.explode_json_text(files)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert f"{{1,{J.CHUNK}}}" in plan and re.search(r"_split_chunks\(_chunk#\d+", plan)
    got = {}
    for x in rows.collect():
        got.setdefault(x["source_file"], []).append((x["source_row"], x["raw_payload"], x["is_error"]))
    want = [(i, broken if i % 97 == 0 else good, i % 97 == 0) for i in range(n)]
    assert got["f"] == got["i"] == want
    assert got["g"] == [(0, '{"a":1}', False)] and [p for p, *_ in got["j"]] == [0, 1] and set(got) == {"f", "g", "i", "j"}


def test_routing_columns_take_one_parse(spark):
    """Both routing columns come from one parse of a good record's payload."""
    rows = spark.createDataFrame([('{"transaction_id": "T1", "posted_at": "2024-01-05T09:00:00"}', False), ('{"transaction_id": "T2"}', True), (None, True),
                                  ('{"transaction_id": 3, "posted_at": "x"}', False)], "raw_payload string, is_error boolean")
    out = LD._routed(rows, LD.TRANSACTION_ROUTING)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("parse_?json", plan, re.I)) == 1
    assert [(r["record_key"], r["route_date"]) for r in out.collect()] == [("T1", dt.date(2024, 1, 5)), (None, None), (None, None), ("3", None)]

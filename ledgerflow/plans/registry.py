"""Registered queries (name -> Spark callable) and their DuckDB oracles.

Every query reads the driver's tables (``events``) and derives the feeds from
them, so its work grows with the data. ``FIXTURE_AS_OF`` replaces the wall
clock everywhere a run timestamp is needed.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow import oracle as O
from ledgerflow.functions import expressions as X
from ledgerflow.functions.expressions import PAYMENT_TYPES, hour_floor, surrogate_key
from ledgerflow.operators import quality as QL
from ledgerflow.operators import transform as TR
from ledgerflow.operators.daily import daily_fact, round_money
from ledgerflow.operators.events import credit_card_events
from ledgerflow.operators.merge import merge_by_key, read_table, stabilize, write_full
from ledgerflow.operators.staging import parse_raw, stg_payments, stg_transactions
from ledgerflow.plans import incremental as INC
from ledgerflow.plans import jobs
from ledgerflow.schemas import (
    EVENT_SCHEMA, FACT_SCHEMA, PAYMENT_COLUMNS, PAYMENT_FIELDS, PAYMENT_SCHEMA, TRANSACTION_COLUMNS,
    TRANSACTION_FIELDS, TRANSACTION_ROUTING, TRANSACTION_SCHEMA,
)
from ledgerflow.session import scratch_path
from ledgerflow.sources import fixtures as fx
from ledgerflow.sources import landing as L
from ledgerflow.sources import loader as LD
from ledgerflow.sources.catalog import register_partitioned_table
from ledgerflow.sources.json_files import read_array_payloads, register_stage
from ledgerflow.streaming import streams as ST

AS_OF = fx.FIXTURE_AS_OF
QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- helpers

def staged(spark: SparkSession, sf_dir: str, window_days: int | None = None):
    st = stg_transactions(fx.raw_transactions(spark, sf_dir), AS_OF, window_days)
    sp = stg_payments(fx.raw_payments(spark, sf_dir), AS_OF, window_days)
    return st, sp


def int_events(spark: SparkSession, sf_dir: str, window_days: int | None = None) -> DataFrame:
    st, sp = staged(spark, sf_dir, window_days)
    return credit_card_events(st, sp, AS_OF)


# ---------------------------------------------------------------- parsing

@register("raw_transactions_parse", O.with_(O.EV, O.RAW_TX) + f"""
SELECT {O.TX_FIELDS}, loaded_at AS _loaded_at, {O.src_file('transactions')} AS source_file,
       event_id AS source_row
FROM raw_tx""")
def q_raw_transactions_parse(spark, sf_dir):
    """JSON payload -> 14 typed transaction fields."""
    raw = fx.raw_transactions(spark, sf_dir)
    return parse_raw(raw, TRANSACTION_FIELDS, None, None).drop("_dbt_updated_at")


@register("raw_payments_parse", O.with_(O.EV, O.RAW_PAY) + f"""
SELECT {O.PAY_FIELDS}, loaded_at AS _loaded_at, {O.src_file('payments')} AS source_file,
       event_id AS source_row
FROM raw_pay""")
def q_raw_payments_parse(spark, sf_dir):
    """B2/L2: JSON payload -> 10 typed payment fields."""
    raw = fx.raw_payments(spark, sf_dir)
    return parse_raw(raw, PAYMENT_FIELDS, None, None).drop("_dbt_updated_at")


# ---------------------------------------------------------------- staging / chain

@register("stg_transactions", O.with_(O.EV, O.RAW_TX, O.stg_tx(7)) + "SELECT * FROM stg_tx")
def q_stg_transactions(spark, sf_dir):
    """7-day load window, key filter, latest version per id."""
    return staged(spark, sf_dir, 7)[0]


@register("stg_payments", O.with_(O.EV, O.RAW_PAY, O.stg_pay(7)) + "SELECT * FROM stg_pay")
def q_stg_payments(spark, sf_dir):
    """Latest payment version, settled_at DESC NULLS LAST."""
    return staged(spark, sf_dir, 7)[1]


@register("int_events", O.with_(*O.chain(None)) + "SELECT * FROM int_ev")
def q_int_events(spark, sf_dir):
    """D1/D2/C6/B7-B14/B23 over the full history (full refresh)."""
    return int_events(spark, sf_dir)


@register("fct_daily", O.with_(*O.chain(None), O.daily_agg("int_ev")) + O.DAILY_SELECT + " FROM daily")
def q_fct_daily(spark, sf_dir):
    """Daily per-card fact over the full history."""
    return round_money(daily_fact(int_events(spark, sf_dir), AS_OF))


@register("surrogate_key", O.with_(O.EV, O.RAW_TX) + f"""
SELECT transaction_id, posted_at, card_id,
       {O.key_sql('CAST(transaction_id AS VARCHAR)', O.ts_text('posted_at'))} AS event_key,
       {O.key_sql(O.date_text('CAST(posted_at AS DATE)'), 'CAST(card_id AS VARCHAR)',
                  'CAST(is_international AS VARCHAR)', 'CAST(amount AS VARCHAR)')} AS mixed_key
FROM raw_tx""")
def q_surrogate_key(spark, sf_dir):
    """md5 keys over strings, timestamps, dates, booleans, doubles, NULLs."""
    rows = fx.raw_transaction_rows(spark, sf_dir).withColumn("_d", F.to_date("posted_at"))
    return rows.select(
        "transaction_id", "posted_at", "card_id",
        surrogate_key(rows, ["transaction_id", "posted_at"]).alias("event_key"),
        surrogate_key(rows, ["_d", "card_id", "is_international", "amount"]).alias("mixed_key"))


# ---------------------------------------------------------------- ingest / landing / load


# JSON text that replaces every 97th landed element (a string,
# not a record).
BAD_ELEMENT = '"{bad"'


def _land_transactions(spark, sf_dir, root, batch_size=L.BATCH_SIZE, payload=None):
    rows = fx.raw_transaction_rows(spark, sf_dir)
    return L.land(rows, root, "transactions", TRANSACTION_COLUMNS, "loaded_at",
                  batch_size=batch_size, payload=payload)


@register("bad_json_rejects", O.with_(O.EV, O.RAW_TX) + """
SELECT CAST(loaded_at AS DATE) AS load_date, COUNT(*) AS rows_total,
       COUNT(*) FILTER (WHERE event_id % 97 <> 0) AS rows_parsed,
       COUNT(*) FILTER (WHERE event_id % 97 = 0) AS rows_rejected
FROM raw_tx GROUP BY 1""")
def q_bad_json_rejects(spark, sf_dir):
    """Unparseable payloads become all-NULL rows and are counted as rejects."""
    raw = fx.raw_transactions(spark, sf_dir, corrupt_every=fx.BAD_PAYLOAD_EVERY)
    parsed = parse_raw(raw, TRANSACTION_FIELDS, None, None)
    return (parsed.groupBy(F.to_date("_loaded_at").alias("load_date"))
                  .agg(F.count(F.lit(1)).alias("rows_total"),
                       F.count_if(F.col("transaction_id").isNotNull()).alias("rows_parsed"),
                       F.count_if(F.col("transaction_id").isNull()).alias("rows_rejected")))


@register("outer_array_rows", O.with_(O.EV, O.RAW_TX) + f"""
SELECT {O.landing_part()} AS source_partition, {O.TX_FIELDS}, TRUE AS has_position
FROM raw_tx""")
def q_outer_array_rows(spark, sf_dir):
    """Land JSON-array files, strip the outer array, keep provenance."""
    root = scratch_path(spark, "outer_array")
    res = _land_transactions(spark, sf_dir, root)
    rows = read_array_payloads(spark, res.prefix)
    v = rows.select(LD.landing_partition_of("source_file").alias("source_partition"),
                    F.col("source_row").between(0, L.BATCH_SIZE - 1).alias("has_position"),
                    F.try_parse_json("raw_payload").alias("_v"))
    return v.select("source_partition",
                    *[F.try_variant_get("_v", f"$.{n}", t.simpleString()).alias(n)
                      for n, t in TRANSACTION_FIELDS], "has_position")


@register("extract_hour_window", O.with_(O.EV, O.RAW_TX) + """
SELECT date_trunc('hour', posted_at) AS window_start,
       date_trunc('hour', posted_at) + INTERVAL 1 HOUR AS window_end,
       COUNT(*) AS records, min(posted_at) AS first_ts, max(posted_at) AS last_ts
FROM raw_tx GROUP BY 1, 2""")
def q_extract_hour_window(spark, sf_dir):
    """Half-open [start, end) extraction window over the data's span, bucketed into hourly runs."""
    rows = fx.raw_transaction_rows(spark, sf_dir)
    lo, hi = rows.agg(F.min("posted_at"), F.max("posted_at")).first()
    rows = L.extract_window(rows, "posted_at", hour_floor(lo), hour_floor(hi) + _dt.timedelta(hours=1))
    ws = F.date_trunc("hour", "posted_at").cast("timestamp_ntz")
    return (rows.groupBy(ws.alias("window_start"))
                .agg(F.count(F.lit(1)).alias("records"), F.min("posted_at").alias("first_ts"),
                     F.max("posted_at").alias("last_ts"))
                .withColumn("window_end", (F.col("window_start") + F.expr("INTERVAL 1 HOUR"))
                            .cast("timestamp_ntz")))


# The fixture has the three extracted payment kinds only: each 11th becomes another one.
@register("extract_payment_types", O.with_(O.EV, O.RAW_PAY) + f"""
SELECT {O.PAY_FIELDS} FROM raw_pay WHERE event_id % 11 <> 0 AND payment_type IN ('ACH', 'WIRE', 'BILLPAY')""")
def q_extract_payment_types(spark, sf_dir):
    """Payment events restricted to ACH, WIRE, BILLPAY, from a feed with a fourth kind."""
    rows = fx.raw_payment_rows(spark, sf_dir)
    other = F.when(F.col("event_id") % 11 == 0, F.lit("CHECK")).otherwise(F.col("payment_type"))
    return L.payment_subset(rows.withColumn("payment_type", other), PAYMENT_TYPES).select(*PAYMENT_COLUMNS)


# A small chunk size so that the registered query exercises chunking.
CHUNK_QUERY_BATCH = 25


@register("landing_chunks", O.with_(O.EV, O.RAW_TX) + f"""
SELECT {O.landing_part()} AS landing_partition, COUNT(*) AS records, TRUE AS within_cap
FROM raw_tx GROUP BY 1""")
def q_landing_chunks(spark, sf_dir):
    """Hour-partitioned landing with at most N records per file."""
    root = scratch_path(spark, "landing")
    res = _land_transactions(spark, sf_dir, root, batch_size=CHUNK_QUERY_BATCH)
    rows = read_array_payloads(spark, res.prefix)
    per_file = rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    return (per_file.groupBy(LD.landing_partition_of("source_file").alias("landing_partition"))
                    .agg(F.sum("n").alias("records"),
                         (F.max("n") <= CHUNK_QUERY_BATCH).alias("within_cap")))


@register("extraction_metrics", O.with_(O.EV, O.RAW_TX, O.RAW_PAY) + """
SELECT 'transactions' AS feed, COUNT(*) AS records_extracted, TRUE AS has_files, 'success' AS status FROM raw_tx
UNION ALL SELECT 'payments', COUNT(*), TRUE, 'success' FROM raw_pay
UNION ALL SELECT 'nothing', 0, FALSE, 'empty'""")
def q_extraction_metrics(spark, sf_dir):
    """What each landing reports (records, files, status), an empty one too."""
    root = scratch_path(spark, "extraction")
    pay = fx.raw_payment_rows(spark, sf_dir)
    got = [_land_transactions(spark, sf_dir, root),
           L.land(pay, root, "payments", PAYMENT_COLUMNS, "loaded_at", fmt="lines"),
           L.land(pay.where(F.lit(False)), root, "nothing", PAYMENT_COLUMNS, "loaded_at")]
    return spark.createDataFrame([(r.feed, r.records_extracted, r.files_written > 0, r.status) for r in got],
                                 "feed string, records_extracted long, has_files boolean, status string")


@register("external_stage", O.with_(O.EV, O.RAW_TX) + f"""
SELECT {O.landing_part()} AS source_partition, COUNT(*) AS records, CAST(sum(amount) AS DECIMAL(18, 2)) AS amount
FROM raw_tx GROUP BY 1""")
def q_external_stage(spark, sf_dir):
    """Landed files queried in place by name."""
    res = _land_transactions(spark, sf_dir, scratch_path(spark, "stage"))
    register_stage(spark, "landed_transactions", res.prefix)
    return spark.sql("""
        SELECT regexp_extract(source_file, '(year=.*/hour=[0-9]+)', 1) AS source_partition, count(*) AS records,
               CAST(sum(CAST(get_json_object(raw_payload, '$.amount') AS DECIMAL(18, 2))) AS DECIMAL(18, 2)) AS amount
        FROM landed_transactions WHERE NOT is_error GROUP BY 1""")


@register("load_metrics", O.with_(O.EV, O.RAW_TX) + """
SELECT CAST(loaded_at AS DATE) AS landing_date,
       COUNT(*) FILTER (WHERE event_id % 97 <> 0) AS rows_loaded,
       COUNT(*) FILTER (WHERE event_id % 97 = 0) AS rows_errored,
       CASE WHEN COUNT(*) FILTER (WHERE event_id % 97 = 0) = 0 THEN 'success' ELSE 'partial' END AS status,
       TRUE AS every_file
FROM raw_tx GROUP BY 1""")
def q_load_metrics(spark, sf_dir):
    """Load landed arrays with bad elements; per-day load metrics."""
    root = scratch_path(spark, "load_metrics")
    bad = F.when(F.col("event_id") % fx.BAD_PAYLOAD_EVERY == 0, F.lit(BAD_ELEMENT)) \
           .otherwise(fx.to_json_payload(TRANSACTION_COLUMNS))
    res = _land_transactions(spark, sf_dir, root, payload=bad)
    got = LD.load(spark, res.prefix, f"{root}/raw", f"{root}/ledger", AS_OF)
    every_file = got.files_processed == res.files_written == LD.read_ledger(spark, f"{root}/ledger").count()
    return LD.load_report(spark, f"{root}/ledger").drop("files_processed").withColumn("every_file", F.lit(every_file))


# File formats of the mixed load, by event_id % 5, and the text of a broken record.
MIXED_FORMATS = ["array", "lines", "concatenated", "csv", "parquet"]
BROKEN_RECORD = '{"transaction_id": "X", "amount": }'


@register("load_mixed_files", O.with_(O.EV, O.RAW_TX) + """
SELECT ['array', 'lines', 'concatenated', 'csv', 'parquet'][1 + event_id % 5] AS kind,
       COUNT(*) FILTER (WHERE event_id % 5 > 2 OR event_id % 97 <> 0) AS rows_loaded,
       COUNT(*) FILTER (WHERE event_id % 5 <= 2 AND event_id % 97 = 0) AS rows_errored,
       COUNT(DISTINCT transaction_id) FILTER (WHERE event_id % 5 > 2 OR event_id % 97 <> 0) AS keys,
       TRUE AS every_file
FROM raw_tx GROUP BY 1""")
def q_load_mixed_files(spark, sf_dir):
    """Arrays with broken elements, JSON lines, concatenated documents, CSV and
    Parquet; each good record is loaded, each broken one is one error."""
    root = scratch_path(spark, "mixed")
    rows = fx.raw_transaction_rows(spark, sf_dir)
    text = F.when(F.col("event_id") % fx.BAD_PAYLOAD_EVERY == 0, F.lit(BROKEN_RECORD)) \
            .otherwise(fx.to_json_payload(TRANSACTION_COLUMNS))
    out = None
    for i, kind in enumerate(MIXED_FORMATS):
        own, path = rows.where(F.col("event_id") % 5 == i), f"{root}/{kind}"
        if kind in ("array", "lines"):
            files = L.land(own, root, kind, TRANSACTION_COLUMNS, "loaded_at", payload=text, fmt=kind).files_written
        else:
            if kind == "concatenated":    # documents on one line, 20 a line
                n = F.floor(F.col("event_id") / 500)
                own.groupBy(n.alias("n")).agg(F.array_join(F.collect_list(text), " ").alias("value")).select("value").write.text(path)
            else:
                own.select(*TRANSACTION_COLUMNS).write.option("header", True).format(kind).save(path)
            files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path").count()
        got = LD.load(spark, path, f"{root}/raw-{kind}", f"{root}/ledger-{kind}", AS_OF,
                      kind if kind in ("csv", "parquet") else "json", glob="part-*", feed="transactions")
        raw = LD.read_raw_table(spark, f"{root}/raw-{kind}", f"{root}/ledger-{kind}", include_errors=True)
        one = raw.agg(F.count_if(~F.col("is_error")).alias("rows_loaded"), F.count_if(F.col("is_error")).alias("rows_errored"),
                      F.count_distinct("record_key").alias("keys")).select(
            F.lit(kind).alias("kind"), "*",
            (F.lit(got.files_processed == files) & (F.col("rows_loaded") == got.rows_loaded)
             & (F.col("rows_errored") == got.rows_errored)).alias("every_file"))
        out = one if out is None else out.unionByName(one)
    return out


@register("load_no_files", O.with_(O.EV, O.RAW_TX) + """
SELECT CAST(min(loaded_at) AS DATE) AS landing_date, 'success' AS status,
       (SELECT COUNT(*) FROM raw_tx r WHERE CAST(r.loaded_at AS DATE) = (SELECT min(CAST(loaded_at AS DATE)) FROM raw_tx)) AS rows_loaded
FROM raw_tx
UNION ALL SELECT CAST(max(loaded_at) AS DATE) + 10, 'no_files', 0 FROM raw_tx""")
def q_load_no_files(spark, sf_dir):
    """The files of one landing day by its path; a day without files says so."""
    root = scratch_path(spark, "load_day")
    _land_transactions(spark, sf_dir, root)
    lo, hi = fx.raw_transaction_rows(spark, sf_dir).agg(F.min(F.to_date("loaded_at")), F.max(F.to_date("loaded_at"))).first()
    days = [lo, hi + _dt.timedelta(days=10)]
    got = [LD.load_date(spark, root, "transactions", f"{root}/raw", f"{root}/ledger", AS_OF, date=d) for d in days]
    return spark.createDataFrame([(d, r.status, r.rows_loaded) for d, r in zip(days, got)],
                                 "landing_date date, status string, rows_loaded long")


@register("load_idempotent", O.with_(O.EV, O.RAW_TX) + """
SELECT CAST(loaded_at AS DATE) AS landing_date, COUNT(*) AS rows_loaded, 1 AS loads,
       0 AS second_run_files
FROM raw_tx GROUP BY 1""")
def q_load_idempotent(spark, sf_dir):
    """Loading the same files twice adds nothing the second time."""
    root = scratch_path(spark, "load_idempotent")
    res = _land_transactions(spark, sf_dir, root)
    LD.load(spark, res.prefix, f"{root}/raw", f"{root}/ledger", AS_OF)
    second = LD.load(spark, res.prefix, f"{root}/raw", f"{root}/ledger", AS_OF)
    raw = LD.read_raw_table(spark, f"{root}/raw", f"{root}/ledger")
    return (raw.groupBy(LD.landing_date_of("source_file").alias("landing_date"))
               .agg(F.count(F.lit(1)).alias("rows_loaded"),
                    F.count_distinct("load_id").cast("int").alias("loads"))
               .withColumn("second_run_files", F.lit(second.files_processed)))


# ---------------------------------------------------------------- batch lane


def _batch_output(spark, sf_dir, name):
    root = scratch_path(spark, name)
    res = _land_transactions(spark, sf_dir, root)
    TR.run_batch(spark, res.prefix, f"{root}/processed", AS_OF)
    return f"{root}/processed"


@register("batch_transform", O.with_(O.EV, O.RAW_TX, O.BATCH_LANE) + "SELECT * FROM batch")
def q_batch_transform(spark, sf_dir):
    """JSON arrays -> dedupe -> classify -> Parquet."""
    return TR.read_processed(spark, _batch_output(spark, sf_dir, "batch"))


@register("catalog_partitions", O.with_(O.EV, O.RAW_TX, O.BATCH_LANE) + """
SELECT event_date, COUNT(*) AS rows_in_partition FROM batch GROUP BY 1""")
def q_catalog_partitions(spark, sf_dir):
    """Register the processed output as a table; partitions found by recovery."""
    import uuid
    path = _batch_output(spark, sf_dir, "catalog")
    name = f"processed_transactions_{uuid.uuid4().hex[:8]}"
    t = register_partitioned_table(spark, name, path, TR.PROCESSED_SCHEMA, ["event_date"])
    counts = stabilize(t.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows_in_partition")))
    spark.sql(f"DROP TABLE {name}")    # external: its files stay
    return counts


@register("clustered_write", O.with_(*O.chain(None)) + """
SELECT event_date, COUNT(*) AS rows_written, TRUE AS files_sorted, TRUE AS few_files FROM int_ev GROUP BY 1""")
def q_clustered_write(spark, sf_dir):
    """The events table as the chain writes it: by event_date, each file sorted by
    transaction_type, at most two files a day."""
    from pyspark.sql import Window
    root = scratch_path(spark, "clustered")
    INC.run_events_from_raw(spark, fx.raw_transactions(spark, sf_dir), fx.raw_payments(spark, sf_dir),
                            f"{root}/events", AS_OF, mode="full")
    back = spark.read.parquet(f"{root}/events").select(
        "event_date", "transaction_type", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"))
    w = Window.partitionBy("_file").orderBy("_row")
    back = back.withColumn("_ok", F.coalesce(
        F.lag("transaction_type").over(w) <= F.col("transaction_type"), F.lit(True)))
    return back.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows_written"),
                                          F.bool_and("_ok").alias("files_sorted"),
                                          (F.count_distinct("_file") <= 2).alias("few_files"))


# ---------------------------------------------------------------- incremental


# Data loaded up to this instant forms the first run.
CUTOFF = _dt.datetime(2024, 1, 20, 0, 0, 0)
CUTOFF_SQL = "TIMESTAMP '2024-01-20 00:00:00'"


def _staged_until(spark, sf_dir, tx_cutoff, pay_cutoff, as_of):
    rt = fx.raw_transactions(spark, sf_dir)
    rp = fx.raw_payments(spark, sf_dir)
    if tx_cutoff is not None:
        rt = rt.where(F.col("loaded_at") <= F.lit(tx_cutoff).cast("timestamp_ntz"))
    if pay_cutoff is not None:
        rp = rp.where(F.col("loaded_at") <= F.lit(pay_cutoff).cast("timestamp_ntz"))
    return stg_transactions(rt, as_of, None), stg_payments(rp, as_of, None)


def _raw_until(raw, cutoff):
    return raw if cutoff is None else raw.where(F.col("loaded_at") <= F.lit(cutoff).cast("timestamp_ntz"))


def _two_runs(spark, sf_dir, name, tx_cutoff, pay_cutoff, with_fact=False, corrections=False):
    """Full run on what arrived up to the cutoff, then an incremental run on everything
    (with corrections of earlier transactions in the second, if asked for). The feeds are
    stored once, as a loader stores them: the runs read them a dozen times."""
    root = scratch_path(spark, name)
    ev_path, fact_path = f"{root}/events", f"{root}/daily"
    rt2 = fx.materialize_raw(fx.raw_transactions(spark, sf_dir), f"{root}/raw/transactions")
    rp2 = fx.materialize_raw(fx.raw_payments(spark, sf_dir), f"{root}/raw/payments")
    rt1, rp1 = _raw_until(rt2, tx_cutoff), _raw_until(rp2, pay_cutoff)
    if corrections:
        late = fx.corrected_rows(fx.raw_transaction_rows(spark, sf_dir), CORRECTED_AT)
        rt2 = rt2.unionByName(fx.materialize_raw(fx.raw_transactions_of(late), f"{root}/raw/corrections"))
    if with_fact:
        INC.run_chain_from_raw(spark, rt1, rp1, ev_path, fact_path, CUTOFF, mode="full")
        INC.run_chain_from_raw(spark, rt2, rp2, ev_path, fact_path, AS_OF, mode="incremental")
    else:
        INC.run_events_from_raw(spark, rt1, rp1, ev_path, CUTOFF, mode="full")
        INC.run_events_from_raw(spark, rt2, rp2, ev_path, AS_OF, mode="incremental")
    return ev_path, fact_path


# When the corrections of the incremental queries arrive.
CORRECTED_AT = AS_OF - _dt.timedelta(hours=1)
_CORRECTED = O.chain_of(O.corrected(f"{O.AS_OF} - INTERVAL 1 HOUR"))


_EVENTS_NO_META = "SELECT * EXCLUDE (_dbt_updated_at) FROM int_ev"


@register("lookback_filter", O.with_(O.EV, O.RAW_TX, O.stg_tx(None),
                                     O.stg_tx(None, "stg_cut", f" AND loaded_at <= {CUTOFF_SQL}")) + """
SELECT transaction_id, posted_at FROM stg_tx
WHERE posted_at >= (SELECT coalesce(max(posted_at), TIMESTAMP '1900-01-01') FROM stg_cut)
                   - INTERVAL 6 HOUR""")
def q_lookback_filter(spark, sf_dir):
    """High-water mark of the target minus 6 h selects the rows to redo."""
    root = scratch_path(spark, "lookback")
    st1, sp1 = _staged_until(spark, sf_dir, CUTOFF, CUTOFF, CUTOFF)
    INC.run_events(spark, st1, sp1, f"{root}/events", CUTOFF, mode="full")
    hw = INC.high_water_mark(spark, f"{root}/events", "posted_at")
    st_all = stg_transactions(fx.raw_transactions(spark, sf_dir), AS_OF, None)
    from ledgerflow.functions.expressions import incremental_predicate
    return st_all.where(incremental_predicate("posted_at", hw, 6)).select("transaction_id",
                                                                          "posted_at")


@register("incremental_events", O.with_(*_CORRECTED) + _EVENTS_NO_META)
def q_incremental_events(spark, sf_dir):
    """Full run on early data, incremental merge on the rest == full refresh; moved
    and lost posting times and a day that loses all its transactions included."""
    ev_path, _ = _two_runs(spark, sf_dir, "inc_events", CUTOFF, CUTOFF, corrections=True)
    return spark.read.parquet(ev_path).select(*EVENT_SCHEMA.names).drop("_dbt_updated_at")


@register("incremental_daily", O.with_(*_CORRECTED, O.daily_agg("int_ev"))
          + O.DAILY_SELECT.replace(", _dbt_updated_at", "") + " FROM daily")
def q_incremental_daily(spark, sf_dir):
    """I2/I5/§2.13 #9: whole-day fact recompute after an incremental events merge, the day of
    unknown posting times and the emptied day included."""
    _, fact_path = _two_runs(spark, sf_dir, "inc_daily", CUTOFF, CUTOFF, with_fact=True, corrections=True)
    return round_money(spark.read.parquet(fact_path)).drop("_dbt_updated_at")


@register("late_settlement_relink", O.with_(*O.chain(None)) + _EVENTS_NO_META)
def q_late_settlement_relink(spark, sf_dir):
    """§2.13 #10: settlements arriving after the transactions' look-back still link."""
    ev_path, _ = _two_runs(spark, sf_dir, "relink", None, CUTOFF)
    return spark.read.parquet(ev_path).drop("_dbt_updated_at")


@register("hourly_from_loads", O.with_(*O.chain(None), O.daily_agg("int_ev")) + """
SELECT event_date, SUM(total_transactions) AS total_transactions, SUM(approved_transactions) AS approved_transactions,
       SUM(payments_linked) AS payments_linked, round(SUM(total_spend), 2) AS total_spend,
       (SELECT COUNT(*) FROM int_ev i WHERE i.event_date = daily.event_date) AS events
FROM daily GROUP BY event_date""")
def q_hourly_from_loads(spark, sf_dir):
    """Land both feeds, load, full run, land more, load, incremental run == full refresh."""
    root = scratch_path(spark, "hourly")
    feeds = {"transactions": (fx.raw_transaction_rows(spark, sf_dir), TRANSACTION_COLUMNS),
             "payments": (fx.raw_payment_rows(spark, sf_dir), PAYMENT_COLUMNS)}
    early = F.col("loaded_at") <= F.lit(CUTOFF).cast("timestamp_ntz")
    for part, as_of, mode in ((early, CUTOFF, "full"), (~early, AS_OF, "incremental")):
        for feed, (rows, columns) in feeds.items():
            res = L.land(rows.where(part), root, feed, columns, "loaded_at", fmt="lines")
            LD.load(spark, res.prefix, f"{root}/raw/{feed}", f"{root}/ledger/{feed}", as_of, feed=feed)
        jobs.run_hourly(spark, *((f"{root}/raw/{f}", f"{root}/ledger/{f}") for f in feeds), f"{root}/events", f"{root}/daily",
                        as_of, mode)
    fact = read_table(spark, f"{root}/daily", FACT_SCHEMA)
    events = read_table(spark, f"{root}/events", EVENT_SCHEMA).groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))
    per_day = fact.groupBy("event_date").agg(
        *(F.sum(c).alias(c) for c in ("total_transactions", "approved_transactions", "payments_linked")),
        F.round(F.sum("total_spend"), 2).alias("total_spend"))
    return per_day.join(events, "event_date", "left")


@register("schema_sync", O.with_(*O.chain(None)) + """
SELECT * EXCLUDE (_dbt_updated_at) REPLACE (CASE WHEN event_date = (SELECT max(event_date) FROM int_ev) THEN amount_tier END AS amount_tier)
FROM int_ev""")
def q_schema_sync(spark, sf_dir):
    """I4: merge one day into a table written with an older schema (one column missing, one
    extra); every day reads with the declared schema."""
    path = f"{scratch_path(spark, 'schema_sync')}/events"
    events = stabilize(int_events(spark, sf_dir))
    write_full(events.drop("amount_tier").withColumn("legacy_score", F.lit(0.0)), path, "event_date")
    day = events.agg(F.max("event_date")).first()[0]
    merge_by_key(spark, path, events.where(F.col("event_date") == F.lit(day)), ["event_key"], "event_date")
    return read_table(spark, path, EVENT_SCHEMA).drop("_dbt_updated_at")


# ---------------------------------------------------------------- quality


_QUALITY_SQL = O.with_(*O.chain(None), O.daily_agg("int_ev"),
                       f"fct AS (SELECT {O.key_sql(O.date_text('event_date'), 'CAST(card_id AS VARCHAR)', 'geo_type')} AS daily_key, * FROM daily)") + """
SELECT 'int_credit_card_events' AS table_name, rule, column_name, failing_rows FROM (
  SELECT 'not_null' AS rule, 'transaction_id' AS column_name, COUNT(*) FILTER (WHERE transaction_id IS NULL) AS failing_rows FROM int_ev
  UNION ALL SELECT 'not_null', 'event_key', COUNT(*) FILTER (WHERE event_key IS NULL) FROM int_ev
  UNION ALL SELECT 'not_null', 'member_id', COUNT(*) FILTER (WHERE member_id IS NULL) FROM int_ev
  UNION ALL SELECT 'accepted_values', 'geo_type', COUNT(*) FILTER (WHERE geo_type NOT IN ('INTERNATIONAL', 'DOMESTIC')) FROM int_ev
  UNION ALL SELECT 'accepted_values', 'amount_tier', COUNT(*) FILTER (WHERE amount_tier NOT IN ('HIGH', 'MEDIUM', 'LOW')) FROM int_ev
  UNION ALL SELECT 'accepted_values', 'transaction_status', COUNT(*) FILTER (WHERE transaction_status NOT IN ('APPROVED', 'DECLINED', 'PENDING')) FROM int_ev
  UNION ALL SELECT 'accepted_values', 'payment_status', COUNT(*) FILTER (WHERE payment_status NOT IN ('SETTLED')) FROM int_ev
  UNION ALL SELECT 'unique', 'event_key,payment_id', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (
      SELECT COUNT(*) AS n FROM int_ev GROUP BY event_key, payment_id HAVING COUNT(*) > 1))
UNION ALL
SELECT 'fct_credit_card_daily', rule, column_name, failing_rows FROM (
  SELECT 'not_null' AS rule, 'daily_key' AS column_name, COUNT(*) FILTER (WHERE daily_key IS NULL) AS failing_rows FROM fct
  UNION ALL SELECT 'not_null', 'event_date', COUNT(*) FILTER (WHERE event_date IS NULL) FROM fct
  UNION ALL SELECT 'approved_plus_declined', 'total_transactions',
      COUNT(*) FILTER (WHERE approved_transactions + declined_transactions <> total_transactions) FROM fct
  UNION ALL SELECT 'unique', 'daily_key', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (
      SELECT COUNT(*) AS n FROM fct GROUP BY daily_key HAVING COUNT(*) > 1)
  UNION ALL SELECT 'unique', 'event_date,card_id,member_id,geo_type', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (
      SELECT COUNT(*) AS n FROM fct GROUP BY event_date, card_id, member_id, geo_type HAVING COUNT(*) > 1))
"""


@register("quality_report", _QUALITY_SQL)
def q_quality_report(spark, sf_dir):
    """Rule results over the events table and the daily fact."""
    ev = int_events(spark, sf_dir)
    fact = daily_fact(ev, AS_OF)
    return (QL.evaluate(ev, "int_credit_card_events", QL.events_rules())
              .unionByName(QL.evaluate(fact, "fct_credit_card_daily", QL.daily_rules(published_key=True))))


@register("quality_gate", O.with_(*O.chain(None)) + """
SELECT 'every_row' AS scope, COUNT(*) FILTER (WHERE transaction_status NOT IN ('APPROVED', 'DECLINED', 'PENDING')) = 0 AS passed
FROM int_ev UNION ALL SELECT 'accepted_rows', TRUE""")
def q_quality_gate(spark, sf_dir):
    """The gate fails a run with a rule violation and passes one without."""
    events = stabilize(int_events(spark, sf_dir))
    ok = F.col("transaction_status").isin(QL.TRANSACTION_STATUSES)
    out = []
    for scope, rows in (("every_row", events), ("accepted_rows", events.where(ok))):
        try:
            QL.gate(QL.evaluate(rows, "int_credit_card_events", QL.events_rules()))
            out.append((scope, True))
        except QL.QualityGateError:
            out.append((scope, False))
    return spark.createDataFrame(out, "scope string, passed boolean")


# ---------------------------------------------------------------- streaming


# Files per micro-batch in the registered streaming queries, so
# the merge runs over several epochs.
STREAM_FILES_PER_TRIGGER = 600


def _run_sink(spark, root, feed, sink):
    """Process what has landed of a feed since its last run."""
    s = ST.landed_files(spark, f"{root}/{feed}", max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    ST.run_available(s.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/_chk_{feed}"))


@register("stream_ingest", O.with_(O.EV, O.RAW_TX) + "SELECT "
          + ", ".join(f"CASE WHEN event_id % 97 <> 0 THEN {c} END AS {c}" for c in TRANSACTION_COLUMNS)
          + ", CASE WHEN event_id % 97 <> 0 THEN 'kept' END AS extra, event_id % 97 = 0 AS is_error FROM raw_tx")
def q_stream_ingest(spark, sf_dir):
    """K1/A10: file-source stream of landed arrays -> raw table: payloads as landed (unknown fields
    and text amounts too), rejects kept."""
    root = scratch_path(spark, "stream_ingest")
    fields = [F.col(c).cast("string").alias(c) if c == "amount" else F.col(c) for c in TRANSACTION_COLUMNS]
    text = F.when(F.col("event_id") % fx.BAD_PAYLOAD_EVERY == 0, F.lit(BAD_ELEMENT)) \
            .otherwise(fx.to_json_payload([*fields, F.lit("kept").alias("extra")]))
    _land_transactions(spark, sf_dir, root, payload=text)
    _run_sink(spark, root, "transactions", ST.ingest_sink(f"{root}/raw", TRANSACTION_ROUTING))
    raw = ST.read_epochs(spark, f"{root}/raw")
    raw = raw.withColumn("raw_payload", F.when(~F.col("is_error"), F.col("raw_payload")))
    return X.parsed_fields(raw.withColumn("extra", F.get_json_object("raw_payload", "$.extra")), "raw_payload",
                           TRANSACTION_FIELDS, ["extra", "is_error"])


@register("stream_dedupe", O.with_(O.EV, O.RAW_TX)
          + f"SELECT {O.TX_FIELDS} FROM raw_tx WHERE resend_set = 'A'")
def q_stream_dedupe(spark, sf_dir):
    """K2: watermark dedupe keeps the first arrival; re-sends landed later are dropped."""
    root = scratch_path(spark, "stream_dedupe")
    rows = fx.raw_transaction_rows(spark, sf_dir)
    prefix = L.land(rows.where(F.col("resend_set") == "A"), root, "transactions",
                    TRANSACTION_COLUMNS, "loaded_at").prefix

    def run():
        s = ST.dedupe_first_arrival(ST.transaction_stream(spark, prefix))
        ST.run_available(s.select(*TRANSACTION_COLUMNS).writeStream.format("parquet")
                         .option("checkpointLocation", f"{root}/_chk_dedupe")
                         .option("path", f"{root}/dedup"), spark)
    run()
    L.land(rows.where(F.col("resend_set") == "B"), root, "transactions",
           TRANSACTION_COLUMNS, "loaded_at")
    run()
    return spark.read.parquet(f"{root}/dedup")


def _stream_merge(spark, sf_dir, name, with_fact):
    """Both feeds as streams, three waves: first versions, re-sends (with late settlements),
    and versions tied with the first on their authorization time."""
    root = scratch_path(spark, name)
    tables = ST.StreamTables(f"{root}/raw_tx", f"{root}/raw_pay", f"{root}/events", f"{root}/daily" if with_fact else None)
    tx, pay = fx.raw_transaction_rows(spark, sf_dir), fx.raw_payment_rows(spark, sf_dir)
    waves = [(tx.where(F.col("resend_set") == w), pay.where(F.col("resend_set") == w)) for w in ("A", "B")]
    for t, p in [*waves, (fx.restated_rows(tx), None)]:
        L.land(t, root, "transactions", TRANSACTION_COLUMNS, "loaded_at")
        _run_sink(spark, root, "transactions", ST.transactions_sink(spark, tables, AS_OF, arrival=lambda epoch: AS_OF))
        if p is not None:
            L.land(p, root, "payments", PAYMENT_COLUMNS, "loaded_at")
            _run_sink(spark, root, "payments", ST.payments_sink(spark, tables, AS_OF, arrival=lambda epoch: AS_OF))
    return tables


@register("stream_merge", O.with_(*O.chain_of(O.RESTATED)) + _EVENTS_NO_META)
def q_stream_merge(spark, sf_dir):
    """K4: foreachBatch merges of arriving transactions and payments == full refresh."""
    return read_table(spark, _stream_merge(spark, sf_dir, "stream_merge", False).events, EVENT_SCHEMA).drop("_dbt_updated_at")


@register("stream_daily", O.with_(*O.chain_of(O.RESTATED), O.daily_agg("int_ev"))
          + O.DAILY_SELECT.replace(", _dbt_updated_at", "") + " FROM daily")
def q_stream_daily(spark, sf_dir):
    """K5: touched days of the fact recomputed per micro-batch (exact distincts)."""
    fact = read_table(spark, _stream_merge(spark, sf_dir, "stream_daily", True).fact, FACT_SCHEMA)
    return round_money(fact).drop("_dbt_updated_at")


# First arrivals of both feeds: set A lands first; of a payment the first settled version counts.
_JOIN_SQL = O.with_(O.EV, O.RAW_TX, O.RAW_PAY) + f"""
, t AS (SELECT * FROM raw_tx WHERE resend_set = 'A' AND transaction_id IS NOT NULL),
p AS (SELECT * FROM raw_pay WHERE payment_status = 'SETTLED' AND payment_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY resend_set) = 1)
SELECT {', '.join('t.' + c for c in TRANSACTION_COLUMNS)}, p.payment_id, p.payment_type, p.payment_status, p.settled_at
FROM t LEFT JOIN p ON t.member_id = p.member_id AND t.amount = p.amount AND t.posted_at::DATE = p.scheduled_date
                  AND p.settled_at BETWEEN t.posted_at - INTERVAL 4 DAY AND t.posted_at + INTERVAL 4 DAY"""


def settle_streams(spark, sf_dir, root):
    """Both feeds deduplicated on the stream and joined stream to stream: the finished join and
    the transactions that it still holds are below ``root``."""
    feeds = {"transactions": (fx.raw_transaction_rows(spark, sf_dir), TRANSACTION_COLUMNS),
             "payments": (fx.raw_payment_rows(spark, sf_dir), PAYMENT_COLUMNS)}
    for wave in ("A", "B"):
        for feed, (rows, columns) in feeds.items():
            prefix = L.land(rows.where(F.col("resend_set") == wave), root, feed, columns, "loaded_at").prefix
            if feed == "transactions":
                s = ST.dedupe_first_arrival(ST.transaction_stream(spark, prefix))
            else:
                settled = ST.payment_stream(spark, prefix).where(F.col("payment_status") == "SETTLED")
                s = ST.dedupe_first_arrival(settled, "payment_id", "settled_at", delay=ST.HISTORY)
            ST.run_available(s.select(*columns).writeStream.format("parquet")
                             .option("checkpointLocation", f"{root}/_chk_{feed}").option("path", f"{root}/first/{feed}"), spark)
    read = lambda feed, schema: spark.readStream.schema(schema).parquet(f"{root}/first/{feed}")
    j = ST.settlement_join(read("transactions", TRANSACTION_SCHEMA), read("payments", PAYMENT_SCHEMA))
    ST.run_available(j.writeStream.format("parquet").outputMode("append")
                     .option("checkpointLocation", f"{root}/_chk_join")
                     .option("path", f"{root}/joined"), spark)
    return ST.flush_unmatched(spark, spark.read.schema(TRANSACTION_SCHEMA).parquet(f"{root}/first/transactions"),
                              spark.read.parquet(f"{root}/joined"))


@register("stream_settlement_join", _JOIN_SQL)
def q_stream_settlement_join(spark, sf_dir):
    """K3: both feeds deduplicated on the stream, joined stream to stream with watermarks; what
    the join still holds when the streams end is flushed, so every transaction is there."""
    return settle_streams(spark, sf_dir, scratch_path(spark, "stream_join"))


# ---------------------------------------------------------------- invalid UTF-8

def _with_invalid_byte(payload):
    """Insert one undecodable byte (0xFF) right after 'MERCHANT_' in the JSON text."""
    bad = F.unhex(F.lit("FF")).cast("string")
    return F.concat(F.substring_index(payload, "MERCHANT_", 1), F.lit("MERCHANT_"), bad,
                    F.substring_index(payload, "MERCHANT_", -1))


@register("utf8_repair", O.with_(O.EV, O.RAW_TX) + """
SELECT transaction_id,
       CASE WHEN event_id % 97 = 0 THEN 'MERCHANT_' || chr(65533) || CAST(k AS VARCHAR)
            ELSE merchant_name END AS merchant_name,
       event_id % 97 = 0 AS repaired
FROM raw_tx JOIN (SELECT event_id AS eid, k FROM ev) e ON e.eid = raw_tx.event_id""")
def q_utf8_repair(spark, sf_dir):
    """A4: files with undecodable bytes load with U+FFFD instead of losing records."""
    root = scratch_path(spark, "utf8")
    payload = fx.to_json_payload(TRANSACTION_COLUMNS)
    payload = F.when(F.col("event_id") % fx.BAD_PAYLOAD_EVERY == 0,
                     _with_invalid_byte(payload)).otherwise(payload)
    res = _land_transactions(spark, sf_dir, root, payload=payload)
    LD.load(spark, res.prefix, f"{root}/raw", f"{root}/ledger", AS_OF)
    raw = LD.read_raw_table(spark, f"{root}/raw", f"{root}/ledger")
    parsed = parse_raw(raw, TRANSACTION_FIELDS, None, None)
    return parsed.select("transaction_id", "merchant_name",
                         F.col("merchant_name").contains("�").alias("repaired"))

"""Structured Streaming forms of ingest, dedupe, linking and merge (A10, K1-K5).

* ``transaction_stream`` – file source over landed JSON arrays (K1/A10).
* ``dedupe_first_arrival`` – watermark + ``dropDuplicatesWithinWatermark``:
  the first arrival of a transaction_id wins; state is bounded by the
  watermark delay (K2).
* ``settlement_join`` – stream-stream LEFT OUTER join of transactions to
  settled payments with a bounded event-time range, so both sides' state is
  evicted by the watermarks; unmatched transactions are emitted once the
  watermark passes their range (K3).
* ``ingest_sink`` / ``transactions_sink`` / ``payments_sink`` – ``foreachBatch``
  functions over ``landed_files``: each epoch appends its records as landed
  (rejects kept and counted, nothing re-made from typed fields) to a raw table,
  overwriting its own epoch folder, so a replayed epoch is idempotent. The
  transactions sink then merges exactly the transactions that arrived, the
  payments sink those that a settled version of a payment that arrived links, or
  once linked (late settlements relink); both recompute the touched days of the fact (K4/K5).
  In the merging sinks distinct counts stay exact because days are recomputed from the
  events table instead of kept as streaming state. Raw epochs are partitioned by route day and
  payloads are read only from days that hold a version of a changed record, so an
  epoch costs what it changes. One of the two streams at a time writes the tables.
* ``daily_state_stream`` – the daily fact as a stateful windowed aggregation in update
  mode, distinct counts as mergeable sketches (K5).

Watermarks need zoned timestamps: NTZ event times are cast to TIMESTAMP with
the session zone pinned to UTC.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerflow.functions.expressions import PAYMENT_SETTLED, event_date
from ledgerflow.operators.daily import GRAIN
from ledgerflow.operators.merge import EVENTS_LAYOUT, merge_by_key, stabilize, table_exists
from ledgerflow.operators.rollup import state_measures
from ledgerflow.operators.transform import cluster_for_write
from ledgerflow.plans.incremental import (
    events_for_keys, merge_candidates, relinked_transactions, run_daily, with_routing,
)
from ledgerflow.schemas import (
    PAYMENT_ROUTING, PAYMENT_SCHEMA, TRANSACTION_COLUMNS, TRANSACTION_ROUTING, TRANSACTION_SCHEMA,
)
from ledgerflow.session import delete_path, list_entries, path_exists
from ledgerflow.sources.json_files import explode_json_text

# Watermark delay for transactions (settlement lag), and the
# event-time range, on either side of the posting time, in which a settlement links.
TRANSACTION_WATERMARK = "3 days"
SETTLEMENT_RANGE = "4 days"
#: Delay that no event of a bounded history exceeds: nothing is late.
HISTORY = "3650 days"

#: State lies on disk, with bounded memory: kept on the heap, as by default, it holds every key
#: and joined row of a history at once. Nothing reads the number of its rows, which costs a look-up a write.
_STORE = "spark.sql.streaming.stateStore"
STATE_STORE = {f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
               f"{_STORE}.rocksdb.boundedMemoryUsage": "true", f"{_STORE}.rocksdb.maxMemoryUsageMB": "400"}

RAW_EPOCH_SCHEMA = T.StructType([
    T.StructField("raw_payload", T.StringType()), T.StructField("loaded_at", T.TimestampNTZType()),
    T.StructField("source_file", T.StringType()), T.StructField("source_row", T.LongType()),
    T.StructField("file_mtime", T.TimestampType()), T.StructField("is_error", T.BooleanType()),
    T.StructField("record_key", T.StringType()), T.StructField("epoch", T.LongType()),
    T.StructField("route_date", T.DateType()),
])


@dataclass(frozen=True)
class StreamTables:
    """Paths of the tables that the merging sinks keep."""
    raw_tx: str
    raw_pay: str
    events: str
    fact: str | None = None


def json_array_stream(spark: SparkSession, path: str, schema: T.StructType,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming fixed-schema scan of landed JSON-array files (A10/K1)."""
    reader = (spark.readStream.schema(schema)
              .option("multiLine", True)
              .option("mode", "PERMISSIVE")
              .option("recursiveFileLookup", True)
              .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path).withColumn("source_file", F.col("_metadata.file_path"))


def transaction_stream(spark: SparkSession, path: str, **kw) -> DataFrame:
    return json_array_stream(spark, path, TRANSACTION_SCHEMA, **kw)


def payment_stream(spark: SparkSession, path: str, **kw) -> DataFrame:
    return json_array_stream(spark, path, PAYMENT_SCHEMA, **kw)


def landed_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of whole landed files: ``text, source_file, file_mtime``."""
    reader = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(F.make_valid_utf8("value").alias("text"),
                                    F.col("_metadata.file_path").alias("source_file"),
                                    F.col("_metadata.file_modification_time").alias("file_mtime"))


def _arrival(epoch_id: int) -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def append_epoch(files: DataFrame, epoch_id: int, raw_path: str, routing: tuple[str, str],
                 arrival=_arrival) -> DataFrame:
    """Write one micro-batch of landed files as an epoch of the raw table; returns its rows.

    ``arrival(epoch)`` is the load time of the epoch; versions of equal times
    rank by epoch and landing time of their file."""
    rows = with_routing(explode_json_text(files), routing)
    good = ~F.col("is_error")
    path = f"{raw_path}/epoch={epoch_id}"
    rows = rows.select("raw_payload", F.lit(arrival(epoch_id)).cast("timestamp_ntz").alias("loaded_at"), "source_file",
                       "source_row", "file_mtime", "is_error", F.when(good, F.col("record_key")).alias("record_key"),
                       F.when(good, F.col("route_date")).alias("route_date"))
    # Files reach a task by size, so each task holds rows of many days: brought together first,
    # or each would write a file a day and every later read of the table opens them all.
    (cluster_for_write(rows, "route_date", [])
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("route_date").parquet(path))
    return files.sparkSession.read.schema(RAW_EPOCH_SCHEMA).option("basePath", raw_path).parquet(path)


def read_epochs(spark: SparkSession, raw_path: str) -> DataFrame:
    """The raw table that the sinks append to (empty before the first epoch)."""
    if not path_exists(spark, raw_path):
        return spark.createDataFrame([], RAW_EPOCH_SCHEMA)
    return spark.read.schema(RAW_EPOCH_SCHEMA).option("basePath", raw_path).parquet(raw_path)


def with_event_time(df: DataFrame, ntz_col: str, name: str = "event_ts") -> DataFrame:
    return df.withColumn(name, F.col(ntz_col).cast(T.TimestampType()))


def dedupe_first_arrival(stream: DataFrame, key: str = "transaction_id",
                         time_col: str = "posted_at",
                         delay: str = TRANSACTION_WATERMARK) -> DataFrame:
    """First arrival per key within the watermark (K2). NULL keys are dropped."""
    s = with_event_time(stream.where(F.col(key).isNotNull()), time_col)
    return s.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark([key])


def settlement_join(tx: DataFrame, pay: DataFrame,
                    tx_delay: str = TRANSACTION_WATERMARK,
                    pay_delay: str = TRANSACTION_WATERMARK,
                    settle_range: str = SETTLEMENT_RANGE) -> DataFrame:
    """Transactions LEFT OUTER JOIN settled payments, as a stream-stream join (K3). A settlement
    links from ``settle_range`` before the posting time to as long after it; others are lost here."""
    t = (with_event_time(tx, "posted_at", "t_ts").withWatermark("t_ts", tx_delay)
         .withColumn("t_date", event_date("posted_at")))
    p = (with_event_time(pay.where(F.col("payment_status") == PAYMENT_SETTLED), "settled_at", "p_ts")
         .withWatermark("p_ts", pay_delay)
         .select(F.col("member_id").alias("p_member_id"), F.col("amount").alias("p_amount"),
                 F.col("scheduled_date").alias("p_date"), "payment_id", "payment_type",
                 "payment_status", "settled_at", "p_ts"))
    cond = F.expr(f"""t_member = p_member_id AND t_amount = p_amount AND t_date = p_date
                     AND p_ts >= t_ts - INTERVAL {settle_range} AND p_ts <= t_ts + INTERVAL {settle_range}""")
    t = t.withColumnRenamed("member_id", "t_member").withColumnRenamed("amount", "t_amount")
    j = t.join(p, cond, "leftOuter")
    return (j.withColumnRenamed("t_member", "member_id").withColumnRenamed("t_amount", "amount")
             .select(*TRANSACTION_COLUMNS, "payment_id", "payment_type", "payment_status",
                     "settled_at"))


def run_available(stream_writer, spark: SparkSession | None = None,
                  state_partitions: int | None = None) -> StreamingQuery:
    """Process everything available now, then stop (batch-like catch-up run).

    The number of state-store partitions of a stateful stream is fixed by
    ``spark.sql.shuffle.partitions`` when its checkpoint is created and
    cannot change later. ``state_partitions`` (default: the cluster's task
    slots) sets it for this stream only: the stream clones the session
    configuration at start, so the session's own value is restored at once.
    So it is with ``STATE_STORE``; a stream goes on with the store of its checkpoint.
    """
    if spark is None:
        q = stream_writer.trigger(availableNow=True).start()
    else:
        own = {"spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism), **STATE_STORE}
        before = {k: spark.conf.get(k, None) for k in own}
        for k, v in own.items():
            spark.conf.set(k, v)
        try:
            q = stream_writer.trigger(availableNow=True).start()
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def ingest_sink(raw_path: str, routing: tuple[str, str], arrival=_arrival):
    """``foreachBatch`` function: landed files to raw rows (K1/A10)."""
    def handle(files: DataFrame, epoch_id: int) -> None:
        append_epoch(files, epoch_id, raw_path, routing, arrival)
    return handle


def _good(raw: DataFrame) -> DataFrame:
    return raw.where(~F.col("is_error"))


def _merge_and_refresh(spark, tables: StreamTables, keys: DataFrame, as_of: dt.datetime) -> None:
    keys = stabilize(keys)
    raw_tx, raw_pay = (_good(read_epochs(spark, p)) for p in (tables.raw_tx, tables.raw_pay))
    if not table_exists(spark, tables.events):
        batch, days = events_for_keys(raw_tx, raw_pay, keys, as_of)
        touched = merge_by_key(spark, tables.events, batch, ["transaction_id"], EVENTS_LAYOUT, partitions=days) if days else []
    else:
        touched = merge_candidates(spark, tables.events, raw_tx, raw_pay, keys, as_of)
    if touched and tables.fact is not None:
        run_daily(spark, tables.events, tables.fact, as_of, "incremental", touched_days=touched)


def transactions_sink(spark: SparkSession, tables: StreamTables, as_of: dt.datetime, arrival=_arrival):
    """``foreachBatch`` function: append arrived transactions and merge their events (K4/K5)."""
    def handle(files: DataFrame, epoch_id: int) -> None:
        epoch = append_epoch(files, epoch_id, tables.raw_tx, TRANSACTION_ROUTING, arrival)
        keys = _good(epoch).where(F.col("record_key").isNotNull()).select("record_key").distinct()
        _merge_and_refresh(spark, tables, keys, as_of)
    return handle


def payments_sink(spark: SparkSession, tables: StreamTables, as_of: dt.datetime, arrival=_arrival):
    """``foreachBatch`` function: append arrived payments and relink the transactions that share
    member, amount and day with any settled version of them."""
    def handle(files: DataFrame, epoch_id: int) -> None:
        epoch = append_epoch(files, epoch_id, tables.raw_pay, PAYMENT_ROUTING, arrival)
        if not table_exists(spark, tables.events):
            return
        changed = stabilize(_good(epoch).where(F.col("record_key").isNotNull()).select("record_key").distinct())
        raw_pay = _good(read_epochs(spark, tables.raw_pay))
        keys = relinked_transactions(spark, tables.events, raw_pay, changed, as_of, by_amount=True)
        _merge_and_refresh(spark, tables, keys.distinct(), as_of)
    return handle


def daily_state_stream(events: DataFrame, delay: str = TRANSACTION_WATERMARK) -> DataFrame:
    """Running daily states as a stateful aggregation (K5): a one-day window and the grain,
    measures that merge and sketches for the distinct counts. State of a day is dropped
    once the watermark has passed it; later events of it, and events without a time, are
    not counted. Use update mode: each epoch gives the whole new state of changed groups."""
    s = with_event_time(events, "posted_at").withWatermark("event_ts", delay)
    keys = [c for c in GRAIN if c != "event_date"]
    agg = s.groupBy(F.window("event_ts", "1 day"), *keys).agg(*state_measures())
    return agg.select(F.to_date("window.start").alias("event_date"), *keys, *[c for c in agg.columns if c not in ("window", *keys)])


def states_sink(path: str):
    """``foreachBatch`` function: the changed states of an epoch, written to its own folder."""
    def handle(states: DataFrame, epoch_id: int) -> None:
        states.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/epoch={epoch_id}")
    return handle


#: Compacted epochs count from here, so they sort by age and before every epoch of the stream.
_COMPACTED = -10**12


def _state_epochs(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    states = spark.read.option("basePath", path).parquet(path).withColumn("epoch", F.col("epoch").cast("long"))
    return states if upto is None else states.where(F.col("epoch") <= upto)


def _newest(states: DataFrame) -> DataFrame:
    measures = [c for c in states.columns if c not in (*GRAIN, "epoch")]
    return states.groupBy(*GRAIN).agg(F.max_by(F.struct(*measures), "epoch").alias("s")).select(*GRAIN, "s.*")


def current_states(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of every group over all epochs."""
    return _newest(_state_epochs(spark, path))


def compact_states(spark: SparkSession, path: str, upto: int) -> None:
    """Fold the epochs up to ``upto`` into one folder, so that reads do not grow with the age
    of the stream. The old folders go only after it is written: a run that dies in between
    leaves states that repeat, never a missing one."""
    target = f"{path}/epoch={_COMPACTED + upto}"
    (_newest(_state_epochs(spark, path, upto)).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target))
    for folder in list_entries(spark, f"{path}/epoch=*"):
        epoch = int(folder.rstrip("/").rsplit("=", 1)[1])
        if epoch <= upto and epoch != _COMPACTED + upto:
            delete_path(spark, folder)


def flush_unmatched(spark: SparkSession, transactions: DataFrame, joined: DataFrame) -> DataFrame:
    """Rows of a finished settlement join: its own, and the transactions that it still
    held in state, without a payment."""
    held = transactions.select(*TRANSACTION_COLUMNS).join(joined.select("transaction_id"), "transaction_id", "left_anti")
    return joined.unionByName(held, allowMissingColumns=True)

"""Landing writer and extraction helpers (A12-A15, A7 path builder).

Layout: ``{root}/{feed}/year=YYYY/month=MM/day=DD/hour=HH/part-*.json``. The
same path builder serves the writer and the loader (one layout for both).

Two file formats:

* ``"array"`` – each file is one JSON array of at most ``batch_size`` records
  (the processor's landing format, fed to the outer-array strip).
* ``"lines"`` – one JSON document a line, at most ``batch_size`` lines a file:
  one shuffle by hour (AQE splits a hot one), no grouping.

Array chunks are formed without a window and with one shuffle. Rows are first
range-partitioned on (hour, source partition, record hash) and sorted within
each task, so a task holds a contiguous run of hours; a chunk is then a run of
consecutive rows of one task within one hour, joined and written by that task.
A chunk can never exceed the cap, a hot hour (or a record repeated many times)
is spread over several tasks, and the sort makes the chunks the same when a
task is retried. A run fills its files from its first record on, so a task
leaves at most one file of an hour short of the cap.
"""

from __future__ import annotations

import datetime as dt
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerflow.functions.expressions import (
    PAYMENT_TYPES, half_open_window, hour_floor, to_json_payload,
)
from ledgerflow.session import local_path, path_exists

# Records per landed file, landing partition columns.
BATCH_SIZE = 10_000
PARTITION_COLUMNS = ["year", "month", "day", "hour"]
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class ExtractionResult:
    feed: str
    records_extracted: int
    files_written: int
    prefix: str
    status: str


def partition_columns(ts: Column | str) -> list[Column]:
    c = F.col(ts) if isinstance(ts, str) else ts
    return [F.date_format(c, "yyyy").alias("year"), F.date_format(c, "MM").alias("month"),
            F.date_format(c, "dd").alias("day"), F.date_format(c, "HH").alias("hour")]


def partition_path(root: str, feed: str, date: dt.date | None = None,
                   hour: int | None = None) -> str:
    """Folder of one feed, day or hour (A7); ``date=None`` is the whole feed."""
    p = f"{root.rstrip('/')}/{feed}"
    if date is not None:
        p += f"/year={date:%Y}/month={date:%m}/day={date:%d}"
        if hour is not None:
            p += f"/hour={hour:02d}"
    return p


def extract_window(df: DataFrame, ts_col: str, start: dt.datetime,
                   end: dt.datetime | None = None) -> DataFrame:
    """Records with ``start <= ts < end``; ``end`` defaults to start + 1 h."""
    start = hour_floor(start) if end is None else start
    end = end or start + dt.timedelta(hours=1)
    return df.where(half_open_window(ts_col, start, end))


def payment_subset(df: DataFrame, types=PAYMENT_TYPES) -> DataFrame:
    """Payments restricted to the extracted event types."""
    return df.where(F.col("payment_type").isin(*types))


def _runs(batches: Iterator[pa.RecordBatch], batch_size: int) -> Iterator[tuple[tuple, list]]:
    """Runs of at most ``batch_size`` records of one hour, as they stand in a task; one at a time is held."""
    hour, run = None, []
    for batch in batches:
        *parts, records = (c.to_pylist() for c in batch.columns)
        for h, record in zip(zip(*parts), records):
            if run and (h != hour or len(run) == batch_size):
                yield hour, run
                run = []
            hour = h
            run.append(record)
    if run:
        yield hour, run


def _array_text(run: list) -> bytes:
    return b"[" + b",".join(r for r in run if r is not None) + b"]"


def _array_texts(batch_size: int):
    """The runs of a task as array texts."""
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hour, run in _runs(batches, batch_size):
            columns = [*(pa.array([h], pa.string()) for h in hour), pa.array([_array_text(run)], pa.binary()), pa.array([len(run)], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [*PARTITION_COLUMNS, "value", "_n"])
    return texts


def _array_files(batch_size: int, staging: str, name: str):
    """Writes the runs of a task as files below a folder of this attempt; gives the folder and its counts."""
    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        folder, made, n, records = f"{staging}/{task.taskAttemptId()}", set(), 0, 0
        for hour, run in _runs(batches, batch_size):
            to = "/".join([folder, *(f"{c}={NULL_PARTITION if h is None else h}" for c, h in zip(PARTITION_COLUMNS, hour))])
            if to not in made:
                os.makedirs(to, exist_ok=True)
                made.add(to)
            with open(f"{to}/part-{task.partitionId():05d}-{name}-c{n:06d}.txt", "xb") as f:
                f.write(_array_text(run) + b"\n")
            n, records = n + 1, records + len(run)
        yield pa.RecordBatch.from_arrays([pa.array([folder]), pa.array([n], pa.int64()), pa.array([records], pa.int64())],
                                         ["folder", "files", "records"])
    return files


def _move_into(folder: str, out: str) -> None:
    """Move the files below ``folder`` to the same places below ``out``, whole folders where none is there."""
    os.makedirs(out, exist_ok=True)
    for entry in os.scandir(folder):
        to = f"{out}/{entry.name}"
        if entry.is_dir() and os.path.isdir(to):
            _move_into(entry.path, to)
        else:
            os.rename(entry.path, to)


def _land_in_folder(rows: DataFrame, out: str, batch_size: int) -> tuple[int, int]:
    """Write ``_hour_runs`` as array files of a mounted folder; returns records and files.

    The tasks write them themselves, as Hadoop's local file system starts processes for
    each file (it sets modes by ``chmod``). Files of the attempts that succeeded move into place
    once all have; nothing of another attempt is ever seen."""
    name = uuid.uuid4().hex[:12]
    staging = f"{out}/_staging-{name}"
    os.makedirs(staging)
    try:
        # One row a task.
        done = rows.mapInArrow(_array_files(batch_size, staging, name), "folder string, files long, records long").collect()
        for folder, n, _ in done:
            if n:
                _move_into(folder, out)
    finally:
        shutil.rmtree(staging, ignore_errors=True)
    open(f"{out}/_SUCCESS", "w").close()
    return sum(r.records for r in done), sum(r.files for r in done)


def _hour_runs(df: DataFrame, fields: list[str], time_col: str, payload: Column | None = None) -> DataFrame:
    rec = payload if payload is not None else to_json_payload(fields)
    rows = df.select(*partition_columns(time_col), F.spark_partition_id().alias("_src"),
                     rec.alias("_rec"))
    # Contiguous hour ranges per task (few files per hour). The range key goes
    # down to the source partition and the record hash, so one hour - or one
    # record repeated many times - still splits across tasks.
    order = [*PARTITION_COLUMNS, "_src", F.xxhash64("_rec"), "_rec"]
    rows = rows.repartitionByRange(*order[:-1]).sortWithinPartitions(*order)
    # Bytes, since a record may hold some that are no UTF-8.
    return rows.select(*PARTITION_COLUMNS, F.col("_rec").cast("binary").alias("_rec"))


def _array_chunks(df: DataFrame, fields: list[str], time_col: str,
                  batch_size: int, payload: Column | None = None) -> DataFrame:
    arrays = _hour_runs(df, fields, time_col, payload).mapInArrow(_array_texts(batch_size), ", ".join(f"{c} string" for c in PARTITION_COLUMNS)
                             + ", value binary, _n int")
    return arrays.withColumn("value", F.col("value").cast("string"))


def _count_files(df: DataFrame, path: str) -> int:
    spark = df.sparkSession
    if not path_exists(spark, path):
        return 0
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "part-*").load(path).select("path").count())


def land(df: DataFrame, root: str, feed: str, fields: list[str], time_col: str,
         batch_size: int = BATCH_SIZE, fmt: str = "array",
         mode: str = "append", payload: Column | None = None) -> ExtractionResult:
    """Write records under hour partitions of ``time_col`` (A12) and report.

    One write action; records and files are counted as they are written (by an
    ``Observation`` in Spark's writers), not by re-running the plan. ``status`` is ``empty`` when
    there was nothing to land. ``payload`` overrides the JSON text of each record.
    """
    out = partition_path(root, feed)
    obs = Observation(f"land_{feed}_{uuid.uuid4().hex[:8]}")
    if fmt == "array":
        folder = local_path(df.sparkSession, out)
        if folder is not None and mode == "append":
            records, files = _land_in_folder(_hour_runs(df, fields, time_col, payload), folder, batch_size)
            return ExtractionResult(feed, records, files, out, "success" if records else "empty")
        chunks = _array_chunks(df, fields, time_col, batch_size, payload)
        chunks = chunks.observe(obs, F.count(F.lit(1)).alias("files"),
                                F.coalesce(F.sum("_n"), F.lit(0)).alias("records"))
        (chunks.select(*PARTITION_COLUMNS, "value")
               .write.mode(mode).partitionBy(*PARTITION_COLUMNS)
               .option("maxRecordsPerFile", 1).option("compression", "none")
               .text(out))
        records, files = int(obs.get["records"]), int(obs.get["files"])
    elif fmt == "lines":
        rec = payload if payload is not None else to_json_payload(fields)
        rows = df.select(*partition_columns(time_col), rec.alias("value")).hint("rebalance", *PARTITION_COLUMNS)
        rows = rows.observe(obs, F.count(F.lit(1)).alias("records"))
        before = _count_files(df, out)
        (rows.write.mode(mode).partitionBy(*PARTITION_COLUMNS)
             .option("maxRecordsPerFile", batch_size).option("compression", "none").text(out))
        records = int(obs.get["records"])
        files = _count_files(df, out) - (before if mode == "append" else 0)
    else:
        raise ValueError(f"unknown landing format {fmt!r}")
    return ExtractionResult(feed, records, files, out, "success" if records else "empty")

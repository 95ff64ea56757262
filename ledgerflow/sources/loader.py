"""Idempotent bulk load of landed files into a raw table.

Raw table (Parquet, partitioned by ``load_date``, ``load_id``):
    raw_payload, loaded_at, source_file, source_row, file_size, file_mtime,
    is_error, record_key, route_date
Ledger (Parquet, partitioned by ``landing_date``, ``load_id``):
    source_file, file_size, file_mtime, rows_loaded, rows_errored, loaded_at

Files are found and loaded in batches of landing days, so what the driver lists
at once is bounded by those days, and the already-loaded check reads only their
ledger partitions. File names are compared on the executors.

Commit protocol on plain Parquet: a batch first appends its rows under a new
``load_id``, then appends its ledger partition. Readers only see loads that
have a ledger partition, and the file listing skips files already in the
ledger (same path, size and mtime). A load that dies between the two writes
leaves an invisible partition and its files are picked up again by the next
run, so every file is visible exactly once. Source files are never deleted.

Malformed input does not stop a load: a record that is not a JSON object, a CSV
line that does not fit its header and a Parquet file that is none are kept with
``is_error`` and counted as errored; the staging views read only good rows.

A JSON file larger than ``json_files.HELD_BYTES`` is never held whole: its text is read in parts,
brought into order by a sort and cut there.

CSV files are read in groups of one header. Parquet files are read together where
their schemas merge (Spark reads the footers in tasks), else in groups of one schema,
so each keeps its own columns and types. A Parquet file must give as many rows as its
footer says. A file that cannot be read to its end, or gives other rows, costs only
itself (``on_error="continue"``): once a write fails the files of the batch are read
again to find those, each becomes one error, and the others are written anew. Where no
file proves damaged (the store failed, say), and with ``on_error="abort"``, nothing of
the batch is committed, its rows are removed, and the next run tries again.
"""

from __future__ import annotations

import datetime as dt
import re
import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.expressions import as_of_literal
from ledgerflow.schemas import PAYMENT_ROUTING, ROUTING, TRANSACTION_ROUTING  # noqa: F401
from ledgerflow.session import delete_path, list_entries, path_exists
from ledgerflow.sources import json_files as J
from ledgerflow.sources.json_files import explode_json_text, list_files

RAW_TABLE_SCHEMA = T.StructType([
    T.StructField("raw_payload", T.StringType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("source_row", T.LongType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("file_mtime", T.TimestampType()),
    T.StructField("is_error", T.BooleanType()),
    T.StructField("record_key", T.StringType()),
    T.StructField("route_date", T.DateType()),
    T.StructField("load_date", T.DateType()),
    T.StructField("load_id", T.StringType()),
])

LEDGER_SCHEMA = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("file_mtime", T.TimestampType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("rows_errored", T.LongType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
    T.StructField("landing_date", T.DateType()),
    T.StructField("load_id", T.StringType()),
])

FILE_KEY = ["source_file", "file_size", "file_mtime"]
#: Landing days that one batch covers at most.
BATCH_DAYS = 31


@dataclass
class LoadResult:
    files_processed: int
    rows_loaded: int
    rows_errored: int
    duration_seconds: float
    status: str


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    return _read_or_empty(spark, ledger_path, LEDGER_SCHEMA)


def read_raw_table(spark: SparkSession, target_path: str, ledger_path: str,
                   include_errors: bool = False) -> DataFrame:
    """Committed rows of the raw table (loads that reached the ledger)."""
    raw = _read_or_empty(spark, target_path, RAW_TABLE_SCHEMA)
    committed = read_ledger(spark, ledger_path).select("load_id").distinct()
    raw = raw.join(committed, "load_id", "left_semi")
    if not include_errors:
        raw = raw.where(~F.col("is_error"))
    return raw


def _name(path: Column) -> Column:
    """One spelling of a file's path, whichever reader names it."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def batches(spark: SparkSession, source: str | list[str], days: int = BATCH_DAYS) -> list[list[str]]:
    """Paths below the sources, in groups of at most ``days`` landing days. Whatever
    lies beside the ``year=/month=/day=`` folders makes a group of its own."""
    out: list[list[str]] = []
    for root in [source] if isinstance(source, str) else list(source):
        if not path_exists(spark, root):
            continue
        root = root.rstrip("/")
        found = list_entries(spark, f"{root}/year=*/month=*/day=*")
        if not found:
            out.append([root])
            continue
        out += [found[i:i + days] for i in range(0, len(found), days)]
        beside = [p for pattern, part in (("*", "year="), ("year=*/*", "month="), ("year=*/month=*/*", "day="))
                  for p in list_entries(spark, f"{root}/{pattern}") if not p.rsplit("/", 1)[1].startswith((part, "_", "."))]
        if beside:
            out.append(beside)
    return out


def _read_files(spark: SparkSession, paths: list[str], glob: str | None) -> DataFrame | None:
    """Files below ``paths``: FILE_KEY and content (read only where it is used)."""
    try:
        files = list_files(spark, paths, glob)
    except AnalysisException:      # e.g. a folder without any matching file
        return None
    return files.select(_name(F.col("path")).alias("source_file"), F.col("length").alias("file_size"),
                        F.col("modificationTime").alias("file_mtime"), "content")


def _csv_header(spark: SparkSession, path: str) -> str | None:
    """First line of a CSV file that is not blank; None if there is none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(conf).open(at)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        while (line := lines.readLine()) is not None:
            if line.strip():
                return line
        return None
    finally:
        stream.close()


def _parquet_footer(spark: SparkSession, path: str) -> tuple[str, int] | None:
    """Schema and row count of a Parquet file's footer; None if the file has none.
    Any other failure, as of the store, is raised."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.parquet.hadoop
    try:
        reader = hadoop.ParquetFileReader.open(hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf))
    except Py4JJavaError as e:
        if re.search("is not a Parquet file|can not read class org.apache.parquet.format|corrupted file", str(e.java_exception)):
            return None
        raise
    try:
        return reader.getFileMetaData().getSchema().toString(), reader.getRecordCount()
    finally:
        reader.close()


def _literal(paths: list[str]) -> list[str]:
    """Paths as the readers take them, which read patterns."""
    return [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths]


def _file_path() -> Column:
    return _name(F.try_url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


def _parquet_groups(spark: SparkSession, paths: list[str]) -> tuple[dict, dict]:
    """Files by schema, and the rows that each file's footer counts (None without a footer)."""
    reader = spark.read.option("mergeSchema", True).option("ignoreCorruptFiles", True)
    try:
        schema = reader.parquet(*_literal(paths)).schema
        one = len({f.name.lower() for f in schema}) == len(schema)
    except (AnalysisException, PySparkException, Py4JJavaError):
        one = False
    if one:
        # no column is read, so the counts are those of the footers
        found = dict(tuple(r) for r in spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(*_literal(paths))
                     .groupBy(_file_path().alias("p")).count().collect())
        rest = {p: _parquet_footer(spark, p) for p in paths if p not in found}  # without rows, or without a footer
        footers = {p: found.get(p, rest[p] and rest[p][1] if p in rest else None) for p in paths}
        return {schema.json(): [p for p in paths if footers[p] is not None]}, footers
    groups, footers = {}, {}
    for p in paths:
        head = _parquet_footer(spark, p)
        footers[p] = None if head is None else head[1]
        if head is not None:
            groups.setdefault(head[0], []).append(p)
    return groups, footers


def _unreadable(read, paths: list[str]) -> list[str]:
    """The files that cannot be read to their end, found by halves."""
    if not paths:
        return []
    try:
        read(paths).write.format("noop").mode("overwrite").save()
        return []
    except (PySparkException, Py4JJavaError):
        if len(paths) == 1:
            return paths
        half = len(paths) // 2
        return _unreadable(read, paths[:half]) + _unreadable(read, paths[half:])


def _damaged(spark: SparkSession, groups: dict, footers: dict, fmt: str) -> set[str]:
    """Files of a failed write that are damaged: they fail, or give other rows than their footer, twice."""
    if fmt == "csv":
        return {p for paths in groups.values() for p in _unreadable(lambda x: _csv_rows(spark, _literal(x)), paths)}
    out: set[str] = set()
    for schema, paths in groups.items():
        short = paths
        for _ in range(2):
            if not short:
                break
            df = spark.read.option("mergeSchema", True).option("ignoreCorruptFiles", True).parquet(*_literal(short))
            got = df.select(_file_path().alias("p"), F.xxhash64(*df.columns).alias("h")).groupBy("p").agg(F.count("*"), F.max("h")).collect()
            got = {r[0]: r[1] for r in got}
            short = [p for p in short if got.get(p, 0) != footers[p]]
        out |= set(short)
    return out


def _csv_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    reader = spark.read.option("header", True).option("recursiveFileLookup", True)
    names = reader.csv(paths).columns
    bad = "_corrupt_record"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, bad]])
    df = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad).schema(schema).csv(paths)
    return df.select(F.when(F.col(bad).isNull(), F.to_json(F.struct(*names))).otherwise(F.col(bad)).alias("raw_payload"),
                     F.col("_metadata").alias("_m"), F.lit(None).cast("long").alias("source_row"), F.col(bad).isNotNull().alias("is_error"))


def _parquet_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    df = (spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).option("ignoreCorruptFiles", False)
          .option("ignoreMissingFiles", False).parquet(*paths))
    return df.select(F.to_json(F.struct(*df.columns)).alias("raw_payload"), F.col("_metadata").alias("_m"),
                     F.col("_metadata.row_index").cast("long").alias("source_row"), F.lit(False).alias("is_error"))


def _larger(pending: DataFrame) -> list[str]:
    return [r[0] for r in pending.where(F.col("file_size") > J.HELD_BYTES).select("source_file").orderBy("source_file").collect()]   # those of one batch


def _large_files(spark: SparkSession, names: list[str]) -> list[str]:
    """The files that can be read in parts: a compressed one's bytes are no text."""
    codecs = spark.sparkContext._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    return [p for p in names if codecs.getCodec(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)) is None]


def _marked(spark: SparkSession, path: str) -> bool:
    """Whether a file begins with a byte order mark."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        return [stream.read() for _ in range(3)] == [0xEF, 0xBB, 0xBF]
    finally:
        stream.close()


def _texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Texts of files up to each ``}``."""
    marked = [p for p in paths if _marked(spark, p)]
    rows = spark.read.format("text").option("lineSep", "}").option("recursiveFileLookup", True).load(_literal(paths))
    return rows.select(_file_path().alias("source_file"), F.col("_metadata.file_size").alias("file_size"), "value",
                       F.col("_metadata.file_block_start").alias("at"), _file_path().isin(marked).alias("mark"))


def _record_rows(spark: SparkSession, files: DataFrame, pending: DataFrame, groups: dict, fmt: str) -> DataFrame:
    """Records of the pending files: raw_payload, source_row, is_error, FILE_KEY.
    ``groups``: paths by header or schema, of the formats that have one."""
    if fmt == "json":
        # The pending keys are those of one batch's files.
        text = F.make_valid_utf8(F.col("content").cast("string"))     # A4
        larger = _larger(pending)
        large = _large_files(spark, larger)
        # The size first, so that the content of a large file is not read.
        held = files.where((F.col("file_size") <= J.HELD_BYTES) | F.col("source_file").isin([p for p in larger if p not in large]))
        rows = explode_json_text(held.select(*FILE_KEY, text.alias("text"))
                                 .join(F.broadcast(pending), FILE_KEY, "left_semi"))
        if large:
            rows = rows.unionByName(J.large_json_rows(_texts(spark, large)).join(F.broadcast(pending), "source_file"))
        return rows
    out = spark.createDataFrame([], "source_file string, file_size long, file_mtime timestamp, "
                                    "source_row long, raw_payload string, is_error boolean")
    m = F.col("_m")
    path = F.try_url_decode(F.replace(m["file_path"], F.lit("+"), F.lit("%2B")))
    for paths in groups.values():
        if not paths:
            continue
        rows = (_csv_rows if fmt == "csv" else _parquet_rows)(spark, _literal(paths))
        out = out.unionByName(rows.select(_name(path).alias("source_file"), m["file_size"].alias("file_size"),
                                          m["file_modification_time"].alias("file_mtime"), "source_row", "raw_payload", "is_error"))
    return out.join(F.broadcast(pending), FILE_KEY, "left_semi")


def _routed(rows: DataFrame, routing: tuple[str, str] | None) -> DataFrame:
    """``rows`` with ``record_key`` and ``route_date`` of the good records."""
    if not routing:
        return rows.withColumns({"record_key": F.lit(None).cast("string"), "route_date": F.lit(None).cast("date")})
    # A projection of its own: one parse gives both columns.
    rows = rows.withColumn("_v", F.when(~F.col("is_error"), F.try_parse_json("raw_payload")))
    return rows.withColumns({"record_key": F.try_variant_get("_v", routing[0], "string"),
                             "route_date": F.try_variant_get("_v", routing[1], "date")}).drop("_v")


def _append(rows: DataFrame, target_path: str, as_of: dt.datetime, load_id: str,
            routing: tuple[str, str] | None) -> None:
    loaded_at = as_of_literal(as_of)
    (_routed(rows, routing).select(
                 "raw_payload", loaded_at.alias("loaded_at"), "source_file",
                 "source_row", "file_size", "file_mtime", "is_error",
                 "record_key", "route_date",
                 F.to_date(loaded_at).alias("load_date"), F.lit(load_id).alias("load_id"))
         .write.mode("append").partitionBy("load_date", "load_id").parquet(target_path))


def _short_files(spark: SparkSession, written: DataFrame, footers: dict) -> RuntimeError | None:
    """The files of which other rows were written than their footers count, as an error."""
    want = spark.createDataFrame(list(footers.items()), "source_file string, want long")
    got = written.groupBy("source_file").agg(F.count("*").alias("got"))
    short = want.join(got, "source_file", "left").where(F.coalesce("got", F.lit(0)) != F.col("want")).collect()
    return RuntimeError(f"rows read and rows of the footer differ, nothing of the batch is committed: {short}") if short else None


def _load_batch(spark: SparkSession, paths: list[str], target_path: str, ledger_path: str, as_of: dt.datetime,
                fmt: str, glob: str | None, routing: tuple[str, str] | None, on_error: str) -> tuple[int, int, int, int]:
    """Load one batch; returns files listed, files loaded, rows loaded, rows errored."""
    files = _read_files(spark, paths, glob)
    if files is None:
        return 0, 0, 0, 0
    listing = files.select(*FILE_KEY)
    # Landing days of the batch (bounded): only those ledger partitions are read.
    per_day = {r[0]: r[1] for r in listing.groupBy(landing_date_of("source_file")).count().collect()}
    vals = [d for d in per_day if d is not None]
    day_cond = F.col("landing_date").isin(vals) if vals else F.lit(False)
    if None in per_day:
        day_cond = day_cond | F.col("landing_date").isNull()
    done = read_ledger(spark, ledger_path).where(day_cond).select(*FILE_KEY)
    pending = listing.join(done, FILE_KEY, "left_anti")
    n_files = pending.count()
    if not n_files:
        return sum(per_day.values()), 0, 0, 0
    groups, footers, broken = {}, {}, set()
    if fmt in ("csv", "parquet"):
        names = [r[0] for r in pending.select("source_file").orderBy("source_file").collect()]   # those of one batch
        if fmt == "parquet":
            groups, footers = _parquet_groups(spark, names)
        for path in names if fmt == "csv" else ():
            try:
                head = _csv_header(spark, path)
            except Py4JJavaError as e:   # a compressed file that ends or breaks in its first block
                if on_error == "abort" or not re.search("EOFException|ZipException|ZlibException|header check", str(e.java_exception)):
                    raise
                broken.add(path)
                continue
            if head is not None:
                groups.setdefault(head, []).append(path)
    load_id = f"{as_of:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    # A file without a footer is no Parquet file: it is one error, as a damaged one is.
    broken |= {p for p, n in footers.items() if n is None}
    for attempt in range(3):
        obs = Observation(f"load_{load_id}_{attempt}")
        rows = _record_rows(spark, files, pending, groups, fmt).observe(
            obs, F.count_if(~F.col("is_error")).alias("loaded"), F.count_if(F.col("is_error")).alias("errored"))
        try:
            _append(rows, target_path, as_of, load_id, routing)
            # Ledger: every processed file (empty ones too), with its counts taken
            # from the partition just written (a narrow columnar scan).
            written = _read_or_empty(spark, target_path, RAW_TABLE_SCHEMA).where(F.col("load_id") == load_id)
            failure = _short_files(spark, written, {p: n for p, n in footers.items() if p not in broken}) if fmt == "parquet" else None
        except (PySparkException, Py4JJavaError) as e:
            failure = e
        if failure is None:
            break
        delete_path(spark, f"{target_path}/load_date={as_of:%Y-%m-%d}/load_id={load_id}")   # no orphans
        found = _damaged(spark, groups, footers, fmt) if on_error == "continue" and fmt != "json" and attempt < 2 else set()
        if not found:
            raise failure
        broken |= found
        groups = {k: [p for p in paths if p not in found] for k, paths in groups.items()}
    loaded, errored = int(obs.get["loaded"]), int(obs.get["errored"])
    if broken:
        keys = spark.createDataFrame([(p,) for p in sorted(broken)], "source_file string")
        _append(pending.join(F.broadcast(keys), "source_file", "left_semi")
                .select(*FILE_KEY, F.lit(None).cast("long").alias("source_row"),
                        F.lit(None).cast("string").alias("raw_payload"), F.lit(True).alias("is_error")), target_path, as_of, load_id, routing)
        errored += len(broken)
        written = spark.read.schema(RAW_TABLE_SCHEMA).parquet(target_path).where(F.col("load_id") == load_id)
    counts = (written.groupBy(*FILE_KEY)
              .agg(F.count_if(~F.col("is_error")).alias("rows_loaded"),
                   F.count_if(F.col("is_error")).alias("rows_errored")))
    ledger = (pending.join(counts, FILE_KEY, "left")
              .select(*FILE_KEY,
                      F.coalesce("rows_loaded", F.lit(0)).cast("long").alias("rows_loaded"),
                      F.coalesce("rows_errored", F.lit(0)).cast("long").alias("rows_errored"),
                      as_of_literal(as_of).alias("loaded_at"),
                      landing_date_of("source_file").alias("landing_date"),
                      F.lit(load_id).alias("load_id")))
    ledger.write.mode("append").partitionBy("landing_date", "load_id").parquet(ledger_path)
    return sum(per_day.values()), n_files, loaded, errored


def load(spark: SparkSession, source: str | list[str], target_path: str, ledger_path: str,
         as_of: dt.datetime, file_format: str = "json", glob: str | None = None,
         routing: tuple[str, str] | None = None, feed: str | None = None,
         batch_days: int = BATCH_DAYS, on_error: str = "continue") -> LoadResult:
    """Load every not-yet-loaded file under ``source``.

    ``loaded_at`` is the batch timestamp ``as_of``. Status: ``no_files`` when
    nothing is listed, ``success`` when no row errored, else ``partial``. A damaged CSV or
    Parquet file is one error; with ``on_error="abort"`` it fails its batch.
    ``feed`` (or ``routing`` = key path, date path) stores ``record_key`` and
    ``route_date`` beside each payload, so incremental runs can select versions
    by key and day without parsing every payload.
    """
    t0 = time.monotonic()
    routing = routing or (ROUTING[feed] if feed else None)
    sums = [0, 0, 0, 0]
    for paths in batches(spark, source, batch_days):
        got = _load_batch(spark, paths, target_path, ledger_path, as_of, file_format.lower(), glob, routing, on_error)
        sums = [a + b for a, b in zip(sums, got)]
    listed, n_files, loaded, errored = sums
    status = "no_files" if not listed else "success" if not errored else "partial"
    return LoadResult(n_files, loaded, errored, time.monotonic() - t0, status)


def load_date(spark: SparkSession, root: str, feed: str, target_path: str, ledger_path: str,
              as_of: dt.datetime, date: dt.date | None = None,
              file_format: str = "json") -> LoadResult:
    """Load one day folder of a feed; the day defaults to today (UTC)."""
    from ledgerflow.sources.landing import partition_path
    day = date or dt.datetime.now(dt.timezone.utc).date()
    return load(spark, partition_path(root, feed, day), target_path, ledger_path, as_of,
                file_format, routing=ROUTING.get(feed))


def landing_partition_of(source_file: Column | str) -> Column:
    """'year=YYYY/month=MM/day=DD/hour=HH' part of a landed file path."""
    c = F.col(source_file) if isinstance(source_file, str) else source_file
    return F.regexp_extract(c, r"(year=\d{4}/month=\d{2}/day=\d{2}/hour=\d{2})", 1)


def landing_date_of(source_file: Column | str) -> Column:
    """Landing day of a file from its ``year=/month=/day=`` folders; NULL if none."""
    c = F.col(source_file) if isinstance(source_file, str) else source_file
    found = F.regexp_extract(c, r"year=(\d{4})/month=(\d{2})/day=(\d{2})", 0)
    text = F.regexp_replace(found, r"year=(\d{4})/month=(\d{2})/day=(\d{2})", "$1-$2-$3")
    return F.when(found != "", text.try_cast("date"))


def load_report(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Per landing day: files, rows loaded / errored and status (A8 by day)."""
    led = read_ledger(spark, ledger_path)
    return (led.groupBy(landing_date_of("source_file").alias("landing_date"))
               .agg(F.count(F.lit(1)).alias("files_processed"),
                    F.sum("rows_loaded").alias("rows_loaded"),
                    F.sum("rows_errored").alias("rows_errored"))
               .withColumn("status", F.when(F.col("rows_errored") == 0, "success")
                           .otherwise("partial")))

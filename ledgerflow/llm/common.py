"""Helpers shared by the corpus operators: inputs, scratch tables, byte-level words.

The word helpers work on whole Arrow buffers: a slice of documents is one byte
array with offsets, words are spans of it, and every span gets a 64-bit hash by
prefix sums, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import delete_path, scratch_path

SLICE_BYTES = 2 << 20

# ASCII white space 0x20, 0x09-0x0D; every other byte belongs to a word.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: the lineage is cut
    by files that outlive any executor. ``partitions`` get folders of their own."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partitions).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def release(*written: DataFrame) -> None:
    """Remove the folders of materialized tables that nothing reads any more."""
    for df in written:
        delete_path(df.sparkSession, df.scratch)


def id_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (a null id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_slices(batch: pa.RecordBatch, column: int | str,
                max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split a batch into runs of rows with at most ``max_bytes`` of text (a longer
    text is a run of its own). Yields first row, row count, bytes, offsets; a null
    text is empty."""
    texts = batch.column(column).cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    n = len(texts)
    if n == 0:
        return
    offsets = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last - first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, is_gap: np.ndarray = IS_SPACE):
    """Starts and ends of the words of all rows, and the row of each word. A word
    never crosses the edge of a row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~is_gap[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | edge[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets, starts, "right") - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        out = []
        for base in (_BASE, _BASE_INVERSE):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            out.append(np.multiply.accumulate(run))
        if size > 16 * SLICE_BYTES:  # one very long text: its tables are not kept
            return out[0], out[1]
        _POWERS["up"], _POWERS["down"] = out
    return _POWERS["up"], _POWERS["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span ``data[start:end]``; equal bytes give equal hashes."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[:len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    return mix64(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.int64).view(np.uint64)

"""Line dedup by a sharded minimal perfect hash over line hashes.

A line's key is the line stripped of white space, A-Z in lower case. Spark counts
for every key of at least ``min_chars`` code points the documents that hold it,
one row a document and key, summed before the shuffle. Keys of at least
``min_docs`` documents go by hash to shards of bounded size; each shard becomes a
minimal perfect hash (levels of bit arrays with rank samples) that indexes
compact arrays: fingerprint, count of documents, largest document id. Documents
then probe the arrays; no line text is shuffled or joined.

Where all shards together stay below ``broadcast_bytes`` (their size is known
once they are written), every task loads them; beyond it, line hashes are sent to
the shard that holds them, each task loading one shard at a time, and only the
numbers of the lines to drop come back. Both ways give the same rows.

A key is a 128-bit hash of the line: 64 bits place it, 64 bits are its
fingerprint. A line that is in no shard is taken for one with chance 2^-64.

Defined cases: null and empty texts are one empty line. In the rows with the
largest ``doc_id`` that holds a key its lines stay, all of them, also where rows
repeat that id; null ids rank lowest, and with null ids alone all lines stay.
Each row counts as a document. Extra columns are kept by ``dedup_lines`` and may
have any name but those it adds. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialize, mix64, shuffle_tasks


@dataclass(frozen=True)
class LineParams:
    min_chars: int = 20
    min_docs: int = 3
    shard_keys: int = 1 << 18       # keys a shard holds, about
    broadcast_bytes: int = 64 << 20
    added: tuple[str, str] = ("n_lines", "n_dropped")  # names of the columns added


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of the line's key; None if the key is shorter than ``min_chars``."""
    key = line.strip().lower()  # of bytes: ASCII white space, A-Z
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def line_counts(docs: DataFrame, p: LineParams) -> DataFrame:
    """``h, f, n, keeper``: key hash and fingerprint, number of documents, largest id."""
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                keys, ids = [], []
                part = batch.slice(at, 256)
                for i, text in enumerate(part.column(1)):
                    own = {k for x in (text.as_py() or "").encode().split(b"\n") if (k := line_key(x, p.min_chars))}
                    keys += own
                    ids += [i] * len(own)
                if keys:
                    h, f = _halves(keys)
                    yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(f), part.column(0).take(pa.array(ids))], names=["h", "f", "doc_id"])

    seen = docs.select("doc_id", "text").mapInArrow(run, f"h long, f long, doc_id {kind.simpleString()}")
    return seen.groupBy("h", "f").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= p.min_docs)


# ------------------------------------------------------------- the hash

def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix64(h ^ mix64(np.full(1, level + 1, np.uint64))) % np.uint64(size)).astype(np.int64)


def build_mph(h: np.ndarray) -> list[np.ndarray]:
    """Levels of bits for distinct ``h``: a key sits at the first level where no other
    remaining key has its place. The number of set bits before is its index."""
    levels, left = [], h
    while len(left):
        size = max(64, 2 * len(left))
        at = _place(left, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[at]]
    return levels


class Mph:
    """Index lookup over the levels of ``build_mph``; unknown keys give any index or -1."""

    def __init__(self, packed: list[bytes], sizes: list[int]):
        self.bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for b, n in zip(packed, sizes, strict=True)]
        self.rank, base = [], 0
        for bits in self.bits:
            self.rank.append(np.cumsum(bits, dtype=np.int32) + base - 1)
            base += int(bits.sum())

    def index(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -1, np.int64)
        open_ = np.arange(len(h))
        for level, bits in enumerate(self.bits):
            at = _place(h[open_], level, len(bits))
            hit = bits[at]
            out[open_[hit]] = self.rank[level][at[hit]]
            open_ = open_[~hit]
        return out


SHARD_SCHEMA = "shard long, sizes array<long>, levels array<binary>, fingerprints binary, counts binary, keepers binary, named binary"


def build_shards(counts: DataFrame, shards: int) -> DataFrame:
    """One row a shard: the hash levels and the arrays that they index."""
    def build(key, pdf):
        h = pdf["h"].to_numpy(np.int64).view(np.uint64)
        # two keys with equal first halves: the hash places the half once, the fingerprint tells the first of them
        _, one = np.unique(h, return_index=True)
        pdf, h = pdf.iloc[one], h[one]
        levels = build_mph(h)
        packed = [np.packbits(x).tobytes() for x in levels]
        at = Mph(packed, [len(x) for x in levels]).index(h)
        order = np.argsort(at)
        return pd.DataFrame({"shard": [key[0]], "sizes": [[len(x) for x in levels]], "levels": [packed],
                             "fingerprints": [pdf["f"].to_numpy(np.int64)[order].tobytes()],
                             "counts": [pdf["n"].to_numpy(np.int64)[order].tobytes()],
                             "keepers": [pdf["keeper"].to_numpy(np.int64)[order].tobytes()],
                             "named": [pdf["named"].to_numpy(bool)[order].tobytes()]})

    return (counts.withColumn("shard", F.pmod("h", F.lit(shards))).withColumn("named", F.col("keeper").isNotNull())
            .withColumn("keeper", F.coalesce(F.col("keeper").cast("long"), F.lit(0)))
            .groupBy("shard").applyInPandas(build, SHARD_SCHEMA))


class Shard:
    """One loaded shard."""

    def __init__(self, row: dict):
        self.mph = Mph(row["levels"], row["sizes"])
        self.fingerprints, self.counts, self.keepers = (np.frombuffer(row[k], np.int64) for k in ("fingerprints", "counts", "keepers"))
        self.named = np.frombuffer(row["named"], bool)

    def dropped(self, h: np.ndarray, f: np.ndarray, ids: np.ndarray, has_id: np.ndarray) -> np.ndarray:
        """Whether each line goes: its key is here, and its document does not have the largest id."""
        at = self.mph.index(h.view(np.uint64))
        known = (at >= 0) & (self.fingerprints[at] == f)
        keeper = np.where(has_id, self.named[at] & (self.keepers[at] == ids), ~self.named[at])
        return known & ~keeper


def _load(path: str, shard: int) -> list[dict]:
    """The row of a written shard, from its own folder in the shared one; none if no key lies there."""
    from pyarrow import fs as pafs
    from pyarrow import parquet as pq
    store, root = pafs.FileSystem.from_uri(path)
    folder = pafs.FileSelector(f"{root}/shard={shard}", allow_not_found=True)
    files = [x.path for x in store.get_file_info(folder) if x.path.endswith(".parquet")]
    return [r for f in files for r in pq.read_table(f, filesystem=store, partitioning=None).to_pylist()]


def shard_deals(counts: DataFrame, shards: int, tasks: int) -> np.ndarray:
    """Over how many places the lines of each shard are dealt: those that repeat by their
    number, which is known, the others evenly. Places are some for each task, so that
    their hashes fill the tasks evenly."""
    deals = np.full(shards, -(-8 * tasks // shards))
    weights = counts.groupBy(F.pmod("h", F.lit(shards)).alias("shard")).agg(F.sum("n").alias("n")).collect()  # one row a shard
    place = max(1, sum(r["n"] for r in weights) // (8 * tasks))
    for r in weights:
        deals[r["shard"]] += r["n"] // place
    return deals


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode().split(b"\n")


def dedup_lines(docs: DataFrame, params: LineParams = LineParams()) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)`` with repeated lines taken out of ``text``, and
    ``n_lines`` (before) and ``n_dropped``. A null text stays null."""
    p = params
    spark = docs.sparkSession
    counts = materialize(line_counts(docs, p), "line-counts")
    keys = counts.count()
    shards = max(1, -(-keys // p.shard_keys))
    table = materialize(build_shards(counts, shards), "line-shards", "shard")
    total = table.agg(F.coalesce(F.sum(F.length("fingerprints") + F.length("counts") + F.length("keepers") + F.length("named")), F.lit(0))).first()[0]
    if 2 * total <= p.broadcast_bytes:
        rows = spark.sparkContext.broadcast([r.asDict() for r in table.collect()])
        return _probe_local(docs, rows, shards, p)
    return _probe_routed(docs, table, shard_deals(counts, shards, shuffle_tasks(docs)), p)


def _rewrite(part: pa.RecordBatch, drops: list[set | None], schema: list[str], p: LineParams):
    """The batch with the numbered lines taken out, and the two counts."""
    at = part.schema.get_field_index("text")
    texts, n_lines, n_dropped = [], [], []
    for text, drop in zip(part.column(at).to_pylist(), drops, strict=True):
        lines = (text or "").split("\n")
        n_lines.append(len(lines))
        n_dropped.append(len(drop) if drop else 0)
        texts.append("\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else text)
    columns = [pa.array(texts, part.column(at).type) if c == at else part.column(c) for c in range(part.num_columns)]
    columns = [x for x, f in zip(columns, part.schema) if f.name in schema]
    names = [f.name for f in part.schema if f.name in schema]
    return pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[*names, *p.added])


def _out_schema(docs: DataFrame, p: LineParams) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"`{c}` long" for c in p.added)])


def _line_arrays(part: pa.RecordBatch, p: LineParams):
    """Row, line number, hash halves and id of every line with a long enough key."""
    keys, rows, numbers = [], [], []
    for i, text in enumerate(part.column("text")):
        for j, line in enumerate(_lines(text.as_py())):
            k = line_key(line, p.min_chars)
            if k:
                keys.append(k)
                rows.append(i)
                numbers.append(j)
    h, f = _halves(keys)
    ids = part.column("doc_id").cast(pa.int64())
    has = ids.is_valid().to_numpy(zero_copy_only=False)
    return np.array(rows, np.int64), np.array(numbers, np.int64), h, f, ids.fill_null(0).to_numpy(), has


def _probe_local(docs: DataFrame, shard_rows, shards: int, p: LineParams) -> DataFrame:
    names = docs.columns

    def run(batches):
        loaded = {r["shard"]: Shard(r) for r in shard_rows.value}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                row, number, h, f, ids, has = _line_arrays(part, p)
                drops: list[set | None] = [None] * part.num_rows
                for s, shard in loaded.items():
                    mine = np.flatnonzero(np.mod(h, shards) == s)
                    gone = mine[shard.dropped(h[mine], f[mine], ids[row[mine]], has[row[mine]])]
                    for r, n in zip(row[gone].tolist(), number[gone].tolist(), strict=True):
                        drops[r] = drops[r] or set()
                        drops[r].add(n)
                yield _rewrite(part, drops, names, p)

    return docs.mapInArrow(run, _out_schema(docs, p))


def route_lines(placed: DataFrame, deals: np.ndarray, p: LineParams) -> DataFrame:
    """``rk, number, h, f, doc_id, shard`` of every line with a long enough key; the lines
    of a shard, and of a frequent key, lie in as many tasks as they are dealt over."""
    def hashes(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                row, number, h, f, ids, has = _line_arrays(part, p)
                rk = part.column("__rk").to_numpy()[row]
                shard = np.mod(h, len(deals))
                deal = mix64((rk + number).astype(np.uint64)) % deals[shard].astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rk), pa.array(number), pa.array(h), pa.array(f), pa.array(ids[row], mask=~has[row]), pa.array(shard), pa.array(deal.astype(np.int64))],
                    names=["rk", "number", "h", "f", "doc_id", "shard", "deal"])

    lines = placed.select("__rk", "doc_id", "text").mapInArrow(hashes, "rk long, number long, h long, f long, doc_id long, shard long, deal long")
    return lines.repartition(shuffle_tasks(placed), "shard", "deal").drop("deal")


def _probe_routed(docs: DataFrame, table: DataFrame, deals: np.ndarray, p: LineParams) -> DataFrame:
    """Line hashes meet their shard; the numbers of dropped lines come back by row position."""
    path = table.inputFiles()[0].rsplit("/", 2)[0]
    placed = docs.withColumn("__rk", F.monotonically_increasing_id())

    def probe(batches):
        current, shard = None, None
        for batch in batches:
            which = batch.column("shard").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.append(True, which[1:] != which[:-1])[:len(which)])
            for a, b in zip(edges, [*edges[1:], len(which)]):
                if which[a] != current:
                    current = int(which[a])
                    rows = _load(path, current)
                    shard = Shard(rows[0]) if rows else None
                part = batch.slice(a, b - a)
                if shard is None:
                    continue
                ids = part.column("doc_id")
                gone = shard.dropped(part.column("h").to_numpy(), part.column("f").to_numpy(), ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(gone)) for c in ("rk", "number")], names=["__rk", "number"])

    routed = route_lines(placed, deals, p).sortWithinPartitions("shard")
    drops = routed.mapInArrow(probe, "__rk long, number long").groupBy("__rk").agg(F.collect_list("number").alias("__drop"))
    names = docs.columns

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield _rewrite(part, [set(x) if x else None for x in part.column("__drop").to_pylist()], names, p)

    return placed.join(drops, "__rk", "left").drop("__rk").mapInArrow(run, _out_schema(docs, p))

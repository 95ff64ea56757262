"""Importance resampling towards a target: hashed n-gram counts by automaton scans.

Features are runs of one to three words, hashed to buckets by the CRC-32 of their
text. A text is scanned in pieces: the distinct words of a piece, each between two
delimiters, make an Aho-Corasick automaton whose entries carry the word's length
and its CRC with and without a leading space. The scan emits these payloads in
text order; the CRC of a longer feature is composed from neighbouring payloads,
since appending n bytes to a text is a linear map of its CRC, so no feature is ever
spelled out. Buckets of all texts are counted once for the corpus and once for the
target, which gives a gain a bucket; a second scan adds up each document's gains.

A piece holds at most ``PIECE_BYTES`` of text, cut between words, and takes the last
two payloads of the piece before with it; words too long to be worth a path of the
automaton are scanned under a short stand-in with the payload of the whole word.
Memory is bounded by the piece but for one word of greater length.

The draw is the top of score plus Gumbel noise of a hash of the document's id. Rows
are range-partitioned by (drawable, score, id, row position), so neither a hot score
nor repeated rows meet in one task, and written once; a row's rank is its place in
its partition behind the rows of the partitions before. Only the 10,000 gains and
one count a partition reach the driver.

Defined cases: null texts have no words; a null id counts as '' in the hash and comes
first among ties; rows that are equal throughout are ranked in the order of the
input files. An empty corpus or target counts nothing, and no rows draw nothing.
Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialize, release, shuffle_tasks, text_slices

PIECE_BYTES = 2 << 20
LONG_WORD = 64
_BREAK = 0  # the payload that stands between two texts

_KEEP = np.full(256, 0x20, np.uint8)
_KEEP[0x30:0x3A] = np.arange(0x30, 0x3A)
_KEEP[0x61:0x7B] = np.arange(0x61, 0x7B)
_KEEP[0x41:0x5B] = np.arange(0x61, 0x7B)
_KEEP[0x80:] = np.arange(0x80, 0x100)
_KEEP = _KEEP.tobytes()


@dataclass(frozen=True)
class ResampleParams:
    buckets: int = 10_000
    longest: int = 3          # words in a feature
    seed: int = 42
    percent: int = 5          # of the drawable documents
    least_words: int = 20


# ---------------------------------------------------------------- CRC composition

@lru_cache(1)
def _appended() -> np.ndarray:
    """``[n, k, byte]``: what byte ``k`` of a CRC gives once ``n`` bytes follow, n up to LONG_WORD + 1."""
    step = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
    step ^= step[0]  # the table of the polynomial, free of the initial value
    out = np.zeros((LONG_WORD + 2, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, len(out)):
        out[n] = step[out[n - 1] & 0xFF] ^ (out[n - 1] >> np.uint32(8))
    return out


@lru_cache(1)
def _doubled() -> list[np.ndarray]:
    """``[k, byte]`` tables for 2^j bytes that follow, j up to 40."""
    out = [_appended()[1]]
    for _ in range(40):
        t = out[-1]
        out.append(_through(t, t))
    return out


def _through(t: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return t[0][crc & 0xFF] ^ t[1][crc >> np.uint32(8) & 0xFF] ^ t[2][crc >> np.uint32(16) & 0xFF] ^ t[3][crc >> np.uint32(24)]


def append_crc(crc: np.ndarray, tail: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC of each text followed by another, from both CRCs and the bytes of the second."""
    t, short = _appended().reshape(-1), np.minimum(length, LONG_WORD + 1)
    at = short * 1024
    out = t[at + (crc & 0xFF)] ^ t[at + 256 + (crc >> np.uint32(8) & 0xFF)] ^ t[at + 512 + (crc >> np.uint32(16) & 0xFF)] ^ t[at + 768 + (crc >> np.uint32(24))]
    for i in np.flatnonzero(length > short):
        value, rest = out[i:i + 1], int(length[i] - short[i])
        for j in range(rest.bit_length()):
            if rest >> j & 1:
                value = _through(_doubled()[j], value)
        out[i] = value[0]
    return out ^ tail


# ---------------------------------------------------------------- scans

@dataclass
class Payloads:
    """Of each dictionary entry: bytes, CRC, and CRC behind a space. Entry 0 is the break."""
    length: np.ndarray
    crc: np.ndarray
    spaced: np.ndarray


def scan(text: bytes) -> tuple[Payloads, np.ndarray]:
    """Payloads of the distinct words of a text of words, single spaces and ``\\0`` between
    documents, and the entry of each word (0 for a break) in text order."""
    words = list(set(text.split()) - {b"\0"})
    shown = words
    if max(map(len, words), default=0) > LONG_WORD:
        stands = {w: b"\1%d" % i for i, w in enumerate(words) if len(w) > LONG_WORD}  # no word holds \1
        text = b" " + b" ".join([stands.get(w, w) for w in text.split()]) + b" "
        shown = [stands.get(w, w) for w in words]
    automaton = ahocorasick.Automaton()
    for i, w in enumerate(shown, 1):
        automaton.add_word((b" %b " % w).decode("latin-1"), i)
    automaton.add_word("\0", _BREAK)
    automaton.make_automaton()
    ids = np.fromiter((i for _, i in automaton.iter(text.decode("latin-1"))), np.int64)
    space = zlib.crc32(b" ")
    return Payloads(np.array([0, *map(len, words)], np.int64), np.array([0, *map(zlib.crc32, words)], np.uint32),
                    np.array([0, *(zlib.crc32(w, space) for w in words)], np.uint32)), ids


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, bytes, int]]:
    """Parts of a slice as ``first document, text, documents begun``; only a slice of one long
    document has more than one."""
    raw = data.tobytes().translate(_KEEP)
    if len(offsets) > 2 or len(raw) <= PIECE_BYTES:
        edges = offsets.tolist()
        yield 0, b" " + b" \0 ".join([raw[a:b] for a, b in zip(edges, edges[1:])]) + b" ", len(edges) - 1
        return
    at = 0
    while at < len(raw):
        end = at + PIECE_BYTES
        if end < len(raw):
            cut = raw.rfind(b" ", at, end)
            end = cut if cut > at else raw.find(b" ", end)
            end = len(raw) if end < 0 else end
        yield 0, b" " + raw[at:end] + b" ", 1
        at = end


def bucket_runs(data: np.ndarray, offsets: np.ndarray, params: ResampleParams) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part of a slice: documents and buckets of its features, and words a document."""
    carried = [np.zeros(0, t) for t in (np.int64, np.uint32, np.uint32)]
    seen = 0  # words of the one long document before this part
    for _, text, n in _pieces(data, offsets):
        entries, ids = scan(text)
        doc = np.cumsum(ids == _BREAK)
        word = ids != _BREAK
        doc, ids = doc[word], ids[word]
        counts = np.bincount(doc, minlength=n)
        known = len(carried[0])
        length, crc, spaced = (np.concatenate([c, x[ids]]) for c, x in zip(carried, (entries.length, entries.crc, entries.spaced)))
        doc = np.concatenate([np.zeros(known, np.int64), doc])
        place = np.arange(len(doc)) - np.concatenate([[0], np.cumsum(counts)])[doc] - known + (seen if n == 1 else 0)
        docs, buckets = [doc[known:]], [crc[known:] % params.buckets]
        run = crc
        for k in range(1, params.longest):
            # run[i] is the CRC of the k words that end at word i; the next ones end at i + 1
            run = append_crc(run[:-1], spaced[k:], length[k:] + 1)
            new = np.flatnonzero((place[k:] >= k) & (np.arange(k, len(doc)) >= known))
            docs.append(doc[k:][new])
            buckets.append(run[new] % params.buckets)
        yield np.concatenate(docs), np.concatenate(buckets).astype(np.int64), counts
        if n == 1:
            seen += int(counts[0])
            carried = [x[-(params.longest - 1):] if params.longest > 1 else x[:0] for x in (length, crc, spaced)]


def bucket_counts(texts: DataFrame, params: ResampleParams = ResampleParams(), text_column: str = "text") -> DataFrame:
    """``bucket, n``: features of all texts; at most ``buckets`` rows a task are shuffled."""
    def run(batches):
        total = np.zeros(params.buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch, 0):
                for _, buckets, _ in bucket_runs(data, offsets, params):
                    total += np.bincount(buckets, minlength=params.buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    return texts.select(text_column).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, params: ResampleParams = ResampleParams(), text_column: str = "text") -> list[int]:
    """The gain of each bucket: a fixed number of rows, whatever the tables hold."""
    sides = [bucket_counts(x, params, text_column).withColumn("side", F.lit(i)) for i, x in enumerate((corpus, target))]
    s, t = np.zeros(params.buckets, np.int64), np.zeros(params.buckets, np.int64)
    for row in sides[0].unionByName(sides[1]).collect():  # two rows a bucket at most
        (t if row["side"] else s)[row["bucket"]] = row["n"]
    up = (t + 1.0) * (float(s.sum()) + params.buckets)
    down = (s + 1.0) * (float(t.sum()) + params.buckets)
    return np.floor(1000 * np.log(up / down)).astype(np.int64).tolist()


def weigh(docs: DataFrame, gains: list[int], params: ResampleParams = ResampleParams(), id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """``id, position, n_words, n_features, weight`` of every document."""
    id_type = docs.schema[id_column].dataType.simpleString()
    names = [id_column, "position", "n_words", "n_features", "weight"]

    def run(batches):
        gain = np.array(gains, np.int64)
        for batch in batches:
            for first, n, data, offsets in text_slices(batch, 2):
                words, features, weight = np.zeros((3, n), np.int64)
                for docs_of, buckets, counts in bucket_runs(data, offsets, params):
                    words += counts
                    features += np.bincount(docs_of, minlength=n)
                    # sums of whole numbers, exact in doubles far beyond any text's weight
                    weight += np.bincount(docs_of, gain[buckets], minlength=n).astype(np.int64)
                ids = [batch.column(k).slice(first, n) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*ids, *(pa.array(x) for x in (words, features, weight))], names=names)

    rows = docs.select(id_column, F.monotonically_increasing_id().alias("position"), text_column)
    return rows.mapInArrow(run, f"{id_column} {id_type}, position long, n_words long, n_features long, weight long")


# ---------------------------------------------------------------- the draw

def gumbel(doc_id: Column, seed: int) -> Column:
    """Noise of a document: the same in every run."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, params: ResampleParams = ResampleParams(), id_column: str = "doc_id",
             text_column: str = "text") -> DataFrame:
    """``id, n_words, n_features, weight, score, rank`` of every document; ``rank`` is null
    for those that are not drawn."""
    gains = bucket_gains(docs, target, params, text_column)
    scored = weigh(docs, gains, params, id_column, text_column)
    scored = scored.withColumn("score", F.col("weight") + gumbel(F.col(id_column), params.seed))
    # written, as range partitioning reads its input twice
    scored = materialize(scored.withColumn("barred", F.col("n_words") < params.least_words), "resample-scored")
    order = [F.col("barred").asc(), F.col("score").desc(), F.col(id_column).asc_nulls_first(), F.col("position").asc()]
    # the id of a sorted row is its partition, then its place in it
    placed = scored.repartitionByRange(shuffle_tasks(docs), *order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("placed", F.monotonically_increasing_id()), "resample-placed")
    release(scored)
    part = F.shiftright("placed", 33)
    parts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("rows"), F.count(F.when(~F.col("barred"), 1)).alias("drawable"))
    counts = sorted(tuple(r) for r in parts.collect())  # one row a partition
    drawn = params.percent * sum(r[2] for r in counts) // 100
    starts = dict(zip((r[0] for r in counts), np.cumsum([0, *(r[1] for r in counts)]).tolist()))
    before = docs.sparkSession.createDataFrame([(p, n) for p, n in starts.items() if n < drawn] or [(-1, 0)], "part long, before long")
    rank = F.col("before") + F.col("placed").bitwiseAND((1 << 33) - 1) + 1
    ranked = placed.withColumn("part", part).join(F.broadcast(before), "part", "left")  # one row a partition that is drawn from
    return ranked.select(id_column, "n_words", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))

"""Benchmark decontamination by a prefix-filtered join with exact windows.

A window is ``size`` consecutive words of a benchmark item (the whole item if it
is shorter). Finding it in a document is a containment join at threshold 1, so
of its words, ordered by rarity in the documents, the prefix that must match is
one word: the rarest. Document words join that word; the position bounds (the
window must begin at or after the first word and end at or before the last) and
then the joint words of the span decide. Rarity is counted over all documents,
for the benchmark's words.

A document's words never leave their row: word, position, bounds and span are
compared within one generated stage, and only real occurrences and one row a
document are shuffled. Windows are sent to the tasks in blocks of at most
``block_bytes``, as many passes as the benchmark needs.

DataFrame functions only.

Defined cases: null and empty texts have no words, no hits and no items, on
either side. Items with equal ids are one item; a null item id can be hit but is
not listed. Repeated documents are judged row by row. With an empty benchmark
nothing is hit. Extra columns are kept by ``clean`` under any name but ``__rk``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialize

# Between words, while capitals still stand: all ASCII but letters and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class WindowParams:
    size: int = 13
    per_mille: int = 50            # contaminated: 1000 * hit words >= per_mille * words
    block_bytes: int = 16 << 20    # window text sent to the tasks at once


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN), "")


def lower(word: Column) -> Column:
    """A-Z in lower case, nothing else."""
    return F.when(word.rlike("[A-Z]"), F.translate(word, UPPER, LOWER)).otherwise(word)


def item_windows(benchmark: DataFrame, p: WindowParams) -> DataFrame:
    """``window`` (words joined by a space), ``words``, ``items``: each distinct window once."""
    items = (benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w"))
             .withColumn("n", F.size("w")).where("n > 0"))
    starts = F.sequence(F.lit(1), F.greatest(F.col("n") - p.size + 1, F.lit(1)))
    spans = items.select("item", "w", F.explode(starts).alias("at")).select("item", F.slice("w", F.col("at"), p.size).alias("w"))
    spans = spans.select("item", lower(F.array_join("w", " ")).alias("window"))
    return (spans.groupBy("window").agg(F.collect_set("item").alias("items"))
            .select("window", F.split("window", " ").alias("words"), "items"))


def _exploded(docs: DataFrame) -> DataFrame:
    """One row a word: ``rk, doc_id, w, n, pos, word`` and a leading row with pos -1."""
    d = docs.select("rk", "doc_id", words_of(F.col("text")).alias("w")).withColumn("n", F.size("w"))
    # The head is a blank, which no word can be.
    d = d.select("rk", "doc_id", "w", "n", F.posexplode(F.concat(F.array(F.lit(" ")), "w")).alias("p", "raw"))
    return d.select("rk", "doc_id", "w", "n", (F.col("p") - 1).alias("pos"), lower(F.col("raw")).alias("word"))


def _blocks(windows: DataFrame, column: str, p: WindowParams) -> int:
    total = windows.agg(F.coalesce(F.sum(F.octet_length(column) + 64), F.lit(0))).first()[0]
    return max(1, -(-total // p.block_bytes))


def _part(df: DataFrame, column: str, k: int, blocks: int) -> DataFrame:
    return df if blocks == 1 else df.where(F.pmod(F.xxhash64(column), F.lit(blocks)) == k)


def rarity(docs: DataFrame, vocabulary: DataFrame, p: WindowParams) -> DataFrame:
    """``word, n``: occurrences in the documents of the words of ``vocabulary(word)``."""
    words = docs.select(F.explode(words_of(F.col("text"))).alias("raw")).select(lower(F.col("raw")).alias("word"))
    blocks = _blocks(vocabulary, "word", p)
    counted = None
    for k in range(blocks):  # a block is at most block_bytes
        part = F.broadcast(_part(vocabulary, "word", k, blocks))
        c = words.join(part, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        counted = c if counted is None else counted.unionByName(c)
    return counted


def prefix_windows(docs: DataFrame, benchmark: DataFrame, p: WindowParams) -> DataFrame:
    """Windows that can occur, each with its rarest word and that word's place."""
    windows = materialize(item_windows(benchmark, p), "bench-windows")
    vocabulary = materialize(windows.select(F.explode("words").alias("word")).distinct(), "bench-words")
    counts = materialize(rarity(docs, vocabulary, p), "bench-rarity")
    placed = windows.select("window", F.size("words").alias("len"), F.posexplode("words").alias("off", "word")).join(counts, "word", "left")
    rarest = (placed.groupBy("window", "len").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "word")).alias("r"))
              .where("r.n > 0").select("window", "len", F.col("r.off").alias("off"), F.col("r.word").alias("key")))
    return materialize(rarest.join(windows.select("window", "items"), "window"), "bench-prefixes")


def occurrences(docs: DataFrame, windows: DataFrame, p: WindowParams) -> DataFrame:
    """``rk, doc_id, n, pos, start, len, items``: a head row (pos -1) for each document and
    a row for each occurrence of a window."""
    blocks = _blocks(windows, "window", p)
    words = _exploded(docs)
    out = None
    for k in range(blocks):  # a block is at most block_bytes
        part = F.broadcast(_part(windows, "window", k, blocks))
        start = F.col("pos") - F.col("off")
        span = lower(F.array_join(F.slice("w", start + 1, F.col("len")), " "))
        match = (F.col("word") == F.col("key")) & (start >= 0) & (start + F.col("len") <= F.col("n")) & (span == F.col("window"))
        found = (words.join(part, match, "left").where((F.col("pos") == -1) | F.col("key").isNotNull())
                 .select("rk", "doc_id", "n", "pos", start.alias("start"), "len", "items"))
        out = found if out is None else out.unionByName(found.where("pos >= 0"))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, params: WindowParams = WindowParams()) -> DataFrame:
    """``rk`` (row position), ``doc_id, n_words, n_hit, n_items, items, contaminated`` of every row."""
    p = params
    docs = docs.select(F.monotonically_increasing_id().alias("rk"), "doc_id", "text")
    found = occurrences(docs, prefix_windows(docs, benchmark, p), p)
    head = F.col("pos") == -1
    per = found.groupBy("rk").agg(
        F.max(F.when(head, F.col("doc_id"))).alias("doc_id"), F.max("n").cast("long").alias("n_words"),
        F.collect_set(F.when(~head, F.struct("start", "len"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(~head, F.col("items")))))).alias("items"))
    begin = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end"))
    hit = F.aggregate(F.array_sort("spans"), begin, lambda a, s: F.struct(
        (a["hit"] + F.greatest(F.lit(0), s["start"] + s["len"] - F.greatest(a["end"], s["start"]))).alias("hit"),
        F.greatest(a["end"], s["start"] + s["len"]).alias("end")), lambda a: a["hit"])
    per = per.withColumn("n_hit", hit.cast("long"))
    return per.select("rk", "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                      ((F.col("n_hit") > 0) & (1000 * F.col("n_hit") >= p.per_mille * F.col("n_words"))).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, params: WindowParams = WindowParams()) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    bad = contamination(docs, benchmark, params).where("contaminated").select(F.col("rk").alias("__rk"))
    return docs.withColumn("__rk", F.monotonically_increasing_id()).join(bad, "__rk", "left_anti").select(*docs.columns)

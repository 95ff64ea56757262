"""Shards of near-equal bytes by k-d splits at distributed weighted medians.

Every row has coordinates that depend on its text alone (log of its size, log of
its number of lines, characters per byte), so equal texts always fall into one
shard. A node is cut along the coordinate in which it is widest, measured against
the whole table, at the point of the order (coordinate, text hash) that divides
its bytes as its leaves divide; leaves hold the target bytes. The point is found
by weighted histograms that all nodes of a level share, refined around the
wanted weight until a bin holds one text; the cuts, a few numbers a node, are looked
up by node in a small broadcast table. Nodes that have become small (10,000 rows, or
a 4,096th of all, whichever is more) are cut by running sums instead, all of a level
in one shuffle by node. Each level writes a row's node as a column, so plans do not
grow with the number of shards.

DataFrame functions only. The driver sees at most 4,096 nodes a level, with at most
``bins`` sums of each a pass.

Defined cases: a null text has size 1 and is grouped with the empty text. A
single text heavier than a leaf keeps its shard to itself as far as cuts allow;
with fewer distinct texts than shards some shards stay empty. Repeated rows get
slots of their own. Null ids sort first within a shard. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialize, release, shuffle_tasks

DIMENSIONS = ("log_size", "log_lines", "chars_per_byte")


#: Nodes of more rows than this, and than a 4,096th of all, are cut by histograms; the
#: others lie within one task each.
LEAST_WINDOW_ROWS = 10_000
MOST_WIDE_NODES = 4096
#: Levels that are cut by windows in one job.
LEVELS_A_JOB = 4


def describe(docs: DataFrame) -> DataFrame:
    """Per row: its position ``rk``, first node, id, size, checksum, coordinates and tie."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text) + 1
    return docs.select(
        F.monotonically_increasing_id().alias("rk"), F.lit(0).alias("first"), "doc_id", size.cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.log(size.cast("double")).alias("log_size"),
        F.log((F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("double")).alias("log_lines"),
        ((F.length(text) + 1) / size).alias("chars_per_byte"),
        (F.pmod(F.xxhash64(text), F.lit(1 << 52)) / F.lit(float(1 << 52))).alias("tie"))


def _lookup(rows: DataFrame, entries: list[dict], schema: str) -> DataFrame:
    """A small table of numbers out of the driver, as part of the plan."""
    text = F.lit(json.dumps(entries))
    return rows.sparkSession.range(1).select(F.inline(F.from_json(text, f"array<struct<{schema}>>")))


def _along(dimension: Column) -> Column:
    """The coordinate that a node is cut along."""
    x = F.lit(None).cast("double")
    for i, name in enumerate(DIMENSIONS):
        x = F.when(dimension == i, F.col(name)).otherwise(x)
    return x


def _refine(rows: DataFrame, spans: dict, bins: int) -> dict:
    """One histogram pass. ``spans``: node -> (dimension, low, high, value or None); with a value
    the ties of the rows that have it are searched. Returns node -> [(weight, least, largest
    value)] in order: at most ``bins`` a node."""
    table = _lookup(rows, [{"first": n, "d": d, "low": low, "high": high, "at": at} for n, (d, low, high, at) in spans.items()],
                    "first int, d int, low double, high double, at double")
    x = _along(F.col("d"))
    value = F.when(F.col("at").isNull(), x).when(x == F.col("at"), F.col("tie"))
    width = F.col("high") - F.col("low")
    bin_of = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("low")) / width * bins), F.lit(bins - 1))).otherwise(0)
    here = rows.join(F.broadcast(table), "first").withColumn("value", value).where(F.col("value").between(F.col("low"), F.col("high")))
    got = here.groupBy("first", bin_of.alias("bin")).agg(F.sum("size").alias("w"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
    out: dict = {node: [] for node in spans}
    for r in sorted(got, key=lambda r: (r["first"], r["bin"])):
        out[r["first"]].append((r["w"], r["lo"], r["hi"]))
    return out


def _search(rows: DataFrame, spans: dict, wanted: dict, before: dict, bins: int) -> dict:
    """Per node the value at which the weight from ``before`` on reaches ``wanted``:
    node -> (value, weight below it, its weight)."""
    spans, found, before = dict(spans), {}, dict(before)
    while spans:
        for node, hist in _refine(rows, spans, bins).items():
            total, k = before[node], 0
            while k < len(hist) - 1 and total + hist[k][0] < wanted[node]:
                total += hist[k][0]
                k += 1
            w, lo, hi = hist[k]
            before[node] = total
            if lo == hi:
                found[node] = lo, total, w
                del spans[node]
            else:
                d, _, _, at = spans[node]
                spans[node] = d, lo, hi, at
    return found


def _widths() -> list[Column]:
    return [f(d).alias(f"{k}_{d}") for d in DIMENSIONS for k, f in (("lo", F.min), ("hi", F.max))]


def _step(left: Column) -> dict[str, Column]:
    """A row's node after the cut: its first shard and how many it has."""
    half = F.floor(F.col("count") / 2).cast("int")
    return {"first": F.when(left, F.col("first")).otherwise(F.col("first") + half).cast("int"),
            "count": F.when(left, half).otherwise(F.col("count") - half).cast("int")}


def _cut_wide(rows: DataFrame, extent: dict, most_rows: int, bins: int) -> DataFrame | None:
    """All nodes of more than ``most_rows`` rows cut once; None where there is none."""
    stats = rows.where(F.col("count") > 1).groupBy("first", "count").agg(F.count("*").alias("n"), F.sum("size").alias("w"), *_widths())
    stats = {r["first"]: r for r in stats.where(F.col("n") > most_rows).collect()}
    if not stats:
        return None
    widest = {n: max(range(len(DIMENSIONS)), key=lambda i, r=r: (r[f"hi_{DIMENSIONS[i]}"] - r[f"lo_{DIMENSIONS[i]}"]) / extent[DIMENSIONS[i]])
              for n, r in stats.items()}
    wanted = {n: r["w"] * (r["count"] // 2) / r["count"] for n, r in stats.items()}
    values = _search(rows, {n: (d, stats[n][f"lo_{DIMENSIONS[d]}"], stats[n][f"hi_{DIMENSIONS[d]}"], None) for n, d in widest.items()},
                     wanted, dict.fromkeys(widest, 0), bins)
    ties = _search(rows, {n: (widest[n], 0.0, 1.0, v) for n, (v, _, _) in values.items()},
                   wanted, {n: below for n, (_, below, _) in values.items()}, bins)
    cuts = [{"first": n, "d": widest[n], "v": values[n][0], "t": tie, "with_tie": abs(below + w - wanted[n]) < abs(below - wanted[n])}
            for n, (tie, below, w) in ties.items()]
    table = _lookup(rows, cuts, "first int, d int, v double, t double, with_tie boolean")
    x, tie = _along(F.col("d")), F.col("tie")
    left = (x < F.col("v")) | ((x == F.col("v")) & ((tie < F.col("t")) | ((tie == F.col("t")) & F.col("with_tie"))))
    cut = rows.join(F.broadcast(table), "first", "left")
    moved = _step(F.col("d").isNull() | left)
    return cut.select(*[c for c in rows.columns if c not in ("first", "count")],
                      moved["first"].alias("first"), F.when(F.col("d").isNull(), F.col("count")).otherwise(moved["count"]).cast("int").alias("count"))


def _cut_narrow(rows: DataFrame, extent: dict) -> DataFrame:
    """All nodes with several shards cut once, each within one task: the same cut, from
    running sums in the order of the node."""
    kept = rows.columns
    # rows of a finished shard are dealt evenly: nothing is asked of them, and there may be many
    rows = rows.withColumn("dealt", F.when(F.col("count") == 1, F.col("rk")).otherwise(-1))
    node = Window.partitionBy("first", "dealt")
    width = {d: (F.max(d).over(node) - F.min(d).over(node)) / extent[d] for d in DIMENSIONS}
    rows = rows.withColumns({f"w_{d}": x for d, x in width.items()} | {"wanted": F.sum("size").over(node) * F.floor(F.col("count") / 2) / F.col("count")})
    top = F.greatest(*[F.col(f"w_{d}") for d in DIMENSIONS])
    widest = F.lit(None).cast("int")
    for i in reversed(range(len(DIMENSIONS))):
        widest = F.when(F.col(f"w_{DIMENSIONS[i]}") == top, i).otherwise(widest)
    rows = rows.withColumn("x", _along(widest))
    rows = rows.withColumns({"upto": F.sum("size").over(node.orderBy("x", "tie").rangeBetween(Window.unboundedPreceding, Window.currentRow)),
                             "own": F.sum("size").over(Window.partitionBy("first", "dealt", "x", "tie"))})
    below, upto, wanted = F.col("upto") - F.col("own"), F.col("upto"), F.col("wanted")
    left = (upto < wanted) | ((below < wanted) & (F.abs(upto - wanted) < F.abs(below - wanted)))
    moved = _step(F.when(F.col("count") > 1, left).otherwise(F.lit(True)))
    return rows.select(*[c for c in kept if c not in ("first", "count")], moved["first"].alias("first"),
                       F.when(F.col("count") > 1, moved["count"]).otherwise(F.col("count")).cast("int").alias("count"))


def place(meta: DataFrame, shards: int, bins: int = 256, least_window_rows: int = LEAST_WINDOW_ROWS) -> DataFrame:
    """``meta`` with ``first``: the shard of each row, 0 to ``shards`` - 1."""
    rows = meta.withColumn("count", F.lit(shards))
    whole = meta.agg(F.count("*").alias("n"), *_widths()).first()
    if shards == 1 or whole["n"] == 0:
        return rows
    extent = {d: (whole[f"hi_{d}"] - whole[f"lo_{d}"]) or 1.0 for d in DIMENSIONS}
    most_rows, old = max(least_window_rows, whole["n"] // MOST_WIDE_NODES), None
    while (cut := _cut_wide(rows, extent, most_rows, bins)) is not None:
        rows = materialize(cut, "shard-nodes")
        if old is not None:
            release(old)
        old = rows
    levels = math.ceil(math.log2(rows.agg(F.max("count")).first()[0]))
    for level in range(levels):
        rows = _cut_narrow(rows, extent)
        if level % LEVELS_A_JOB == LEVELS_A_JOB - 1 and level < levels - 1:
            rows = materialize(rows, "shard-nodes")
            if old is not None:
                release(old)
            old = rows
    return rows


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row: as many
    shards as asked for, or as leaves of ``target_bytes`` need."""
    meta = materialize(describe(docs), "shard-meta")
    if shards is None:
        total = meta.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        shards = max(1, math.ceil(total / target_bytes))
    placed = place(meta, shards).select("rk", "doc_id", "size", "text_crc32", F.col("first").alias("shard"))
    n = shuffle_tasks(docs)
    # Slots: rank within the sorted run of a written partition, plus the rows of the shard in earlier ones.
    laid = materialize(placed.repartitionByRange(n, "shard", "doc_id", "rk").sortWithinPartitions("shard", "doc_id", "rk")
                       .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "shard-rows")
    runs = laid.groupBy("part", "shard").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # one row for each written partition and shard in it: at most partitions + shards rows
    runs = runs.select("part", "shard", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"))
    return laid.join(F.broadcast(runs), ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("at") + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

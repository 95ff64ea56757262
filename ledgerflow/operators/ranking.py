"""Places within a group without bringing a hot group into one task.

``row_number`` over a group needs all its rows in one task. Here rows are
range-partitioned by group and order together, so a hot group lies in several
neighbouring partitions; a row's place is its place in its own partition plus the
rows of its group in the partitions before. Only groups that cross a partition edge
have such rows, at most one a partition, so the offsets are a table of at most two
rows a partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators.merge import stabilize

_MASK = (1 << 33) - 1


def place_in_group(rows: DataFrame, group: list[str], order: list[str], name: str = "place", partitions: int | None = None) -> DataFrame:
    """``rows`` with ``name``: 1, 2, 3... in each group by ``order`` (ascending, nulls first).
    Rows equal in all of ``order`` are told apart arbitrarily but only once."""
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stabilize(rows.withColumn("_tie", F.monotonically_increasing_id()))  # sampled, then shuffled: read twice
    keys = [*group, *order, "_tie"]
    # in a sorted partition this id is the partition, then the position in it
    placed = stabilize(rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    g = F.struct(*group)
    edges = placed.groupBy("_part").agg(F.min_by(g, "_at").alias("_first"), F.max_by(g, "_at").alias("_last"))
    before = F.lag("_last").over(Window.orderBy("_part"))  # one row a partition
    crossing = edges.withColumn("_before", before).where(F.col("_before").eqNullSafe(F.col("_first"))).select(F.col("_first").alias("_group")).distinct()
    split = placed.withColumn("_group", g).join(F.broadcast(crossing), "_group", "left_semi")  # at most one group a partition
    counts = split.groupBy("_group", "_part").agg(F.count("*").alias("_n"))
    ahead = F.sum("_n").over(Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stabilize(counts.select(F.col("_group").alias("_g"), F.col("_part").alias("_p"), F.coalesce(ahead, F.lit(0)).alias("_ahead")))
    own = F.row_number().over(Window.partitionBy("_part", *group).orderBy("_at"))  # bounded by a partition
    numbered = placed.withColumn("_own", own)
    cond = (numbered["_part"] == offsets["_p"]) & F.struct(*[numbered[c] for c in group]).eqNullSafe(offsets["_g"])
    numbered = numbered.join(F.broadcast(offsets), cond, "left")
    return numbered.withColumn(name, F.col("_own") + F.coalesce("_ahead", F.lit(0))).drop("_tie", "_at", "_part", "_own", "_g", "_p", "_ahead")

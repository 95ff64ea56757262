"""Payment reconciliation: transactions and settled payments paired one to one.

The payment link of the events model attaches every settled payment of a (member,
amount, day) to every transaction of it. Here each takes part once: within a key the
first transaction pairs with the first payment, the second with the second, by time
and then id. What is left over is classed:

* ``matched`` -- a transaction and its payment;
* ``unpaid`` -- a transaction without one;
* ``surplus`` -- a payment of a key that has transactions, but fewer than payments;
* ``orphan`` -- a payment of a key without any transaction.

So every row of either input is in exactly one row of the result. Both inputs go into
one narrow table tagged by side; one shuffle by key serves the ranking, the count of
transactions and the pairing (an aggregation by key and rank). Keys with more than
``hot_rows`` rows would meet in one task: for these alone, ranks come from range
partitions (``place_in_group``) and the pairing shuffles by key and rank. There are
at most rows / ``hot_rows`` of such keys.

Defined cases: a row with a null member, amount or day matches nothing (``unpaid`` or
``orphan``) and is not shuffled. Null times come first in a key. Rows with equal ids
are rows of their own. Wide columns are not read; join them by id where needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.expressions import PAYMENT_SETTLED
from ledgerflow.operators.merge import stabilize
from ledgerflow.operators.ranking import place_in_group

KEY = ["member_id", "amount", "payment_date"]
# What rows are shuffled by. Grouping normalises a double anew each time, and a plan does not
# know that its rows still lie together; the text of it (0 for -0) is left as it is.
_BY = ["member_id", "amount_text", "payment_date"]
HOT_ROWS = 1_000_000
RECONCILED_COLUMNS = [*KEY, "place", "transaction_id", "posted_at", "payment_id", "settled_at", "match_class"]


def _sides(transactions: DataFrame, payments: DataFrame) -> DataFrame:
    null = lambda kind: F.lit(None).cast(kind)
    t = transactions.select("member_id", "amount", F.to_date("posted_at").alias("payment_date"), F.lit(False).alias("is_payment"),
                            F.col("posted_at").alias("at"), F.col("transaction_id").alias("id"))
    p = payments.where(F.col("payment_status") == PAYMENT_SETTLED).select(
        "member_id", "amount", F.col("scheduled_date").alias("payment_date"), F.lit(True).alias("is_payment"),
        F.col("settled_at").alias("at"), F.col("payment_id").alias("id"))
    return t.unionByName(p).withColumn("amount_text", (F.col("amount") + F.lit(0.0)).cast("string"))


def _paired(ranked: DataFrame) -> DataFrame:
    """One row a key and place; ``owed`` holds the transactions of the key."""
    said = lambda payment, c: F.max(F.when(F.col("is_payment") == payment, F.col(c)))
    seen = lambda payment: F.max(F.col("is_payment") == payment)
    pairs = ranked.groupBy(*_BY, "place").agg(
        F.max("amount").alias("amount"), said(False, "id").alias("transaction_id"), said(False, "at").alias("posted_at"), said(True, "id").alias("payment_id"),
        said(True, "at").alias("settled_at"), seen(False).alias("has_tx"), seen(True).alias("has_pay"), F.max("owed").alias("owed"))
    return pairs.select(*RECONCILED_COLUMNS[:-1], F.when(F.col("has_tx") & F.col("has_pay"), "matched").when(F.col("has_tx"), "unpaid")
                        .when(F.col("owed") > 0, "surplus").otherwise("orphan").alias("match_class"))


def reconcile(transactions: DataFrame, payments: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Staged transactions and payments paired: ``RECONCILED_COLUMNS``."""
    sides = stabilize(_sides(transactions, payments))  # narrow, and read for the counts and for the ranks
    complete = F.col("member_id").isNotNull() & F.col("amount").isNotNull() & F.col("payment_date").isNotNull()
    mine = lambda payment, c: F.when(F.col("is_payment") == payment, F.col(c))
    alone = sides.where(~complete).select(*KEY, F.lit(None).cast("long").alias("place"), mine(False, "id").alias("transaction_id"),
                                          mine(False, "at").alias("posted_at"), mine(True, "id").alias("payment_id"), mine(True, "at").alias("settled_at"),
                                          F.when(F.col("is_payment"), "orphan").otherwise("unpaid").alias("match_class"))
    sides = sides.where(complete)
    hot = sides.groupBy(*_BY).agg(F.count("*").alias("n"), F.count_if(~F.col("is_payment")).alias("owed")).where(F.col("n") > hot_rows).drop("n")
    hot = stabilize(hot)
    # the wider window first, so that its shuffle by key serves the ranks and the pairs too
    owed = F.count_if(~F.col("is_payment")).over(Window.partitionBy(*_BY))
    place = F.row_number().over(Window.partitionBy(*_BY, "is_payment").orderBy("at", "id")).cast("long")
    if hot.isEmpty():
        return _paired(sides.withColumn("owed", owed).withColumn("place", place)).unionByName(alone)
    cold = sides.join(F.broadcast(hot), _BY, "left_anti")  # at most rows / hot_rows keys
    split = place_in_group(sides.join(F.broadcast(hot), _BY), [*_BY, "is_payment"], ["at", "id"])
    return _paired(cold.withColumn("owed", owed).withColumn("place", place)).unionByName(_paired(split)).unionByName(alone)


def reconciliation_totals(reconciled: DataFrame, day: str = "payment_date") -> DataFrame:
    """Per day and class: rows, transactions, payments, and days from posting to settlement."""
    lag = F.date_diff(F.to_date("settled_at"), F.to_date("posted_at"))
    return reconciled.groupBy(day, "match_class").agg(
        F.count("*").alias("pairs"), F.count("transaction_id").alias("transactions"), F.count("payment_id").alias("payments"),
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("decimal(18,2)").alias("amount"), F.max(lag).cast("long").alias("longest_lag_days"))

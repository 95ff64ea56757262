"""Member context: each event gets the version of its member that was valid on its day.

Versions carry half-open validity intervals of days. They are resolved once for each
distinct (member, day) of the events: both sides are cut into buckets of
``bucket_days``, so the interval join is an equi-join on (member, bucket) with the
exact bounds as a filter, and the winner is taken by a partial aggregation. A hot
member asks at most once a day, whatever its number of events. The events then meet
the resolved days in an equi-join on (member, day); a side is broadcast only where
adaptive execution measures it small, hot days are split by the skew rule, and events
without member or day carry a salted key.

Defined cases (``member_status``): ``known``; ``gap`` where the member has versions
but none on that day; ``unknown`` where it has none; ``no_member`` and ``no_date``
where the event lacks them. A null ``valid_from`` is open to the past, a null
``valid_to`` to the future; an interval that ends before it begins holds no day. Where
versions overlap the one that began last counts, of those the greatest version id.
Repeated versions change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.merge import stabilize

VERSION_COLUMNS = ["member_id", "version_id", "valid_from", "valid_to"]
BUCKET_DAYS = 32


def _bucket(day: Column, bucket_days: int) -> Column:
    return F.floor(F.unix_date(day) / bucket_days)


def valid_versions(asked: DataFrame, versions: DataFrame, attributes: list[str], bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """``member_id, day, version_id, <attributes>`` of the distinct (member_id, day) in ``asked``
    that a version covers. ``asked`` is read twice, so it should be a written table."""
    first, last = asked.agg(F.min("day"), F.max("day")).first()
    if first is None:
        return asked.select("member_id", "day").join(versions.select("member_id", "version_id", *attributes).limit(0), "member_id")
    begins = F.greatest(F.coalesce("valid_from", F.lit(first)), F.lit(first))
    ends = F.least(F.coalesce(F.date_sub("valid_to", 1), F.lit(last)), F.lit(last))  # the last day it holds
    held = versions.where(F.col("member_id").isNotNull() & (begins <= ends)).select(
        F.col("member_id").alias("_member"), "valid_from", "version_id", *attributes, begins.alias("_begins"), ends.alias("_ends"),
        F.explode(F.sequence(_bucket(begins, bucket_days), _bucket(ends, bucket_days))).alias("_bucket"))
    days = asked.withColumn("_at", _bucket(F.col("day"), bucket_days))
    found = days.join(held, (days["member_id"] == held["_member"]) & (days["_at"] == held["_bucket"])
                      & F.col("day").between(F.col("_begins"), F.col("_ends")))
    best = F.max_by(F.struct("version_id", *attributes), F.struct("valid_from", "version_id", *attributes))
    return found.groupBy("member_id", "day").agg(best.alias("best")).select("member_id", "day", "best.*")


def with_member_context(events: DataFrame, versions: DataFrame, attributes: list[str], day: str = "event_date",
                        row_key: str = "transaction_id", bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """``events`` with ``member_version, <attributes prefixed by member_>, member_status``."""
    has = F.col("member_id").isNotNull() & F.col(day).isNotNull()
    asked = stabilize(events.where(has).select("member_id", F.col(day).alias("day")).distinct())
    valid = valid_versions(asked, versions, attributes, bucket_days).withColumn("_known", F.lit(True))
    members = versions.where(F.col("member_id").isNotNull()).select("member_id").distinct().withColumn("_listed", F.lit(True))
    resolved = asked.join(members, "member_id", "left").join(valid, ["member_id", "day"], "left")
    named = {a: a if a.startswith("member_") else f"member_{a}" for a in attributes}
    resolved = resolved.select(F.col("member_id").alias("_m"), F.col("day").alias("_d"), "_known", "_listed",
                               F.col("version_id").alias("member_version"), *[F.col(a).alias(f"_a_{b}") for a, b in named.items()])
    salted = F.concat(F.lit("\u0000"), F.xxhash64(row_key).cast("string"))  # no member begins like this
    e = events.withColumn("_key", F.when(has, F.col("member_id")).otherwise(salted))
    e = e.join(resolved, (e["_key"] == resolved["_m"]) & (e[day] == resolved["_d"]), "left")
    status = (F.when(F.col("member_id").isNull(), "no_member").when(F.col(day).isNull(), "no_date").when(F.col("_known"), "known")
              .when(F.col("_listed"), "gap").otherwise("unknown"))
    return e.select(*events.columns, "member_version", *[F.col(f"_a_{b}").alias(b) for b in named.values()], status.alias("member_status"))

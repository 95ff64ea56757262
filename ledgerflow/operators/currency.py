"""Amounts in one currency: the latest rate on or before the day of each transaction.

Rates are looked up once for each distinct (currency, day) of the transactions, a
set that partial aggregation shrinks to currencies x days before it is shuffled. In
one sorted pass over these days and the rate days together, ``last(rate)`` carries
the newest rate forward, so no rate is copied to the days it stays valid. The
transactions then meet the looked-up days in an equi-join whose small side adaptive
execution broadcasts only by its measured size; beyond that a hot currency day is
split by the skew rule. Rows that need no rate carry a salted key, as unmatched
rows would otherwise all hash to one reducer.

Defined cases (``rate_status``): ``base`` for the base currency (rate 1);
``exact`` and ``carried`` for a rate of that day or an older one; ``stale`` where
the newest rate is older than ``max_age_days`` (no amount); ``missing`` where no rate
is as old as the transaction, unknown currencies included; ``no_currency`` and
``no_date`` where the transaction lacks them. Of several rates for a day the one
published last counts, of those published at once the greatest; rates that are null,
not finite or not positive are no rates. A null amount stays null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The currency that amounts are converted to.
BASE_CURRENCY = "USD"
RATE_COLUMNS = ["currency_code", "rate_date", "rate", "published_at"]
CONVERTED_COLUMNS = ["fx_rate", "fx_rate_date", "fx_rate_status", "amount_base"]


def daily_rates(rates: DataFrame) -> DataFrame:
    """``currency_code, rate_date, rate``: one valid rate a currency and day."""
    good = (F.col("rate") > 0) & (F.col("rate") < F.lit(float("inf"))) & F.col("currency_code").isNotNull() & F.col("rate_date").isNotNull()
    newest = F.max(F.struct("published_at", "rate"))["rate"]
    return rates.where(good).groupBy("currency_code", "rate_date").agg(newest.alias("rate"))


def rates_on(days: DataFrame, rates: DataFrame) -> DataFrame:
    """``currency_code, day, rate, rate_date`` for distinct (currency_code, day): the latest
    rate on or before the day, null where there is none."""
    known = daily_rates(rates).select("currency_code", F.col("rate_date").alias("day"), "rate", "rate_date")
    asked = days.select("currency_code", "day", F.lit(None).cast("double").alias("rate"), F.lit(None).cast("date").alias("rate_date"))
    both = known.withColumn("asked", F.lit(False)).unionByName(asked.withColumn("asked", F.lit(True)))
    so_far = (Window.partitionBy("currency_code").orderBy("day", "asked")  # a day's own rate sorts before the question
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = [F.last(c, ignorenulls=True).over(so_far).alias(c) for c in ("rate", "rate_date")]
    return both.select("currency_code", "day", "asked", *carried).where("asked").drop("asked")


def to_base_currency(transactions: DataFrame, rates: DataFrame, day: Column | str = "event_date", base: str = BASE_CURRENCY,
                     max_age_days: int | None = None, row_key: str = "transaction_id") -> DataFrame:
    """``transactions`` with ``fx_rate, fx_rate_date, fx_rate_status, amount_base``."""
    day = F.col(day) if isinstance(day, str) else day
    own = F.col("currency_code")
    needs = own.isNotNull() & (own != base) & day.isNotNull()
    asked = transactions.where(needs).select("currency_code", day.alias("day")).distinct()
    found = rates_on(asked, rates).select(F.col("currency_code").alias("_fx_currency"), F.col("day").alias("_fx_day"),
                                          F.col("rate").alias("_fx_rate"), F.col("rate_date").alias("_fx_rate_date"))
    salted = F.concat(F.lit("\u0000"), F.xxhash64(row_key).cast("string"))  # no currency begins like this
    t = transactions.withColumns({"_key": F.when(needs, own).otherwise(salted), "_day": day})
    t = t.join(found, (t["_key"] == found["_fx_currency"]) & (t["_day"] == found["_fx_day"]), "left")
    age = F.date_diff("_day", "_fx_rate_date")
    stale = F.lit(False) if max_age_days is None else age > max_age_days
    status = (F.when(own.isNull(), "no_currency").when(own == base, "base").when(F.col("_day").isNull(), "no_date")
              .when(F.col("_fx_rate").isNull(), "missing").when(stale, "stale").when(age == 0, "exact").otherwise("carried"))
    t = t.withColumn("fx_rate_status", status)
    used = F.col("fx_rate_status").isin("exact", "carried")
    rate = F.when(F.col("fx_rate_status") == "base", F.lit(1.0)).when(used, F.col("_fx_rate"))
    t = t.withColumns({"fx_rate": rate, "fx_rate_date": F.when(used | (F.col("fx_rate_status") == "stale"), F.col("_fx_rate_date"))})
    return t.withColumn("amount_base", F.col("amount") * F.col("fx_rate")).select(*transactions.columns, *CONVERTED_COLUMNS)

"""Data-quality rules and the post-run gate.

Row-level rules (not-null, accepted values, expression checks) of one table
are evaluated together in a single aggregation pass (``count_if`` per rule,
map-side partial aggregation, one tiny shuffle). A uniqueness rule needs a
group-by on its key (one shuffle per rule) and counts the rows whose key
occurs more than once. The result is a small violations DataFrame; the gate
raises when any rule failed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Rule:
    kind: str                     # not_null | accepted_values | unique | expression
    columns: list[str]
    values: list = field(default_factory=list)
    expr: Column | None = None    # for kind == "expression": rows that FAIL
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or f"{self.kind}"


def not_null(col: str) -> Rule:
    return Rule("not_null", [col])


def accepted_values(col: str, values: list) -> Rule:
    return Rule("accepted_values", [col], list(values))


def unique(*cols: str) -> Rule:
    return Rule("unique", list(cols))


def failing_when(name: str, cond: Column, cols: list[str] | None = None) -> Rule:
    return Rule("expression", cols or [], expr=cond, name=name)


def _row_fail(rule: Rule) -> Column:
    if rule.kind == "not_null":
        return F.col(rule.columns[0]).isNull()
    if rule.kind == "accepted_values":
        c = F.col(rule.columns[0])
        return c.isNotNull() & ~c.isin(*rule.values)
    if rule.kind == "expression":
        return F.coalesce(rule.expr, F.lit(False))
    raise ValueError(rule.kind)


def evaluate(df: DataFrame, table: str, rules: list[Rule],
             partition_col: str | None = None, partitions: list | None = None) -> DataFrame:
    """Violations: (table_name, rule, column_name, failing_rows).

    With ``partitions`` only those values of ``partition_col`` are checked:
    after an incremental run that is exactly what changed, and uniqueness of
    a key that determines its partition is a per-partition property.
    """
    spark = df.sparkSession
    if partition_col is not None and partitions is not None:
        vals = [v for v in partitions if v is not None]
        cond = F.col(partition_col).isin(vals) if vals else F.lit(False)
        if len(vals) < len(partitions):
            cond = cond | F.col(partition_col).isNull()
        df = df.where(cond)
    row_rules = [r for r in rules if r.kind != "unique"]
    parts: list[DataFrame] = []
    if row_rules:
        counts = df.agg(*[F.count_if(_row_fail(r)).alias(f"r{i}")
                          for i, r in enumerate(row_rules)])
        stack = ", ".join(f"'{r.label}', '{','.join(r.columns)}', r{i}"
                          for i, r in enumerate(row_rules))
        parts.append(counts.selectExpr(
            f"stack({len(row_rules)}, {stack}) AS (rule, column_name, failing_rows)"))
    for r in rules:
        if r.kind != "unique":
            continue
        dup = (df.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("_n"))
                 .where(F.col("_n") > 1)
                 .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("failing_rows")))
        parts.append(dup.select(F.lit(r.label).alias("rule"),
                                F.lit(",".join(r.columns)).alias("column_name"),
                                "failing_rows"))
    if not parts:
        return spark.createDataFrame([], "table_name string, rule string, column_name string, "
                                         "failing_rows long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(table).alias("table_name"), "rule", "column_name",
                      F.col("failing_rows").cast("long").alias("failing_rows"))


class QualityGateError(RuntimeError):
    pass


def gate(violations: DataFrame) -> None:
    """Fail the run when any rule has failing rows."""
    bad = violations.where(F.col("failing_rows") > 0).collect()   # one row per rule
    if bad:
        detail = "; ".join(f"{r.table_name}.{r.column_name} {r.rule}: {r.failing_rows}"
                           for r in bad)
        raise QualityGateError(f"data-quality checks failed: {detail}")


# Transaction statuses accepted downstream.
TRANSACTION_STATUSES = ["APPROVED", "DECLINED", "PENDING"]


def events_rules() -> list[Rule]:
    from ledgerflow.functions.expressions import (
        GEO_DOMESTIC, GEO_INTERNATIONAL, TIER_HIGH, TIER_LOW, TIER_MEDIUM,
    )
    return [
        not_null("transaction_id"), not_null("event_key"), not_null("member_id"),
        accepted_values("geo_type", [GEO_INTERNATIONAL, GEO_DOMESTIC]),
        accepted_values("amount_tier", [TIER_HIGH, TIER_MEDIUM, TIER_LOW]),
        accepted_values("transaction_status", TRANSACTION_STATUSES),
        accepted_values("payment_status", ["SETTLED"]),
        unique("event_key", "payment_id"),
    ]


def daily_rules(published_key: bool = False) -> list[Rule]:
    """Rules of the daily fact. The published ``daily_key`` repeats where one card id
    spans several members, so its uniqueness is reported on request and gates nothing."""
    rules = [not_null("daily_key"), not_null("event_date")]
    if published_key:
        rules.append(unique("daily_key"))
    return rules + [
        unique("event_date", "card_id", "member_id", "geo_type"),
        failing_when("approved_plus_declined", F.col("approved_transactions")
                     + F.col("declined_transactions") != F.col("total_transactions"),
                     ["total_transactions"]),
    ]


def load_rules() -> list[Rule]:
    """Reject accounting on a raw table (J5): rows flagged as errors."""
    return [failing_when("rejected_rows", F.col("is_error"), ["is_error"])]

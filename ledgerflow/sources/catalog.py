"""Catalog registration of written tables and partition discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def register_partitioned_table(spark: SparkSession, name: str, path: str,
                               schema: T.StructType, partition_cols: list[str]) -> DataFrame:
    """External Parquet table over ``path``; partitions found by a recovery scan.

    Equivalent of an hourly crawler: re-running picks up partitions written
    since the last call.
    """
    data_cols = [f for f in schema.fields if f.name not in partition_cols]
    part_cols = [schema[c] for c in partition_cols]
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data_cols + part_cols)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"PARTITIONED BY ({', '.join(partition_cols)}) LOCATION '{path}'")
    spark.catalog.recoverPartitions(name)
    return spark.table(name)


def partitions(spark: SparkSession, name: str) -> DataFrame:
    """Partition list as recorded in the catalog."""
    return spark.sql(f"SHOW PARTITIONS {name}")

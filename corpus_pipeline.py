"""Corpus preparation: quality rules, line dedup, near-dedup, decontamination, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor
kept. All but the last return the columns of ``documents``; the last returns the
token ids of every text that is left, as digests. ``run`` writes each stage's
rows to the shared folder and reads them back for the next one.

Defined cases: as in the operators; a null text fails the quality rules, so no
later stage of a run sees one. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import byte_bpe, decontamination, line_dedup, near_duplicates, quality_rules
from ledgerflow.llm.common import materialize, table
from ledgerflow.llm.queries import PATTERN, VOCABULARY

#: Word shingles of the near-duplicate stage.
NEAR = near_duplicates.MinHashParams(shingle=5)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines leave the texts; ``n_chars`` follows."""
    params = line_dedup.LineParams(added=("__n_lines", "__n_dropped"))
    out = line_dedup.dedup_lines(docs, params)
    return out.withColumn("n_chars", F.when(F.col("__n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
                          .cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return near_duplicates.keep_one(docs, NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, checked by decoding."""
    return byte_bpe.round_trip(docs, VOCABULARY, PATTERN)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_copies),
          ("decontamination", decontaminate), ("byte_bpe", encode)]

#: Token ids are beyond SQL: the tests hold the rows against a plain run of the same rules.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

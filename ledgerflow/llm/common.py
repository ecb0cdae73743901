"""Helpers shared by the operators: reading, storing intermediate tables, words."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import ensure_checkpoint_dir

TEXTS_A_BATCH = 1000  # rows of an Arrow batch that carries whole texts
# One word between white space, as a Java regular expression.
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage: what follows reads the files, so a lost executor costs
    only its own tasks. Every call writes a folder of its own.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerflow-llm/{uuid.uuid4().hex}/{name}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts_by_arrow(documents: DataFrame) -> DataFrame:
    """``documents``, in a session whose Arrow batches hold few rows.

    The default of 10,000 rows is made for numbers; with whole texts it holds tens of
    MB several times over in the JVM and in the Python worker of every task.
    """
    documents.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_A_BATCH))
    return documents


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def spaced_words(column: str = "text") -> Column:
    """Number of white-space separated words; 0 for null."""
    return F.regexp_count(text_or_empty(column), F.lit(SPACED_WORD)).cast("long")

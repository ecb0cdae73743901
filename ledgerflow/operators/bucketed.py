"""Tables bucketed by a key: joins and groupings on it read them without an exchange (J1).

A bucketed table is dealt by its key once, when it is written; every later join on
the key finds both sides already together. The buckets are the hash partitions of
``HashPartitioning``, so tables of the same number of buckets fit each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 64


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Write ``df`` as the external table ``table``, one sorted file a bucket; the table."""
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def attach(spark: SparkSession, table: str, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The table written at ``path`` in a session whose catalog does not know it."""
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"create table {table} ({columns}) using parquet clustered by ({by}) sorted by ({by}) into {buckets} buckets location '{path}'")
    return spark.table(table)

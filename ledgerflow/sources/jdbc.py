"""Warehouse reads and writes over JDBC (IO3, IO4).

Not exercised by the registered queries: they need a database server, and
an embedded database would be visible only to its own process.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_read(spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None, fetch_size: int = 10000) -> DataFrame:
    """Run a SQL text on the warehouse and return its rows as a DataFrame.

    With ``partition_column`` and bounds the read is split into
    ``num_partitions`` range queries that executors run in parallel (Spark
    needs ``dbtable`` rather than ``query`` for that, so the text is wrapped
    as a subquery)."""
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        return (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
                .option("lowerBound", lower).option("upperBound", upper)
                .option("numPartitions", num_partitions or 8).load())
    return r.option("query", query).load()


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                batch_size: int = 10000, staging_table: str | None = None) -> None:
    """Append rows in batches. Each partition commits on its own, so for an
    all-or-nothing load write to ``staging_table`` and promote it on the
    warehouse in one statement afterwards."""
    w = (df.write.format("jdbc").option("url", url).option("dbtable", staging_table or table)
         .option("batchsize", batch_size).option("isolationLevel", "READ_COMMITTED"))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode("append").save()

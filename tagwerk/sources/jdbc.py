"""Full read of a served table over JDBC, optionally range-partitioned.

Credentials come from the caller, never from source.  A driver jar for the
database must be on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, **extra) -> dict:
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               lower_bound=None, upper_bound=None, num_partitions: int | None = None,
               fetch_size: int = 10_000, **conn) -> DataFrame:
    """``SELECT *`` of ``table``; with ``partition_column`` read in parallel ranges."""
    opts = jdbc_options(url, table, fetchsize=fetch_size, **conn)
    if partition_column:
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions or 8))
    return spark.read.format("jdbc").options(**opts).load()

"""K5/K6: full refresh of a served table over JDBC.

``truncate`` keeps the table's DDL (keys, types) and empties it before the
insert.  This is the simple form and is not atomic: readers can see a partly
loaded table.  For an atomic switch, publish files with
``sinks.publish.publish_table`` or load a staging table and rename it in the
database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.jdbc import jdbc_options


def write_table(df: DataFrame, url: str, table: str, batch_size: int = 10_000,
                num_partitions: int | None = None, isolation_level: str = "READ_COMMITTED",
                **conn) -> None:
    opts = jdbc_options(url, table, truncate="true", batchsize=batch_size,
                        isolationLevel=isolation_level, **conn)
    if num_partitions:
        # caps concurrent connections; coalesce does not shuffle
        df = df.coalesce(num_partitions)
    df.write.format("jdbc").options(**opts).mode("overwrite").save()

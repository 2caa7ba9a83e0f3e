"""Writing tables to a relational database through Spark's JDBC sink."""

from pyspark.sql import DataFrame

from countcast.sources.database import BATCH_ROWS, Server


def save_table(df: DataFrame, server: Server, database: str | None, table: str, mode: str = "append",
               connections: int | None = None) -> None:
    """Appends to or overwrites a table. ``connections`` bounds how many tasks write at once.

    Each task writes in one transaction of its own. A task that is lost after its commit runs
    again, so keep the stored Parquet results as the reference copy.
    """
    options = {
        **server.options(database),
        "dbtable": table,
        "batchsize": str(BATCH_ROWS),
        **({"numPartitions": str(connections)} if connections else {}),
    }
    df.write.format("jdbc").options(**options).mode(mode).save()

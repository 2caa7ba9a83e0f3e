"""Reading tables from a relational database through Spark's JDBC source."""

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The database driver and the rows fetched or written per round trip.
DRIVER = "com.microsoft.sqlserver.jdbc.SQLServerDriver"
FETCH_ROWS = 100_000
BATCH_ROWS = 10_000


@dataclass(frozen=True)
class Server:
    """How to reach the server. Without a user, the login is that of the running process."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str = DRIVER
    extra: dict = field(default_factory=lambda: {"encrypt": "true", "trustServerCertificate": "true"})

    def options(self, database: str | None) -> dict:
        url = self.url if database is None else f"{self.url};databaseName={database}"
        if self.user is None:
            return {"url": f"{url};integratedSecurity=true", "driver": self.driver, **self.extra}
        return {"url": url, "driver": self.driver, "user": self.user, "password": self.password, **self.extra}


@dataclass(frozen=True)
class Split:
    """Reads a table over several connections, by ranges of a numeric, date or timestamp column.

    The bounds only shape the ranges: rows outside them, or without a value, are read too.
    """

    column: str
    lower: int | dt.date
    upper: int | dt.date
    parts: int

    def options(self) -> dict:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def subquery(table: str, fields: str, join: str | None = None, where: str | None = None) -> str:
    """The part of a table that the server should send, as a table expression."""
    clauses = [f"SELECT {fields}", f"FROM {table}"]
    if join:
        clauses.append(join)
    if where:
        clauses.append(f"WHERE {where}")
    return f"({' '.join(clauses)}) AS t"


def read_table(spark: SparkSession, server: Server, database: str | None, table: str, fields: str,
               join: str | None = None, where: str | None = None, split: Split | None = None) -> DataFrame:
    """Rows of a table; further filters and columns chosen on the result are pushed down too."""
    options = {
        **server.options(database),
        "dbtable": subquery(table, fields, join, where),
        "fetchsize": str(FETCH_ROWS),
        **(split.options() if split else {}),
    }
    return spark.read.format("jdbc").options(**options).load()
